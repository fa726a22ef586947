"""Salt columns.

A salt follows from the row and the number of its partition, so that a repeated task gives the
same ones, and equal copies of a row get different ones in different partitions.
"""

from pyspark.sql import Column, functions as F


def row_hash(*columns) -> Column:
    return F.xxhash64(*columns, F.spark_partition_id())


def row_salt(buckets: int, *columns) -> Column:
    """0 … buckets-1 by the hash of the given columns."""
    return F.pmod(row_hash(*columns), F.lit(buckets)).cast("int")


def all_salts(buckets: int) -> Column:
    """One output row per salt: the other side of a salted join."""
    return F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
