"""One row per key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

_RANK = "_rank"


def unique_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the highest `order` columns per key; a hash of the others breaks ties.

    The rank limit is applied on each side of the shuffle, so a hot key sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranking = [F.col(c).desc_nulls_last() for c in order]
    ranking += [F.xxhash64(*rest)] if rest else [F.lit(1)] if not order else []
    window = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
