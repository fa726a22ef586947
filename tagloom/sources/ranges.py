"""Tables of address ranges."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.functions.ip import ip_to_long

_BOUNDS = ("start_ip", "end_ip")


def read_ranges(spark: SparkSession, path, columns: str, fmt: str = "parquet",
                **options) -> DataFrame:
    """Columns `start_ip`, `end_ip` and those of the DDL string `columns`.

    In csv, the bounds may be numbers or dotted addresses.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    ddl = f"start_ip string, end_ip string, {columns}"
    table = spark.read.format(fmt).schema(ddl).options(**options).load(path)
    return table.withColumns({
        bound: F.coalesce(ip_to_long(F.col(bound)), F.col(bound).try_cast("bigint"))
        for bound in _BOUNDS})
