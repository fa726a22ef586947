"""Small dictionaries kept as `key##value` text."""

from pyspark.sql import DataFrame, SparkSession, functions as F

SEPARATOR = "##"

# Codes of clients, networks and carriers.
DEVICE_CODES = {
    "1": "D00010001", "2": "D00010002", "3": "D00010003", "4": "D00010004",
    "WIFI": "D00020001", "4G": "D00020002", "3G": "D00020003", "2G": "D00020004",
    "NETWORKOTHER": "D00020005",
    "移动": "D00030001", "联通": "D00030002", "电信": "D00030003", "OPERATOROTHER": "D00030004",
}


def read_dictionary(spark: SparkSession, path, key: str, value: str) -> DataFrame:
    """One row per key; the last line of a key counts."""
    parts = F.split("value", SEPARATOR)
    lines = (spark.read.text(path)
             .select(F.monotonically_increasing_id().alias("_line"),
                     parts[0].alias(key), F.element_at(parts, -1).alias(value)))
    return lines.groupBy(key).agg(F.max_by(value, "_line").alias(value))


def device_codes(spark: SparkSession) -> DataFrame:
    """The built-in device dictionary, columns `value` and `code`."""
    entries = [F.lit(text) for entry in DEVICE_CODES.items() for text in entry]
    return spark.range(1).select(F.explode(F.create_map(*entries)).alias("value", "code"))
