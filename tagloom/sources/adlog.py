"""Reading the raw ad log."""

from pyspark.sql import DataFrame, SparkSession, types as T

from tagloom.schema import AD_LOG

CORRUPT = "_corrupt_record"


def read_json_log(spark: SparkSession, path, schema: T.StructType | None = AD_LOG,
                  keep_corrupt: bool = False) -> DataFrame:
    """JSON lines with the declared schema; `schema=None` infers it with an extra pass.

    Lines that do not parse give rows of NULLs; `keep_corrupt` adds their text in a column.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if schema is None:
        return reader.json(path)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).json(path)
