"""An ad log and its side tables, derived from the test tables by fixed rules.

Every event is one log row. The rules are Spark SQL; `oracle.py` states them in DuckDB's SQL.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tagloom.functions.areas import request_key
from tagloom.operators.areas import distinct_coordinates
from tagloom.operators.skew import lookup_join
from tagloom.schema import AD_LOG, ODS

EXTRA = ("event_id", "user_id", "ts")
REGION = ("province", "city")
HISTORY_END = "2024-01-16"

RULES = {
    "sessionid": "event_id",
    "requestmode": "CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 1 END",
    "processnode": "1 + event_id % 3",
    "adplatformproviderid": "99990 + k",
    "iseffective": "if(k % 5 = 0, 0, 1)",
    "isbilling": "if(event_id % 7 = 0, 0, 1)",
    "isbid": "if(event_id % 3 = 0, 0, 1)",
    "iswin": "event_id % 2",
    "adorderid": "if(event_id % 11 = 0, 0, 199950 + k)",
    "adcreativeid": "199960 + k",
    "winprice": "bigint(round(value * 100))",
    "adpayment": "bigint(round(value * 80))",
    "channelid": "if(k % 20 = 0, '', string(123400 + k % 20))",
    "client": "1 + k % 6",
    "devicetype": "1 + k % 2",
    "device": "if(event_id % 17 = 0, NULL, 'DEV ' || event_id % 8)",
    "networkmannerid": "1 + k % 4",
    "networkmannername": "element_at(array('WIFI', '4G', '3G', '5G'), int(1 + k % 4))",
    "ispname": "element_at(array('移动', '联通', '电信', ''), int(1 + k % 4))",
    "appid": "'XRX' || (1 + k % 10)",
    "appname": "if(event_id % 4 = 0, NULL, 'App ' || (1 + k % 10))",
    "ip": "if(event_id % 29 = 0, NULL,"
          " concat_ws('.', 1 + k, user_id % 256, event_id % 256, 7))",
    "longitude": "if(user_id % 31 = 0, NULL, double(user_id * 7919 % 36000) / 100 - 180)",
    "latitude": "if(user_id % 31 = 0, NULL, double(user_id * 104729 % 18000) / 100 - 90)",
    "keywords": "concat_ws(',', event_type, 'w' || k % 3, event_type)",
    "age": "18 + user_id % 50",
    "sex": "user_id % 2",
    "androidid": "if(event_id % 3 = 0, 'A' || user_id, NULL)",
    "openudid": "if(event_id % 5 = 0, 'O' || (user_id - user_id % 2), NULL)",
    "mac": "if(event_id % 7 = 0, 'M' || (user_id - user_id % 10), NULL)",
    "idfa": "if(event_id % 11 = 0, 'D' || event_id, NULL)",
    "imei": "CASE event_id % 13 WHEN 1 THEN 'I' || user_id WHEN 2 THEN ' ' ELSE '' END",
}


def _rule(field: T.StructField) -> str:
    """Columns without a rule of their own get a value by their type."""
    if field.name in RULES:
        return RULES[field.name]
    if isinstance(field.dataType, T.StringType):
        return f"'{field.name}-' || event_id % 7"
    if isinstance(field.dataType, T.DecimalType):
        return "(event_id % 1000) / 100"
    return "event_id % 10"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def adlog(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named columns of the log. Customers are joined only if the region is asked for."""
    columns = columns or (*EXTRA, *ODS.names)
    # A generator, so that conditions on derived columns do not parse the JSON again.
    events = (table(spark, sf_dir, "events").select("*", F.json_tuple("props", "k").alias("k"))
              .withColumn("k", F.col("k").cast("bigint")))
    made = [F.expr(_rule(ODS[c])).cast(ODS[c].dataType).alias(c)
            for c in columns if c not in EXTRA and c not in REGION]
    rows = events.select(*EXTRA, *made)
    if set(columns) & set(REGION):
        customers = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("user_id"), "c_nationkey")
        rows = lookup_join(rows, customers, "user_id", spread=["event_id"])
        rows = rows.join(F.broadcast(_nations(spark, sf_dir)),
                         F.col("c_nationkey") == F.col("n_nationkey"), "left")
        rows = rows.withColumnsRenamed({"r_name": "province", "n_name": "city"})
    return rows.select(*columns)


def _nations(spark, sf_dir) -> DataFrame:
    """The 25 nations and their regions."""
    return table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as it arrives, without geo columns."""
    return adlog(spark, sf_dir, *AD_LOG.names)


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One range of addresses per nation; every fourth first octet is a gap."""
    nations = _nations(spark, sf_dir)
    n = F.col("n_nationkey").cast("bigint")
    return nations.select(
        ((1 + 4 * n) * (1 << 24)).alias("start_ip"), ((4 + 4 * n) * (1 << 24) - 1).alias("end_ip"),
        F.expr("if(n_nationkey % 5 = 0, n_name || '市', r_name || '省' || n_name || '市')")
        .alias("country"),
        F.expr("if(n_nationkey % 7 = 0, ' CZ88.NET', 'ISP' || n_nationkey % 3)").alias("area"),
        (13 * n).cast("double").alias("lon"), (3 * n).cast("double").alias("lat"))


def region_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ip_ranges(spark, sf_dir).select("start_ip", "end_ip", "country", "area")


def place_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ip_ranges(spark, sf_dir).select("start_ip", "end_ip", "lon", "lat")


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_coordinates(adlog(spark, sf_dir, "longitude", "latitude"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored service response for each coordinate pair of the log."""
    users = (adlog(spark, sf_dir, "longitude", "latitude", "user_id").dropna()
             .groupBy("longitude", "latitude").agg(F.min("user_id").alias("u")))
    response = F.expr("""
        CASE WHEN u % 23 = 0 THEN '' WHEN u % 19 = 0 THEN 'not json'
             WHEN u % 17 = 0 THEN '{"regeocode":{}}'
             ELSE '{"regeocode":{"addressComponent":{"businessAreas":['
                  || '{"id":"1","location":"0,0","name":"AREA' || u % 9 || '"},'
                  || '{"id":"2","location":"1,1","name":"AREA' || u % 4 || '"}]}}}' END""")
    return users.select("longitude", "latitude",
                        request_key(F.col("longitude"), F.col("latitude")).alias("location"),
                        response.alias("response"))


def app_names(spark: SparkSession) -> DataFrame:
    """Names of eight of the ten apps."""
    return spark.range(1, 9).select(F.concat(F.lit("XRX"), "id").alias("appid"),
                                    F.concat(F.lit("Dict "), "id").alias("appname"))
