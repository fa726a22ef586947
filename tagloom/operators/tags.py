"""User tags of a log row, as array columns of tag names."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.functions.predicates import non_blank
from tagloom.operators.skew import broadcast_join
from tagloom.schema import ID_COLUMNS

# Prefixes and labels of tags.
APP, DEVICE, CLIENT, CARRIER, NETWORK = "APP_", "DV_", "DT_", "ISP_", "NW_"
PROVINCE, CITY, CHANNEL, KEYWORD = "PV_", "CT_", "CN_", "KW_"
AGE, SEX, AREA = "AGE_", "SEX_", "BA_"
PHONE, TABLET = "手机", "平板"
FEMALE, MALE = "女", "男"
OTHER_CODE = "OTHER"


# -- lookups ------------------------------------------------------------------------

def fill_app_name(df: DataFrame, app_names: DataFrame) -> DataFrame:
    """Rows without `appname` get that of their `appid` in `app_names`, else the empty text."""
    names = app_names.select("appid", F.col("appname").alias("_listed"))
    listed = broadcast_join(df, names, "appid")
    return (listed.withColumn("appname", F.coalesce("appname", "_listed", F.lit("")))
            .drop("_listed"))


def with_codes(df: DataFrame, codes: DataFrame, default_code: str = OTHER_CODE) -> DataFrame:
    """Add `client_code`, `carrier_code` and `network_code` from the device dictionary."""
    sources = {"client_code": F.col("client").cast("string"),
               "carrier_code": F.col("ispname"),
               "network_code": F.col("networkmannername")}
    for name, source in sources.items():
        table = codes.select(F.col("value").alias("_value"), F.col("code").alias(name))
        df = (broadcast_join(df.withColumn("_value", source), table, "_value")
              .drop("_value")
              .withColumn(name, F.coalesce(name, F.lit(default_code))))
    return df


# -- tags, each kind an array; NULL stands for no tag -----------------------------------

def _tag(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def _listed(prefix: str, text: Column) -> Column:
    """One tag per word of a comma list; empty words become the bare prefix, which is removed."""
    prefixed = F.concat(F.lit(prefix), F.replace(text, F.lit(","), F.lit("," + prefix)))
    return F.array_except(F.split(prefixed, ","), F.array(F.lit(prefix)))


def app_tags() -> Column:
    return F.array(_tag(APP, F.col("appname")))


def device_tags(kind_prefix: str = NETWORK) -> Column:
    """Device, codes of client, carrier and network, and whether it is a phone or a tablet."""
    kind = F.when(F.col("devicetype") == 1, PHONE).when(F.col("devicetype").isNotNull(), TABLET)
    client = F.when(F.col("client").isNotNull(), F.col("client_code"))
    return F.array(_tag(DEVICE, F.col("device")), _tag(CLIENT, client),
                    _tag(CARRIER, F.col("carrier_code")), _tag(NETWORK, F.col("network_code")),
                    _tag(kind_prefix, kind))


def region_tags() -> Column:
    return F.array(_tag(PROVINCE, F.col("province")), _tag(CITY, F.col("city")))


def channel_tags() -> Column:
    return F.array(_tag(CHANNEL, F.col("channelid")))


def keyword_tags() -> Column:
    return _listed(KEYWORD, F.col("keywords"))


def age_tags() -> Column:
    return F.array(_tag(AGE, F.col("age")))


def sex_tags() -> Column:
    sex = F.col("sex").cast("string")
    return F.array(_tag(SEX, F.when(sex == "0", FEMALE).when(sex.isNotNull(), MALE)))


def area_tags() -> Column:
    return _listed(AREA, F.when(non_blank(F.col("areas")), F.col("areas")))


# Kinds of tags; app tags need `fill_app_name`, device tags `with_codes`, area tags `with_areas`.
TAG_KINDS: dict[str, Callable[[], Column]] = {
    "app": app_tags, "device": device_tags, "region": region_tags, "channel": channel_tags,
    "keyword": keyword_tags, "age": age_tags, "sex": sex_tags, "area": area_tags,
}


def row_tags(*kinds: str) -> Column:
    """Tags of the given kinds (default: all), each name once per row and without NULLs."""
    nothing = F.array(F.lit(None).cast("string"))
    arrays = [F.coalesce(TAG_KINDS[kind](), nothing) for kind in kinds or TAG_KINDS]
    return F.array_except(F.concat(*arrays), nothing)


def explode_tags(records: DataFrame, *keep) -> DataFrame:
    """One row per tag. The outer explode keeps Catalyst from computing the tags a second
    time in a condition on their number."""
    return (records.select(*keep, F.explode_outer("tags").alias("tag"))
            .where(F.col("tag").isNotNull()))


# -- identifiers --------------------------------------------------------------------

def row_ids(qualify: bool = False) -> Column:
    """Filled identifiers of a row, main one first; `qualify` puts the kind before each."""
    def identifier(name):
        text = F.concat(F.lit(f"{name}:"), F.col(name)) if qualify else F.col(name)
        return F.when(non_blank(F.col(name)), text)
    return F.array_compact(F.array(*[identifier(name) for name in ID_COLUMNS]))
