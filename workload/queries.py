"""One query per operator, over the whole tables of a scale-factor folder."""

import datetime as dt
import uuid

from pyspark.sql import DataFrame, functions as F, types as T

from tagloom.functions.areas import area_text
from tagloom.functions.dates import previous_suffix, suffix
from tagloom.functions.geohash import geohash
from tagloom.functions.ip import city_of, ip_to_long, is_private, long_to_ip, province_of
from tagloom.operators.areas import distinct_coordinates, with_areas
from tagloom.operators.bucketed import BucketedTable
from tagloom.operators.components import connected_components
from tagloom.operators.funnel import (REPORTS, ad_funnel, all_funnels, merged_funnels, partial_funnels,
                                      province_city_counts)
from tagloom.operators.history import cooled, decayed, merge_cooled
from tagloom.operators.identity import (extend_members, identified_rows, identity_edges, members_of,
                                        with_user)
from tagloom.operators.iprange import locate, with_ranges
from tagloom.operators.keyed import (KeyedTable, delete_rows, insert_rows, update_rows,
                                     upsert_rows)
from tagloom.operators.skew import (broadcast_join, hot_keys, join_filled_keys, lookup_join,
                                    salted_agg, salted_join, split_salted_join)
from tagloom.operators.tags import explode_tags, fill_app_name, row_ids, row_tags, with_codes
from tagloom.operators.unique import unique_by_key
from tagloom.operators.userrows import from_text, members_and_weights, to_text, user_rows
from tagloom.plans.daily import run_cooling_tags, run_etl, run_tags
from tagloom.plans.ods import build_ods, distinct_ips, ip_info, ip_regions
from tagloom.plans.tags import build_area_dictionary, build_tags, records
from tagloom.schema import ID_COLUMNS
from tagloom.session import Scratch
from tagloom.sources.adlog import read_json_log
from tagloom.sources.dictionaries import DEVICE_CODES, SEPARATOR, device_codes, read_dictionary
from tagloom.sources.ranges import read_ranges
from tagloom.sources.tables import DatedTables
from workload.adlog import (HISTORY_END, adlog, app_names, coordinates, place_ranges, raw_log,
                            region_ranges, responses, table)

QUERIES = {}
RUN_DATE = dt.date(2024, 1, 16)
_YESTERDAY = f"ts < TIMESTAMP '{HISTORY_END}'"
_TODAY = f"ts >= TIMESTAMP '{HISTORY_END}'"

FUNNEL_COLUMNS = ("requestmode", "processnode", "adplatformproviderid", "iseffective", "isbilling",
                  "isbid", "iswin", "adorderid", "adcreativeid", "winprice", "adpayment")


def query(function):
    """Register under the function's name; a trailing `_` only avoids hiding an import."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def _as_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else f.name for f in df.schema])


def _rounded(weights: DataFrame) -> DataFrame:
    return weights.select("user_id", "tag", F.round("weight", 6).alias("weight"))


# -- reports ------------------------------------------------------------------------

def _report(name):
    dimensions = REPORTS[name].dimensions

    def run(spark, sf_dir):
        return ad_funnel(adlog(spark, sf_dir, *dimensions, *FUNNEL_COLUMNS), *dimensions)
    return run


for _name in REPORTS:
    QUERIES[f"report_{_name}"] = _report(_name)


@query
def report_cost_by_payment(spark, sf_dir):
    """The channel report with cost taken from `adpayment`."""
    log = adlog(spark, sf_dir, "channelid", *FUNNEL_COLUMNS)
    return ad_funnel(log, "channelid", cost_column="adpayment")


@query
def report_province_city(spark, sf_dir):
    return province_city_counts(adlog(spark, sf_dir, "province", "city"))


@query
def report_suite(spark, sf_dir):
    """All reports in one pass."""
    dimensions = dict.fromkeys(d for r in REPORTS.values() for d in r.dimensions)
    return all_funnels(adlog(spark, sf_dir, *dimensions, *FUNNEL_COLUMNS))


@query
def report_partials(spark, sf_dir):
    """All reports out of the stored sums of three parts of the log; a late one adds its own."""
    dimensions = dict.fromkeys(d for r in REPORTS.values() for d in r.dimensions)
    log = adlog(spark, sf_dir, "ts", *dimensions, *FUNNEL_COLUMNS)
    scratch = Scratch(spark, "partials")
    parts = [scratch.save(partial_funnels(log.where(when)), f"part_{n}") for n, when in enumerate(
        ("hour(ts) < 8", "hour(ts) >= 8 AND minute(ts) < 50", "hour(ts) >= 8 AND minute(ts) >= 50"))]
    return merged_funnels(parts[0].unionByName(parts[1]).unionByName(parts[2]))


# -- sources and tables -------------------------------------------------------------

@query
def read_json_log_(spark, sf_dir):
    scratch = Scratch(spark, "json")
    raw_log(spark, sf_dir).write.json(scratch.path("log"))
    return _as_doubles(read_json_log(spark, scratch.path("log")))



@query
def write_read_roundtrip(spark, sf_dir):
    """A day of the log is written twice and read once."""
    tables = DatedTables(spark, Scratch(spark, "tables").folder)
    log = adlog(spark, sf_dir, "sessionid", "ip", "appid", "winprice")
    for _ in range(2):
        tables.write(log, "ods", RUN_DATE, ["sessionid"], partitions=3, check_keys=True)
    return _as_doubles(tables.read("ods", RUN_DATE))


@query
def unique_by_key_(spark, sf_dir):
    """The latest event of each user."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return unique_by_key(events, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type")



@query
def etl_unique_sessions(spark, sf_dir):
    """A log that came twice is stored once."""
    tables = DatedTables(spark, Scratch(spark, "tables").folder)
    log = raw_log(spark, sf_dir)
    run_etl(tables, RUN_DATE, log.unionByName(log), region_ranges(spark, sf_dir),
            place_ranges(spark, sf_dir))
    return _as_doubles(tables.read("ods", RUN_DATE))


@query
def table_suffix(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", suffix(F.col("ts")).alias("today"),
                         previous_suffix(F.col("ts")).alias("yesterday"))


# -- addresses ----------------------------------------------------------------------

@query
def distinct_ips_(spark, sf_dir):
    return distinct_ips(adlog(spark, sf_dir, "ip"))



@query
def ip_to_long_(spark, sf_dir):
    ips = distinct_ips(adlog(spark, sf_dir, "ip"))
    return ips.select("ip", ip_to_long(F.col("ip")).alias("number"))



@query
def long_to_ip_(spark, sf_dir):
    """Every event as an address spread over the 32-bit range, and back."""
    number = F.col("event_id") * 429497 % (1 << 32)
    return table(spark, sf_dir, "events").select(
        "event_id", long_to_ip(number).alias("ip"),
        ip_to_long(long_to_ip(number)).alias("number"))



@query
def ip_region_join(spark, sf_dir):
    return ip_regions(adlog(spark, sf_dir, "ip"), region_ranges(spark, sf_dir))


@query
def ip_lonlat_join(spark, sf_dir):
    found = locate(distinct_ips(adlog(spark, sf_dir, "ip")),
                   {"place": place_ranges(spark, sf_dir)})
    return found.select("ip", F.col("place")["lon"].alias("lon"), F.col("place")["lat"].alias("lat"))


@query
def ip_rows(spark, sf_dir):
    """All rows of the log with the records of both tables; no row is moved."""
    found = with_ranges(adlog(spark, sf_dir, "sessionid", "ip"),
                        {"region": region_ranges(spark, sf_dir), "place": place_ranges(spark, sf_dir)})
    return found.select("sessionid", "ip", F.col("region")["country"].alias("country"),
                        F.col("place")["lon"].alias("lon"))


@query
def ip_city(spark, sf_dir):
    """City per address; those of the private network get none."""
    info = ip_info(adlog(spark, sf_dir, "ip"), region_ranges(spark, sf_dir),
                   place_ranges(spark, sf_dir))
    return info.select("ip", F.when(~is_private(F.col("ip")), F.col("city")).alias("city"))


@query
def ip_range_files(spark, sf_dir):
    """Narrow, adjacent and overlapping ranges out of a text file, a private address, and texts that
    are no addresses."""
    scratch = Scratch(spark, "ranges")
    key = F.col("c_custkey").cast("bigint")
    narrow = _customers(spark, sf_dir).select(
        long_to_ip(key * 16).alias("start_ip"),
        # Up to 11 addresses, or into the next range.
        long_to_ip(key * 16 + 5 + key % 3 * 6).alias("end_ip"), F.col("c_name").alias("country"))
    narrow.write.csv(scratch.path("ranges"))
    ranges = read_ranges(spark, scratch.path("ranges"), "country string", "csv")
    number = F.col("event_id") * 7 % (1 << 21)
    texts = F.when(F.col("event_id") % 50 == 0, "192.168.0.7") \
        .when(F.col("event_id") % 50 == 1, F.concat(F.lit("1.2.3.999"), "event_id")) \
        .when(F.col("event_id") % 50 == 2, "").otherwise(long_to_ip(number))
    found = locate(table(spark, sf_dir, "events").select(texts.alias("ip")), {"range": ranges})
    return found.select("ip", F.when(~is_private(F.col("ip")), F.col("range")["country"])
                        .alias("country"))


@query
def split_region(spark, sf_dir):
    regions = ip_regions(adlog(spark, sf_dir, "ip"), region_ranges(spark, sf_dir))
    country = F.col("country")
    return regions.select("ip", "country", province_of(country).alias("province"),
                          city_of(country).alias("city"))


@query
def ods_enrich(spark, sf_dir):
    return _as_doubles(build_ods(raw_log(spark, sf_dir), region_ranges(spark, sf_dir),
                                 place_ranges(spark, sf_dir)))


# -- business areas -----------------------------------------------------------------

@query
def geohash8(spark, sf_dir):
    pairs = coordinates(spark, sf_dir)
    return pairs.select("longitude", "latitude",
                        geohash(F.col("longitude"), F.col("latitude")).alias("geohash"))


@query
def distinct_coords(spark, sf_dir):
    return distinct_coordinates(adlog(spark, sf_dir, "longitude", "latitude"))


@query
def parse_areas(spark, sf_dir):
    return responses(spark, sf_dir).select(
        "longitude", "latitude", area_text(F.col("response")).alias("areas"))


@query
def area_dictionary(spark, sf_dir):
    return build_area_dictionary(adlog(spark, sf_dir, "longitude", "latitude"),
                                 responses(spark, sf_dir))


def _areas(spark, sf_dir) -> DataFrame:
    return Scratch(spark, "areas").save(area_dictionary(spark, sf_dir), "areas")


# -- tags ---------------------------------------------------------------------------

@query
def app_name_fill(spark, sf_dir):
    """Names from a dictionary file; of a repeated app id the last line counts."""
    scratch = Scratch(spark, "dictionary")
    lines = app_names(spark).select(F.concat_ws(SEPARATOR, "appid", "appname"))
    outdated = app_names(spark).select(F.concat_ws(SEPARATOR, "appid", F.lit("outdated")))
    outdated.unionByName(lines.toDF(*outdated.columns)).coalesce(1).write.text(scratch.path("apps"))
    names = read_dictionary(spark, scratch.path("apps"), "appid", "appname")
    return fill_app_name(adlog(spark, sf_dir, "sessionid", "appid", "appname"), names).select(
        "sessionid", "appid", "appname")


@query
def device_code(spark, sf_dir):
    scratch = Scratch(spark, "dictionary")
    lines = [(SEPARATOR.join(entry),) for entry in DEVICE_CODES.items()]
    spark.createDataFrame(lines, "line string").write.text(scratch.path("devices"))
    codes = read_dictionary(spark, scratch.path("devices"), "value", "code")
    log = adlog(spark, sf_dir, "sessionid", "client", "ispname", "networkmannername")
    return with_codes(log, codes).select("sessionid", "client_code", "carrier_code", "network_code")


def _tags(rows: DataFrame, *kinds: str) -> DataFrame:
    return explode_tags(rows.select("sessionid", row_tags(*kinds).alias("tags")), "sessionid")


@query
def tag_app(spark, sf_dir):
    log = adlog(spark, sf_dir, "sessionid", "appid", "appname")
    return _tags(fill_app_name(log, app_names(spark)), "app")


@query
def tag_device(spark, sf_dir):
    log = adlog(spark, sf_dir, "sessionid", "device", "client", "ispname", "networkmannername",
                "devicetype")
    return _tags(with_codes(log, device_codes(spark)), "device")


@query
def tag_region(spark, sf_dir):
    return _tags(adlog(spark, sf_dir, "sessionid", "province", "city"), "region")


@query
def tag_channel(spark, sf_dir):
    return _tags(adlog(spark, sf_dir, "sessionid", "channelid"), "channel")


@query
def tag_keyword(spark, sf_dir):
    return _tags(adlog(spark, sf_dir, "sessionid", "keywords"), "keyword")


@query
def tag_demography(spark, sf_dir):
    return _tags(adlog(spark, sf_dir, "sessionid", "age", "sex"), "age", "sex")


@query
def tag_business_area(spark, sf_dir):
    log = adlog(spark, sf_dir, "sessionid", "longitude", "latitude")
    return _tags(with_areas(log, _areas(spark, sf_dir), spread=["sessionid"]), "area")


TAG_COLUMNS = ("sessionid", "appid", "appname", "device", "client", "ispname", "networkmannername",
               "devicetype", "province", "city", "channelid", "keywords", "age", "sex",
               "longitude", "latitude", "ts", *ID_COLUMNS)


def _records(spark, sf_dir) -> DataFrame:
    return records(adlog(spark, sf_dir, *TAG_COLUMNS), _areas(spark, sf_dir), app_names(spark),
                   device_codes(spark))


@query
def tags_per_row(spark, sf_dir):
    return explode_tags(_records(spark, sf_dir), "sessionid")


# -- identity -----------------------------------------------------------------------

def _ids(spark, sf_dir) -> DataFrame:
    return identified_rows(adlog(spark, sf_dir, "sessionid", *ID_COLUMNS)).select(
        "sessionid", row_ids().alias("ids"))


@query
def identified_rows_(spark, sf_dir):
    return identified_rows(adlog(spark, sf_dir, "sessionid", *ID_COLUMNS))



@query
def identity_ids(spark, sf_dir):
    return _ids(spark, sf_dir).select("sessionid", F.array_join("ids", ",").alias("ids"),
                                      F.col("ids")[0].alias("main_id"))


@query
def identity_edges_(spark, sf_dir):
    return identity_edges(_ids(spark, sf_dir))



@query
def connected_components_(spark, sf_dir):
    return connected_components(identity_edges(_ids(spark, sf_dir)))



@query
def identity_members(spark, sf_dir):
    return members_of(identity_edges(_ids(spark, sf_dir)))


@query
def identity_increment(spark, sf_dir):
    """Users of the earlier days, and then of the later days too."""
    log = adlog(spark, sf_dir, "ts", *ID_COLUMNS)
    old, new = (identity_edges(identified_rows(log.where(when)).select(row_ids().alias("ids")))
                for when in (_YESTERDAY, _TODAY))
    return extend_members(members_of(old), new).members


@query
def identity_records(spark, sf_dir):
    ids = Scratch(spark, "ids").save(_ids(spark, sf_dir), "ids")
    rows = ids.select("sessionid", F.col("ids")[0].alias("id"))
    return with_user(rows, members_of(identity_edges(ids))).select("sessionid", "id", "user_id")


# -- merged tags --------------------------------------------------------------------

def _users(spark, sf_dir, when=None, history=None):
    log = adlog(spark, sf_dir, *TAG_COLUMNS)
    if when is not None:
        log = log.where(when)
    return build_tags(log, _areas(spark, sf_dir), app_names(spark), device_codes(spark), history)


def _stored(users, label):
    members, weights = users
    return members, Scratch(members.sparkSession, label).save(weights, "weights")


@query
def tag_merge(spark, sf_dir):
    _, weights = _users(spark, sf_dir)
    return _rounded(weights)


@query
def tag_decay(spark, sf_dir):
    """All weights of all days, after a day."""
    _, weights = _users(spark, sf_dir)
    return _rounded(decayed(weights))


@query
def tag_history_merge(spark, sf_dir):
    history = _stored(_users(spark, sf_dir, _YESTERDAY), "yesterday")
    _, weights = _users(spark, sf_dir, _TODAY, history)
    return _rounded(weights)


@query
def tag_decay_all(spark, sf_dir):
    """All weights of all days, after a day; keywords fade faster."""
    _, weights = _users(spark, sf_dir)
    return _rounded(decayed(weights, {"KW_": 0.8}))


@query
def tag_cooling(spark, sf_dir):
    """Every day's weights, merged in two steps, as they are a week after the last day."""
    log = adlog(spark, sf_dir, *TAG_COLUMNS)
    rows = records(log.withColumn("sessionid", F.concat("sessionid", F.lit("@"), F.to_date("ts"))),
                   _areas(spark, sf_dir), app_names(spark), device_codes(spark))
    rows = Scratch(spark, "cooling").save(rows, "records")
    day = F.to_date(F.substring_index("sessionid", "@", -1))
    per_day = (explode_tags(rows, F.col("ids")[0].alias("id"), day.alias("day"))
               .groupBy("id", "tag", "day").agg(F.count("*").cast("double").alias("weight")))
    weights = with_user(per_day, members_of(identity_edges(rows))).select("user_id", "tag", "weight", "day")
    decay, middle, end = {"KW_": 0.8}, dt.date(2024, 1, 20), dt.date(2024, 2, 6)
    early = merge_cooled(weights.where(F.col("day") <= middle), middle, decay)
    late = weights.where(F.col("day") > middle)
    return _rounded(merge_cooled(early.unionByName(late), end, decay))


@query
def tag_cooling_stored(spark, sf_dir):
    """Days 10, 11 and 20 through the daily job, read on day 25: the job bears the days between."""
    tables = DatedTables(spark, Scratch(spark, "tables").folder)
    log, areas = adlog(spark, sf_dir, *TAG_COLUMNS), _areas(spark, sf_dir)
    ends = [dt.date(2024, 1, d) for d in (10, 11, 20)]
    for before, day in zip([dt.date(2000, 1, 1), *ends], [*ends[:-1], dt.date(2024, 12, 31)]):
        run_day = min(day, ends[-1])
        tables.write(log.where((F.to_date("ts") > before) & (F.to_date("ts") <= day)), "ods", run_day,
                     ["sessionid"])
        tables.write(areas, "business_area", run_day, ["geohash"])
        run_cooling_tags(tables, run_day, app_names(spark), device_codes(spark), first_run=before.year == 2000)
    return _rounded(cooled(tables.read("cooling_tag", ends[-1]), dt.date(2024, 1, 25)))


@query
def tag_merge_qualified(spark, sf_dir):
    """Identifiers of two kinds with the same text stay apart."""
    log = adlog(spark, sf_dir, *TAG_COLUMNS).withColumn(
        "openudid", F.when(F.col("openudid").isNotNull(), F.concat(F.lit("M"), F.substring("openudid", 2, 99))))
    members, _ = build_tags(log, _areas(spark, sf_dir), app_names(spark), device_codes(spark),
                            qualify_ids=True)
    return members


@query
def tag_history_stored(spark, sf_dir):
    """Two days through the daily job and its tables."""
    tables = DatedTables(spark, Scratch(spark, "tables").folder)
    log, areas = adlog(spark, sf_dir, *TAG_COLUMNS), _areas(spark, sf_dir)
    days = ((RUN_DATE - dt.timedelta(days=1), _YESTERDAY), (RUN_DATE, _TODAY))
    for day, when in days:
        tables.write(log.where(when), "ods", day, ["sessionid"])
        tables.write(areas, "business_area", day, ["geohash"])
        run_tags(tables, day, app_names(spark), device_codes(spark), first_run=day < RUN_DATE)
    return _rounded(tables.read("tag", RUN_DATE))


@query
def tag_text_escape(spark, sf_dir):
    """Ids with commas and tags with the separators of the text form, written and read again."""
    customers = table(spark, sf_dir, "customer")
    user = F.concat(F.lit("u"), "c_nationkey")
    members = customers.select(user.alias("user_id"),
                               F.concat("c_mktsegment", F.lit(",\\c"), "c_custkey").alias("id"))
    tag = F.concat(F.lit("KW_C#"), F.col("c_custkey") % 7, F.lit(" -> \\h,"), "c_mktsegment")
    weights = (customers.groupBy(user.alias("user_id"), tag.alias("tag"))
               .agg(F.count("*").cast("double").alias("weight")))
    stored = Scratch(spark, "text").save(to_text(user_rows(members, weights)), "users")
    members, weights = members_and_weights(from_text(stored))
    return weights.unionByName(members.withColumnRenamed("id", "tag"), allowMissingColumns=True)


def _text_rows(spark, sf_dir):
    return to_text(user_rows(*_stored(_users(spark, sf_dir), "users")))


@query
def tag_encode(spark, sf_dir):
    return _text_rows(spark, sf_dir)


@query
def tag_decode(spark, sf_dir):
    stored = Scratch(spark, "text").save(_text_rows(spark, sf_dir), "users")
    _, weights = members_and_weights(from_text(stored))
    return _rounded(weights)


# -- skew ---------------------------------------------------------------------------

def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"))


def _customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


def _blank_orders(spark, sf_dir) -> DataFrame:
    """Orders of which a third has no customer."""
    return _orders(spark, sf_dir).withColumn(
        "c_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("c_custkey")))


@query
def hot_keys_(spark, sf_dir):
    return hot_keys(table(spark, sf_dir, "events"), "event_type", 0.2)



@query
def skew_nullfilter_join(spark, sf_dir):
    return join_filled_keys(_blank_orders(spark, sf_dir), _customers(spark, sf_dir), "c_custkey")


@query
def skew_blank_around_join(spark, sf_dir):
    return join_filled_keys(_blank_orders(spark, sf_dir), _customers(spark, sf_dir), "c_custkey",
                            keep_blank=True)


@query
def skew_two_phase_count(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return salted_agg(events, "user_id", {"n": ("count", "event_id"), "first_id": ("min", "event_id"),
                                          "last_id": ("max", "event_id"),
                                          "id_sum": ("sum", "event_id")}, 10, ["event_id"])


@query
def skew_broadcast_join(spark, sf_dir):
    return broadcast_join(_orders(spark, sf_dir), _customers(spark, sf_dir), "c_custkey")


@query
def skew_lookup_join(spark, sf_dir):
    """The way beyond the size check of the broadcast join."""
    return lookup_join(_blank_orders(spark, sf_dir), _customers(spark, sf_dir), "c_custkey",
                       spread=["o_orderkey"], max_bytes=0)


@query
def skew_split_join(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    hot = hot_keys(orders, "c_custkey", 0.001)
    return split_salted_join(orders, _customers(spark, sf_dir), "c_custkey", hot, 10,
                             spread=["o_orderkey"])


@query
def skew_salted_join(spark, sf_dir):
    return salted_join(_orders(spark, sf_dir), _customers(spark, sf_dir), "c_custkey", 10,
                       spread=["o_orderkey"])


def _skewed_orders(spark, sf_dir) -> DataFrame:
    """Orders of which three in ten belong to one customer."""
    return _orders(spark, sf_dir).withColumn(
        "c_custkey", F.when(F.col("o_orderkey") % 10 < 3, F.lit(1)).otherwise(F.col("c_custkey")))


@query
def skew_hot_keys(spark, sf_dir):
    return hot_keys(_skewed_orders(spark, sf_dir), "c_custkey", 0.05)


@query
def skew_hot_filled_join(spark, sf_dir):
    return join_filled_keys(_skewed_orders(spark, sf_dir), _customers(spark, sf_dir), "c_custkey")


@query
def skew_hot_lookup_join(spark, sf_dir):
    return lookup_join(_skewed_orders(spark, sf_dir), _customers(spark, sf_dir), "c_custkey",
                       spread=["o_orderkey"], max_bytes=0)


@query
def skew_hot_split_join(spark, sf_dir):
    orders = _skewed_orders(spark, sf_dir)
    return split_salted_join(orders, _customers(spark, sf_dir), "c_custkey",
                             hot_keys(orders, "c_custkey"), spread=["o_orderkey"])


@query
def skew_hot_salted_join(spark, sf_dir):
    return salted_join(_skewed_orders(spark, sf_dir), _customers(spark, sf_dir), "c_custkey",
                       spread=["o_orderkey"])


@query
def skew_hot_count(spark, sf_dir):
    return salted_agg(_skewed_orders(spark, sf_dir), "c_custkey", {"n": ("count", "o_orderkey")},
                      spread=["o_orderkey"])


@query
def union_distinct(spark, sf_dir):
    segments = _customers(spark, sf_dir).select("c_custkey")
    return segments.union(_orders(spark, sf_dir).select("c_custkey")).distinct()


# -- keyed tables -------------------------------------------------------------------

_KEY = ["c_custkey"]


def _accounts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")


def _patch(spark, sf_dir) -> DataFrame:
    """A change to every tenth account, and a new account for every hundredth."""
    accounts = _accounts(spark, sf_dir)
    name = F.when(F.col("c_custkey") % 20 != 0, F.concat(F.lit("patched "), "c_custkey"))
    changed = accounts.where("c_custkey % 10 = 0").select("c_custkey", name.alias("c_name"),
                                                          (F.col("c_acctbal") + 1).alias("c_acctbal"))
    added = accounts.where("c_custkey % 100 = 0").withColumn("c_custkey", F.col("c_custkey") + 1000000)
    return changed.unionByName(added)


@query
def keyed_insert(spark, sf_dir):
    rows, conflicts = insert_rows(_accounts(spark, sf_dir), _patch(spark, sf_dir), _KEY)
    return rows.withColumn("conflict", F.lit(0)).unionByName(conflicts.withColumn("conflict", F.lit(1)))


@query
def keyed_update(spark, sf_dir):
    return update_rows(_accounts(spark, sf_dir), _patch(spark, sf_dir).drop("c_acctbal"), _KEY)


@query
def keyed_delete(spark, sf_dir):
    return delete_rows(_accounts(spark, sf_dir), _patch(spark, sf_dir).select(*_KEY), _KEY)


@query
def keyed_upsert(spark, sf_dir):
    return upsert_rows(_accounts(spark, sf_dir), _patch(spark, sf_dir), _KEY)


def _account_table(spark, sf_dir) -> KeyedTable:
    """The accounts as a stored table of its own."""
    accounts = KeyedTable(spark, f"accounts_{uuid.uuid4().hex}", _KEY)
    rows = _accounts(spark, sf_dir)
    accounts.create(rows.schema)
    accounts.append(rows)
    return accounts


def _leaving(frame: DataFrame, *tables) -> DataFrame:
    """The rows, stored apart; the tables that they come from are dropped."""
    rows = Scratch(frame.sparkSession, "rows").save(frame, "rows")
    for one in tables:
        one.drop()
    return rows


@query
def keyed_table_insert(spark, sf_dir):
    """The stored rows, and those that were not added; the patch has its new keys twice."""
    accounts, patch = _account_table(spark, sf_dir), _patch(spark, sf_dir)
    twice = patch.where("c_custkey > 1000000").withColumn("c_acctbal", F.lit(-1000000).cast(
        patch.schema["c_acctbal"].dataType))
    conflicts = accounts.insert(patch.unionByName(twice))
    return _leaving(accounts.read().withColumn("conflict", F.lit(0)).unionByName(
        conflicts.withColumn("conflict", F.lit(1))), accounts)


@query
def keyed_table_update(spark, sf_dir):
    accounts = _account_table(spark, sf_dir)
    accounts.update(_patch(spark, sf_dir).drop("c_acctbal"))
    return _leaving(accounts.read(), accounts)


@query
def keyed_table_delete(spark, sf_dir):
    accounts = _account_table(spark, sf_dir)
    accounts.delete(_patch(spark, sf_dir).select(*_KEY))
    return _leaving(accounts.read(), accounts)


@query
def keyed_table_upsert(spark, sf_dir):
    accounts = _account_table(spark, sf_dir)
    accounts.upsert(_patch(spark, sf_dir))
    return _leaving(accounts.read(), accounts)


@query
def keyed_insert_select(spark, sf_dir):
    """`INSERT INTO ... SELECT` from one stored table into another."""
    accounts, rich = _account_table(spark, sf_dir), _account_table(spark, sf_dir)
    rich.delete(accounts.read(*_KEY))
    rich.append(spark.sql(f"SELECT c_custkey, c_name, c_acctbal FROM {accounts.name} WHERE c_acctbal > 3000"))
    spark.sql(f"""INSERT INTO {rich.name} (c_custkey, c_name, c_acctbal)
                  SELECT c_custkey + 1000000, c_name, c_acctbal FROM {accounts.name} WHERE c_acctbal > 9000""")
    rich.update(accounts.read().where("c_acctbal > 3000").select("c_custkey", F.lit("rich").alias("c_name")))
    return _leaving(rich.read(), accounts, rich)


def _bucketed(spark, rows: DataFrame) -> BucketedTable:
    stored = BucketedTable(spark, f"bucketed_{uuid.uuid4().hex}", _KEY,
                           int(spark.conf.get("spark.sql.shuffle.partitions")))
    stored.write(rows)
    return stored


@query
def bucketed_join(spark, sf_dir):
    """Two stored tables by their key, neither of which is moved."""
    accounts = _bucketed(spark, _accounts(spark, sf_dir))
    segments = _bucketed(spark, table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))
    return _leaving(accounts.join(segments), accounts, segments)


@query
def bucketed_upsert(spark, sf_dir):
    accounts, patch = (_bucketed(spark, rows(spark, sf_dir)) for rows in (_accounts, _patch))
    accounts.upsert(patch)
    return _leaving(accounts.read(), accounts, patch)


@query
def bucketed_delete(spark, sf_dir):
    accounts, patch = (_bucketed(spark, rows(spark, sf_dir)) for rows in (_accounts, _patch))
    accounts.delete(patch)
    return _leaving(accounts.read(), accounts, patch)


@query
def keyed_select(spark, sf_dir):
    tables = DatedTables(spark, Scratch(spark, "tables").folder)
    tables.write(_accounts(spark, sf_dir), "accounts", RUN_DATE, _KEY)
    return tables.read("accounts", RUN_DATE, ["c_custkey", "c_name"])


@query
def insert_select_filter(spark, sf_dir):
    """Rows of one table are inserted into another, which is then read with a condition."""
    tables = DatedTables(spark, Scratch(spark, "tables").folder)
    tables.write(_accounts(spark, sf_dir), "accounts", RUN_DATE, _KEY)
    tables.append(_patch(spark, sf_dir), "accounts", RUN_DATE)
    return tables.read("accounts", RUN_DATE).where("c_acctbal > 3000")
