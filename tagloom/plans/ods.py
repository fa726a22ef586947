"""From the raw log to the enriched table."""

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.functions.ip import (UNKNOWN_AREA, UNKNOWN_COUNTRY, city_of, clean_area, province_of)
from tagloom.functions.predicates import filled
from tagloom.operators.iprange import locate, with_small_ranges
from tagloom.operators.skew import hot_of_counts, lookup_join
from tagloom.schema import GEO_COLUMNS, ODS_COLUMNS
from tagloom.session import Scratch


def distinct_ips(log: DataFrame) -> DataFrame:
    return log.select("ip").where(filled(log, "ip")).distinct()


def ip_counts(log: DataFrame) -> DataFrame:
    """`ip` and `n`, the rows of each filled address."""
    return log.select("ip").where(filled(log, "ip")).groupBy("ip").agg(F.count("*").alias("n"))


def ip_info(log: DataFrame, regions: DataFrame, places: DataFrame) -> DataFrame:
    """`ip`, `longitude`, `latitude`, `province`, `city`, one row per address in the log.

    `regions` has ranges with `country` and `area`, `places` ranges with `lon` and `lat`.
    """
    return _placed(distinct_ips(log), regions, places)


def _placed(ips: DataFrame, regions: DataFrame, places: DataFrame) -> DataFrame:
    return locate(ips, {"region": regions, "place": places}).select("ip", *_geo("region", "place"))


def _geo(region: str, place: str) -> list[Column]:
    """GEO_COLUMNS out of the records of both tables."""
    country = F.coalesce(F.col(region)["country"], F.lit(UNKNOWN_COUNTRY))
    values = (F.col(place)["lon"], F.col(place)["lat"], province_of(country), city_of(country))
    return [value.alias(name) for value, name in zip(values, GEO_COLUMNS)]


def ip_regions(log: DataFrame, regions: DataFrame) -> DataFrame:
    """`ip`, `country` and `area`, with the names for unknown addresses filled in."""
    found = locate(distinct_ips(log), {"region": regions})
    region = F.col("region")
    return found.select("ip", F.coalesce(region["country"], F.lit(UNKNOWN_COUNTRY)).alias("country"),
                        F.coalesce(clean_area(region["area"]), F.lit(UNKNOWN_AREA)).alias("area"))


def build_ods(log: DataFrame, regions: DataFrame, places: DataFrame, store_log: bool = False) -> DataFrame:
    """The log with the place of each address; rows without an address keep NULL.

    With small range tables, rows are placed where they are. With large ones the log is read twice: for the
    counts of its addresses, which also tell those that need to be spread, and for the join. `store_log`
    stores it for that, if it is not a table but costs work of its own.
    """
    raw = log.drop(*GEO_COLUMNS)
    placed = with_small_ranges(raw, {"_region": regions, "_place": places})
    if placed is not None:
        known = filled(raw, "ip")
        geo = {name: F.when(known, value) for name, value in zip(GEO_COLUMNS, _geo("_region", "_place"))}
        return placed.withColumns(geo).select(*ODS_COLUMNS)
    scratch = Scratch(log.sparkSession, "ods")
    raw = scratch.save(raw, "log") if store_log else raw
    counts = scratch.save(ip_counts(raw), "ips")
    info = scratch.save(_placed(counts.select("ip"), regions, places), "ip_info")
    return lookup_join(raw, info, "ip", hot=hot_of_counts(counts, "ip"),
                       spread=["sessionid"]).select(*ODS_COLUMNS)
