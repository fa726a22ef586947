"""Delivery funnel: requests, bids, wins, impressions, clicks, spend and rates."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.functions.predicates import filled

# Thresholds, codes and labels of the log.
_MIN_PROVIDER = 100000
_MIN_ORDER = 200000
_MIN_CREATIVE = 200000
_PRICE_UNIT = 1000
_REQUEST, _SHOW, _CLICK = 1, 2, 3
CLIENT_LABELS = {1: "android", 2: "ios", 3: "wp"}
OTHER_CLIENT = "other"
# The price that is the cost of a delivery, unless another is named.
COST_COLUMN = "winprice"


def client_label(client) -> Column:
    """Name of a client code; every unknown code is `other`, NULL stays NULL."""
    label = F.when(client.isNull(), F.lit(None).cast("string"))
    for code, name in CLIENT_LABELS.items():
        label = label.when(client == code, name)
    return label.otherwise(OTHER_CLIENT)


@dataclass(frozen=True)
class Report:
    """A table of the funnel along some columns of the log."""
    table: str
    dimensions: tuple[str, ...]


REPORTS = {
    "region": Report("ad_region_analysis", ("province", "city")),
    "channel": Report("ad_channel_analysis", ("channelid",)),
    "device": Report("ad_device_analysis", ("client", "device")),
    "network": Report("ad_network_analysis", ("networkmannerid", "networkmannername")),
    "operator": Report("ad_operate_analysis", ("ispname",)),
    "app": Report("app_analysis", ("appid", "appname")),
}


def _all(*conditions) -> Column:
    condition = conditions[0]
    for other in conditions[1:]:
        condition = condition & other
    return condition


def _conditions() -> dict[str, Column]:
    mode, node = F.col("requestmode"), F.col("processnode")
    effective, billed = F.col("iseffective") == 1, F.col("isbilling") == 1
    bidding = _all(F.col("adplatformproviderid") >= _MIN_PROVIDER, effective, billed)
    return {
        "org_request_num": _all(mode == _REQUEST, node >= 1),
        "valid_request_num": _all(mode == _REQUEST, node >= 2),
        "ad_request_num": _all(mode == _REQUEST, node == 3),
        "bid_num": _all(bidding, F.col("isbid") == 1, F.col("adorderid") != 0),
        "bid_success_num": _all(bidding, F.col("iswin") == 1),
        "ad_show_num": _all(mode == _SHOW, effective),
        "ad_click_num": _all(mode == _CLICK, effective),
        "media_show_num": _all(mode == _SHOW, effective, billed),
        "media_click_num": _all(mode == _CLICK, effective, billed),
    }


def _measures(cost_column: str) -> dict[str, Column]:
    """Per-row contribution to each sum: 0 or 1, or a price in its stored unit."""
    conditions = _conditions()
    spent = _all(conditions["bid_success_num"],
                 F.col("adorderid") > _MIN_ORDER, F.col("adcreativeid") > _MIN_CREATIVE)
    return {
        **{name: F.when(condition, 1).otherwise(0) for name, condition in conditions.items()},
        "ad_consumption": F.when(spent, F.col("winprice")).otherwise(0),
        "ad_cost": F.when(spent, F.col(cost_column)).otherwise(0),
    }


def _sums(names) -> list[Column]:
    """Prices are summed in the stored unit and divided once."""
    return [(F.sum(name).cast("double") / _PRICE_UNIT if name in ("ad_consumption", "ad_cost")
             else F.sum(name)).alias(name) for name in names]


def _with_rates(sums: DataFrame) -> DataFrame:
    return sums.withColumns({
        "bid_success_rate": F.try_divide("bid_success_num", "bid_num"),
        "click_rate": F.try_divide("media_click_num", "media_show_num"),
    })


def ad_funnel(df: DataFrame, *dimensions: str, cost_column: str = COST_COLUMN) -> DataFrame:
    """The funnel per value of the dimensions, rows with an empty dimension left out."""
    measures = _measures(cost_column)
    rows = df.where(filled(df, *dimensions)).select(
        *[_dimension(name) for name in dimensions],
        *[measure.alias(name) for name, measure in measures.items()])
    return _with_rates(rows.groupBy(*dimensions).agg(*_sums(measures)))


def _dimension(name: str) -> Column:
    return client_label(F.col(name)).alias(name) if name == "client" else F.col(name)


def province_city_counts(df: DataFrame) -> DataFrame:
    return (df.where(filled(df, "province", "city"))
            .groupBy("province", "city").agg(F.count("*").alias("count")))


def all_funnels(df: DataFrame, cost_column: str = COST_COLUMN) -> DataFrame:
    """Every report in one pass over the log: the grouping sets of all reports.

    Column `report` names the report; the columns of other reports' dimensions are NULL.
    Rows with an empty dimension form groups of their own, dropped after the aggregation.
    `n` counts the rows of a group.
    """
    return _finished(partial_funnels(df, cost_column))


def _dimensions() -> list[str]:
    return list(dict.fromkeys(d for r in REPORTS.values() for d in r.dimensions))


def partial_funnels(df: DataFrame, cost_column: str = COST_COLUMN) -> DataFrame:
    """The sums of all reports over a part of a log, such as a file or an hour, in stored units.

    They add up: `merged_funnels` of the parts of any split is `all_funnels` of the whole log.
    """
    names = _dimensions()
    measures = _measures(cost_column)
    rows = df.select(*[_dimension(name) for name in names],
                     *[measure.alias(name) for name, measure in measures.items()])
    sets = [[F.col(d) for d in r.dimensions] for r in REPORTS.values()]
    sums = rows.groupingSets(sets, *names).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("n"),
        *[F.sum(name).alias(name) for name in measures])

    report = F.lit(None).cast("string")
    complete = F.lit(False)
    for key, spec in REPORTS.items():
        # Bit i from the right is set if the i-th last column is not grouped by.
        code = sum(1 << i for i, name in enumerate(reversed(names)) if name not in spec.dimensions)
        report = F.when(F.col("_set") == code, key).otherwise(report)
        complete = complete | ((F.col("_set") == code) & filled(sums, *spec.dimensions))
    return sums.where(complete).withColumn("report", report).drop("_set")


def merged_funnels(partials: DataFrame) -> DataFrame:
    """All reports out of the partial sums of the parts of a log, in the form of `all_funnels`."""
    keys = ["report", *_dimensions()]
    sums = [c for c in partials.columns if c not in keys]
    return _finished(partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]))


def _finished(sums: DataFrame) -> DataFrame:
    return _with_rates(sums.withColumns({
        name: F.col(name).cast("double") / _PRICE_UNIT for name in ("ad_consumption", "ad_cost")}))


def report_from(funnels: DataFrame, name: str) -> DataFrame:
    """One report out of the result of `all_funnels`."""
    spec = REPORTS[name]
    others = {d for r in REPORTS.values() for d in r.dimensions} - set(spec.dimensions)
    return funnels.where(F.col("report") == name).drop("report", "n", *others)
