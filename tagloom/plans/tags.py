"""From the enriched table to users and their tags."""

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tagloom.operators.areas import area_dictionary, distinct_coordinates, with_areas
from tagloom.operators.history import DECAY, extend_cooling, extend_history
from tagloom.operators.identity import (identified_rows, identity_edges, members_of, summed,
                                        tags_of_users)
from tagloom.operators.skew import hot_keys
from tagloom.operators.tags import fill_app_name, row_ids, row_tags, with_codes


def build_area_dictionary(ods: DataFrame, responses: DataFrame) -> DataFrame:
    return area_dictionary(distinct_coordinates(ods), responses)


def tagged(ods: DataFrame, areas: DataFrame, app_names: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows with all columns that the tags are made of."""
    rows = with_areas(ods, areas, spread=["sessionid"])
    return with_codes(fill_app_name(rows, app_names), codes)


def records(ods: DataFrame, areas: DataFrame, app_names: DataFrame, codes: DataFrame,
            qualify_ids: bool = False) -> DataFrame:
    """`sessionid`, `ids` and `tags` of every row that has an identifier."""
    rows = tagged(identified_rows(ods), areas, app_names, codes)
    return rows.select("sessionid", row_ids(qualify_ids).alias("ids"), row_tags().alias("tags"))


def build_tags(ods: DataFrame, areas: DataFrame, app_names: DataFrame, codes: DataFrame,
               history: tuple[DataFrame, DataFrame] | None = None,
               decay: float | Mapping[str, float] = DECAY,
               qualify_ids: bool = False,
               cooling_day: dt.date | None = None) -> tuple[DataFrame, DataFrame]:
    """Members (user_id, id) and weights (user_id, tag, weight) of today's users.

    `history` are yesterday's members and weights, which are extended by today's. With `cooling_day`,
    the day of the log, weights have a `day` too, and the history may be that of any earlier day.
    The area dictionary should be a stored table.
    Identifiers and tags are read from the log separately, each with only the columns it needs.
    `qualify_ids` keeps equal texts of two kinds of identifiers apart.
    """
    ids = identified_rows(ods).select(row_ids(qualify_ids).alias("ids"))
    edges = identity_edges(ids)
    rows = records(ods, areas, app_names, codes, qualify_ids)
    # The hot ids are counted without making tags.
    hot = hot_keys(ids.select(F.col("ids")[0].alias("id")), "id")

    def weights(members):
        return tags_of_users(rows, members, hot)

    if history is None:
        members = members_of(edges)
        merged = summed(weights(members))
        return members, merged.withColumn("day", F.lit(cooling_day)) if cooling_day else merged
    if cooling_day:
        return extend_cooling(*history, edges, weights, cooling_day, decay)
    return extend_history(*history, edges, weights, decay)
