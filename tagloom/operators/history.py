"""Merging the tags of earlier days.

Weights fade by Newton's law of cooling: after t days w * exp(-k t) is left, with a coefficient k for each kind
of tag. It is stated here as the share that is left after a day, exp(-k). `decayed` takes one step of a day;
weights with a `day` of their own cool by the days that went by, when they are read or merged.
"""

import datetime as dt
import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.operators.identity import extend_members, members_of, summed, user_weights
from tagloom.operators.skew import lookup_join
from tagloom.session import Scratch

# Fixed value: the share of a weight that is left after a day.
DECAY = 0.9

# Today's weights: a frame per id (`id`, `tag`, `weight`), or a function that makes rows per user (`user_id`, `tag`,
# `weight`; still to be summed) of today's labels (`id`, `user_id`).
Weights = DataFrame | Callable[[DataFrame], DataFrame]


def decayed(weights: DataFrame, decay: float | Mapping[str, float] = DECAY) -> DataFrame:
    """Weights times the decay factor.

    A mapping gives one factor per tag prefix, such as `{"KW_": 0.8}`; other tags get DECAY.
    """
    return weights.withColumn("weight", F.col("weight") * _factor(decay))


def _factor(decay: float | Mapping[str, float]) -> Column:
    if not isinstance(decay, Mapping):
        return F.lit(float(decay))
    factor = F.lit(DECAY)
    for prefix, value in decay.items():
        factor = F.when(F.col("tag").startswith(prefix), float(value)).otherwise(factor)
    return factor


def merge_history(old_members: DataFrame, old_weights: DataFrame, edges: DataFrame,
                  weights: DataFrame, decay: float | Mapping[str, float] = DECAY,
                  ) -> tuple[DataFrame, DataFrame]:
    """Members and weights of the old users and today's records together.

    `edges` and `weights` (per id) are today's. Identity is resolved once, over all ids of
    both sides, as a record of today may join two old users.
    """
    old_edges = old_members.select(F.col("user_id").alias("src"), F.col("id").alias("dst"))
    members = members_of(old_edges.unionByName(edges))
    old = decayed(old_weights, decay).select(F.col("user_id").alias("id"), "tag", "weight")
    merged = user_weights(old.unionByName(weights.select("id", "tag", "weight")), members)
    return members, merged


def extend_history(old_members: DataFrame, old_weights: DataFrame, edges: DataFrame,
                   weights: Weights, decay: float | Mapping[str, float] = DECAY,
                   ) -> tuple[DataFrame, DataFrame]:
    """The same rows as `merge_history`, with work that follows today's records.

    Identity is resolved among today's ids and the old users that they belong to. Only weights of
    those users are moved and summed; the others are read, decayed and passed on.
    """
    return _extended(old_members, decayed(old_weights, decay), edges, weights)


def _extended(old_members, old_weights, edges, weights, today: Column | None = None,
              cool=lambda touched: touched) -> tuple[DataFrame, DataFrame]:
    """Members and weights; `cool` is applied to the weights of the old users that today touches."""
    scratch = Scratch(edges.sparkSession, "extend")
    found = extend_members(old_members, edges)
    old = lookup_join(old_weights, found.touched.select(
        F.col("old_user").alias("user_id"), F.col("user_id").alias("_now")), "user_id")
    columns = old_weights.columns
    resting = old.where("_now IS NULL").select(*columns)
    touched = cool(old.where("_now IS NOT NULL").withColumn("user_id", F.col("_now")).select(*columns))
    if callable(weights):
        fresh = weights(found.labels)
    else:
        fresh = lookup_join(scratch.save(weights.select("id", "tag", "weight"), "weights"),
                            found.labels, "id", "inner")
    merged = summed(touched.select("user_id", "tag", "weight").unionByName(fresh.select("user_id", "tag", "weight")))
    if today is not None:
        merged = merged.withColumn("day", today)
    return found.members, resting.unionByName(merged.select(*columns))


# -- weights with a day -----------------------------------------------------------------

def left_after_a_day(coefficient: float) -> float:
    """The share of a weight that is left after a day, by its coefficient of cooling per day."""
    return math.exp(-coefficient)


def cooled(weights: DataFrame, as_of: dt.date, decay: float | Mapping[str, float] = DECAY) -> DataFrame:
    """Weights as they are on a day: what is left of each after the days since its own `day`.

    Right for any gap, and for days in between, as cooling twice is cooling for the sum of the days.
    A weight of a later day is what would cool to it.
    """
    days = F.datediff(F.lit(as_of), F.col("day"))
    return (weights.withColumn("weight", F.col("weight") * F.pow(_factor(decay), days))
            .withColumn("day", F.lit(as_of)))


def merge_cooled(weights: DataFrame, as_of: dt.date, decay: float | Mapping[str, float] = DECAY,
                 keys: tuple[str, ...] = ("user_id", "tag")) -> DataFrame:
    """One weight per key, of `as_of`. Merging what was merged before gives the same as merging all at
    once, in any order and grouping, up to rounding."""
    return (cooled(weights, as_of, decay).groupBy(*keys).agg(F.sum("weight").alias("weight"))
            .withColumn("day", F.lit(as_of)))


def extend_cooling(old_members: DataFrame, old_weights: DataFrame, edges: DataFrame,
                   weights: Weights, day: dt.date, decay: float | Mapping[str, float] = DECAY,
                   ) -> tuple[DataFrame, DataFrame]:
    """Members and weights (with their `day`) of the old users and the records of `day`.

    Weights of users without a record stay as they are, with the day that they were last merged on, so
    that days may be missing between the old weights and `day`.
    """
    return _extended(old_members, old_weights.select("user_id", "tag", "weight", "day"), edges, weights,
                     F.lit(day), lambda touched: cooled(touched, day, decay))
