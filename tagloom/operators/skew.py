"""Joins and aggregations that hold up when one key owns a large share of the rows."""

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.functions.predicates import filled
from tagloom.functions.salt import all_salts, row_hash, row_salt
from tagloom.session import Scratch, fits_broadcast

# A key is hot with at least this share of the rows of an even task. With P tasks there are at
# most P / HOT_TASK_SHARE such keys, whatever the size of the data, so frames of one row per hot
# key can be broadcast.
HOT_TASK_SHARE = 1 / 4

# Salts of operators that are given none.
SALTS = 10

# Hot keys beyond this number are treated like others, so that a broadcast of them stays small.
MAX_HOT_KEYS = 10_000

# Size up to which a requested broadcast is carried out.
MAX_BROADCAST_BYTES = 10 * 1024 * 1024

# Items of a sketch; shares that take more are counted exactly.
MAX_TRACKED = 1 << 16
_SKETCH_GROUPS = 64

_ITEM = "_item"
_SALT = "_salt"
_HOT = "_hot"
_COLD = "_cold"


def _as_list(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _null_key(keys) -> Column:
    return reduce(or_, (F.col(k).isNull() for k in keys))


def hot_share(df: DataFrame) -> float:
    """Share of the rows from which a key is hot, by the number of tasks after a shuffle."""
    return HOT_TASK_SHARE / max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# -- finding hot keys ---------------------------------------------------------------

def hot_keys(df: DataFrame, key, min_share: float | None = None,
             sample: float | None = None, seed: int = 0) -> DataFrame:
    """Keys with at least `min_share` (default: `hot_share`) of the rows that have a key, and their
    counts.

    Exact: a sketch of the heavy hitters names the candidates, and only their rows are counted, so that no
    more than a row per candidate and task is shuffled. `df` is read twice for it. With `sample` the shares
    are those of a random sample. The result has at most 1 / `min_share` rows.
    """
    keys = _as_list(key)
    rows = df.select(*keys).where(~_null_key(keys))
    if sample is not None:
        rows = rows.sample(False, sample, seed)
    share = hot_share(df) if min_share is None else min_share
    found = _heavy_hitters(rows, keys, share)
    if sample is not None or found is None:
        return hot_of_counts(rows.groupBy(*keys).agg(F.count("*").alias("n")), *keys, min_share=share)
    total = found.select("total").scalar()
    candidates = found.select(F.explode("items.item").alias(_ITEM))
    return (rows.withColumn(_ITEM, F.xxhash64(*keys)).join(F.broadcast(candidates), _ITEM, "left_semi")
            .groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= total * share))


def _heavy_hitters(rows: DataFrame, keys: Sequence[str], share: float) -> DataFrame | None:
    """`items`, which hold the hash of every key with at least `share` of the rows, and the `total` of rows.

    Spark's sketch of m tracked items is off by at most 3.5 * 0.75 / m of the rows, however it is
    merged, and returns the items of which more than that is certain. So with m = 6 / share a key with
    that share of the rows is always among them, and as it is counted higher than all keys of less than half
    the share, it is among the first 2 / share. None if that takes more items than a sketch should have.
    """
    tracked = math.ceil(6 / share)
    if tracked > MAX_TRACKED:
        return None
    hashed = rows.select(F.xxhash64(*keys).alias(_ITEM))
    # Sketches of tasks are merged in groups first, so that no task merges all of them.
    parts = hashed.groupBy((F.spark_partition_id() % _SKETCH_GROUPS).alias("group")).agg(
        F.expr(f"approx_top_k_accumulate({_ITEM}, {tracked})").alias("sketch"), F.count("*").alias("n"))
    # By a constant, as the sketches of no rows can't be combined.
    return parts.groupBy(F.lit("all")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {math.ceil(2 / share)})")
        .alias("items"), F.sum("n").alias("total"))


def hot_of_counts(counts: DataFrame, *keys: str, min_share: float | None = None) -> DataFrame:
    """The hot keys, with their counts, of a frame that has the count of each key as `n`."""
    total = counts.agg(F.sum("n")).scalar()
    share = hot_share(counts) if min_share is None else min_share
    return counts.select(*keys, "n").where(F.col("n") >= total * share)


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition of a frame, to see skew."""
    return (df.select(F.spark_partition_id().alias("partition"))
            .groupBy("partition").agg(F.count("*").alias("n")))


# -- joins --------------------------------------------------------------------------

def drop_blank_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.where(filled(df, *keys))


def join_filled_keys(left: DataFrame, right: DataFrame, key, keep_blank: bool = False) -> DataFrame:
    """Left join of the rows that have a key; the others are dropped, or, with
    `keep_blank`, go around the join and keep NULL in the right side's columns. The right side has
    at most one row per key, as for `lookup_join`, which sees to hot keys."""
    keys = _as_list(key)
    joined = lookup_join(drop_blank_keys(left, *keys), right, keys)
    if not keep_blank:
        return joined
    around = left.where(~filled(left, *keys))
    return joined.unionByName(around, allowMissingColumns=True)


def broadcast_join(left: DataFrame, right: DataFrame, key, how: str = "left",
                   max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join without moving the left side, if the right side is small enough to be copied
    to every executor; otherwise `lookup_join`. The right side's key is unique.

    The bound is that of the caller and not of the session, as the copy is asked for."""
    return lookup_join(left, right, key, how, max_bytes=max_bytes)


def lookup_join(left: DataFrame, right: DataFrame, key, how: str = "left",
                hot: DataFrame | None = None, spread: Sequence[str] | None = None,
                max_bytes: int | None = None, small: bool | None = None,
                store_left: bool = False) -> DataFrame:
    """Add the columns of `right`, which has at most one row per key, to `left`.

    `right` should be a stored table, as its size is looked at and it is read twice; a caller that
    knows the size of a computed frame says so by `small`.
    If it is small it is broadcast. If not, both sides are shuffled by key, but
    the rows of hot keys get their values from a broadcast of a row per hot key
    and are, like the rows without a key, spread over all tasks by the hash of the
    `spread` columns (default: of the whole row).

    `hot` may give the hot keys if they are known; of too many, only the hottest are taken.
    To find them, the keys of `left` are counted; `store_left` writes a frame that is costly to
    compute to the shared folder first.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    keys = _as_list(key)
    if fits_broadcast(right, max_bytes) if small is None else small:
        return left.join(F.broadcast(right), keys, how)
    scratch = Scratch(left.sparkSession, "lookup")
    if store_left:
        left = scratch.save(left, "left")
    # Stored, so that a chain of lookups does not repeat the plan of `left` in each of them.
    hot = scratch.save(_bounded(hot_keys(left, keys) if hot is None else hot), "hot")

    values = [c for c in right.columns if c not in keys]
    record = F.struct(*[F.col(c) for c in values], F.lit(True).alias("_found"))
    hot = hot.select(*keys)
    hot_records = (right.join(F.broadcast(hot), keys, "left_semi")
                   .select(*keys, record.alias("_record")))
    hot = (hot.join(F.broadcast(hot_records), keys, "left")
           .select(*keys, F.struct("_record").alias(_HOT)))

    # Ordinary rows meet their record by the hash of the key. Placed rows go anywhere; if one
    # does meet a record, it is the one it already has.
    placed = F.col(_HOT).isNotNull() | _null_key(keys)
    marked = (left.join(F.broadcast(hot), keys, "left")
              .withColumn(_SALT, F.when(placed, row_hash(*(spread or left.columns)))
                          .otherwise(F.xxhash64(*keys))))
    cold = right.select(*keys, F.xxhash64(*keys).alias(_SALT), record.alias(_COLD))
    joined = marked.join(cold, [*keys, _SALT], "left")
    found = F.coalesce(F.col(_COLD), F.col(_HOT)["_record"])
    if how == "inner":
        joined = joined.where(found.isNotNull())
    others = [c for c in left.columns if c not in keys]
    return joined.select(*keys, *others, *[found[c].alias(c) for c in values])


def _bounded(hot: DataFrame) -> DataFrame:
    """At most MAX_HOT_KEYS hot keys, the hottest if their counts are there; others stay cold."""
    return (hot.orderBy(F.desc("n")) if "n" in hot.columns else hot).limit(MAX_HOT_KEYS)


def salted_join(left: DataFrame, right: DataFrame, key, buckets: int = SALTS,
                how: str = "left", spread: Sequence[str] | None = None) -> DataFrame:
    """Split every key of the left side over `buckets` tasks and copy the right side to all
    of them. Right for many hot keys on the left and a right side that can grow `buckets`-fold."""
    if how not in ("left", "inner"):
        raise ValueError("the right side is replicated: only left and inner joins are exact")
    keys = _as_list(key)
    salted = left.withColumn(_SALT, row_salt(buckets, *(spread or left.columns)))
    copies = right.withColumn(_SALT, all_salts(buckets))
    return salted.join(copies, [*keys, _SALT], how).drop(_SALT)


def split_salted_join(left: DataFrame, right: DataFrame, key, hot, buckets: int = SALTS,
                      how: str = "left", spread: Sequence[str] | None = None) -> DataFrame:
    """Join hot keys salted and the rest plainly, and unite the two without losing duplicates.

    `hot` is a list of keys, or a frame of them as made by `hot_keys`.
    """
    name, = _as_list(key)
    if isinstance(hot, DataFrame):
        hot = Scratch(left.sparkSession, "split").save(_bounded(hot), "hot")
        keys = F.broadcast(hot.select(name))
        parts = [(side.join(keys, name, "left_semi"), side.join(keys, name, "left_anti"))
                 for side in (left, right)]
    else:
        is_hot = F.coalesce(F.col(name).isin(list(hot)), F.lit(False))
        parts = [(side.where(is_hot), side.where(~is_hot)) for side in (left, right)]
    (left_hot, left_cold), (right_hot, right_cold) = parts
    salted = salted_join(left_hot, right_hot, name, buckets, how, spread)
    return left_cold.join(right_cold, name, how).unionByName(salted)


# -- aggregation --------------------------------------------------------------------

_PARTIAL = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_FINAL = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def salted_agg(df: DataFrame, keys, aggregates: dict[str, tuple[str, str]],
               buckets: int = SALTS, spread: Sequence[str] | None = None) -> DataFrame:
    """Aggregate per key and salt first, then per key.

    `aggregates` maps an output name to (count | sum | min | max, column).
    """
    keys = _as_list(keys)
    local = (df.withColumn(_SALT, row_salt(buckets, *(spread or df.columns)))
             .groupBy(*keys, _SALT)
             .agg(*[_PARTIAL[fn](column).alias(name) for name, (fn, column) in aggregates.items()]))
    return local.groupBy(*keys).agg(
        *[_FINAL[fn](name).alias(name) for name, (fn, _) in aggregates.items()])
