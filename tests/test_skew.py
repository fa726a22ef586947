"""Skew-safe joins and aggregations give what the plain ones give."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagloom.operators.skew import (broadcast_join, drop_blank_keys, hot_keys, join_filled_keys,
                                    lookup_join, partition_profile, salted_agg, salted_join,
                                    split_salted_join)
from tagloom.operators.unique import duplicate_keys, unique_by_key

@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has the key `hot`, of which many are copies, a tenth has none, and a
    tenth has a hot key that the right side does not know."""
    rng = random.Random(11)
    keys = ["hot"] * 1000 + [None] * 300 + ["unknown"] * 300 + [f"k{rng.randrange(600)}" for _ in range(1400)]
    rng.shuffle(keys)
    return spark.createDataFrame([(i // 2, k) for i, k in enumerate(keys)], "n int, k string").repartition(6)


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame([("hot", "H", None)] + [(f"k{i}", f"v{i}", i) for i in range(500)],
                                 "k string, v string, w int")


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_counts_by_key(spark):
    parcels = [(n, depot) for depot, count in (("north", 23), ("south", 4), (None, 2)) for n in range(count)]
    counts = salted_agg(spark.createDataFrame(parcels, "n int, depot string"), "depot", {"c": ("count", "n")}, 10)
    assert {r.depot: r.c for r in counts.collect()} == {"north": 23, "south": 4, None: 2}


def test_salted_agg(skewed):
    plain = skewed.groupBy("k").agg(F.count("n").alias("c"), F.sum("n").alias("s"),
                                    F.min("n").alias("a"), F.max("n").alias("b"))
    salted = salted_agg(skewed, "k", {"c": ("count", "n"), "s": ("sum", "n"), "a": ("min", "n"),
                                      "b": ("max", "n")}, 5)
    assert rows(salted) == rows(plain)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("max_bytes", [None, 0])
def test_lookup_join(skewed, records, how, max_bytes):
    records = records.coalesce(1)
    joined = lookup_join(skewed, records, "k", how, max_bytes=max_bytes)
    assert rows(joined) == rows(skewed.join(records, "k", how))
    assert joined.columns == ["k", "n", "v", "w"]


def test_lookup_join_spreads_hot_keys(spark, skewed, records):
    """The shuffle is by key and salt, and the salt is not folded away."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup_join(skewed, records, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [k" in plan
    assert any("hashpartitioning(k#" in line and "_salt#" in line for line in plan.splitlines())


def test_lookup_join_rejects_other_types(skewed, records):
    with pytest.raises(ValueError):
        lookup_join(skewed, records, "k", "full")


def test_two_column_key(spark, skewed):
    left = skewed.withColumn("j", F.col("n") % 3)
    right = left.select("k", "j").where("k IS NOT NULL").distinct().withColumn("x", F.concat("k", "j"))
    joined = lookup_join(left, right, ["k", "j"], max_bytes=0)
    assert rows(joined) == rows(left.join(right, ["k", "j"], "left"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_joins(skewed, records, how):
    expected = rows(skewed.join(records, "k", how))
    assert rows(salted_join(skewed, records, "k", 4, how)) == expected
    assert rows(split_salted_join(skewed, records, "k", ["hot"], 4, how)) == expected
    assert rows(split_salted_join(skewed, records, "k", hot_keys(skewed, "k", 0.05), 4, how)) == expected
    assert rows(broadcast_join(skewed, records, "k", how)) == expected


def test_salted_join_needs_left_or_inner(skewed, records):
    with pytest.raises(ValueError):
        salted_join(skewed, records, "k", 4, "full")


def test_hot_keys(skewed):
    assert {r.k: r.n for r in hot_keys(skewed, "k", 0.05).collect()} == {"hot": 1000, "unknown": 300}
    assert {r.k for r in hot_keys(skewed, "k", 0.05, sample=0.5).collect()} == {"hot", "unknown"}


def test_blank_keys(spark, records):
    left = spark.createDataFrame([(1, "k1"), (2, ""), (3, None), (4, "zz")], "n int, k string")
    assert rows(drop_blank_keys(left, "k")) == Counter([("k1", 1), ("zz", 4)])
    assert rows(join_filled_keys(left, records, "k")) == Counter([("k1", 1, "v1", 1), ("zz", 4, None, None)])
    assert rows(join_filled_keys(left, records, "k", keep_blank=True)) == Counter(
        [("k1", 1, "v1", 1), ("zz", 4, None, None), ("", 2, None, None), (None, 3, None, None)])


def test_partition_profile(spark):
    profile = partition_profile(spark.range(0, 100, 1, 4))
    assert sorted(tuple(r) for r in profile.collect()) == [(i, 25) for i in range(4)]


def test_unique_by_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q")],
                               "k string, o int, v string")
    kept = sorted(map(tuple, unique_by_key(df, ["k"], ["o"]).collect()))
    assert kept in ([("a", 2, v), ("b", None, "q")] for v in "yz")
    assert kept == sorted(map(tuple, unique_by_key(df.orderBy("v"), ["k"], ["o"]).collect()))
    assert [r.k for r in duplicate_keys(df, ["k"]).collect()] == ["a"]


def test_unique_by_key_limits_before_the_shuffle(skewed):
    plan = unique_by_key(skewed, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("seed", range(4))
def test_the_sketch_misses_no_hot_key(spark, seed):
    """Keys just at and below the share, among very many rare ones, in an order that favours neither."""
    rng = random.Random(seed)
    share, rare = 1 / 40, 20_000
    keys = [f"r{i}" for i in range(rare)]
    keys += [f"at{i}" for i in range(12) for _ in range(1000)] + [f"under{i}" for i in range(8) for _ in range(999)]
    rng.shuffle(keys)
    assert len(keys) * share < 1000
    df = spark.createDataFrame([(k, "c") for k in keys], "k string, other string").repartition(5 + seed)
    found = hot_keys(df, ["k", "other"], 1000 / len(keys))
    assert {r.k: r.n for r in found.collect()} == {f"at{i}": 1000 for i in range(12)}


def test_only_candidates_are_shuffled_by_key(spark, skewed):
    plan = hot_keys(skewed, "k", 0.05)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    exact = hot_keys(skewed, "k", 1e-6)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" not in exact


def test_hot_keys_of_no_rows(spark, skewed):
    assert hot_keys(skewed.where("false"), "k", 0.1).isEmpty()
    assert hot_keys(skewed.where("k IS NULL"), "k", 0.1).isEmpty()


def test_hot_share_follows_the_number_of_tasks(spark, skewed):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        found = {}
        for tasks in (2, 2000):
            spark.conf.set("spark.sql.shuffle.partitions", tasks)
            found[tasks] = hot_keys(skewed, "k").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert found[2] < 8 < found[2000]


def test_too_many_hot_keys_are_not_broadcast(spark, skewed, records, monkeypatch):
    monkeypatch.setattr("tagloom.operators.skew.MAX_HOT_KEYS", 1)
    every = skewed.select("k").distinct()
    joined = lookup_join(skewed, records, "k", hot=every, max_bytes=0)
    assert rows(joined) == rows(skewed.join(records, "k", "left"))


def test_filled_join_spreads_a_hot_key(spark, skewed, records):
    """The way beyond a broadcast marks the rows of the hot key."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_filled_keys(skewed, records, "k")
        assert "_hot" in joined._jdf.queryExecution().analyzed().toString()
        assert rows(joined) == rows(skewed.where("k IS NOT NULL").join(records, "k", "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
