"""Components, merged tags and history."""

import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tagloom.operators.components import connected_components
from tagloom.operators.history import (cooled, decayed, extend_cooling, extend_history, left_after_a_day,
                                       merge_cooled, merge_history)
from tagloom.operators.identity import (extend_members, id_weights, identity_edges, members_of,
                                        user_weights)
from tagloom.operators.userrows import (from_text, members_and_weights, to_text, user_rows)
from tagloom.plans.tags import build_tags, records
from tagloom.session import Scratch


def edges_frame(spark, edges):
    return spark.createDataFrame([(str(a), str(b)) for a, b in edges], "src string, dst string")


def union_find(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = root(str(a)), root(str(b))
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def components(spark, edges, **options):
    rows = connected_components(edges_frame(spark, edges), **options).collect()
    labels = {r.id: r.component for r in rows}
    assert len(labels) == len(rows)
    return labels


# Two households: devices seen at routers, one of which moved between two routers.
SEEN = [("phone", "r1"), ("tablet", "r1"), ("tv", "r1"), ("tablet", "r2"), ("watch", "r2"),
        ("laptop", "r3"), ("printer", "r3")]
HOUSEHOLDS = [["laptop", "printer"], ["phone", "tablet", "tv", "watch"]]


def test_groups(spark):
    groups = defaultdict(set)
    for vertex, label in components(spark, SEEN).items():
        if vertex not in ("r1", "r2", "r3"):
            groups[label].add(vertex)
    assert sorted(map(sorted, groups.values())) == HOUSEHOLDS


def test_names_by_component(spark):
    """The devices regrouped, with their owners' names."""
    names = spark.createDataFrame([(d, f"{d} of mine") for g in HOUSEHOLDS for d in g], "id string, name string")
    labels = connected_components(edges_frame(spark, SEEN))
    groups = names.join(labels, "id").groupBy("component").agg(F.sort_array(F.collect_set("name")).alias("n"))
    assert sorted(r.n for r in groups.collect()) == [[f"{d} of mine" for d in g] for g in HOUSEHOLDS]


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_against_union_find(spark, broadcast_bytes):
    rng = random.Random(5)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(300)]
    star = [("hub", f"s{i}") for i in range(300)]
    scattered = [(f"r{rng.randrange(300)}", f"r{rng.randrange(300)}") for _ in range(220)]
    alone = [("x", "x"), ("y", "y"), ("hub", "hub")]
    edges = chain + star + scattered + alone + star[:5]
    rng.shuffle(edges)
    assert components(spark, edges, max_broadcast_bytes=broadcast_bytes) == union_find(edges)


def test_direction_does_not_matter(spark):
    assert components(spark, [(b, a) for a, b in reversed(SEEN)]) == components(spark, SEEN)


def test_only_isolated_and_empty(spark):
    assert components(spark, [("a", "a"), ("b", "b"), ("a", "a")]) == {"a": "a", "b": "b"}
    assert connected_components(edges_frame(spark, SEEN).limit(0)).isEmpty()


def records_frame(spark, records):
    return spark.createDataFrame(records, "ids array<string>, tags array<string>")


def test_tag_merge(spark):
    """Three records of one user, and one of another with some of the same tags."""
    records = [(["p1", "q1"], ["KW_tea", "KW_cup", "CT_Oslo"]), (["q1", "p1"], ["KW_tea", "CT_Bergen"]),
               (["q1", "z9"], ["KW_tea", "CT_Oslo", "AGE_31"]), (["k7"], ["KW_tea", "CT_Oslo"])]
    frame = records_frame(spark, records)
    members = members_of(identity_edges(frame))
    assert {(r.user_id, r.id) for r in members.collect()} == {
        ("p1", "p1"), ("p1", "q1"), ("p1", "z9"), ("k7", "k7")}
    weights = user_weights(id_weights(frame), members).collect()
    assert {(r.user_id, r.tag): r.weight for r in weights} == {
        ("p1", "KW_tea"): 3, ("p1", "CT_Oslo"): 2, ("p1", "KW_cup"): 1, ("p1", "CT_Bergen"): 1,
        ("p1", "AGE_31"): 1, ("k7", "KW_tea"): 1, ("k7", "CT_Oslo"): 1}


def weights_frame(spark, rows, key="user_id"):
    return spark.createDataFrame(rows, f"{key} string, tag string, weight double")


def members_frame(spark, rows):
    return spark.createDataFrame(rows, "user_id string, id string")


def test_decay(spark):
    weights = weights_frame(spark, [("u", "KW_a", 2.0), ("u", "BA_b", 1.0)])
    assert {r.tag: r.weight for r in decayed(weights).collect()} == {"KW_a": 1.8, "BA_b": 0.9}
    assert {r.tag: r.weight for r in decayed(weights, {"KW_": 0.5}).collect()} == {"KW_a": 1.0, "BA_b": 0.9}


def test_history_decays_and_adds(spark):
    members, weights = merge_history(
        members_frame(spark, [("u", "u")]), weights_frame(spark, [("u", "a", 2.0), ("u", "b", 1.0)]),
        edges_frame(spark, [("u", "u")]),
        weights_frame(spark, [("u", "a", 1.0), ("u", "c", 1.0)], "id"))
    assert {r.tag: round(r.weight, 6) for r in weights.collect()} == {"a": 2.8, "b": 0.9, "c": 1.0}


def test_today_bridges_old_users(spark):
    members, weights = merge_history(
        members_frame(spark, [("A1", "A1"), ("M1", "M1"), ("M1", "M0x")]),
        weights_frame(spark, [("A1", "a", 1.0), ("M1", "m", 1.0)]),
        edges_frame(spark, [("A1", "A1"), ("A1", "M1")]),
        weights_frame(spark, [("A1", "t", 1.0)], "id"))
    assert {(r.user_id, r.id) for r in members.collect()} == {("A1", "A1"), ("A1", "M1"), ("A1", "M0x")}
    assert {(r.user_id, r.tag, r.weight) for r in weights.collect()} == {
        ("A1", "a", 0.9), ("A1", "m", 0.9), ("A1", "t", 1.0)}


@pytest.mark.parametrize("parts", [1, 7])
def test_user_rows_keep_everything(spark, parts):
    """Also names that hold the separators of the text form and its escapes."""
    names = ["a,b", "C#", "x -> y", "\\h", "\\", "->", "a -", "\\b,#", " "]
    members = members_frame(spark, [("big", i) for i in names + [f"i{i}" for i in range(100)]] + [("small", "s")])
    weights = weights_frame(spark, [("big", t, 0.5) for t in names + [f"t{i}" for i in range(40)]]
                            + [("small", "t", 1.0)])
    text = to_text(user_rows(members, weights, parts))
    if parts == 1:
        assert [r.part for r in text.collect()] == [0, 0]
    back_members, back_weights = members_and_weights(from_text(text))
    assert sorted(map(tuple, back_members.collect())) == sorted(map(tuple, members.collect()))
    assert sorted(map(tuple, back_weights.collect())) == sorted(map(tuple, weights.collect()))


def test_large_users_are_written_in_bounded_rows(spark):
    """A user with a third of all entries; the others keep one row."""
    members = members_frame(spark, [("big", f"i{i}") for i in range(150)] + [(f"u{i}", f"u{i}") for i in range(60)])
    weights = weights_frame(spark, [("big", f"t{i}", 1.0) for i in range(50)] + [(f"u{i}", "t", 1.0) for i in range(200)])
    scratch = Scratch(spark, "large")
    members, weights = scratch.save(members, "members"), scratch.save(weights, "weights")
    rows = user_rows(members, weights, row_entries=20).collect()
    big = [len(r.ids) + len(r.tags) for r in rows if r.user_id == "big"]
    assert sum(big) == 200 and len(big) == 10 and max(big) < 50
    assert all(r.part == 0 for r in rows if r.user_id != "big") and len(rows) == 10 + 200
    back_members, back_weights = members_and_weights(from_text(to_text(user_rows(members, weights, row_entries=20))))
    assert _sorted(back_members) == _sorted(members) and _sorted(back_weights) == _sorted(weights)


def test_text_without_part(spark):
    text = spark.createDataFrame([("u", "u,v", "a -> 1.5#b -> 2.0")], "user_id string, all_user_id string, tags string")
    members, weights = members_and_weights(from_text(text))
    assert sorted(r.id for r in members.collect()) == ["u", "v"]
    assert {r.tag: r.weight for r in weights.collect()} == {"a": 1.5, "b": 2.0}


# -- day by day -----------------------------------------------------------------------

def _sorted(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.collect())


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_days_in_sequence_equal_one_run_over_all(spark, threshold):
    """Random days over few ids, among them days that join old users, and one without a known id."""
    rng = random.Random(8)
    days = [[(f"i{rng.randrange(60):02d}", f"i{rng.randrange(60):02d}") for _ in range(n)] for n in (9, 7, 1, 12)]
    days += [[("n1", "n1"), ("n2", "a0")], [(days[0][0][0], days[1][0][0]), (days[0][1][1], "n2")], []]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        members, weights, full = members_frame(spark, []), weights_frame(spark, []), (members_frame(spark, []), weights_frame(spark, []))
        seen = []
        for n, day in enumerate(days):
            edges = edges_frame(spark, day) if day else edges_frame(spark, [("x", "x")]).limit(0)
            seen += day
            rows = [(a, f"t{n % 3}", 1.0 + i) for i, (a, _) in enumerate(day)]
            today = weights_frame(spark, rows, "id")
            scratch = Scratch(spark, "days")
            members, weights = (scratch.save(df, name) for df, name in zip(
                extend_history(members, weights, edges, today), ("members", "weights")))
            full = tuple(scratch.save(df, name) for df, name in zip(
                merge_history(*full, edges, today), ("full", "full_weights")))
            assert {r.id: r.user_id for r in members.collect()} == union_find(seen)
            assert _sorted(members) == _sorted(full[0].select(*members.columns))
            assert _sorted(weights) == _sorted(full[1].select(*weights.columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_old_members_are_not_shuffled_for_a_small_day(spark, tmp_path):
    old = spark.range(5000).selectExpr("concat('u', id % 700) AS user_id", "concat('u', id) AS id")
    old.write.parquet(str(tmp_path / "old"))
    found = extend_members(spark.read.parquet(str(tmp_path / "old")), edges_frame(spark, [("u3", "u9"), ("u3", "new")]))
    assert {tuple(r) for r in found.touched.collect()} == {("u3", "new"), ("u9", "new")}
    plan = found.members._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan.split("Union")[1].split("old]")[0]
    assert found.members.where("user_id = 'new'").count() == 17


def cooling_frame(spark, rows):
    return spark.createDataFrame([(u, t, w, dt.date(2024, 1, d)) for u, t, w, d in rows],
                                 "user_id string, tag string, weight double, day date")


def test_cooling_once_equals_cooling_daily(spark):
    weights = cooling_frame(spark, [("u", "KW_a", 2.0, 1), ("u", "BA_b", 1.0, 4)])
    decay = {"KW_": left_after_a_day(0.2)}
    once = cooled(weights, dt.date(2024, 1, 9), decay)
    for day in range(5, 10):
        weights = cooled(weights, dt.date(2024, 1, day), decay)
    assert _sorted(once) == _sorted(weights)
    assert {r.tag: round(r.weight, 9) for r in once.collect()} == {
        "KW_a": round(2 * math.exp(-0.2 * 8), 9), "BA_b": round(0.9 ** 5, 9)}


def test_merging_in_any_grouping_is_the_same(spark):
    rng = random.Random(4)
    rows = [(f"u{rng.randrange(4)}", f"t{rng.randrange(3)}", rng.random(), rng.randint(1, 20)) for _ in range(80)]
    end = dt.date(2024, 1, 31)
    every = merge_cooled(cooling_frame(spark, rows), end)
    a, b, c = (cooling_frame(spark, rows[i::3]) for i in range(3))
    left = merge_cooled(merge_cooled(a.unionByName(b), dt.date(2024, 1, 21)).unionByName(c), end)
    right = merge_cooled(a.unionByName(merge_cooled(b.unionByName(c), dt.date(2024, 1, 28)).select(*a.columns)), end)
    assert _sorted(every) == _sorted(left.select(*every.columns)) == _sorted(right.select(*every.columns))


def test_users_without_records_keep_the_day_of_their_weights(spark):
    old = cooling_frame(spark, [("a", "x", 1.0, 1), ("b", "x", 1.0, 2), ("c", "x", 1.0, 2)])
    members, weights = extend_cooling(
        members_frame(spark, [("a", "a"), ("b", "b"), ("c", "c")]), old, edges_frame(spark, [("b", "a"), ("d", "d")]),
        weights_frame(spark, [("b", "x", 1.0), ("d", "y", 1.0)], "id"), dt.date(2024, 1, 11))
    assert {(r.user_id, r.tag): (round(r.weight, 9), r.day.day) for r in weights.collect()} == {
        ("a", "x"): (round(1 + 0.9 ** 9 + 0.9 ** 10, 9), 11), ("c", "x"): (1.0, 2), ("d", "y"): (1.0, 11)}
    assert _sorted(members) == [("a", "a"), ("a", "b"), ("c", "c"), ("d", "d")]


@pytest.mark.parametrize("threshold, cooling_day", [("10MB", None), ("-1", dt.date(2024, 1, 2))])
def test_tags_are_summed_per_user_at_once(spark, monkeypatch, threshold, cooling_day):
    """Half of the rows have the same main id, some come twice and some have no id; no tags per id are stored."""
    log = spark.range(400).selectExpr(
        "string(id) AS sessionid", "if(id % 2 = 0, 'hot', if(id % 9 = 0, ' ', 'I' || id % 40)) AS imei",
        "if(id % 7 = 0, 'M' || id % 20, NULL) AS mac", "if(id % 5 = 0, 'D' || id, NULL) AS idfa",
        "'' AS openudid", "string(NULL) AS androidid", "'X' || id % 3 AS appid", "'App' || id % 3 AS appname",
        "if(id % 4 = 0, NULL, 'DEV ' || id % 6) AS device", "id % 3 AS client", "'移动' AS ispname",
        "'WIFI' AS networkmannername", "id % 2 AS devicetype", "'P' || id % 2 AS province", "'C' || id % 5 AS city",
        "'c' || id % 8 AS channelid", "'a,b,a,' || id % 6 AS keywords", "20 + id % 3 AS age", "id % 2 AS sex",
        "double(id % 10) AS longitude", "double(id % 10) AS latitude")
    log = log.unionByName(log.where("sessionid % 11 = 0"))
    log = Scratch(spark, "test").save(log, "log")
    sides = [spark.sql(f"SELECT {columns}") for columns in (
        "'s00000000' AS geohash, 'x,y' AS areas", "'X1' AS appid, 'One' AS appname", "'WIFI' AS value, 'N1' AS code")]
    per_row = Scratch(spark, "test").save(records(log, *sides), "records")
    weights = user_weights(id_weights(per_row), members_of(identity_edges(per_row)))
    expected = {(r.user_id, r.tag): r.weight for r in weights.collect()}
    schemas = ("user_id string, id string", f"user_id string, tag string, weight double{', day date' if cooling_day else ''}")
    empty = [Scratch(spark, "test").save(spark.createDataFrame([], schema), "empty") for schema in schemas]
    stored, save = [], Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: (stored.append(df.columns), save(self, df, name))[1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for history in (None, empty):
            _, found = build_tags(log, *sides, history, cooling_day=cooling_day)
            rows = found.collect()
            assert {(r.user_id, r.tag): r.weight for r in rows} == expected and len(rows) == len(expected) > 100
            assert not cooling_day or {r.day for r in rows} == {cooling_day}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [columns for columns in stored if "tag" in columns]
