"""Address ranges, funnels, tags, keyed tables and sources."""

import bisect
import datetime as dt
import itertools
import os
import random
import re
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tagloom.functions.ip import ip_to_long, long_to_ip
from tagloom.operators.bucketed import BucketedTable
from tagloom.operators.funnel import REPORTS, ad_funnel, all_funnels, client_label, report_from
from tagloom.operators.iprange import _carried, locate, with_ranges
from tagloom.operators.keyed import (KeyedTable, delete_rows, insert_rows, update_rows, upsert_rows)
from tagloom.operators.tags import explode_tags, row_ids, row_tags, with_codes
from tagloom.schema import AD_LOG, GEO_COLUMNS, ODS
from tagloom.sources.adlog import read_json_log
from tagloom.sources.dictionaries import device_codes, read_dictionary
from tagloom.sources.ranges import read_ranges
from tagloom.sources import tables as table_module
from tagloom.sources.tables import DatedTables


# -- addresses ----------------------------------------------------------------------

def brute_force(ranges, number):
    """The last record that starts at or before the number, if it reaches it."""
    starts = [r[0] for r in ranges]
    i = bisect.bisect_right(starts, number) - 1
    return ranges[i][2] if i >= 0 and number <= ranges[i][1] else None


@pytest.mark.parametrize("max_bytes", [-1, 1 << 20])
@pytest.mark.parametrize("overlap", [False, True])
def test_locate(spark, overlap, max_bytes):
    """By one sort, and by an index that is copied to every task."""
    rng = random.Random(int(overlap))
    starts = sorted(rng.sample(range(0, 1 << 32, 5), 300) + rng.sample(range(1 << 20, 1 << 21), 100))
    ranges = []
    for i, start in enumerate(starts):
        following = starts[i + 1] if i + 1 < len(starts) else 1 << 32
        end = rng.randrange(start, (1 << 32) if overlap and i % 4 == 0 else following)
        ranges.append((start, end, f"r{i}"))
    numbers = rng.sample(range(1 << 32), 300) + rng.sample(range(1 << 20, 1 << 21), 300)
    numbers += [r[0] for r in ranges[:50]] + [r[1] for r in ranges[:50]] + [0, (1 << 32) - 1]
    points = (spark.createDataFrame([(n,) for n in numbers], "n bigint")
              .select(long_to_ip(F.col("n")).alias("ip")))
    table = spark.createDataFrame(ranges, "start_ip bigint, end_ip bigint, name string")
    found = locate(points, {"a": table, "b": table.where("start_ip % 2 = 0")}, max_bytes)
    result = {r.n: (r.x, r.y) for r in found.select(
        ip_to_long(F.col("ip")).alias("n"), F.col("a")["name"].alias("x"), F.col("b")["name"].alias("y")).collect()}
    even = [r for r in ranges if r[0] % 2 == 0]
    assert result == {n: (brute_force(ranges, n), brute_force(even, n)) for n in numbers}


def test_small_range_tables_move_no_rows(spark):
    rows = spark.createDataFrame([(i, f"{i % 3}.0.0.{i}" if i % 5 else None) for i in range(50)], "i int, ip string")
    rows = rows.unionByName(spark.createDataFrame([(99, "nowhere"), (98, "")], rows.schema))
    table = spark.createDataFrame([(0, 20, "a"), (10, 12, "b"), (10, 15, "c"), (1 << 24, 1 << 25, "d")],
                                  "start_ip bigint, end_ip bigint, name string")
    small, large = (with_ranges(rows, {"r": table}, max_bytes) for max_bytes in (1 << 20, -1))
    assert "Exchange hashpartitioning" not in small._jdf.queryExecution().executedPlan().toString()
    assert sorted(small.collect()) == sorted(large.select(*small.columns).collect())
    names = {r.i: r.r and r.r["name"] for r in small.collect()}
    assert names[9] == "a" and names[12] == "c" and names[18] is None and names[1] == "d" and names[99] is None
    empty = with_ranges(rows, {"r": table.where("false")}, 1 << 20)
    assert empty.where("r IS NOT NULL").isEmpty() and empty.count() == rows.count()


def test_records_are_carried_into_later_blocks(spark):
    """No window over all blocks; the last record before each of them is the one."""
    rng = random.Random(3)
    starts = sorted(rng.sample(range(1 << 32), 40))
    records = spark.createDataFrame([(s, (s, s + 5)) for s in starts],
                                    "_position bigint, r struct<start_ip: bigint, end_ip: bigint>")
    for bits in (4, 7, 16):
        carried = _carried(records, "r", bits)
        assert "SinglePartition" not in carried._jdf.queryExecution().executedPlan().toString()
        found = {r["_position"]: r.r["start_ip"] for r in carried.collect()}
        size = 1 << (32 - bits)
        expected = {b * size: max(s for s in starts if s < b * size) for b in range(1 << bits) if b * size > starts[0]}
        assert found == expected


def test_locate_keeps_texts_that_are_no_addresses(spark):
    points = spark.createDataFrame([("nowhere",), ("1.1.1.1",), (None,), ("1.1.1.1",)], "ip string")
    table = spark.createDataFrame([(0, 1 << 30, "x")], "start_ip bigint, end_ip bigint, name string")
    found = locate(points, {"a": table}).select("ip", "a.name").collect()
    assert {tuple(r) for r in found} == {("nowhere", None), ("1.1.1.1", "x")} and len(found) == 2


def test_read_ranges(spark, tmp_path):
    (tmp_path / "r.csv").write_text("1.0.0.0,1.255.255.255,A\n33554432,33554433,B\n")
    table = read_ranges(spark, str(tmp_path / "r.csv"), "name string", "csv")
    assert [tuple(r) for r in table.collect()] == [(16777216, 33554431, "A"), (33554432, 33554433, "B")]


# -- funnel -------------------------------------------------------------------------

FUNNEL = ("channelid string, client bigint, device string, province string, city string, networkmannerid int,"
          " networkmannername string, ispname string, appid string, appname string, requestmode int,"
          " processnode int, adplatformproviderid bigint, iseffective int, isbilling int, isbid int, iswin int,"
          " adorderid bigint, adcreativeid bigint, winprice bigint, adpayment bigint")


@pytest.fixture(scope="module")
def log(spark):
    common = ("P", "C", 1, "WIFI", "移动", "a", "A")
    return spark.createDataFrame([
        ("c", 1, "d", *common, 1, 3, 100000, 1, 1, 1, 1, 200001, 200001, 1500, 700),
        ("c", 4, "d", *common, 2, 1, 100000, 1, 1, 1, 0, 0, 0, 900, 800),
        ("c", 5, "d", *common, 3, None, 99999, 1, 1, None, 1, 300000, 300000, 900, 800),
        ("", 1, "", *common, 1, 3, 100000, 1, 1, 1, 1, 200001, 200001, 1500, 700),
        (None, None, "d", *common, 1, 2, 100000, 1, 1, 1, 1, 200000, 200001, 1500, 700),
    ], FUNNEL)


def test_funnel(log):
    row, = ad_funnel(log, "channelid").collect()
    assert row.asDict() == {
        "channelid": "c", "org_request_num": 1, "valid_request_num": 1, "ad_request_num": 1, "bid_num": 1,
        "bid_success_num": 1, "ad_show_num": 1, "ad_click_num": 1, "media_show_num": 1, "media_click_num": 1,
        "ad_consumption": 1.5, "ad_cost": 1.5, "bid_success_rate": 1.0, "click_rate": 1.0}


def test_cost_column(log):
    assert ad_funnel(log, "channelid", cost_column="adpayment").first().ad_cost == 0.7


def test_clients_are_grouped_by_label(log):
    counts = {(r.client, r.device): r.ad_click_num + r.ad_show_num for r in ad_funnel(log, "client", "device").collect()}
    assert counts == {("android", "d"): 0, ("other", "d"): 2}


def test_no_denominator_gives_null(log):
    row = ad_funnel(log.where("channelid IS NULL"), "appid", "appname").first()
    assert row.click_rate is None and row.bid_success_rate == 1.0


def test_client_label(spark):
    labels = spark.createDataFrame([(c,) for c in (1, 2, 3, 9, None)], "c bigint").select(client_label(F.col("c")).alias("x"))
    assert [r.x for r in labels.collect()] == ["android", "ios", "wp", "other", None]


def test_one_pass_equals_single_reports(log):
    together = all_funnels(log)
    for name, report in REPORTS.items():
        single = ad_funnel(log, *report.dimensions)
        part = report_from(together, name).select(*single.columns)
        assert sorted(map(tuple, part.collect())) == sorted(map(tuple, single.collect()))


# -- tags ---------------------------------------------------------------------------

TAGGED = ("appname string, device string, client bigint, ispname string, networkmannername string,"
          " devicetype bigint, province string, city string, channelid string, keywords string, age string,"
          " sex string, areas string")


def test_row_tags(spark):
    df = spark.createDataFrame([
        ("微信", "htc", 1, "移动", "WIFI", 1, "A省", "B市", "123", "x,y,,x", "30", "0", "P,Q"),
        ("", None, 9, "网通", None, 2, None, None, "", None, None, "1", " "),
        (None,) * 13], TAGGED)
    rows = with_codes(df, device_codes(spark)).select("age", row_tags().alias("t")).collect()
    tags = sorted((set(r.t) for r in rows), key=len, reverse=True)
    assert all(len(set(r.t)) == len(r.t) for r in rows)
    assert tags[0] == {"APP_微信", "DV_htc", "DT_D00010001", "ISP_D00030001", "NW_D00020001", "NW_手机", "PV_A省",
                       "CT_B市", "CN_123", "KW_x", "KW_y", "AGE_30", "SEX_女", "BA_P", "BA_Q"}
    assert tags[1] == {"APP_", "DT_OTHER", "ISP_OTHER", "NW_OTHER", "NW_平板", "CN_", "SEX_男"}
    assert tags[2] == {"ISP_OTHER", "NW_OTHER"}


def test_explode_tags_computes_them_once(spark):
    df = with_codes(spark.createDataFrame([(None,) * 13], TAGGED), device_codes(spark))
    plan = explode_tags(df.select(row_tags().alias("tags")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("array_except(concat") == 1


def test_row_ids(spark):
    df = spark.createDataFrame([("i", "m", "d", "o", "a"), (" ", "m", None, "", "\t")],
                               "imei string, mac string, idfa string, openudid string, androidid string")
    assert [r.x for r in df.select(row_ids().alias("x")).collect()] == [["a", "o", "m", "d", "i"], ["m"]]
    assert [r.x for r in df.select(row_ids(qualify=True).alias("x")).collect()][1] == ["mac:m"]


def test_read_dictionary(spark, tmp_path):
    (tmp_path / "d").write_text("a##1\nb##2\na##3\nc\n")
    assert {tuple(r) for r in read_dictionary(spark, str(tmp_path / "d"), "k", "v").collect()} == {
        ("a", "3"), ("b", "2"), ("c", "c")}


# -- keyed tables -------------------------------------------------------------------

KEYED = "id int, name string, age int"


@pytest.fixture
def stock(spark):
    table = KeyedTable(spark, "stock", ["id"], parts=4)
    table.drop()
    table.create(spark.createDataFrame([], KEYED).schema)
    yield table
    table.drop()


def rows_of(table):
    return sorted(map(tuple, table.read().collect()))


def test_keyed_table(spark, stock):
    stock.create(spark.createDataFrame([], KEYED).schema)  # it stays as it is
    tools = [(100 + i, f"tool {i}", 7 * i) for i in range(12)]
    assert stock.insert(spark.createDataFrame(tools, KEYED)).isEmpty()
    stock.delete(spark.createDataFrame([(103,), (104,), (999,)], "id int"))
    stock.update(spark.createDataFrame([(101, "saw"), (102, None), (998, "nothing")], "id int, name string"))
    stock.upsert(spark.createDataFrame([(105, "axe", 1), (200, "nail", None)], KEYED))
    wanted = {i: (i, name, n) for i, name, n in tools if i not in (103, 104)}
    wanted |= {101: (101, "saw", 7), 102: (102, None, 14), 105: (105, "axe", 1), 200: (200, "nail", None)}
    assert rows_of(stock) == sorted(wanted.values(), key=str)
    assert stock.read("id", "name").columns == ["id", "name"]
    stock.delete(stock.read("id"))
    assert rows_of(stock) == []
    stock.drop()
    assert not stock.exists()


def test_insert_returns_all_rows_that_are_not_stored(spark, stock):
    rows = spark.createDataFrame([(1, "x", 1), (1, "y", 1), (2, "z", 1)], KEYED)
    assert [tuple(r) for r in stock.insert(rows).collect()] == [(1, "x", 1)]
    assert sorted(map(tuple, stock.insert(rows).collect())) == sorted(map(tuple, rows.collect()))
    assert rows_of(stock) == [(1, "y", 1), (2, "z", 1)]


def test_repeated_keys_of_a_change_are_refused(spark, stock):
    stock.append(spark.createDataFrame([(1, "a", 1)], KEYED))
    twice = spark.createDataFrame([(1, "p", 1), (1, "q", 1)], KEYED)
    for change in (stock.update, stock.upsert):
        with pytest.raises(ValueError, match="not unique"):
            change(twice)
    assert rows_of(stock) == [(1, "a", 1)]


def test_a_change_rewrites_only_the_folders_of_its_keys(spark, stock):
    stock.append(spark.range(200).selectExpr("CAST(id AS INT) AS id", "'n' AS name", "1 AS age"))
    before = {f for f in stock.read().inputFiles()}
    stock.upsert(spark.createDataFrame([(7, "seven", 7)], KEYED))
    assert len(before & set(stock.read().inputFiles())) >= len(before) * 3 // 4
    assert stock.read().count() == 200 and stock.read().where("name = 'seven'").count() == 1


def test_sql_inserts_between_tables(spark, stock):
    stock.append(spark.createDataFrame([(1, "a", 5), (2, "b", 50)], KEYED))
    spark.sql("INSERT INTO stock (id, name, age) SELECT id + 10, name, age FROM stock WHERE age > 30")
    assert rows_of(stock) == [(1, "a", 5), (2, "b", 50), (12, "b", 50)]
    assert [r.id for r in stock.insert(spark.createDataFrame([(12, "c", 1)], KEYED)).collect()] == [12]
    stock.update(spark.createDataFrame([(12, "twelve")], "id int, name string"))
    assert rows_of(stock) == [(1, "a", 5), (2, "b", 50), (12, "twelve", 50)]
    assert spark.table("stock").where("_part IS NULL").isEmpty()


def test_keyed_frames(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], KEYED)
    rows, conflicts = insert_rows(target, spark.createDataFrame([(2, "x", 9), (3, "c", 3)], KEYED), ["id"])
    assert {tuple(r) for r in rows.collect()} == {(1, "a", 1), (2, "b", 2), (3, "c", 3)}
    assert [tuple(r) for r in conflicts.collect()] == [(2, "x", 9)]
    rows, conflicts = insert_rows(target, spark.createDataFrame([(3, "c", 3), (3, "d", 3)], KEYED), ["id"])
    assert rows.count() == 3 and [r.name for r in conflicts.collect()] == ["c"]
    updated = update_rows(target, spark.createDataFrame([(2, None)], "id int, name string"), ["id"])
    assert {tuple(r) for r in updated.collect()} == {(1, "a", 1), (2, None, 2)}
    with pytest.raises(ValueError):
        delete_rows(target, target, ["id"])
    assert [r.id for r in delete_rows(target, target.select("id").where("id = 1"), ["id"]).collect()] == [2]
    upserted = upsert_rows(target, spark.createDataFrame([(2, "z", 0), (4, "d", 4)], KEYED), ["id"])
    assert {tuple(r) for r in upserted.collect()} == {(1, "a", 1), (2, "z", 0), (4, "d", 4)}


def _layout(spark, *frames):
    tables = [BucketedTable(spark, f"t{uuid.uuid4().hex}", ["id"], 4) for _ in frames]
    for one, frame in zip(tables, frames):
        one.write(frame)
    return tables


def test_bucketed_tables_are_changed_where_they_lie(spark):
    old = spark.createDataFrame([(i, f"o{i}", i if i % 3 else None) for i in range(40)], KEYED)
    new = spark.createDataFrame([(i, None if i % 2 else f"n{i}", -i) for i in range(30, 50)], KEYED)
    table, patch = _layout(spark, old, new)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        plan = table.join(patch.__class__(spark, patch.name, ["id"], 4))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        plan = table._matched(patch, "full_outer", F.coalesce("_new_row", "_old_row"))
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    olds, news = ({r.id: tuple(r) for r in df.collect()} for df in (old, new))
    table.update(patch)
    assert {r.id: tuple(r) for r in table.read().collect()} == {i: news.get(i, olds[i]) for i in olds}
    table.upsert(patch)
    assert {r.id: tuple(r) for r in table.read().collect()} == olds | news
    table.delete(patch)
    assert {r.id: tuple(r) for r in table.read().collect()} == {i: r for i, r in olds.items() if i not in news}
    assert len(table.versions()) == 2 and table.version() in table.versions()
    with pytest.raises(ValueError, match="differently"):
        table.join(BucketedTable(spark, patch.name, ["id"], 5))
    table.drop()
    patch.drop()
    assert not table.exists() and table.versions() == []


def test_a_lookup_reads_its_buckets_only(spark):
    table, = _layout(spark, spark.range(1000).toDF("id"))
    found = table.lookup(17, 512)
    assert sorted(r.id for r in found.collect()) == [17, 512]
    setting = "spark.sql.sources.bucketing.autoBucketedScan.enabled"  # else the plan doesn't tell
    spark.conf.set(setting, "false")
    try:
        plan = table.lookup(17, 512)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(setting)
    assert re.search(r"SelectedBucketsCount: [12] out of 4", plan) and "PushedFilters: [In(id" in plan
    folder = spark.sql(f"DESCRIBE FORMATTED {table.version()}").where("col_name = 'Location'").first()[1]
    files = [f"{folder.removeprefix('file:')}/{f}" for f in os.listdir(folder.removeprefix("file:")) if f.endswith("parquet")]
    assert len(files) == 4
    for name in files:  # sorted, with the least and greatest value of each row group
        ids = pq.read_table(name).column("id").to_pylist()
        statistics = pq.ParquetFile(name).metadata.row_group(0).column(0).statistics
        assert ids == sorted(ids) and (statistics.min, statistics.max) == (ids[0], ids[-1])
    table.drop()


def test_a_killed_change_leaves_the_table_before_it(spark, monkeypatch):
    table, = _layout(spark, spark.range(10).toDF("id"))
    for step in ("_publish", "version"):
        with monkeypatch.context() as patch:
            calls = itertools.count()

            def killed(self, *args, real=getattr(BucketedTable, step), name=step):
                if name == "_publish" or next(calls) > 0:
                    raise KeyboardInterrupt
                return real(self, *args)
            patch.setattr(BucketedTable, step, killed)
            with pytest.raises(KeyboardInterrupt):
                table.write(spark.range(5).toDF("id"))
                table.version()
        assert table.read().count() in (10, 5)
    with pytest.raises(ValueError, match="not unique"):
        table.write(spark.createDataFrame([(1,), (1,)], "id bigint"))
    table.write(spark.range(7).toDF("id"))
    assert table.read().count() == 7 and len(table.versions()) == 2
    table.drop()


def test_dated_tables(spark, tmp_path):
    tables, day = DatedTables(spark, str(tmp_path)), dt.date(2024, 1, 2)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert tables.read_or_empty("t", day, df.schema, first_run=True).isEmpty()
    with pytest.raises(ValueError, match="missing"):
        tables.read_or_empty("t", day, df.schema)
    for _ in range(2):
        tables.write(df, "t", day, ["id"], partitions=3)
    assert "/t/dt=20240102/" in tables.path("t", day)
    assert sorted(map(tuple, tables.read_or_empty("t", day, df.schema).collect())) == [(1, "a"), (2, "b")]
    assert tables.read("t", day, ["v"]).columns == ["v"]
    tables.append(df.where("id = 1"), "t", day)
    assert tables.read("t", day).count() == 3
    with pytest.raises(ValueError):
        tables.write(df.union(df), "t", day, ["id"])
    assert tables.read("t", day).count() == 3 and os.listdir(tmp_path / "t") == ["dt=20240102"]
    tables.drop("t", day)
    tables.drop("t", day)
    assert not tables.exists("t", day)


STEPS = ("create_marker", "delete_path", "duplicate_keys")


@pytest.mark.parametrize("rows_before", [0, 2])
def test_a_killed_writer_leaves_one_whole_version(spark, tmp_path, monkeypatch, rows_before):
    """The writer is killed before and after each of its steps; readers see the old rows or the new."""
    day = dt.date(2024, 1, 2)
    new = spark.range(5).toDF("id")
    seen = set()
    for kill_at in range(12):
        tables = DatedTables(spark, f"{tmp_path}/{rows_before}-{kill_at}")
        for n in range(rows_before):
            tables.write(spark.range(10 + n).toDF("id"), "t", day, ["id"])
        steps = itertools.count()
        with monkeypatch.context() as patch:
            for name in STEPS:
                def step(*args, real=getattr(table_module, name)):
                    if next(steps) >= kill_at:  # what is dead does nothing any more
                        raise KeyboardInterrupt
                    return real(*args)
                patch.setattr(table_module, name, step)
            try:
                tables.write(new, "t", day, ["id"])
            except KeyboardInterrupt:
                pass
        found = tables.read("t", day).count() if tables.exists("t", day) else None
        assert found in ({5, 9 + rows_before} if rows_before else {5, None})
        seen.add(found)
        tables.write(spark.range(7).toDF("id"), "t", day, ["id"])
        assert tables.read("t", day).count() == 7
        assert len(os.listdir(tables.folder("t", day))) <= 3  # this version, the one before, the markers
    assert len(seen) == 2


def test_latest_before(spark, tmp_path):
    tables, df = DatedTables(spark, str(tmp_path)), spark.range(1).toDF("id")
    days = [dt.date(2023, 12, 30), dt.date(2024, 1, 2), dt.date(2024, 1, 9)]
    assert tables.latest_before("t", days[2]) is None
    for day in days:
        tables.write(df, "t", day)
    assert tables.latest_before("t", days[2]) == days[1]
    tables.drop("t", days[1])
    assert tables.latest_before("t", days[2]) == days[0] and tables.latest_before("t", days[0]) is None


# -- raw log ------------------------------------------------------------------------

def test_schema():
    assert len(ODS) == 89 and len(AD_LOG) == 85
    assert not set(GEO_COLUMNS) & set(AD_LOG.names)


def test_read_json_log(spark, tmp_path):
    path = tmp_path / "log.json"
    path.write_text('{"sessionid": "s1", "winprice": 2.5, "client": 1, "unknown": 3}\nbroken\n')
    rows = read_json_log(spark, str(path), keep_corrupt=True).collect()
    assert [r._corrupt_record for r in rows] == [None, "broken"]
    assert (rows[0].sessionid, float(rows[0].winprice), rows[0].client, rows[0].imei) == ("s1", 2.5, 1, None)
    assert "unknown" in read_json_log(spark, str(path), schema=None).columns
