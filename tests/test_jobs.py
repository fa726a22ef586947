"""The jobs of two days, end to end."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tagloom.__main__ import main
from tagloom.operators.funnel import REPORTS, ad_funnel
from tagloom.plans.daily import (run_area_dictionary, run_cooling_tags, run_etl, run_report_part,
                                run_reports, run_reports_of_parts, run_tags)
from tagloom.plans.ods import build_ods
from tagloom.schema import ODS_COLUMNS
from tagloom.session import Scratch, shared_folder
from tagloom.sources.dictionaries import device_codes
from tagloom.sources.tables import DatedTables
from workload.adlog import app_names, place_ranges, raw_log, region_ranges, responses, table

SF = "/root/testdata/sf0.001"
DAYS = (dt.date(2024, 1, 15), dt.date(2024, 1, 16))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    tables = DatedTables(spark, str(tmp_path_factory.mktemp("tables")))
    log = raw_log(spark, SF)
    answers = ('{"regeocode":{"addressComponent":{"businessAreas":[{"id":"1","location":"x","name":"N"}]}}}')
    places = place_ranges(spark, SF).select(F.concat_ws(",", "lon", "lat").alias("location"),
                                            F.lit(answers).alias("response"))
    for i, day in enumerate(DAYS):
        run_etl(tables, day, log.where(F.col("sessionid").cast("bigint") % 2 == i), region_ranges(spark, SF),
                place_ranges(spark, SF))
        run_reports(tables, day)
        run_area_dictionary(tables, day, places)
        run_tags(tables, day, app_names(spark), device_codes(spark), first_run=i == 0)
    return tables


def users(tables, day):
    return tables.read("tag_members", day), tables.read("tag", day)


def test_ods(tables, spark):
    ods = tables.read("ods", DAYS[0])
    assert ods.columns == list(ODS_COLUMNS)
    assert ods.count() + tables.read("ods", DAYS[1]).count() == table(spark, SF, "events").count()


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_ods_of_a_log_that_came_twice(spark, tmp_path, monkeypatch, threshold):
    """The log is stored apart only if large range tables have it read twice; wide rows run compiled meanwhile."""
    saved, limits, limit = [], [], "spark.sql.codegen.hugeMethodLimit"
    save, write = Scratch.save, DatedTables.write
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: saved.append(name) or save(self, df, name))
    monkeypatch.setattr(DatedTables, "write", lambda self, *args, **more: limits.append(
        int(spark.conf.get(limit))) or write(self, *args, **more))
    before, threshold_before = spark.conf.get(limit), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    log = raw_log(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        tables = DatedTables(spark, str(tmp_path / "tables"))
        run_etl(tables, DAYS[0], log.unionByName(log), region_ranges(spark, SF), place_ranges(spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold_before)
    assert ("log" in saved) == (threshold == "-1")
    assert limits == [8000] and spark.conf.get(limit) == before
    found = tables.read("ods", DAYS[0])
    expected = build_ods(log, region_ranges(spark, SF), place_ranges(spark, SF))
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_reports(tables):
    ods = tables.read("ods", DAYS[0])
    for report in REPORTS.values():
        expected = ad_funnel(ods, *report.dimensions)
        stored = tables.read(report.table, DAYS[0], expected.columns)
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, expected.collect()))
    counts = tables.read("province_city_analysis", DAYS[0])
    assert counts.agg(F.sum("count")).first()[0] == ods.where("province <> '' AND city <> ''").count()


def test_tags_of_first_day(tables):
    members, weights = users(tables, DAYS[0])
    assert members.count() == members.select("id").distinct().count()
    assert weights.where("tag = 'BA_N'").count() > 0
    assert weights.where("weight % 1 <> 0").isEmpty()


def test_second_day_has_history(tables):
    first, first_weights = users(tables, DAYS[0])
    second, second_weights = users(tables, DAYS[1])
    assert first.select("id").subtract(second.select("id")).isEmpty()
    assert second.select("id").distinct().count() == second.count()
    ods = tables.read("ods", DAYS[1])
    today = second_weights.agg(F.sum("weight")).first()[0] - 0.9 * first_weights.agg(F.sum("weight")).first()[0]
    assert ods.count() > 0 and abs(today - round(today)) < 1e-6


def test_jobs_leave_no_scratch(tables, spark):
    def listed():
        folder = shared_folder(spark).removeprefix("file:")
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    before = listed()
    run_area_dictionary(tables, DAYS[1], spark.createDataFrame([], "location string, response string"))
    run_reports(tables, DAYS[1])
    run_tags(tables, DAYS[1], app_names(spark), device_codes(spark))
    assert listed() == before


def test_a_missed_day_is_an_error(tables, spark):
    day = DAYS[1] + dt.timedelta(days=2)
    for name in ("ods", "business_area"):
        tables.write(tables.read(name, DAYS[1]), name, day)
    with pytest.raises(ValueError, match="missing"):
        run_tags(tables, day, app_names(spark), device_codes(spark))
    assert not tables.exists("tag", day)


def test_a_late_part_adds_its_own(tables, spark):
    """Reports of parts are those of the whole day, also after a part came late or was run again."""
    day = DAYS[1]
    run_reports(tables, day)
    names = [r.table for r in REPORTS.values()] + ["province_city_analysis"]
    whole = {name: sorted(map(str, tables.read(name, day).collect())) for name in names}
    rows = tables.read("ods", day).withColumn("n", F.xxhash64("sessionid") % 3)
    with pytest.raises(ValueError, match="no part"):
        run_reports_of_parts(tables, day)
    for part in (0, 1, -1):
        run_report_part(tables, day, f"file{part}", rows.where(F.col("n") == part))
    run_reports_of_parts(tables, day)
    early = tables.read("ad_region_analysis", day).agg(F.sum("ad_request_num")).first()[0]
    for part in (2, -2, 1):
        run_report_part(tables, day, f"file{part}", rows.where(F.col("n") == part))
    run_reports_of_parts(tables, day)
    assert early < tables.read("ad_region_analysis", day).agg(F.sum("ad_request_num")).first()[0]
    assert whole == {name: sorted(map(str, tables.read(name, day).select(
        *tables.read(name, day).columns).collect())) for name in names}


def test_cooling_bears_missed_days(tables, spark):
    names, codes = app_names(spark), device_codes(spark)
    later = DAYS[1] + dt.timedelta(days=5)
    with pytest.raises(ValueError, match="first_run"):
        run_cooling_tags(tables, DAYS[1], names, codes)
    run_cooling_tags(tables, DAYS[1], names, codes, first_run=True)
    for name in ("ods", "business_area"):
        tables.write(tables.read(name, DAYS[1]), name, later)
    run_cooling_tags(tables, later, names, codes)
    once, twice = (tables.read("cooling_tag", day) for day in (DAYS[1], later))
    assert twice.select("day").distinct().collect() == [(later,)]
    total = once.agg(F.sum("weight")).first()[0]
    assert abs(twice.agg(F.sum("weight")).first()[0] - total * (1 + 0.9 ** 5)) < 1e-6 * total
    assert tables.read("cooling_members", later).count() == tables.read("cooling_members", DAYS[1]).count()
    for name in ("ods", "business_area"):
        tables.drop(name, later)


def test_a_failed_run_keeps_the_day(tables, spark):
    before = tables.read("ods", DAYS[0]).count()
    log = tables.read("ods", DAYS[0])
    with pytest.raises(ValueError, match="not unique"):
        tables.write(log.unionByName(log), "ods", DAYS[0], ["sessionid"])
    assert tables.read("ods", DAYS[0]).count() == before


def test_commands(spark, tmp_path):
    """The day again, by the commands and their options."""
    day, folder = "2024-01-15", str(tmp_path / "tables")
    raw_log(spark, SF).limit(200).write.json(str(tmp_path / "log"))
    region_ranges(spark, SF).write.parquet(str(tmp_path / "regions"))
    place_ranges(spark, SF).write.csv(str(tmp_path / "places"))
    region_ranges(spark, SF).write.csv(str(tmp_path / "regions_csv"))
    responses(spark, SF).write.parquet(str(tmp_path / "responses"))
    (tmp_path / "apps.txt").write_text("XRX1##One\nXRX2##Two\n")
    common = ["--tables", folder, "--date", day]
    main(["etl", *common, "--log", str(tmp_path / "log"), "--regions", str(tmp_path / "regions_csv"),
          "--places", str(tmp_path / "places"), "--ranges-format", "csv"], spark)
    main(["reports", *common, "--cost-column", "adpayment"], spark)
    main(["areas", *common, "--responses", str(tmp_path / "responses")], spark)
    main(["tags", *common, "--app-names", str(tmp_path / "apps.txt"), "--first-run", "--qualify-ids",
          "--decay", '{"KW_": 0.5}'], spark)
    tables, day = DatedTables(spark, folder), dt.date.fromisoformat(day)
    assert tables.read("ods", day).count() == 200
    costs = tables.read("ad_channel_analysis", day).agg(F.sum("ad_cost")).first()[0]
    wanted = ad_funnel(tables.read("ods", day), "channelid", cost_column="adpayment")
    assert costs == wanted.agg(F.sum("ad_cost")).first()[0]
    members = tables.read("tag_members", day)
    assert members.where("id NOT LIKE '%:%'").isEmpty() and members.count() > 0
    assert tables.read("tag", day).where("tag = 'APP_One'").count() > 0
