"""Golden cases of the column functions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tagloom.functions.areas import area_text, request_key
from tagloom.functions.dates import previous_suffix, run_suffix, suffix
from tagloom.functions.geohash import geohash
from tagloom.functions.ip import city_of, clean_area, ip_to_long, is_private, long_to_ip, province_of
from tagloom.functions.predicates import any_non_blank, filled, non_blank
from tagloom.operators.userrows import decode_ids, decode_tags, encode_tags


def column(spark, values, expression, ddl="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {ddl}")
    return [r.x for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_ip_numbers(spark):
    texts = ["171.14.161.255", "0.0.0.0", "255.255.255.255", "010.1.2.3", "256.1.1.1", "1.2.3", "x",
             "", None, "1.2.3.4.5", " 1.2.3.4"]
    numbers = column(spark, texts, ip_to_long)
    assert numbers == [2869862911, 0, 4294967295, 167838211] + [None] * 7
    assert column(spark, [2869862911, 0, 4294967295, -1, 1 << 32, None], long_to_ip, "v bigint") == [
        "171.14.161.255", "0.0.0.0", "255.255.255.255", None, None, None]


def test_ip_roundtrip(spark):
    numbers = random.Random(7).sample(range(1 << 32), 500)
    assert column(spark, numbers, lambda c: ip_to_long(long_to_ip(c)), "v bigint") == numbers


def test_private(spark):
    assert column(spark, ["192.168.0.1", "192.16.0.1", None], is_private) == [True, False, None]


def test_region_split(spark):
    countries = ["江苏省镇江市", "上海市", "河南省", "内蒙古呼和浩特市", None, "A省省B", "省B", "A省B省C"]
    assert column(spark, countries, province_of) == [
        "江苏省", "上海市", "河南省", "内蒙古呼和浩特市", None, "A省", "省", "A省"]
    assert column(spark, countries, city_of) == [
        "镇江市", "上海市", "河南省", "内蒙古呼和浩特市", None, "", "B", "B"]


def test_clean_area(spark):
    assert column(spark, [" CZ88.NET ", "电信", None], clean_area) == ["本机或本网络", "电信", None]


def bisection(lon, lat, length=8):
    ranges, code = [[-180.0, 180.0], [-90.0, 90.0]], 0
    for i in range(5 * length):
        span, value = ranges[i % 2], (lon, lat)[i % 2]
        middle = sum(span) / 2
        high = value >= middle
        span[0 if high else 1] = middle
        code = code << 1 | high
    return "".join("0123456789bcdefghjkmnpqrstuvwxyz"[code >> 5 * i & 31] for i in range(length - 1, -1, -1))


def test_geohash(spark):
    rng = random.Random(3)
    points = [(116.4, 39.9), (0.0, 0.0), (-180.0, -90.0), (180.0, 90.0), (45.0, -45.0)]
    points += [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(1000)]
    df = spark.createDataFrame(points, "lon double, lat double")
    rows = df.select("*", geohash(F.col("lon"), F.col("lat")).alias("g"),
                     geohash(F.col("lon"), F.col("lat"), 4).alias("g4")).collect()
    for row in rows:
        assert (row.g, row.g4) == (bisection(row.lon, row.lat), bisection(row.lon, row.lat, 4))
    assert [r.g for r in rows if (r.lon, r.lat) == (116.4, 39.9)] == ["wx4fbxxf"]


def test_geohash_outside(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (181.0, 0.0), (0.0, -91.0)], "lon double, lat double")
    assert [r.g for r in df.select(geohash(F.col("lon"), F.col("lat")).alias("g")).collect()] == [None] * 4
    with pytest.raises(ValueError):
        geohash(F.col("lon"), F.col("lat"), 7)


def test_area_names(spark):
    def document(names):
        areas = ",".join(f'{{"id":"1","location":"0,0","name":"{n}"}}' for n in names)
        return '{"regeocode":{"addressComponent":{"businessAreas":[%s]}}}' % areas
    responses = [document(["朝阳", "北海"]), document([]), '{"regeocode":{}}', "not json", "", None,
                 '{"regeocode":{"addressComponent":{"businessAreas":[[]]}}}']
    assert column(spark, responses, area_text) == ["朝阳,北海"] + [""] * 6


def test_request_key(spark):
    df = spark.createDataFrame([(116.4, 39.9), (None, 1.0)], "a double, b double")
    assert [r.k for r in df.select(request_key(F.col("a"), F.col("b")).alias("k")).collect()] == [
        "116.4,39.9", None]


def test_dates(spark):
    day = dt.date(2024, 3, 1)
    assert column(spark, [day], suffix, "v date") == ["20240301"]
    assert column(spark, [day], previous_suffix, "v date") == ["20240229"]
    assert (run_suffix(day), run_suffix(day, 1)) == ("20240301", "20240229")


def test_presence(spark):
    assert column(spark, ["a", " ", "\t\n", "", None], non_blank) == [True] + [False] * 4
    df = spark.createDataFrame([("a", 1), ("", 1), (" ", 1), (None, 1), ("a", None)], "t string, n int")
    assert [tuple(r) for r in df.where(filled(df, "t", "n")).collect()] == [("a", 1), (" ", 1)]
    assert df.where(any_non_blank("t")).count() == 2


def test_text_codec(spark):
    text = "BA_x -> 1.0#DT_y -> 0.9"
    assert column(spark, [text], decode_tags) == [{"BA_x": 1.0, "DT_y": 0.9}]
    assert column(spark, [text], lambda c: encode_tags(decode_tags(c))) == [text]
    assert column(spark, ["a,b", "a", "", None], decode_ids) == [["a", "b"], ["a"], [], None]
    odd = {"a#b": 1.0, "c -> d,\\h": 2.0, "\\": 0.5}
    assert column(spark, [odd], lambda c: decode_tags(encode_tags(c)), "v map<string, double>") == [odd]
