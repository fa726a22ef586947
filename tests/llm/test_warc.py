import base64
import hashlib
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import warc
from tagloom.llm.oracle import ORACLES
from tests.compare import connect, difference
from tests.llm import nasty

PAGES = "page_id long, url string, html string, value string, record long, payload_digest string, size long"


def fake(n, text):
    """A payload that looks like records."""
    body = f"HTTP/1.1 200 OK\r\n\r\n{text}"
    return "".join(f"WARC/1.0\r\nWARC-Type: response\r\nX-Page-ID: {900 + i}\r\n"
                   f"Content-Length: {len(body)}\r\n\r\n{body}\r\n\r\n" for i in range(n))


def payloads():
    found = {i: f"<p>{nasty.words(i, 20 + 37 * i)}</p>" for i in range(1, 25)}
    return found | {30: found[3], 31: found[3], 32: None, 33: "", 34: fake(3, "x"), 35: "a" + fake(2, ""),
                    36: "WARC/1.0\r\n", 37: "\r\n\r\n", 38: fake(1, "y") + "WARC/1.0\r\nContent-Length: 5",
                    39: "é\r\n中文" * 4000, 40: fake(40, nasty.words(7, 300))}


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://x/{i}?a=%20" if i % 4 else None, html, "v", 1, "d", 2)
            for i, html in payloads().items()]
    rows += [(None, "http://none/\r\nWARC-Type: fake", "no id", *[None] * 4), (2, "again", payloads()[2], "", 1, "", 1)]
    return spark.createDataFrame(rows, PAGES)


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def wanted(min_bytes=0):
    whole = {i: (html or "").encode() for i, html in payloads().items()}
    found = {}
    for i, payload in whole.items():
        last = max(j for j, other in whole.items() if other == payload)
        revisit = i != last and len(payload) >= min_bytes
        found[i] = (len(payload), digest(payload), "revisit" if revisit else "response",
                    last if revisit else None)
    return found


@pytest.mark.parametrize("split_bytes", [128 << 20, 1500])
def test_round_trip(spark, pages, split_bytes, tmp_path):
    """Also with splits so small that records lie across several of them."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        warc.write(pages.coalesce(2), str(tmp_path / "w"))
        rows = warc.read(spark, str(tmp_path / "w")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == len(payloads()) + 2
    found = {r.page_id: r for r in rows}
    for i, (size, sha, kind, refers) in wanted().items():
        row = found[i]
        assert (row.payload_bytes, row.payload_digest, row.record_type, row.refers_to) == (
            size, sha, kind, refers)
        assert row.payload == (None if kind == "revisit" else payloads()[i] or "")
        assert row.url == (f"http://x/{i}?a=%20" if i % 4 else None) or i == 2
    assert found[None].record_type == "response" and found[None].url == "http://none/%0D%0AWARC-Type: fake"


def test_small_payloads_are_all_responses(spark, pages):
    found = {r.page_id: r for r in warc.round_trip(pages, min_bytes=10_000).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in found.items() if i} == {
        i: w[2:] for i, w in wanted(10_000).items()}
    assert {w[2] for w in wanted(10_000).values()} == {"response"}


def test_files_are_plain_archives(spark, pages, tmp_path):
    """A reader that goes from record to record finds the same number of records."""
    warc.write(pages, str(tmp_path / "w"))
    count = 0
    for name in os.listdir(tmp_path / "w"):
        if not name.startswith("part-"):
            continue
        data, at = open(tmp_path / "w" / name, "rb").read(), 0
        while at < len(data):
            header, _, _ = data[at:].partition(b"\r\n\r\n")
            assert header.startswith(b"WARC/1.0\r\nWARC-Type: ")
            length = int(header.split(b"Content-Length: ")[1])
            at += len(header) + 4 + length
            assert data[at:at + 4] == b"\r\n\r\n"
            at, count = at + 4, count + 1
    assert count == len(payloads()) + 2


def test_same_as_sql(spark, pages):
    con = connect("/root/testdata/sf0.001")
    con.register("given", pages.toArrow())
    con.execute("CREATE OR REPLACE VIEW pages AS SELECT * FROM given")
    assert difference(warc.round_trip(pages), con, ORACLES["op10_warc"]) is None


def test_empty_table(pages):
    assert warc.round_trip(pages.where("false")).collect() == []


def test_jumps_within_a_split():
    # Records at 10, 20, 40 and 60; 30 and 50 are payload, and 50 leads nowhere.
    table = pa.table({"file": ["f"] * 6, "split": [0] * 6, "row": list(range(6)), "size": [1] * 6,
                      "offset": [10, 20, 30, 40, 50, 60], "next": [20, 40, 60, 60, None, 99]})
    assert warc._split_exits(table)["exit"].to_pylist() == [99, 99, 99, 99, None, 99]
    chain = warc._split_chain(None, table, pa.table({"offset": pa.array([20], pa.int64())}))
    assert chain["record"].to_pylist() == [-1, 20, 20, 40, 40, 60]


@pytest.mark.parametrize("change", ["split + 7", "row + 100"])
def test_pieces_of_another_split_are_an_error(spark, pages, change, tmp_path, monkeypatch):
    """As after executors were lost between the passes: stored parts that meet no piece."""
    warc.write(pages, str(tmp_path / "w"))
    real = warc._parts
    column = change.split()[0]
    monkeypatch.setattr(warc, "_parts", lambda *args: real(*args).withColumn(column, F.expr(change)))
    with pytest.raises(Exception, match="split differently"):
        warc.read(spark, str(tmp_path / "w")).collect()
