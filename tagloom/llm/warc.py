r"""WARC archives: writing with revisit records, and reading by verified boundary chains.

Archives are written by Spark's text writer with the records' end as line end, so that each file is a
plain uncompressed WARC file on any file system. They are read by Spark's text reader, which splits
files at any place, with the magic `WARC/1.0` as line end. Each piece between two magics is a
candidate record, since a payload may hold the magic too. From its header a candidate knows its
length, and so the offset of its successor. Only what can be reached from the start of the file by
going from successor to successor is a record; other candidates are payload.

The chain is found by pointer jumping. A task first jumps within its own split, so that only the few
candidates at which a chain enters a split are left; between splits, the tables of entries are joined
with themselves, which doubles the reach in each round.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tagloom.operators.skew import MAX_BROADCAST_BYTES, lookup_join
from tagloom.session import Scratch

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: eight times four digits, each of twenty bits of the hexadecimal form."""
    digits = F.sha1(payload)
    chars = []
    for i in range(0, 40, 5):
        value = F.conv(F.substring(digits, i + 1, 5), 16, 10).cast("int")
        chars += [F.substring(F.lit(_BASE32), F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1))
                  for s in (15, 10, 5, 0)]
    return F.concat(*chars)


# -- writing ------------------------------------------------------------------------

def with_records(pages: DataFrame, id_column: str, url: str, payload: str,
                 min_bytes: int = 0) -> DataFrame:
    """`page_id`, `url`, `payload`, its size and digest, and `refers_to` of revisits."""
    html = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"),
                        F.col(url).cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                             "payload_digest": base32_sha1(F.col("payload").cast("binary"))})
    # Only payloads that come again have a row here.
    again = (rows.where(F.col("payload_bytes") >= min_bytes)
             .groupBy("payload_digest", "payload_bytes")
             .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
             .where((F.col("n") > 1) & F.col("original").isNotNull()).drop("n"))
    scratch = Scratch(pages.sparkSession, "warc-digests")
    found = lookup_join(rows, scratch.save(again, "again"), ["payload_digest", "payload_bytes"],
                        spread=["page_id", "payload_digest"], max_bytes=MAX_BROADCAST_BYTES)
    return found.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("original")),
                                                F.col("original"))).drop("original")


def _header_value(text: Column) -> Column:
    """Text in one header line."""
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record(row_type: Column) -> Column:
    """A record without the two line ends that follow it."""
    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    page = F.coalesce(line("X-Page-ID", F.col("page_id").cast("string")), F.lit(""))
    target = F.coalesce(line("WARC-Target-URI", _header_value(F.col("url"))), F.lit(""))
    refers = F.coalesce(line("X-Refers-To-Page-ID", F.col("refers_to").cast("string")), F.lit(""))
    return F.concat(
        F.lit(MAGIC), line("WARC-Type", row_type), page, target,
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))),
        line("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")), refers,
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write(pages: DataFrame, path: str, id_column: str = "page_id", url: str = "url",
          payload: str = "html", min_bytes: int = 0) -> None:
    """One record per row. Of equal payloads of at least `min_bytes` bytes, the one with the largest
    id is written as response, the others as revisits to it."""
    rows = with_records(pages, id_column, url, payload, min_bytes)
    kind = F.when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")
    rows.select(_record(kind).alias("value")).write.option("lineSep", END).text(path)


# -- reading ------------------------------------------------------------------------

_HEADER_END = b"\r\n\r\n"


def _length(piece: bytes) -> int | None:
    """Length of a record after its magic, with its end; None if it has no header of a record."""
    header, found, _ = piece.partition(_HEADER_END)
    if not found:
        return None
    for line in header.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return len(header) + len(_HEADER_END) + int(value) + len(END)
    return None


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """`file`, `split` (where it starts in the file), `row` (ascending within a split) and `value`."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("split"),
                    F.monotonically_increasing_id().alias("row"), F.col("value")))


_CANDIDATE = "file string, split long, row long, size long, length long"


def _measure(batches):
    for batch in batches:
        values = batch.column("value").cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in ("file", "split", "row")],
             pa.array([len(v) for v in values], pa.int64()),
             pa.array([_length(v) for v in values], pa.int64())],
            ["file", "split", "row", "size", "length"])


def candidates(measured: DataFrame) -> DataFrame:
    """`file`, `split`, `row`, `size`, `offset` of a candidate after its magic, and `next`, where its
    successor's would be.

    A file is its pieces with a magic between each two, so an offset is the sum of what is before: of
    the splits before, and of the rows before in the split. What is before the first magic, usually
    nothing, leads to the first record.
    """
    taken = F.col("size") + len(MAGIC)
    splits = measured.groupBy("file", "split").agg(F.sum(taken).alias("taken"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "split",
                           F.coalesce(F.sum("taken").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("file", "split").orderBy("row").rowsBetween(
        Window.unboundedPreceding, -1)
    offset = F.col("start") + F.coalesce(F.sum(taken).over(inside), F.lit(0))
    return (measured.join(starts, ["file", "split"]).withColumn("offset", offset)
            .withColumn("next", F.col("offset") + len(MAGIC) + F.when(
                F.col("offset") == 0, F.col("size")).otherwise(F.col("length")))
            .select("file", "split", "row", "size", "offset", "next"))


def _jumps(next_row: np.ndarray) -> np.ndarray:
    """The last row of each row's chain; `next_row` has the row itself at ends of chains."""
    while True:
        further = next_row[next_row]
        if (further == next_row).all():
            return next_row
        next_row = further


def _split_exits(table: pa.Table) -> pa.Table:
    """Of each candidate of one split, where its chain leaves the split (NULL: nowhere)."""
    table = table.sort_by("offset")
    offsets = table["offset"].to_numpy()
    successors = table["next"].fill_null(-1).to_numpy()
    rows = np.arange(len(offsets))
    place = np.minimum(np.searchsorted(offsets, successors), len(offsets) - 1)
    last = _jumps(np.where(offsets[place] == successors, place, rows))
    exits = successors[last]
    return pa.table({"file": table["file"], "split": table["split"], "offset": table["offset"],
                     "exit": pa.array(exits, pa.int64(), mask=exits < offsets)})


def _split_chain(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """The rows of a split on the chains that enter it at the offsets of `right`."""
    left = left.sort_by("offset")
    offsets, successors = left["offset"].to_numpy(), left["next"].fill_null(-1).to_numpy()
    rows = np.arange(len(offsets))
    place = np.minimum(np.searchsorted(offsets, successors), max(0, len(offsets) - 1))
    follows = offsets[place] == successors if len(offsets) else np.zeros(0, bool)
    jump = np.where(follows, place, rows)
    reached = np.isin(offsets, right["offset"].to_numpy())
    while True:
        further = reached.copy()
        further[jump[reached]] = True
        if (further == reached).all() and (jump[jump] == jump).all():
            break
        reached, jump = further, jump[jump]
    owner = np.maximum.accumulate(np.where(reached, rows, -1))
    return pa.table({"file": left["file"], "split": left["split"], "row": left["row"],
                     "size": left["size"],
                     "record": pa.array(np.where(owner >= 0, offsets[owner], -1), pa.int64())})


def _entries(scratch: Scratch, exits: DataFrame) -> DataFrame:
    """`file`, `offset`: the first record of each file and every record that follows one of an
    earlier split. Doubles the reach of the jumps until nothing new is reached."""
    starts = (exits.groupBy("file").agg(F.min("offset").alias("offset"))
              .withColumn("reached", F.lit(True)))
    targets = exits.where(F.col("exit").isNotNull()).select("file", F.col("exit").alias("offset"))
    nodes = (starts.unionByName(targets.distinct().withColumn("reached", F.lit(False)))
             .groupBy("file", "offset").agg(F.max("reached").alias("reached")))
    nodes = scratch.save(nodes.join(exits.select("file", "offset", F.col("exit").alias("jump")),
                                    ["file", "offset"], "left"), "nodes_0")
    turn, known = 0, -1
    while (count := nodes.where("reached").count()) != known:
        known, turn = count, turn + 1
        hit = (nodes.where("reached").select("file", F.col("jump").alias("offset")).dropna()
               .distinct().withColumn("hit", F.lit(True)))
        far = nodes.select("file", F.col("offset").alias("jump"), F.col("jump").alias("far"))
        nodes = scratch.save(
            nodes.join(far, ["file", "jump"], "left").join(hit, ["file", "offset"], "left")
            .select("file", "offset", (F.col("reached") | F.coalesce("hit", F.lit(False))).alias("reached"),
                    F.col("far").alias("jump")), f"nodes_{turn}")
    return nodes.where("reached").select("file", "offset")


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """`file`, `split`, `row`, `size`, `record` of the pieces that are not a record of their own:
    those of records with the magic in their payload (`record` is the offset of the record),
    and what is before the first record (`record` is 0)."""
    scratch = Scratch(spark, "warc-chain")
    measured = scratch.save(pieces(spark, path).mapInArrow(_measure, _CANDIDATE), "measured")
    found = scratch.save(candidates(measured), "candidates")
    exits = scratch.save(found.groupBy("file", "split").applyInArrow(
        _split_exits, "file string, split long, offset long, exit long"), "exits")
    entries = _entries(scratch, exits)
    # An entry belongs to the split of the candidate that begins there.
    entered = scratch.save(found.join(entries, ["file", "offset"], "left_semi")
                           .select("file", "split", "offset"), "entered")
    owned = scratch.save(
        found.groupBy("file", "split").cogroup(entered.groupBy("file", "split")).applyInArrow(
            _split_chain, "file string, split long, row long, size long, record long"), "owned")
    # Pieces before the first record of a split belong to the last record of the splits before.
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = (owned.groupBy("file", "split").agg(F.max("record").alias("last"))
               .select("file", "split", F.max("last").over(before).alias("carried")))
    owner = F.when(F.col("record") >= 0, F.col("record")).otherwise(F.col("carried"))
    owned = owned.join(carried, ["file", "split"]).withColumn("record", owner).drop("carried")
    several = (owned.groupBy("file", "record").agg(F.count("*").alias("n"))
               .where((F.col("n") > 1) | (F.col("record") == 0)).drop("n"))
    return scratch.save(owned.join(several, ["file", "record"]).select(
        "file", "split", "row", "size", "record"), "parts")


def records(spark: SparkSession, path: str) -> DataFrame:
    """`value`, the text after the magic, of every record of the files.

    Records of one piece, usually all, are not moved. The others are put together from their pieces
    and the magics between them, which are payload.
    """
    parts = _parts(spark, path)
    marked = lookup_join(pieces(spark, path), parts, ["file", "split", "row"], spread=["row"])
    # The files were split alike in both passes if every stored part met one piece of its size. If not, as
    # may be after executors were lost in between, some part met none, as pieces are numbered within splits.
    found = (marked.where(F.col("record") >= 0).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("split", "row", "value"))).alias("parts"),
        F.count(F.when(F.octet_length("value") == F.col("size"), 1)).alias("met")))
    expected = parts.groupBy("file", "record").agg(F.count("*").alias("n"))
    both = expected.join(found, ["file", "record"], "left")
    text = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC)
    checked = F.when(F.col("met") == F.col("n"), text).otherwise(
        F.raise_error(F.lit("the archive was split differently; read it again")))
    whole = both.select("record", checked.alias("value")).where(F.col("value").isNotNull() & (F.col("record") > 0))
    return marked.where(F.col("record").isNull()).select("value").unionByName(whole.select("value"))


def _after(text: str) -> Column:
    """What follows the first empty line."""
    return F.expr(f"substring({text}, length(substring_index({text}, '\\r\\n\\r\\n', 1)) + 5)")


def read(spark: SparkSession, path: str) -> DataFrame:
    """`page_id`, `url`, `record_type`, `refers_to`, `payload`, `payload_bytes` and `payload_digest`
    of every record. The digest of a payload that is present is computed from its bytes."""
    header = F.substring_index("value", END, 1)

    def field(name):
        found = F.regexp_extract(header, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
        return F.nullif(found, F.lit(""))

    rows = records(spark, path).select(
        field("X-Page-ID").cast("long").alias("page_id"), field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"),
        field("X-Refers-To-Page-ID").cast("long").alias("refers_to"),
        field("X-Payload-Length").cast("long").alias("length"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("digest"),
        _after("value").alias("block")).withColumn("body", _after("block"))
    # The record's own end is still there.
    rows = rows.withColumn("payload", F.expr(f"substring(body, 1, length(body) - {len(END)})"))
    present = F.col("record_type") == "response"
    return rows.select(
        "page_id", "url", "record_type", "refers_to",
        F.when(present, F.col("payload")).alias("payload"),
        F.when(present, F.octet_length("payload")).otherwise(F.col("length")).cast("long")
        .alias("payload_bytes"),
        F.when(present, base32_sha1(F.col("payload").cast("binary"))).otherwise(F.col("digest"))
        .alias("payload_digest"))


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write `page_id`, `url`, `html` as archives in the shared folder, and read them back.

    NULL payloads are empty. Records without an id are responses unless their payload has a row with
    one; equal ids with equal payloads are all responses. Line ends in a URL are percent-encoded,
    as they end a header line; a NULL or empty URL is left out and comes back as NULL. An empty table
    gives no rows; other columns are not looked at.
    """
    spark = pages.sparkSession
    folder = Scratch(spark, "warc").path("archive")
    write(pages, folder, min_bytes=min_bytes)
    return read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                      "refers_to")
