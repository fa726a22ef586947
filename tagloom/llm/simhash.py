"""SimHash near-duplicates: segment-popcount embedding, grid range-join, exact verification.

A fingerprint is embedded as the bit counts of its 32 two-bit segments. The Manhattan distance of
two embeddings never exceeds the number of differing bits, so that it can be used as a filter. The
segments are dealt out to `axes` axes of a grid. Two embeddings within a distance of d differ on d
axes at most, so they share a cell on some choice of `axes - d` axes: the range join looks into
exactly these cells, one per choice. Cells hold distinct fingerprints only; a cell with very many
is split into blocks that are compared block by block. What leaves a task is not all pairs, but a
forest that connects the linked fingerprints of a cell.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tagloom.llm.common import column_bytes, in_pieces, words_of
from tagloom.operators.components import connected_components
from tagloom.operators.skew import lookup_join
from tagloom.session import Scratch

SEGMENTS = 32
SEED = 42
_LOW_BITS = 0x5555555555555555
# Members of a cell that are compared in one task; a cell with more is split.
CELL_ROWS = 8192
_BUFFER_ROWS = 1 << 18
_SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64 bits; a bit is set if it is set in more than half of the shingles' hashes."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
    size = min(shingle, len(words))
    begins, ends = starts[:-size].tolist(), (starts[size:] - 1).tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(begins), _SHINGLES_AT_ONCE):
        part = slice(at, at + _SHINGLES_AT_ONCE)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins[part], ends[part])],
                          np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(begins), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 shingle: int = 4, *carried: Column) -> DataFrame:
    """`id`, `fp` (the 64 bits as a signed long) and the `carried` binary columns of every row. NULL
    texts are empty."""
    def compute(batches):
        for batch in in_pieces(batches, "text"):
            found = [fingerprint(text, shingle) for text in column_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.array(found, np.uint64).view(np.int64)),
                 *batch.columns[2:]], ["id", "fp", *batch.schema.names[2:]])

    rows = docs.select(F.col(id_column).cast("long").alias("id"),
                       F.col(text_column).cast("string").alias("text"), *carried)
    more = "".join(f", {name} binary" for name in rows.columns[2:])
    return rows.mapInArrow(compute, f"id long, fp long{more}")


def _row_key(id_column: str, text_column: str) -> Column:
    """The same for rows of equal id and text only, NULL being an id of its own."""
    named = F.coalesce(F.col(id_column).cast("long").cast("string"), F.lit(""))
    return F.unhex(F.md5(F.concat(named, F.lit(":"),
                                  F.coalesce(F.col(text_column).cast("string"), F.lit("")))))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _choices(max_bits: int, shared: int) -> list[int]:
    """Masks of the fingerprint bits on each choice of `shared` axes."""
    axes = max_bits + shared
    edges = [round(SEGMENTS * i / axes) for i in range(axes + 1)]
    masks = [sum(3 << 2 * s for s in range(a, b)) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, shared)]


def _shared_axes(rows: int) -> int:
    """More axes make smaller cells and more of them. The links found are the same."""
    return 2 if rows <= 1 << 19 else 3 if rows <= 1 << 24 else 4 if rows <= 1 << 29 else 6


def _roots(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> np.ndarray:
    """For each row the first row of its component within its cell; `keys` are sorted."""
    low = np.uint64(_LOW_BITS)
    ones, highs = fps & low, (fps >> np.uint64(1)) & low
    # The bit count of a segment in unary, so that differing bits count the Manhattan distance.
    unary = (ones | highs) | ((ones & highs) << np.uint64(1))
    root = np.arange(len(keys))
    left, shift = np.arange(len(keys)), 0
    while len(left):
        shift += 1
        left = left[left + shift < len(keys)]
        left = left[keys[left] == keys[left + shift]]
        near = left[np.bitwise_count(unary[left] ^ unary[left + shift]) <= max_bits]
        near = near[np.bitwise_count(fps[near] ^ fps[near + shift]) <= max_bits]
        while len(near):
            a, b = root[near], root[near + shift]
            apart = a != b
            if not apart.any():
                break
            np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while (root != root[root]).any():
                root = root[root]
    return root


def _forest(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links of each cell, whose rows follow each other, as pairs of row and first linked row."""
    held: list[pa.RecordBatch] = []

    def emit(keys, fps):
        root = _roots(keys, fps.view(np.uint64), max_bits)
        own = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(fps[own]), pa.array(fps[root[own]])],
                                          ["src", "dst"])

    def take():
        return [np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1)]

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= _BUFFER_ROWS:
            keys, fps = take()
            whole = int(np.searchsorted(keys, keys[-1]))
            yield emit(keys[:whole], fps[:whole])
            held = [pa.RecordBatch.from_arrays([pa.array(keys[whole:]), pa.array(fps[whole:])],
                                               ["key", "fp"])]
    if held:
        yield emit(*take())


def links(fps: DataFrame, max_bits: int = 4, cell_rows: int = CELL_ROWS,
          shared: int | None = None) -> DataFrame:
    """`src` and `dst`: enough linked pairs of the distinct longs in `fp` to connect all that are
    linked by chains of at most `max_bits` differing bits. `fps` should be a stored table."""
    scratch = Scratch(fps.sparkSession, "simhash-cells")
    shared = shared or _shared_axes(fps.count())
    bits = F.col("fp")
    ones, highs = bits.bitwiseAND(_LOW_BITS), F.shiftrightunsigned(bits, 1).bitwiseAND(_LOW_BITS)
    # Two-bit fields with the bit count of each segment.
    embedded = ones.bitwiseXOR(highs).bitwiseOR(F.shiftleft(ones.bitwiseAND(highs), 1))
    cells = fps.select("fp", F.posexplode(F.array(*[
        embedded.bitwiseAND(F.lit(_signed(mask))) for mask in _choices(max_bits, shared)
    ])).alias("choice", "place")).select(F.xxhash64("choice", "place").alias("key"), "fp")
    large = scratch.save(cells.groupBy("key").count().where(F.col("count") > cell_rows), "large")
    if not large.isEmpty():
        sized = cells.join(large, "key", "left").select(
            "key", "fp", F.ceil(F.coalesce("count", F.lit(1)) / cell_rows).alias("blocks"))
        block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        pairs = sized.select("key", "fp", block.alias("own"), F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        cells = pairs.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
                             .alias("key"), "fp")
    return (cells.repartition("key").sortWithinPartitions("key")
            .mapInArrow(lambda batches: _forest(batches, max_bits), "src long, dst long")
            .distinct())


def components(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """Add `component_id`, the smallest id in the component, and `root`, one of its fingerprints, to a
    stored table of `id` and `fp`."""
    scratch = Scratch(prints.sparkSession, "simhash")
    groups = scratch.save(prints.groupBy("fp").agg(F.min("id").alias("first")), "groups")
    edges = links(groups.select("fp"), max_bits)
    named = connected_components(edges.select(F.col("src").cast("string").alias("src"),
                                              F.col("dst").cast("string").alias("dst")))
    linked = named.select(F.col("id").cast("long").alias("fp"),
                          F.col("component").cast("long").alias("root"))
    rooted = scratch.save(groups.join(linked, "fp", "left"), "rooted")
    least = scratch.save(rooted.where(F.col("root").isNotNull())
                         .groupBy("root").agg(F.min("first").alias("component_id")), "least")
    labels = scratch.save(lookup_join(rooted, least, "root").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.coalesce("component_id", "first").alias("component_id")), "labels")
    return lookup_join(prints, labels, "fp")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits) and `component_id` of every row.

    Rows whose fingerprints differ in `max_bits` bits or fewer are linked, and `component_id` is
    the smallest id that can be reached. Texts that are NULL or have no words get the fingerprint
    zero and are linked like any other; fewer words than a shingle count as one shingle. Rows
    without an id take part, and name the component only by the ids of others (NULL if there are
    none). Repeated rows are returned as often as they are given; an empty table gives no rows;
    other columns are not looked at.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    prints = scratch.save(fingerprints(docs, id_column, text_column, shingle), "prints")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return components(prints, max_bits).select(F.col("id").alias("doc_id"),
                                               digits.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id.

    Rows without an id come last, and of equal ids the smallest fingerprint comes first. So components
    without any id, and components that share an id, keep a row each. Of rows with equal id and
    text any is taken. The texts are moved once.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    prints = scratch.save(fingerprints(
        docs, "doc_id", "text", shingle, _row_key("doc_id", "text").alias("key")), "prints")
    least = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "fp", "key"))
    kept = (components(prints, max_bits).groupBy("root").agg(least.alias("least"))
            .select(F.col("least.key").alias("_key")))
    return (docs.withColumn("_key", _row_key("doc_id", "text")).join(kept, "_key", "left_semi")
            .dropDuplicates(["_key"]).drop("_key"))
