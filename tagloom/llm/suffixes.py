"""Long strings that occur twice, by suffix arrays in shards.

A string of `length` bytes that starts at two places is found by its suffixes: in the sorted order of
all suffixes, two that share their first `length` bytes are neighbours, or only such are between them.

What is sorted. The grams of a text are hashed, and each window of `length` bytes is named by the least
hash of its grams. Equal windows have equal names, so a window whose name comes from one place only is not
repeated. A run is a maximal stretch of windows with one name; what is sorted are the pieces, the bytes of
the runs whose name comes from two places or more. Every window of a text lies in exactly one of its pieces.

Shards. All pieces of a name go to one shard, and shards are bounded in bytes. A name with more
than half a shard is split over many. In each shard the suffixes are sorted by Larsson and Sadakane's
refinement (ranks by the first bytes, then only groups of equal rank by the ranks further on, doubling
the depth), and Kasai's walk in text order gives the common prefixes of neighbours, with many stretches of
text as lanes side by side. The windows of split names that are left are merged across shards: each
shard hands on every different window once, with a fingerprint of 128 bits for its text, and binary
search in the merged order tells which come from several shards.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tagloom.operators.skew import lookup_join
from tagloom.session import Scratch

LENGTH = 400
# Bytes of pieces in a shard, and of texts in a bucket.
SHARD_BYTES = 2 << 20
BUCKET_BYTES = 64 << 20
# Windows in a run, and bytes of a text that are hashed at once; longer ones are cut.
_RUN_WINDOWS = 1 << 16
_CHUNK_BYTES = 4 << 20
# Positions in a lane of the walk.
_LANE = 1 << 9
_MERGE_ROWS = 1 << 18
_FIRST_DEPTH = 7
# Suffixes and pieces up to which 32 bits do for a place; so does a depth then, which is doubled.
_NARROW = 1 << 30
_KEY_BYTES = 16


# -- names of windows -----------------------------------------------------------------

def _gram(length: int) -> int:
    """Bytes of a gram: a power of two, a quarter of the window at most."""
    return 1 << max(0, (length // 4).bit_length() - 1)


def _gram_hashes(text: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes from each position on, built by doubling."""
    mix, factor = np.uint64(0x9E3779B97F4A7C15), 0xBF58476D1CE4E5B9
    h, done = (text.astype(np.uint64) + np.uint64(1)) * mix, 1
    while done < size:
        right = h[done:]
        h = (h[:-done] * np.uint64(factor)) ^ (right + (right >> np.uint64(29)))
        h = (h ^ (h >> np.uint64(31))) * mix
        done, factor = 2 * done, (factor * factor | 1) & ((1 << 64) - 1)
    return h


def _of_neighbours(pick, values: np.ndarray, width: int) -> np.ndarray:
    """The minimum or maximum of every `width` neighbours."""
    done = 1
    while 2 * done <= width:
        values, done = pick(values[:-done], values[done:]), 2 * done
    rest = width - done
    return pick(values[:-rest], values[rest:]) if rest else values


def runs(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and name of each run of a text, and whether the name comes from several
    places of the text, as a run may then repeat itself."""
    found, gram = [], _gram(length)
    windows, width = len(text) - length + 1, length - gram + 1
    for at in range(0, max(0, windows), _CHUNK_BYTES):
        count = min(_CHUNK_BYTES, windows - at)
        part = np.frombuffer(text, np.uint8, count + length - 1, at)
        hashes = _gram_hashes(part, gram)
        names = _of_neighbours(np.minimum, hashes, width)
        # A place names a window if its hash is the greatest of the names of the windows around it.
        around = _of_neighbours(np.maximum, np.pad(names, width - 1), width)
        naming = np.sort(hashes[hashes == around])
        new = np.flatnonzero(names[1:] != names[:-1]) + 1
        starts = np.union1d(np.append(new, 0), np.arange(0, count, _RUN_WINDOWS))
        again = np.isin(names[starts], naming[1:][naming[1:] == naming[:-1]])
        found.append((starts + at, np.diff(np.append(starts, count)), names[starts], again))
    if not found:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.uint64, bool))
    return tuple(map(np.concatenate, zip(*found)))


# -- the suffix array of a shard -------------------------------------------------------

class Suffixes:
    """The sorted suffixes of some pieces; a piece ends before any byte, an earlier piece first."""

    def __init__(self, pieces: list[bytes]):
        sizes = np.array([len(p) for p in pieces], np.int64)
        stops = np.cumsum(sizes)
        self.starts, self.size = stops - sizes, int(sizes.sum())
        self.text = np.frombuffer(b"".join(pieces) + bytes(16), np.uint8)
        self.number = np.int32 if self.size + len(pieces) < _NARROW else np.int64
        self.piece = np.repeat(np.arange(len(pieces), dtype=self.number), sizes)
        self.left = np.repeat(stops.astype(self.number), sizes) - np.arange(self.size, dtype=self.number)
        self.order, self.rank = self._refined(len(pieces))

    def _refined(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Order and rank of the suffixes. The rank of an unsorted group is that of its first."""
        key = np.zeros(self.size, np.uint64)
        for i in range(_FIRST_DEPTH):
            key <<= np.uint64(8)
            key |= np.where(self.left > i, self.text[i:i + self.size], np.uint8(0))
        key <<= np.uint64(8)
        key |= np.minimum(self.left, _FIRST_DEPTH).astype(np.uint8)
        order, rank = np.zeros(self.size, self.number), np.zeros(self.size, self.number)
        slots = positions = np.arange(self.size, dtype=self.number)
        depth = _FIRST_DEPTH
        while len(slots):
            by_key = np.argsort(key)
            positions, key = positions[by_key], key[by_key]
            del by_key
            order[slots] = positions
            first = np.append(True, key[1:] != key[:-1])
            del key
            heads = np.flatnonzero(first)
            sizes = np.diff(heads, append=len(first))
            rank[positions] = np.repeat(slots[heads], sizes)
            unsorted = np.repeat(sizes > 1, sizes)
            del first, heads, sizes
            slots, positions = slots[unsorted], positions[unsorted]
            del unsorted
            inside = self.left[positions] > depth
            further = self.piece[positions]
            further[inside] = rank[positions[inside] + depth] + count
            del inside
            key = rank[positions].astype(np.uint64)
            key <<= np.uint64(32)
            key |= further.astype(np.uint64)
            del further
            depth *= 2
        return order, rank

    def same_as_previous(self, length: int) -> np.ndarray:
        """For each place in the order, whether the suffix shares `length` bytes with the one before."""
        words = np.zeros(self.size + 8, np.uint64)
        for i in range(8):
            part = self.text[i:i + (len(self.text) - i) // 8 * 8].view(">u8")[:len(words[i::8])]
            words[i::8][:len(part)] = part
        lanes = self._lanes(length)
        same = np.zeros(self.size + 1, bool)
        at, counts = lanes[:, 0], lanes[:, 1]
        common = np.zeros(len(lanes), np.int64)
        for step in range(int(counts.max(initial=0))):
            live = int(np.searchsorted(-counts, -step, "left"))
            here = at[:live] + step
            rank = self.rank[here]
            before = self.order[rank - 1]
            limit = np.where(rank > 0, np.minimum(self.left[before], length), 0)
            # The walk: what was shared a byte earlier is shared here, but for that byte.
            common = np.minimum(np.maximum(common[:live] - 1, 0), limit)
            open_ = np.flatnonzero(common < limit)
            while len(open_):
                a, b = here[open_] + common[open_], before[open_] + common[open_]
                apart = words[a] ^ words[b]
                shared = np.zeros(len(open_), np.int64)
                for bits in range(0, 64, 8):
                    shared += apart < np.uint64(1 << (56 - bits)) if bits < 56 else apart == 0
                common[open_] = np.minimum(common[open_] + shared, limit[open_])
                open_ = open_[(shared == 8) & (common[open_] < limit[open_])]
            same[rank] = common >= length
        return same[:self.size]

    def _lanes(self, length: int) -> np.ndarray:
        """Start and number of windows of each stretch, the longest first."""
        windows = np.maximum(np.append(self.starts[1:], self.size) - self.starts - length + 1, 0)
        parts = -(-windows // _LANE)
        offset = (np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)) * _LANE
        count = np.minimum(np.repeat(windows, parts) - offset, _LANE)
        longest = np.argsort(-count, kind="stable")
        return np.stack([np.repeat(self.starts, parts) + offset, count], axis=1)[longest]

    def windows(self, length: int, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the class of equal windows at each position (-1: no window), and how often each
        class occurs; `copies` is how often each piece does."""
        group = np.cumsum(~self.same_as_previous(length), dtype=self.number) - 1
        number = np.where(self.left >= length, group[self.rank], -1)
        window = number >= 0
        return number, np.bincount(number[window], copies[self.piece[window]],
                                   minlength=int(group[-1]) + 1 if len(group) else 0)


# What a shard hands on of a window: its print, and where it is (start -1: known to be repeated).
_WINDOW = np.dtype([("print", f"S{_KEY_BYTES}"), ("key", f"V{_KEY_BYTES}"), ("start", "<i8")])


def _found(shard: pa.Table, length: int, blocks: int) -> pa.Table:
    """Repeated ranges (`key`, `start`, `stop`) of the pieces of a shard, and for names that are split, all
    different windows, packed in a row for each of the `blocks` that their prints fall in."""
    places, split = {}, {}
    for piece, keys, starts, is_split in zip(*(shard.column(c).to_pylist() for c in (
            "piece", "keys", "starts", "split"))):
        places.setdefault(piece, []).extend(zip(keys, starts))
        split[piece] = is_split
    pieces = list(places)
    suffixes = Suffixes(pieces)
    number, times = suffixes.windows(length, np.array([len(places[p]) for p in pieces]))
    repeated = (number >= 0) & (times[number] > 1)
    out = []
    for a, b in _stretches(np.flatnonzero(repeated), suffixes.piece):
        of = int(suffixes.piece[a])
        shift = int(suffixes.starts[of])
        out += [(key, start + a - shift, start + b - shift + length, None, None)
                for key, start in places[pieces[of]]]
    is_split = np.array([split[p] for p in pieces], bool)
    # Equal windows have one name, so all of them or none are in pieces of split names.
    first = np.flatnonzero((number >= 0) & is_split[suffixes.piece])
    first = first[np.unique(number[first], return_index=True)[1]]
    windows = np.zeros(len(first), _WINDOW)
    for i, at in enumerate(first.tolist()):
        of = int(suffixes.piece[at])
        shift = at - int(suffixes.starts[of])
        digest = xxhash.xxh3_128_digest(pieces[of][shift:shift + length])
        key, start = places[pieces[of]][0]
        windows[i] = (digest, key, -1) if repeated[at] else (digest, key, start + shift)
    block = np.ascontiguousarray(windows["print"]).view(">u8")[::2] % np.uint64(blocks)
    for n in np.unique(block):
        out.append((None, None, None, int(n), windows[block == n].tobytes()))
    return _table(out)


def _stretches(at: np.ndarray, group: np.ndarray) -> list[tuple[int, int]]:
    """First and last of the consecutive positions within a group."""
    if not len(at):
        return []
    new = np.flatnonzero((np.diff(at) > 1) | (np.diff(group[at]) != 0)) + 1
    return list(zip(at[np.append(0, new)].tolist(), at[np.append(new, len(at)) - 1].tolist()))


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * 5
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)],
                    ["key", "start", "stop", "block", "windows"])


def _merged(block: pa.Table, length: int) -> pa.Table:
    """Ranges of the windows that came from several shards: by binary search of the print of each one in
    the merged order."""
    windows = np.concatenate([np.frombuffer(rows, _WINDOW) for rows in block.column("windows").to_pylist()])
    merged = np.sort(windows["print"])
    times = (np.searchsorted(merged, windows["print"], "right")
             - np.searchsorted(merged, windows["print"], "left"))
    found = windows[(times > 1) & (windows["start"] >= 0)]
    places = sorted(zip(found["key"].tolist(), found["start"].tolist()))
    starts = np.array([start for _, start in places], np.int64)
    text = np.cumsum([False] + [a != b for (a, _), (b, _) in zip(places, places[1:])])
    new = np.flatnonzero((np.diff(starts) > 1) | (np.diff(text[:len(starts)]) != 0)) + 1
    heads = np.append(0, new) if len(starts) else new
    tails = np.append(new, len(starts)) - 1 if len(starts) else new
    return _table([(places[a][0], places[a][1], places[b][1] + length, None, None)
                   for a, b in zip(heads.tolist(), tails.tolist())])


# -- the job ---------------------------------------------------------------------------

def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each key in a task."""
    seen = set()
    for batch in batches:
        new = []
        for row, key in enumerate(batch.column("key").to_pylist()):
            if key not in seen:
                seen.add(key)
                new.append(row)
        yield batch.take(pa.array(new, pa.int64()))


def _equal_pieces_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal pieces of a batch as one row with all their places."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(["shard", "piece"]).aggregate(
            [("split", "max"), ("key", "list"), ("start", "list")])
        yield from table.select(["shard", "piece", "split_max", "key_list", "start_list"]).rename_columns(
            ["shard", "piece", "split", "keys", "starts"]).combine_chunks().to_batches()


def _text_key(text_column: str):
    return F.unhex(F.sha2(F.col(text_column).cast("string").cast("binary"), 256))


class _Texts:
    """The different texts of at least `length` bytes, by key in a bucketed table, so that what is
    found about them is joined to them without moving them again."""

    def __init__(self, docs: DataFrame, text_column: str, length: int, total_bytes: int, scratch: Scratch):
        self.spark, self.length, self.scratch = docs.sparkSession, length, scratch
        self.buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")),
                           -(-total_bytes // BUCKET_BYTES))
        self.name = f"texts_{uuid.uuid4().hex}"
        text = F.col(text_column).cast("string").cast("binary")
        rows = docs.select(F.substring(_text_key(text_column), 1, _KEY_BYTES).alias("key"),
                           text.alias("text")).where(F.length("text") >= length)
        schema = "key binary, text binary"
        # Copies are dropped before and after the shuffle, so that a frequent text is moved once per task.
        (rows.mapInArrow(_first_of_each, schema).repartition(self.buckets, "key")
         .mapInArrow(_first_of_each, schema).write.bucketBy(self.buckets, "key")
         .option("path", scratch.path("texts")).saveAsTable(self.name))

    def frame(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.scratch.drop("texts")

    def _runs(self) -> DataFrame:
        length = self.length

        def compute(batches):
            for batch in batches:
                for key, text in zip(batch.column("key"), batch.column("text")):
                    starts, counts, names, again = runs(text.as_py(), length)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()] * len(starts), pa.binary()), pa.array(starts),
                         pa.array(counts), pa.array(names.view(np.int64)), pa.array(again)],
                        ["key", "start", "n", "name", "again"])

        return self.scratch.save(self.frame().mapInArrow(
            compute, "key binary, start long, n long, name long, again boolean"), "runs")

    def _pieces(self) -> DataFrame:
        """`shard`, `piece`, `split`, `keys`, `starts` of the runs whose name comes from several places."""
        spark, length, found = self.spark, self.length, self._runs()
        names = self.scratch.save(
            found.groupBy("name").agg(F.count("*").alias("times"), F.max("again").alias("again"),
                                      F.sum("n").alias("windows"),
                                      F.sum(F.col("n") + (length - 1)).alias("bytes"))
            .where("times > 1 OR again").select("name", "bytes", "windows"), "names")
        total = names.agg(F.sum("bytes")).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))
        limit = max(1, total // shards // 2)
        apart = names.where(F.col("bytes") > limit).agg(F.sum("windows")).first()[0] or 0
        self.blocks = -(-apart // _MERGE_ROWS)
        parts = F.ceil(F.col("bytes") / limit)
        part = F.when(F.col("bytes") > limit, F.pmod(F.xxhash64("key", "start"), parts)).otherwise(F.lit(0))
        wanted = lookup_join(found, names.select("name", "bytes"), "name", "inner").select(
            "key", "start", "n", (F.col("bytes") > limit).alias("split"),
            F.pmod(F.xxhash64("name", part), F.lit(shards)).alias("shard"))
        piece = F.substring("text", (F.col("start") + 1).cast("int"), (F.col("n") + (length - 1)).cast("int"))
        pieces = self.frame().join(wanted, "key").select("shard", piece.alias("piece"), "split", "key", "start")
        return pieces.mapInArrow(_equal_pieces_once, "shard long, piece binary, split boolean, "
                                                     "keys array<binary>, starts array<long>")

    def ranges(self) -> DataFrame:
        """`key`, `start`, `stop` of stretches of repeated windows; they may overlap."""
        length, pieces = self.length, self._pieces()
        blocks, schema = max(1, self.blocks), "key binary, start long, stop long, block long, windows binary"
        found = pieces.groupBy("shard").applyInArrow(lambda shard: _found(shard, length, blocks), schema)
        if self.blocks:
            found = self.scratch.save(found, "found")
        known = found.where("block IS NULL")
        if self.blocks:
            merged = found.where("block IS NOT NULL").groupBy("block").applyInArrow(
                lambda block: _merged(block, length), schema)
            known = known.unionByName(merged)
        return known.select("key", "start", "stop")

    def cut(self) -> DataFrame:
        """`key`, `spans` (maximal repeated stretches, as start and stop) and `kept`, the bytes outside
        them, of the texts that have any."""
        def compute(batches):
            for batch in batches:
                for key, text, ranges in zip(*(batch.column(c) for c in ("key", "text", "ranges"))):
                    text = text.as_py()
                    spans = _united(ranges.values.field(0).to_pylist(), ranges.values.field(1).to_pylist())
                    edges = [0, *(edge for span in spans for edge in span), len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()], pa.binary()),
                         pa.array([[{"start": a, "stop": b} for a, b in spans]], _SPANS),
                         pa.array([kept], pa.binary())], ["key", "spans", "kept"])

        ranges = self.ranges().groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
        return self.frame().join(ranges, "key").mapInArrow(
            compute, "key binary, spans array<struct<start: long, stop: long>>, kept binary")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _united(starts: list[int], stops: list[int]) -> list[list[int]]:
    spans = []
    for start, stop in sorted(zip(starts, stops)):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], stop)
        else:
            spans.append([start, stop])
    return spans


def _named(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """`doc_id`, the number of bytes and the sha256 of each row's text. NULL is empty."""
    text = F.coalesce(F.col(text_column).cast("string").cast("binary"), F.lit(b""))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha256"))


def repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
            length: int = LENGTH) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans` and `kept_sha256` of every row.

    Every byte that is part of a string of `length` bytes that also starts anywhere else, in the same
    text or another, is removed; all are judged on the given texts. NULL texts are empty, and texts
    shorter than `length` stay as they are. Rows with equal texts repeat each other, also if their ids
    are equal or NULL, and are returned as often as they are given. An empty table gives no rows;
    other columns are not looked at.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    rows = scratch.save(_named(docs, id_column, text_column), "rows")
    total = rows.where(F.col("n_bytes") >= length).agg(F.sum("n_bytes")).first()[0] or 0
    texts = _Texts(docs, text_column, length, total, scratch)
    parts = texts.cut().select(
        F.substring(F.lower(F.hex("key")), 1, 2 * _KEY_BYTES).alias("key"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    rows = rows.withColumn("key", F.substring("sha256", 1, 2 * _KEY_BYTES))
    copies = (rows.where(F.col("n_bytes") >= length).groupBy("key")
              .agg(F.count("*").alias("times")).where("times > 1"))
    # What comes as a whole text again is removed as a whole.
    verdicts = scratch.save(
        parts.join(copies, "key", "full").select(
            "key", F.col("times").isNotNull().alias("whole"), "n_removed", "n_spans", "kept_sha256"),
        "verdicts")
    texts.drop()
    whole = F.coalesce("whole", F.lit(False))
    empty = F.sha2(F.lit(b""), 256)
    return lookup_join(rows, verdicts, "key").select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, empty).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"))
