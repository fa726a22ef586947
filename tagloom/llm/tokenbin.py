"""Token ids as compact binary blocks.

Texts are encoded by a tokenizer file, the ids are renumbered by their frequency in the whole
corpus (the most frequent is 0), and written in a byte-aligned code of variable length: one control
byte holds the byte counts of four numbers, the data bytes follow in a stream of their own.
Documents start at a multiple of four, filled up with zeros, so that a block of documents is the
concatenation of theirs. Decoding looks the lengths up in a table, for a whole block at once.

The container of the blocks is Parquet, so that any file system of Spark will do: `blocks` has
`shard`, `block` and `before` (numbers of the range, of the block in it, and ids before it in the
range), the ids and sizes of its documents, and the two streams. `ranks` has the id of each rank.
Shards are ranges of document ids in ascending order; within them, blocks and documents ascend too.

Memory: a task holds a block of about `BLOCK_IDS` ids or one document.
"""

import functools
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from tagloom.llm.common import in_pieces
from tagloom.session import Scratch

BLOCK_IDS = 1 << 20
END_ID = 2
_REMEMBERED = 400_000
_REMEMBERED_BYTES = 64 << 20
_WORDS_AT_ONCE = 500
# Kinds of characters, as the expressions of `re` tell them: letters, digits, the space, other white space, the rest,
# and those that `re` takes for another kind than the tokenizers. `_EDGE` stands for what is before and behind a text.
_EDGE, _LETTER, _DIGIT, _SPACE, _BLANK, _REST, _ODD = range(7)
_KINDS = {_LETTER: r"[^\W\d_]+", _DIGIT: r"\d+", _SPACE: " ", _BLANK: r"[^\S ]+"}
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)


# -- text to ids ---------------------------------------------------------------------

@functools.cache
def _kinds() -> np.ndarray:
    """The kind of every character by its code."""
    every = "".join(map(chr, range(0x110000)))
    kinds = np.full(len(every), _REST, np.uint8)
    for kind, expression in _KINDS.items():
        for found in re.finditer(expression, every):
            kinds[found.start():found.end()] = kind
    kinds[0x1C:0x20] = _ODD
    kinds[[ord(c) for c in every if c.isnumeric() and not c.isalpha() and not c.isdecimal()]] = _ODD
    return kinds


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _cuts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where parts begin that the tokenizers of this kind never join with what is beside them; `first` are the
    beginnings of texts.

    Such parts are a run of letters with the space before it, a contraction that does not follow a sign or a
    space, and the last of several white spaces but a space, which they leave to what follows. What is between
    such parts is a part too.
    """
    kind = _kinds()[codes]
    before, after = np.roll(kind, 1), np.roll(kind, -1)
    before[first], after[first - 1] = _EDGE, _EDGE  # of the first text, that is behind the last one
    cut = np.zeros(len(codes) + 1, bool)
    cut[first] = True
    letter = kind == _LETTER
    cut[:-1] |= ~letter & (before == _LETTER)
    begins = letter & (before != _LETTER)

    quotes = np.flatnonzero(codes == ord("'"))
    quotes = quotes[np.isin(before[quotes], (_EDGE, _LETTER, _DIGIT, _BLANK)) & (after[quotes] == _LETTER)]
    short = quotes[np.isin(codes[quotes + 1], [ord(c) for c in "stmd"])]
    long = quotes[after[quotes + 1] == _LETTER]
    long = long[np.isin(codes[long + 1] << 8 | codes[long + 2], [ord(c) << 8 | ord(d) for c, d in ("re", "ve", "ll")])]
    for found, length in ((short, 2), (long, 3)):
        begins[found + 1] = False
        cut[found] = cut[found + length] = True

    words = np.flatnonzero(begins)
    cut[words - (before[words] == _SPACE)] = True
    blanks = np.flatnonzero(kind == _BLANK)
    blanks = blanks[np.isin(before[blanks], (_SPACE, _BLANK)) & ~np.isin(after[blanks], (_EDGE, _SPACE, _BLANK))]
    cut[blanks] = cut[blanks + 1] = True
    return np.flatnonzero(cut[:-1])


def _ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of several runs, one after the other."""
    ends = np.cumsum(sizes)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


class _Parts:
    """Different parts of texts and their ids."""

    def __init__(self):
        self.texts = pa.array([], pa.string())
        self.ids = np.zeros(0, np.uint32)
        self.starts = self.sizes = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.texts)

    def places(self, texts: pa.Array) -> np.ndarray:
        """Where each text is, -1 for those that are not there."""
        return pc.index_in(texts, value_set=self.texts).fill_null(-1).to_numpy().astype(np.int64)

    def ids_of(self, places: np.ndarray) -> np.ndarray:
        return _ragged(self.ids, self.starts[places], self.sizes[places])

    def add(self, texts: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The places that the new texts get."""
        self.texts = pa.concat_arrays([self.texts, texts])
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.ids = np.append(self.ids, ids)
        return np.arange(len(self.texts) - len(texts), len(self.texts))


class Encoder:
    """Encodes texts with a tokenizer file, remembering parts: those of late, and those before them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        # A character of a token's name stands for a byte.
        self.bytes = np.array([len(name.encode()) if i in special else len(name)
                               for i, name in enumerate(names)], np.int64)
        self.parts = _Parts()
        self.before = _Parts()
        self.special = [token.content for token in special.values()]
        self.by_parts = _is_of_bytes(self.tokenizer)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in found]

    def _whole(self, text: str) -> bool:
        """Texts with characters of odd kinds, or with special tokens, are encoded whole."""
        return (not self.by_parts or any(token in text for token in self.special)
                or bool((_kinds()[_codes(text)] == _ODD).any()))

    def _ids_of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers; many words are encoded as one text, and told apart by their bytes."""
        offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset)
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), _WORDS_AT_ONCE):
            ends = offsets[at:at + _WORDS_AT_ONCE + 1]
            text = words.buffers()[2].slice(ends[0], ends[-1] - ends[0]).to_pybytes().decode()
            ids.append(np.frombuffer(self._encoded([text])[0], np.uint32))
            sizes.append(np.diff(np.searchsorted(np.cumsum(self.bytes[ids[-1]]), ends - ends[0], side="right")))
        return np.concatenate(ids), np.concatenate(sizes)

    def _remember(self, texts: pa.Array, is_word: np.ndarray) -> np.ndarray:
        """The places of different texts among the parts. Words, with the space before them, are encoded many at
        once; other parts singly."""
        places = self.parts.places(texts)
        if len(self.parts) + len(texts) > _REMEMBERED or self.parts.texts.nbytes > _REMEMBERED_BYTES:
            self.parts, self.before = _Parts(), self.parts
            places[:] = -1
        new = np.flatnonzero(places < 0)
        unknown, is_word = texts.take(pa.array(new)), is_word[new]
        earlier = self.before.places(unknown)
        is_word &= earlier < 0
        some = np.flatnonzero(earlier >= 0)
        places[new[some]] = self.parts.add(
            unknown.take(pa.array(some)), self.before.ids_of(earlier[some]), self.before.sizes[earlier[some]])
        some = np.flatnonzero(is_word)
        words = unknown.take(pa.array(some))
        places[new[some]] = self.parts.add(words, *self._ids_of_words(words))
        some = np.flatnonzero(~is_word & (earlier < 0))
        others = unknown.take(pa.array(some))
        found = self._encoded(others.to_pylist())
        places[new[some]] = self.parts.add(others, np.frombuffer(b"".join(found), np.uint32),
                                           np.array([len(ids) // 4 for ids in found], np.int64))
        return places

    def _by_parts(self, texts: list[str]) -> list[bytes]:
        """Cuts all texts at once, and looks each different part up once."""
        joined = "".join(texts)
        if not joined:
            return [b""] * len(texts)
        codes = _codes(joined)
        bounds = np.cumsum([0, *map(len, texts)])
        at = _cuts(codes, bounds[:-1][np.diff(bounds) > 0])
        ends = np.append(at, len(codes))
        words = (codes[at] == ord(" ")) & (np.diff(ends) > 1)
        words[words] = _kinds()[codes[at[words] + 1]] == _LETTER
        if not joined.isascii():
            more = (codes > 0x7F).view(np.uint8) + (codes > 0x7FF).view(np.uint8) + (codes > 0xFFFF).view(np.uint8)
            ends = ends + np.append(0, np.cumsum(more, dtype=np.int64))[ends]
        parts = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int32)),
                                            pa.py_buffer(joined.encode())).dictionary_encode()
        which = parts.indices.to_numpy()
        is_word = np.zeros(len(parts.dictionary), bool)
        is_word[which] = words
        which = self._remember(parts.dictionary, is_word)[which]
        ids = self.parts.ids_of(which)
        reached = np.append(0, np.cumsum(self.parts.sizes[which]))
        places = reached[np.searchsorted(at, bounds)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(places, places[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        is_whole = [self._whole(text) for text in texts]
        whole = iter(self._encoded([text for text, single in zip(texts, is_whole) if single]))
        others = iter(self._by_parts([text for text, single in zip(texts, is_whole) if not single]))
        return [next(whole if single else others) for single in is_whole]


def _is_of_bytes(tokenizer: Tokenizer) -> bool:
    """Whether the tokenizer takes texts as they are and cuts them by the usual expression."""
    made = json.loads(tokenizer.to_str())
    cut = made["pre_tokenizer"] or {}
    return (made["normalizer"] is None and cut.get("type") == "ByteLevel" and cut["use_regex"]
            and not cut["add_prefix_space"])


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _encode_rows(path: str, end_id: int):
    end = np.array([end_id], np.uint32).tobytes()

    def apply(batches):
        for batch in in_pieces(batches, "text", 4 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = [found + end for found in _encoder(path).encode(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                 pa.array([_narrow(i) for i in ids], pa.binary())], ["doc_id", "n", "crc", "ids"])

    return apply


def _narrow(ids: bytes) -> bytes:
    """A byte that tells the width, then the ids in two bytes each if they fit, else in four."""
    wide = np.frombuffer(ids, np.uint32)
    return b"\x02" + wide.astype(np.uint16).tobytes() if wide.max() < 1 << 16 else b"\x04" + ids


def _wide(narrow: bytes) -> np.ndarray:
    return np.frombuffer(narrow, np.uint16 if narrow[0] == 2 else np.uint32, offset=1).astype(np.uint32)


# -- the code -------------------------------------------------------------------------

def pack(values: np.ndarray, sizes: np.ndarray) -> tuple[bytes, bytes, np.ndarray, np.ndarray]:
    """Control and data bytes of consecutive documents, and where each document's begin and end."""
    filled = (sizes + 3) // 4 * 4
    ends, filled_ends = np.cumsum(sizes), np.cumsum(filled)
    padded = np.zeros(int(filled.sum()), np.uint32)
    padded[np.arange(len(values)) + np.repeat(filled_ends - filled - (ends - sizes), sizes)] = values
    extra = ((padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF))
    control = (extra.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    kept = np.arange(4, dtype=np.uint8) <= extra[:, None]
    data = padded.astype("<u4").view(np.uint8).reshape(-1, 4)[kept]
    data_ends = np.concatenate([[0], np.cumsum(extra.astype(np.int64) + 1)])
    starts = np.concatenate([[0], filled_ends])
    return control.tobytes(), data.tobytes(), starts // 4, data_ends[starts]


def unpack(control: bytes, data: bytes, sizes: np.ndarray) -> np.ndarray:
    """The numbers of consecutive documents of the given sizes."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    stream = np.frombuffer(data, np.uint8)
    values = stream[starts].astype(np.uint32) if len(starts) else np.zeros(0, np.uint32)
    for byte in (1, 2, 3):
        more = np.flatnonzero(lengths > byte)
        values[more] |= stream[starts[more] + byte].astype(np.uint32) << np.uint32(8 * byte)
    filled = (sizes + 3) // 4 * 4
    gap = np.cumsum(filled) - filled - (np.cumsum(sizes) - sizes)
    return values[np.arange(int(sizes.sum())) + np.repeat(gap, sizes)]


# -- writing ----------------------------------------------------------------------------

def _id_counts(encoded: DataFrame) -> dict[int, int]:
    """Corpus counts of the ids, at most as many as the tokenizer has."""
    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            found = np.bincount(np.concatenate([_wide(i) for i in batch.column("ids").to_pylist()]))
            if len(found) > len(total):
                total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
            total[:len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    rows = (encoded.select("ids").mapInArrow(count, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).toArrow().to_pydict())
    return dict(zip(rows["id"], rows["n"]))


def _pack_rows(rank_of: np.ndarray):
    def apply(batches):
        for batch in in_pieces(batches, "ids"):
            ids = [_wide(i) for i in batch.column("ids").to_pylist()]
            sizes = np.array([len(i) for i in ids], np.int64)
            control, data, c, d = pack(rank_of[np.concatenate(ids)], sizes)
            parts = [[stream[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                     for stream, at in ((control, c), (data, d))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in ("doc_id", "crc", "shard")], pa.array(sizes),
                 pa.array(parts[0], pa.binary()), pa.array(parts[1], pa.binary())],
                ["doc_id", "crc", "shard", "size", "control", "data"])

    return apply


_BLOCK = ("shard int, block long, before long, n long, doc_ids array<long>, sizes array<long>, "
          "control binary, data binary")


def _blocks(block_ids: int):
    """Rows sorted by shard to blocks."""
    def block(shard, number, before, rows):
        sizes = [r["size"] for r in rows]
        return pa.RecordBatch.from_pylist([{
            "shard": shard, "block": number, "before": before, "n": sum(sizes),
            "doc_ids": [r["doc_id"] for r in rows], "sizes": sizes,
            "control": b"".join(r["control"] for r in rows),
            "data": b"".join(r["data"] for r in rows)}], schema)

    schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("before", pa.int64()),
                        ("n", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("sizes", pa.list_(pa.int64())), ("control", pa.binary()),
                        ("data", pa.binary())])

    def apply(batches):
        shard, number, before, held, size = None, 0, 0, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["shard"] != shard or size >= block_ids):
                    yield block(shard, number, before, held)
                    number, before, held, size = number + 1, before + size, [], 0
                if row["shard"] != shard:
                    shard, number, before = row["shard"], 0, 0
                held.append(row)
                size += row["size"]
        if held:
            yield block(shard, number, before, held)

    return apply


def write(docs: DataFrame, path: str, tokenizer_path: str, id_column: str = "doc_id",
          text: str = "text", end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Write `path`/blocks and `path`/ranks."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-ids")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    rows.mapInArrow(_encode_rows(tokenizer_path, end_id), "doc_id long, n long, crc long, ids binary") \
        .write.option("compression", "zstd").parquet(scratch.path("encoded"))
    encoded = spark.read.parquet(scratch.path("encoded"))

    counts = _id_counts(encoded)
    ranked = sorted(counts, key=lambda i: (-counts[i], i))
    rank_of = np.zeros(max(ranked, default=0) + 1, np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    (spark.createDataFrame(list(enumerate(ranked)), "rank long, id long").coalesce(1)
     .write.parquet(f"{path}/ranks"))

    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / shards for i in range(1, shards)] or [1.0]
    bounds = encoded.select(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or []
    # Rows without an id come first. Equal ids go to one shard, in the order of their ids' digest.
    shard = F.size(F.filter(F.array(*map(F.lit, sorted(set(bounds)))),
                            lambda bound: F.coalesce(bound < F.col("doc_id"), F.lit(False)))) \
        if bounds else F.lit(0)
    packed = encoded.withColumn("shard", shard.cast("int")).mapInArrow(
        _pack_rows(rank_of),
        "doc_id long, crc long, shard int, size long, control binary, data binary")
    (packed.repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", "crc", "size")
     .mapInArrow(_blocks(block_ids), _BLOCK)
     .write.option("compression", "zstd").parquet(f"{path}/blocks"))
    scratch.drop("encoded")


# -- reading ----------------------------------------------------------------------------

def read(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id`, `start`, `n_tokens`, `ids_crc32`, read from the files of `write`."""
    ranks = spark.read.parquet(f"{path}/ranks").toArrow().to_pydict()
    id_of = np.zeros(len(ranks["rank"]), np.uint32)
    id_of[ranks["rank"]] = ranks["id"]
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    # One row per shard: no more than there were partitions when the files were written.
    totals = blocks.groupBy("shard").agg(F.sum("n").alias("total"))
    first = totals.select("shard", (F.sum("total").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")).alias("first"))

    def apply(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                got = {n: batch.column(n)[row].as_py() for n in ("shard", "before", "control", "data")}
                sizes = batch.column("sizes")[row].values.to_numpy()
                ids = id_of[unpack(got["control"], got["data"], sizes)].astype("<u4")
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(sizes), got["shard"], np.int32)),
                    batch.column("doc_ids")[row].values, pa.array(ends - sizes + got["before"]),
                    pa.array(sizes), pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(
                        (ends - sizes).tolist(), ends.tolist())], pa.int64())],
                    ["shard", "doc_id", "offset", "n_tokens", "ids_crc32"])

    decoded = blocks.mapInArrow(
        apply, "shard int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return decoded.join(F.broadcast(first), "shard").select(
        "doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids of all texts to files in the shared folder, and read them back.

    NULL texts are empty and have the end id only. Rows without an id come first; rows with equal ids
    follow each other in the order of the digests of their token ids. An empty table gives no rows;
    other columns are not looked at. Strings of special tokens in a text are what the tokenizer file
    makes of them.
    """
    folder = Scratch(docs.sparkSession, "token-files").path("corpus")
    write(docs, folder, tokenizer_path, end_id=end_id)
    return read(docs.sparkSession, folder)
