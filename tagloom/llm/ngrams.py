"""Language-model scores by a weighted backoff automaton over words.

Blocks. The corpus is cut into blocks of whole texts. In a block words are numbers of its own vocabulary; across
blocks a word is known by its 64-bit hash, and an n-gram by a hash of the hashes, so that there is no
bound on the number of words.

Counting. A block asks for the corpus counts of its n-grams: per range of hashes it sends one row of packed
arrays, sorted hashes and own counts, and the task of the range answers with the sums in the same order. N-grams
of higher order are kept if they come at least MIN_COUNT times in the corpus, at any size of it. A trigram
can be kept only if both its bigrams are, so trigrams are asked for after bigrams, and most are never sent.

The automaton. The root holds the words, by absolute discounting; the discounted mass is that of all
unknown words, which are one type. Each n-gram that is continued is a state; its arcs have the
discounted probabilities of the continuations, and its failure arc, to the state without the
first word, has the weight that makes all sum to one. The sums behind the weights come from the blocks in
the same way: every kept n-gram has one block that owns it and adds it to its state. So each block
gets the states and arcs of its own n-grams. One traversal from left to right then carries a state per text,
for all texts of a block side by side: a word takes the arc of the state if there is one, or else the failure
arc and its weight, until a state has an arc.
"""

import contextlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.llm.common import column_bytes, in_pieces, remainder
from tagloom.session import Scratch

END = b"\n"  # no word holds it
MIN_COUNT = 2
ORDER = 3
DISCOUNT = 0.5
BLOCK_BYTES = 10 << 20
# Entries that a range of hashes should have.
RANGE_ENTRIES = 1 << 21
# Words of a text that are scored one after the other; longer texts are cut into lanes.
LANE_WORDS = 512
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# -- packed arrays ------------------------------------------------------------------------

def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0, in the fewest bytes that fit all, compressed byte by byte of their places."""
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8")
                if not len(values) or int(values.max()) <= np.iinfo(k).max)
    planes = values.astype(kind).view(np.uint8).reshape(len(values), int(kind[2])).T
    return kind[2].encode() + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    size = int(data[:1])
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(f"<u{size}").reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes, by their differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data).astype(np.uint64), dtype=np.uint64)


def mixed(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of an n-gram out of those of its first words and of its last one."""
    z = first * np.uint64(0x9E3779B97F4A7C15) + (last ^ (last >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return z ^ (z >> np.uint64(31))


# -- blocks -------------------------------------------------------------------------------

_BLOCKS = ("block long, doc_ids array<long>, held array<boolean>, sizes binary, words binary, ids binary")


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _encode(batches, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Blocks of about `block_bytes` of text."""
    number, size = TaskContext.get().partitionId() << 32, 0
    doc_ids, held, sizes, ids, vocabulary = [], [], [], [], _Vocabulary()

    def block():
        hashes = np.array([xxhash.xxh3_64_intdigest(word) for word in vocabulary], np.uint64)
        place = np.empty(len(hashes), np.int64)
        order = np.argsort(hashes)
        place[order] = np.arange(len(hashes))
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
             pa.array([packed(np.array(sizes, np.int64))]), pa.array([packed_keys(hashes[order])]),
             pa.array([packed(place[np.concatenate(ids)])])],
            ["block", "doc_ids", "held", "sizes", "words", "ids"])

    for batch in in_pieces(batches, "text"):
        for doc_id, held_out, text in zip(batch.column("doc_id").to_pylist(),
                                          batch.column("held_out").to_pylist(), column_bytes(batch, "text")):
            words = text.lower().split()
            words.append(END)
            ids.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
            doc_ids.append(doc_id)
            held.append(held_out)
            sizes.append(len(words))
            size += len(text)
            if size > block_bytes:
                yield block()
                number, size = number + 1, 0
                doc_ids, held, sizes, ids, vocabulary = [], [], [], [], _Vocabulary()
    if doc_ids:
        yield block()


class Grams:
    """The n-grams of a block, by order from 1: `keys` (sorted hashes), `at` (the number of the n-gram that ends at
    each place, or -1), and `first` and `last` (numbers of the n-gram without its last word, and of that word)."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, sizes: np.ndarray, order: int):
        self.sizes, self.begin = sizes, np.cumsum(sizes) - sizes
        self.keys, self.at = [words], [ids]
        self.first, self.last = [None], [None]
        for _ in range(1, order):
            self._longer(np.ones(len(self.keys[-1]), bool))

    def _longer(self, kept: np.ndarray) -> None:
        """N-grams of one word more, of which both parts are `kept`."""
        shorter, words = self.at[-1], self.at[0]
        before = np.empty_like(shorter)
        before[1:] = shorter[:-1]
        before[self.begin] = -1
        usable = (before >= 0) & (shorter >= 0)
        usable[usable] = kept[before[usable]] & kept[shorter[usable]]
        width = len(self.keys[0])
        codes = before[usable].astype(np.int64) * width + words[usable]
        del before
        codes, inverse = np.unique(codes, return_inverse=True)
        first, last = codes // width, (codes % width).astype(np.int32)
        keys = mixed(self.keys[-1][first], self.keys[0][last])
        by_key = np.argsort(keys)
        place = np.empty(len(keys), np.int32)
        place[by_key] = np.arange(len(keys), dtype=np.int32)
        at = np.full(len(words), -1, np.int32)
        at[usable] = place[inverse]
        self.keys.append(keys[by_key])
        self.first.append(first[by_key].astype(np.int32))
        self.last.append(last[by_key])
        self.at.append(at)

    def suffix(self, order: int) -> np.ndarray:
        """For each n-gram the number of the one without its first word."""
        ends = self.at[order - 1]
        found = np.full(len(self.keys[order - 1]), -1, np.int32)
        there = ends >= 0
        found[ends[there]] = self.at[order - 2][there]
        return found


def _opened(docs: pa.Table, order: int) -> tuple[Grams, np.ndarray]:
    """The n-grams of a block up to `order`, and which of its places are learned from."""
    row = {name: docs.column(name)[0].as_py() for name in ("held", "sizes", "words", "ids")}
    sizes = unpacked(row["sizes"]).astype(np.int64)
    grams = Grams(unpacked_keys(row["words"]), unpacked(row["ids"]).astype(np.int32), sizes, order)
    return grams, np.repeat(~np.array(row["held"], bool), sizes)


# -- asking for sums by ranges of hashes -----------------------------------------------------

_ASKED = "kind int, range long, block long, keys binary, a binary, b binary, c binary"


def _asked(kind: int, block: int, bits: int, keys: np.ndarray, *values: np.ndarray) -> Iterator[tuple]:
    """A row for each range that sorted `keys` fall in, with their values."""
    of = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    ranges, starts = np.unique(of, return_index=True)
    for number, start, stop in zip(ranges.tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)]):
        columns = [packed(v[start:stop]) for v in values] + [None] * (3 - len(values))
        yield (kind, number, block, packed_keys(keys[start:stop]), *columns)


def _rows(rows, schema: str) -> pa.Table:
    names = [field.split() for field in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, names)],
                    [name for name, _ in names])


_ANSWERS = "kind int, range long, block long, a binary, b binary, c binary"


def _count(group: pa.Table) -> pa.Table:
    """Corpus counts (`a`) of the keys of each block, and which of them the block owns (`b`). A row of
    block -1 has the sum, the number of counts, and those of 1 and 2."""
    rows = group.to_pylist()
    keys = [unpacked_keys(row["keys"]) for row in rows]
    found, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    n = np.zeros(len(found), np.int64)
    np.add.at(n, inverse, np.concatenate([unpacked(row["a"]) for row in rows]).astype(np.int64))
    owned = np.zeros(len(inverse), np.uint8)
    owned[first] = 1
    out, at = [], 0
    for row, part in zip(rows, keys):
        there = slice(at, at + len(part))
        out.append((row["kind"], row["range"], row["block"], packed(n[inverse[there]]), packed(owned[there]), None))
        at += len(part)
    facts = np.array([n.sum(), (n > 0).sum(), (n == 1).sum(), (n == 2).sum()])
    out.append((rows[0]["kind"], rows[0]["range"], -1, packed(facts), None, None))
    return _rows(out, _ANSWERS)


# Kinds of rows of the second exchange.
_ADD, _ASK, _STATES = 0, 1, 9


def _add_up(group: pa.Table) -> pa.Table:
    """For the states that blocks ask for, the sums of what blocks add: the number of continuations, of
    their counts, and of the counts of their last words in the shorter state."""
    rows = group.to_pylist()
    added = [row for row in rows if row["kind"] == _ADD]
    keys = np.concatenate([unpacked_keys(row["keys"]) for row in added] or [np.zeros(0, np.uint64)])
    found, inverse = np.unique(keys, return_inverse=True)
    sums = []
    for name in "abc":
        total = np.zeros(len(found) + 1, np.int64)
        if added:
            np.add.at(total, inverse, np.concatenate([unpacked(row[name]) for row in added]).astype(np.int64))
        sums.append(total)
    out = []
    for row in rows:
        if row["kind"] == _ASK:
            wanted = unpacked_keys(row["keys"])
            at = np.searchsorted(found, wanted)
            at[at < len(found)] = np.where(found[at[at < len(found)]] == wanted[at < len(found)],
                                           at[at < len(found)], len(found))
            out.append((_STATES, row["range"], row["block"], *(packed(total[at]) for total in sums)))
    return _rows(out, _ANSWERS)


def _answer(answers: dict, kind: int, name: str) -> np.ndarray:
    """The answers of a kind to a block, in the order of its keys."""
    parts = [unpacked(row[name]) for row in answers.get(kind, [])]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def _by_kind(table: pa.Table) -> dict[int, list[dict]]:
    answers: dict[int, list[dict]] = {}
    for row in sorted(table.to_pylist(), key=lambda row: row["range"]):
        answers.setdefault(row["kind"], []).append(row)
    return answers


def _ask_counts(order: int, bits: int):
    """Rows that ask for the counts of words and bigrams."""
    def apply(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                docs = pa.Table.from_batches([batch.slice(i, 1)])
                yield from _rows(_own_counts(docs, *_opened(docs, min(order, 2)), bits, (1, 2)), _ASKED).to_batches()

    return apply


def _own_counts(docs: pa.Table, grams: Grams, learned: np.ndarray, bits: int, orders) -> Iterator[tuple]:
    block = docs.column("block")[0].as_py()
    for order, (keys, at) in enumerate(zip(grams.keys, grams.at), 1):
        if order in orders:
            there = (at >= 0) & learned
            yield from _asked(order, block, bits, keys, np.bincount(at[there], minlength=len(keys)))


class Kept:
    """The n-grams of a block with their corpus counts `n`, by order; those of higher order are kept from `least` on.
    What is not kept, or never was asked for, counts nothing."""

    def __init__(self, docs: pa.Table, answers: dict, order: int, least: float):
        self.block = docs.column("block")[0].as_py()
        self.grams, self.learned = _opened(docs, min(order, 2))
        self.n = [_answer(answers, 1, "a")]
        self.owned = [None]
        if order > 1:
            self._counted(answers, 2, least)
        if order > 2:
            self.grams._longer(self.n[1] > 0)
            if 3 in answers or not len(self.grams.keys[2]):
                self._counted(answers, 3, least)

    def _counted(self, answers: dict, order: int, least: float) -> None:
        n = _answer(answers, order, "a")
        self.n.append(np.where(n >= least, n, 0))
        self.owned.append(_answer(answers, order, "b") > 0)


def _ask_trigrams(least: float, bits: int):
    def apply(docs: pa.Table, answers: pa.Table) -> pa.Table:
        kept = Kept(docs, _by_kind(answers), 3, least)
        return _rows(_own_counts(docs, kept.grams, kept.learned, bits, (3,)), _ASKED)

    return apply


def _ask_states(order: int, least: float, bits: int):
    """What a block's own n-grams add to their states, and the states that it asks for."""
    def apply(docs: pa.Table, answers: pa.Table) -> pa.Table:
        kept, out = Kept(docs, _by_kind(answers), order, least), []
        grams = kept.grams
        for size in range(2, order + 1):
            n, states = kept.n[size - 1], grams.keys[size - 2]
            mine = np.flatnonzero((n > 0) & kept.owned[size - 1])
            state = grams.first[size - 1][mine]
            below = kept.n[size - 2][grams.suffix(size)[mine]]
            sums = [np.zeros(len(states), np.int64) for _ in range(3)]
            for total, values in zip(sums, (np.ones(len(mine), np.int64), n[mine], below)):
                np.add.at(total, state, values)
            some = np.flatnonzero(sums[0])
            out += _asked(_ADD, kept.block, bits, states[some], *(total[some] for total in sums))
        for size in range(1, order):
            wanted = np.flatnonzero(kept.n[size - 1] >= MIN_COUNT)
            # Of both orders together, in the order of the hashes.
            out += _asked(_ASK, kept.block * ORDER + size, bits, grams.keys[size - 1][wanted])
        return _rows(out, _ASKED)

    return apply


# -- the automaton --------------------------------------------------------------------------

class Automaton:
    """Arcs of all states in one sorted table: `codes` are state * width + word, with the log10 probability and the
    next state of each. State 0 is the root, which has an arc for every word: `root` and `root_next`."""

    def __init__(self, root: np.ndarray, root_next: np.ndarray, codes: np.ndarray, arcs: np.ndarray,
                 following: np.ndarray, weights: np.ndarray, failures: np.ndarray):
        order = np.argsort(codes)
        self.root, self.root_next, self.width = root, root_next, max(1, len(root))
        # One code above all, so that every search ends at one.
        self.codes = np.append(codes[order], np.iinfo(np.int64).max)
        self.arcs, self.following = np.append(arcs[order], 0.0), np.append(following[order], 0)
        self.weights, self.failures = weights, failures

    def step(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log10 probability of a word after each state, and the state after it."""
        total, after = np.zeros(len(states)), np.zeros(len(states), np.int64)
        open_, at = np.arange(len(states)), states
        while len(open_):
            rooted = at == 0
            done, word = open_[rooted], words[open_[rooted]]
            total[done] += self.root[word]
            after[done] = self.root_next[word]
            open_, at = open_[~rooted], at[~rooted]
            codes = at * self.width + words[open_]
            place = np.searchsorted(self.codes, codes)
            hit = self.codes[place] == codes
            total[open_[hit]] += self.arcs[place[hit]]
            after[open_[hit]] = self.following[place[hit]]
            # The failure arc, and its weight.
            open_, at = open_[~hit], at[~hit]
            total[open_] += self.weights[at]
            at = self.failures[at]
        return total, after

    def score(self, words: np.ndarray, sizes: np.ndarray, lane: int = LANE_WORDS) -> np.ndarray:
        """The log10 probability of each text: one pass from left to right, all texts side by side. Long texts
        are cut into lanes; one begins some words early, as a state is told by the last ORDER - 1 words."""
        ends = np.cumsum(sizes)
        parts = -(-sizes // lane)
        text = np.repeat(np.arange(len(sizes)), parts)
        offset = (np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)) * lane
        warm = np.where(offset > 0, ORDER - 1, 0)
        warm = np.minimum(warm, offset)
        begin = ends[text] - sizes[text] + offset - warm
        count = np.minimum(sizes[text] - offset, lane) + warm
        longest = np.argsort(-count, kind="stable")
        text, begin, count, warm = text[longest], begin[longest], count[longest], warm[longest]
        states, totals = np.zeros(len(text), np.int64), np.zeros(len(text))
        for step in range(int(count[0]) if len(count) else 0):
            live = int(np.searchsorted(-count, -step, "left"))
            gained, states = self.step(states[:live], words[begin[:live] + step])
            totals[:live] += np.where(step >= warm[:live], gained, 0.0)
        return np.bincount(text, totals, len(sizes))


def automaton(kept: Kept, order: int, sums: dict[int, tuple], tokens: int, types: int, discount: float) -> Automaton:
    """Of a block's own n-grams. `sums` has, for each order of states, the number of continuations, of their
    counts, and of the counts of their last words in the shorter state, by n-gram."""
    n, grams = kept.n, kept.grams
    with np.errstate(divide="ignore", invalid="ignore"):
        known = np.log10((n[0] - discount) / max(tokens, 1))
        unknown = math.log10(discount * types / tokens) if tokens else 0.0
    root = np.where(n[0] > 0, known, unknown)
    state, total = [], 1
    for size in range(1, order):
        exists = sums[size][0] > 0
        state.append(np.where(exists, np.cumsum(exists) - 1 + total, 0))
        total += int(exists.sum())
    weights, failures = np.zeros(total), np.zeros(total, np.int64)
    codes, arcs, following = [], [], []
    for size in range(1, order):
        # What is left in the state, over what is left of its words in the shorter one.
        there = np.flatnonzero(state[size - 1])
        k, continued, below = (s[there] for s in sums[size])
        left = 1 - (continued - DISCOUNT * k) / n[size - 1][there]
        if size == 1:
            shorter = 1 - (below - discount * k) / max(tokens, 1)
        else:
            suffix = grams.suffix(size)[there]
            shorter = 1 - (below - DISCOUNT * k) / n[size - 2][suffix]
            failures[state[size - 1][there]] = state[size - 2][suffix]
        weights[state[size - 1][there]] = np.log10(np.maximum(left, 1e-12) / np.maximum(shorter, 1e-12))
        gram = np.flatnonzero(n[size] > 0)
        first = grams.first[size][gram]
        codes.append(state[size - 1][first] * len(root) + grams.last[size][gram])
        arcs.append(np.log10((n[size][gram] - DISCOUNT) / n[size - 1][first]))
        # The longest state that is a suffix, and no longer than the order allows.
        suffix = grams.suffix(size + 1)[gram]
        after = state[size - 1][suffix]
        if size > 1:
            shorter_suffix = grams.suffix(size)[suffix]
            after = np.where(after > 0, after, state[size - 2][shorter_suffix])
        if size < order - 1:
            after = np.where(state[size][gram] > 0, state[size][gram], after)
        following.append(after)
    empty = np.zeros(0, np.int64)
    return Automaton(root, state[0] if state else np.zeros(len(root), np.int64), np.concatenate([empty, *codes]),
                     np.concatenate([np.zeros(0), *arcs]), np.concatenate([empty, *following]), weights, failures)


_RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")


def _score_block(order: int, least: float, tokens: int, types: int, discount: float):
    def apply(docs: pa.Table, answers: pa.Table) -> pa.Table:
        answers = _by_kind(answers)
        kept = Kept(docs, answers, order, least)
        sums = {}
        for size in range(1, order):
            rows = {_STATES: [row for row in answers.get(_STATES, []) if row["block"] % ORDER == size]}
            wanted = np.flatnonzero(kept.n[size - 1] >= MIN_COUNT)
            sums[size] = tuple(np.zeros(len(kept.n[size - 1]), np.int64) for _ in range(3))
            for total, name in zip(sums[size], "abc"):
                total[wanted] = _answer(rows, _STATES, name)
        made = automaton(kept, order, sums, tokens, types, discount)
        ids, sizes = kept.grams.at[0], kept.grams.sizes
        text = np.repeat(np.arange(len(sizes)), sizes)
        base = np.log10((kept.n[0] + 1) / (tokens + types + 1))
        return pa.table({
            "doc_id": pa.array(docs.column("doc_ids")[0].as_py(), pa.int64()),
            "held_out": pa.array(docs.column("held")[0].as_py(), pa.bool_()),
            "n_tokens": pa.array(sizes),
            "n_known": pa.array(np.bincount(text, kept.n[0][ids] > 0, len(sizes)).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(sizes), tokens)),
            "base_score": pa.array(np.bincount(text, base[ids], len(sizes))),
            "score": pa.array(made.score(ids, sizes))})

    return apply


@contextlib.contextmanager
def _shuffles_cleaned_up(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job that wrote a table are of no use after it, and are deleted at its end."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def score(docs: DataFrame, id_column: str = "doc_id", text: str = "text", modulus: int = 7,
          held: int = 2, order: int = ORDER, min_share: float = 0.0,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` of every row.

    Learns from the rows whose crc32 of the id does not leave `held`; rows without an id are learned
    from. N-grams of two and three words are all that come MIN_COUNT times, or `min_share` of all
    tokens if that is more. NULL texts are empty: their only token is the end. Without any text to
    learn from all tokens are unknown, with probability one. Repeated rows are counted and scored as
    often as they are given; an empty table gives no rows; other columns are not looked at.
    The result is a table in the shared folder.
    """
    if not 1 <= order <= ORDER:
        raise ValueError(f"order {order} is not from 1 to {ORDER}")
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngrams")
    held_out = F.coalesce(remainder(F.col(id_column), modulus) == held, F.lit(False))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out.alias("held_out"),
                       F.col(text).cast("string").alias("text"))
    blocks = scratch.save(rows.mapInArrow(lambda batches: _encode(batches, block_bytes), _BLOCKS), "blocks")
    with _shuffles_cleaned_up(spark):
        return _scored(blocks, scratch, order, min_share)


def _scored(blocks: DataFrame, scratch: Scratch, order: int, min_share: float) -> DataFrame:
    spark = blocks.sparkSession
    # Packed words take about two bytes, so this is about the number of tokens.
    size = blocks.agg(F.sum(F.length("ids"))).first()[0] or 0
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(shuffles, size // RANGE_ENTRIES).bit_length()

    def exchanged(asked: DataFrame, answer, name: str) -> DataFrame:
        return scratch.save(asked.groupBy("kind", "range").applyInArrow(answer, _ANSWERS), name)

    def beside(answers: DataFrame, function, schema: str) -> DataFrame:
        """`function` of every block and the answers to it."""
        own = F.when(F.col("kind") == _STATES, F.floor(F.col("block") / ORDER)).otherwise(F.col("block"))
        return (blocks.groupBy("block").cogroup(
            answers.where("block >= 0").withColumn("of", own).groupBy("of")).applyInArrow(function, schema))

    answers = exchanged(blocks.mapInArrow(_ask_counts(order, bits), _ASKED), _count, "counts")
    facts = [unpacked(row.a) for row in answers.where("block = -1 AND kind = 1").select("a").collect()]
    tokens, types, ones, twos = (sum(int(f[i]) for f in facts) for i in range(4))
    discount = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones else DISCOUNT
    least = max(float(MIN_COUNT), tokens * min_share)
    if order > 2:
        asked = beside(answers, _ask_trigrams(least, bits), _ASKED)
        answers = answers.unionByName(exchanged(asked, _count, "trigrams"))
    if order > 1:
        asked = beside(answers, _ask_states(order, least, bits), _ASKED)
        states = scratch.save(asked.groupBy("range").applyInArrow(_add_up, _ANSWERS), "states")
        answers = answers.unionByName(states)
    result = scratch.save(beside(answers, _score_block(order, least, tokens, types, discount), _RESULT), "scores")
    scratch.drop("blocks", "counts", "trigrams", "states")
    return result
