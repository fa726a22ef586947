"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The benchmark is the stated query set. It goes to the tasks in blocks of bounded size, and for each
block the documents are read twice: once to count the benchmark's words in the whole corpus, and
once to look for seeds and align. No document leaves its task, so that passages shared by many
documents meet nowhere.

A seed is a shortest run of an item's words that is rare: the product of its words' corpus
frequencies, the chance of meeting it at a given place, is at most `max_chance`. Every run of every
item that is rare is a seed. An item without any is its own seed as a whole: its verbatim copies are
found, and reported as what chance may give.
"""

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagloom.llm.common import in_pieces

MAX_CHANCE = 1e-8
MIN_SCORE = 0.5
BLOCK_BYTES = 16 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
# Words around the expected place of an item that are aligned too, as a share of its length.
SLACK = 0.5
_WORDS = re.compile(r"\w+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score of the two sequences, and the first place where it ends in `text`."""
    at = np.arange(len(text) + 1) * GAP
    row, best, end = np.zeros(len(text) + 1, np.int64), 0, 0
    for word in item:
        new = np.zeros(len(text) + 1, np.int64)
        new[1:] = row[:-1] + np.where(text == word, MATCH, MISMATCH)
        np.maximum(new, row + GAP, out=new)
        np.maximum(new, 0, out=new)
        # Gaps along the text: the best start to the left, less a gap for each step.
        row = np.maximum.accumulate(new - at) + at
        top = int(row.argmax())
        if row[top] > best or row[top] == best and top < end:
            best, end = int(row[top]), top
    return best, end


class Matcher:
    """A block of items, ready to be looked for."""

    def __init__(self, items: list[tuple], max_chance: float = MAX_CHANCE):
        self.max_chance = max_chance
        texts = [words_of(text) for _, text in items]
        self.ids = [item_id for item_id, _ in items]
        self.vocabulary = {word: n for n, word in enumerate(sorted({w for t in texts for w in t}))}
        self.items = [np.array([self.vocabulary[w] for w in t], np.int64) for t in texts]
        self.seeds: dict[int, tuple[np.ndarray, list]] = {}
        self.common: set[int] = set()

    def numbers(self, words: list[str]) -> np.ndarray:
        known = self.vocabulary.get
        return np.array([known(w, -1) for w in words], np.int64)

    def choose_seeds(self, counts: np.ndarray, total: int) -> None:
        """`counts` of the vocabulary's words among the `total` words of the corpus."""
        log_chance = np.log((counts + 1) / (total + len(counts) + 1))
        limit, found = np.log(self.max_chance), defaultdict(lambda: defaultdict(list))
        for n, item in enumerate(self.items):
            sums = np.concatenate([[0.0], np.cumsum(log_chance[item])])
            # Sums fall, so the end of the shortest rare run from each start is found by search.
            ends = np.searchsorted(-sums, -(sums[:-1] + limit) - 1e-9)
            least = min(2, len(item))
            runs = [(start, max(least, end - start)) for start, end in enumerate(ends.tolist())]
            runs = [(start, size) for start, size in runs if start + size <= len(item)]
            if not runs and len(item):
                self.common.add(n)
                runs = [(0, len(item))]
            for start, size in runs:
                found[size][int(self._codes(item[start:start + size], size)[0])].append((n, start))
        self.seeds = {size: (np.array(sorted(codes), np.uint64), [codes[c] for c in sorted(codes)])
                      for size, codes in found.items()}

    @staticmethod
    def _codes(numbers: np.ndarray, size: int) -> np.ndarray:
        values = numbers.astype(np.uint64) + np.uint64(1)
        codes = np.zeros(max(0, len(numbers) - size + 1), np.uint64)
        for i in range(size):
            codes = codes * _FACTOR + values[i:i + len(codes)]
        return codes

    def hits(self, text: str | None) -> list[tuple]:
        """(item id, score, first word, word after the last, is rare) of items with a score to report."""
        if not self.seeds:
            return []
        numbers = self.numbers(words_of(text))
        known = np.concatenate([[0], np.cumsum(numbers >= 0)])
        places = defaultdict(set)
        for size, (codes, targets) in self.seeds.items():
            if len(numbers) < size:
                continue
            starts = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(starts):
                continue
            values = self._codes_at(numbers, starts, size)
            found = np.minimum(np.searchsorted(codes, values), len(codes) - 1)
            for i in np.flatnonzero(codes[found] == values).tolist():
                for item, offset in targets[found[i]]:
                    places[item].add(int(starts[i]) - offset)
        return [hit for item, at in places.items() if (hit := self._best(item, sorted(at), numbers))]

    @staticmethod
    def _codes_at(numbers: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        codes = np.zeros(len(starts), np.uint64)
        for i in range(size):
            codes = codes * _FACTOR + (numbers[starts + i].astype(np.uint64) + np.uint64(1))
        return codes

    def _best(self, n: int, places: list[int], numbers: np.ndarray) -> tuple | None:
        """The best alignment around the places where the item should begin."""
        item = self.items[n]
        slack, best = int(len(item) * SLACK) + 1, (0, 0, 0)
        windows: list[list[int]] = []
        for place in places:
            if not windows or place - slack > windows[-1][1]:
                windows.append([max(0, place - slack), 0])
            windows[-1][1] = place + len(item) + slack
        for begin, end in windows:
            score, stop = align(item, numbers[begin:end])
            if score > best[0]:
                best = (score, begin, begin + stop)
        score, begin, stop = best
        share = score / (MATCH * len(item))
        if share <= 0:
            return None
        # The same alignment from its end tells where it starts.
        _, length = align(item[::-1], numbers[begin:stop][::-1])
        return self.ids[n], share, stop - length, stop, n not in self.common


def _word_counts(docs: DataFrame, matcher: Matcher) -> tuple[np.ndarray, int]:
    """Corpus counts of the matcher's words and of all words, summed in the tasks first."""
    sent = docs.sparkSession.sparkContext.broadcast(matcher)
    size = len(matcher.vocabulary)

    def count(batches):
        counts = np.zeros(size + 1, np.int64)
        for batch in in_pieces(batches, "text"):
            for text in batch.column("text").to_pylist():
                counts += np.bincount(sent.value.numbers(words_of(text)) + 1, minlength=size + 1)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen - 1), pa.array(counts[seen])], ["word", "n"])

    rows = (docs.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .toArrow().to_pydict())
    counts = np.zeros(size, np.int64)
    for word, n in zip(rows["word"], rows["n"]):
        if word >= 0:
            counts[word] = n
    return counts, sum(rows["n"])


def matchers(docs: DataFrame, benchmark: DataFrame, max_chance: float = MAX_CHANCE,
             block_bytes: int = BLOCK_BYTES):
    """One matcher per block of the benchmark; `docs` has `text`, `benchmark` `item_id`, `text`."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // block_bytes + 1
    for block in range(blocks):
        chosen = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = chosen.select("item_id", "text").toArrow().to_pydict()
        matcher = Matcher(sorted(zip(rows["item_id"], rows["text"]), key=str), max_chance)
        if matcher.vocabulary:
            matcher.choose_seeds(*_word_counts(docs, matcher))
            yield matcher


def _plain(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col(text).cast("string").alias("text"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id",
                 text: str = "text", min_score: float = MIN_SCORE,
                 max_chance: float = MAX_CHANCE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`doc_id`, `item_id`, `score`, `first_word`, `end_word` and `rare` of each row and item that align.

    The score is that of the best local alignment over that of the item with itself; those of at
    least `min_score` are returned, with the place of the alignment in the document's words. Items
    without a rare run (`rare` is false) are found where they stand word by word. Texts
    and items that are NULL or have no word match nothing. Ids may be NULL. Equal items and repeated
    rows are all reported; of equally good places the first is. Empty tables give no rows;
    other columns are not looked at.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    schema = "doc_id long, item_id long, score double, first_word long, end_word long, rare boolean"
    result = docs.sparkSession.createDataFrame([], schema)
    for matcher in matchers(_plain(docs, text), benchmark, max_chance, block_bytes):
        result = result.unionByName(rows.mapInArrow(_finder(docs, matcher, min_score), schema))
    return result


def _finder(docs: DataFrame, matcher: Matcher, min_score: float):
    sent = docs.sparkSession.sparkContext.broadcast(matcher)

    def find(batches):
        for batch in in_pieces(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            rows = [(doc_id, *hit) for doc_id, text in zip(ids, batch.column("text").to_pylist())
                    for hit in sent.value.hits(text) if hit[1] >= min_score]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(
                        zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()))],
                    ["doc_id", "item_id", "score", "first_word", "end_word", "rare"])

    return find


def clean_documents(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows that no item aligns with, with all their columns. Items without a rare run, such as a word
    or two that many texts hold, are no reason to drop a row."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col("text").cast("string").alias("text"))
    for matcher in matchers(_plain(docs, "text"), benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(matcher)

        def keep(batches, sent=sent):
            for batch in in_pieces(batches, "text"):
                clean = [all(hit[1] < min_score or not hit[4] for hit in sent.value.hits(text))
                         for text in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        row = row.mapInArrow(keep, row.schema)
    return row.select("row.*")
