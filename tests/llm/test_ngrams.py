import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tagloom.llm.ngrams import (DISCOUNT, END, Automaton, Grams, mixed, packed, packed_keys, score, unpacked,
                                unpacked_keys)
from tests.llm import nasty


def tokens(text):
    return (text or "").encode().lower().split() + [END]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute_counts(texts, order, least):
    """Word counts, and counts of the n-grams of each higher order that come often enough."""
    counts = [Counter(t[i:i + n] for t in map(tuple, texts) for i in range(len(t) - n + 1))
              for n in range(1, order + 1)]
    return {g[0]: c for g, c in counts[0].items()}, [
        {g: c for g, c in table.items() if c >= least} for table in counts]


class Backoff:
    """Probabilities by recursion instead of states."""

    def __init__(self, texts, order, least):
        self.words, self.grams = brute_counts(texts, order, least)
        self.n, self.v, self.order = sum(self.words.values()), len(self.words), order
        ones, twos = (sum(c == k for c in self.words.values()) for k in (1, 2))
        self.d = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones else DISCOUNT

    def root(self, word):
        c = self.words.get(word, 0)
        return (c - self.d) / self.n if c else self.d * self.v / self.n

    def share(self, context, word):
        if not context:
            return self.root(word)
        seen = {g: c for g, c in self.grams[len(context)].items() if g[:-1] == context}
        if not seen:
            return self.share(context[1:], word)
        whole = self.grams[len(context) - 1][context]
        if (*context, word) in seen:
            return (seen[*context, word] - DISCOUNT) / whole
        left = 1 - sum((c - DISCOUNT) / whole for c in seen.values())
        below = 1 - sum(self.share(context[1:], g[-1]) for g in seen)
        return left / below * self.share(context[1:], word)

    def score(self, text):
        return sum(math.log10(self.share(tuple(text[max(0, i + 1 - self.order):i]), w))
                   for i, w in enumerate(text))


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts of a small vocabulary, with n-grams that come often."""
    rows = [(i, nasty.words(i % 5, 30) + " " + nasty.words(i, 6) + " " + nasty.words(i % 3, 20))
            for i in range(100, 160)]
    return nasty.docs(spark).unionByName(spark.createDataFrame(rows, "doc_id long, text string"),
                                         allowMissingColumns=True)


@pytest.mark.parametrize("order, share", [(3, 2.0 ** -18), (2, 1e-3), (1, 1e-3)])
def test_against_backoff_by_recursion(spark, corpus, order, share):
    docs = corpus.where("length(coalesce(text, '')) < 20000")
    rows = docs.collect()
    train = [tokens(r.text) for r in rows if not held_out(r.doc_id)]
    brute = Backoff(train, order, max(2.0, share * sum(map(len, train))))
    found = score(docs, order=order, min_share=share).collect()
    assert len(found) == len(rows)
    wanted = {r.doc_id: tokens(r.text) for r in rows if r.doc_id is not None}
    for row in (r for r in found if r.doc_id is not None):
        text = wanted[row.doc_id]
        assert (row.held_out, row.n_tokens) == (held_out(row.doc_id), len(text))
        assert row.train_tokens == brute.n
        assert row.n_known == sum(w in brute.words for w in text)
        assert row.base_score == pytest.approx(
            sum(math.log10((brute.words.get(w, 0) + 1) / (brute.n + brute.v + 1)) for w in text))
        assert row.score == pytest.approx(brute.score(text)), row.doc_id


def test_probabilities_sum_to_one():
    texts = [tokens("a b c a b d a b c"), tokens("b c a b"), tokens("x a b c")]
    brute = Backoff(texts, 3, 2)
    for context in [(), (b"a",), (b"a", b"b"), (b"b", b"c"), (b"x",), (b"zz", b"a")]:
        total = sum(brute.share(context, w) for w in [*brute.words, b"unknown"])
        assert total == pytest.approx(1)


def test_packed_arrays():
    rng = np.random.default_rng(2)
    for top in (0, 200, 1 << 16, 1 << 40):
        values = rng.integers(0, top + 1, 500)
        assert unpacked(packed(values)).tolist() == values.tolist()
    keys = np.sort(rng.integers(0, 1 << 64, 300, dtype=np.uint64))
    assert unpacked_keys(packed_keys(keys)).tolist() == keys.tolist()
    for empty in (packed(np.zeros(0, np.int64)), packed_keys(np.zeros(0, np.uint64))):
        assert len(unpacked(empty)) == len(unpacked_keys(empty)) == 0


def test_n_grams_of_a_block():
    rng = np.random.default_rng(3)
    words, sizes = np.sort(rng.integers(0, 1 << 64, 9, dtype=np.uint64)), np.array([1, 7, 2, 30])
    ids = rng.integers(0, 9, sizes.sum())
    grams = Grams(words, ids, sizes, 3)
    texts = np.split(ids, np.cumsum(sizes)[:-1])
    for order in (2, 3):
        wanted = {tuple(t[i:i + order].tolist()) for t in texts for i in range(len(t) - order + 1)}
        keys = {}
        for gram in wanted:
            key = words[[gram[0]]]
            for word in gram[1:]:
                key = mixed(key, words[[word]])
            keys[int(key[0])] = gram
        assert grams.keys[order - 1].tolist() == sorted(keys)
        shorter = grams.suffix(order)
        for n, key in enumerate(sorted(keys)):
            assert grams.last[order - 1][n] == keys[key][-1]
            if order == 3:
                first, suffix = (int(grams.keys[1][at[n]]) for at in (grams.first[2], shorter))
                pairs = {int(mixed(words[[a]], words[[b]])[0]): (a, b) for a in range(9) for b in range(9)}
                assert (pairs[first], pairs[suffix]) == (keys[key][:2], keys[key][1:])


def test_traversal_takes_arcs_and_failure_arcs():
    """Words a, b, c; the state after a has an arc for b, to a state that has one for c."""
    model = Automaton(root=np.array([-1.0, -2.0, -4.0]), root_next=np.array([1, 0, 0]),
                      codes=np.array([2 * 3 + 2, 1 * 3 + 1]), arcs=np.array([-0.25, -0.5]),
                      following=np.array([0, 2]), weights=np.array([0.0, -0.125, -0.0625]),
                      failures=np.array([0, 0, 0]))
    texts = {(0, 1, 2): -1 - 0.5 - 0.25, (0, 2): -1 - 0.125 - 4, (0, 1, 1): -1 - 0.5 - 0.0625 - 2,
             (0, 0, 1): -1 - 0.125 - 1 - 0.5, (2,): -4.0}
    words = np.concatenate([np.array(t) for t in texts])
    sizes = np.array([len(t) for t in texts])
    assert model.score(words, sizes).tolist() == list(texts.values())


def test_lanes_give_the_same(spark):
    rng = np.random.default_rng(4)
    root_next = np.array([1, 2, 0, 0])
    codes = np.array([1 * 4 + 1, 2 * 4 + 0, 3 * 4 + 2, 3 * 4 + 0])
    model = Automaton(rng.random(4), root_next, codes, rng.random(4), np.array([3, 1, 0, 1]),
                      np.append(0.0, rng.random(3)), np.array([0, 0, 0, 2]))
    sizes = np.array([1, 50, 3, 17])
    words = rng.integers(0, 4, sizes.sum())
    assert model.score(words, sizes) == pytest.approx(model.score(words, sizes, lane=5))


@pytest.mark.parametrize("block_bytes", [300, 4000])
def test_small_blocks_give_the_same(spark, corpus, block_bytes):
    """Every n-gram has one owner among the blocks that have it."""
    docs = corpus.where("length(coalesce(text, '')) < 5000").repartition(3)
    whole, parts = (sorted((str(r.doc_id), r.n_known, round(r.score, 6)) for r in score(docs, block_bytes=size).collect())
                    for size in (1 << 20, block_bytes))
    assert whole == parts


def test_better_than_base_on_held_out_texts(spark):
    found = score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in found) > sum(r.base_score for r in found) * 0.85


def test_long_texts_without_training_and_empty_tables(spark, corpus):
    only = spark.createDataFrame([(i, nasty.words(i, 5)) for i in range(60) if held_out(i)],
                                 "doc_id long, text string")
    found = score(only).collect()
    assert found and all((r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0, 0) for r in found)
    assert score(nasty.empty(spark)).collect() == []
    row = score(corpus).where("doc_id = 9").collect()[0]
    assert row.n_tokens == 20_001


def test_all_repeated_n_grams_at_any_size(spark):
    """Among so many tokens, what comes twice is less than 2^-18 of them; it has arcs all the same."""
    ids = [i for i in range(2000) if not held_out(i)]
    rows = [(i, " ".join(f"w{(i + j) % 7}" for j in range(3000))) for i in ids[:300]]
    rows += [(i, "seldom seen pair") for i in ids[300:302]]
    others = [i for i in range(2000) if held_out(i)]
    asked = dict(zip(others, ["seldom seen pair", "seldom pair seen", "w1 w2 seldom seen"]))
    train = [tokens(text) for _, text in rows]
    brute = Backoff(train, 3, 2)
    assert brute.n * 2.0 ** -18 > 2
    found = score(spark.createDataFrame(rows + [*asked.items()], "doc_id long, text string"))
    for row in found.where("held_out").collect():
        assert row.score == pytest.approx(brute.score(tokens(asked[row.doc_id]))), asked[row.doc_id]
