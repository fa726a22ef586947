import random

import numpy as np
import pytest

from tagloom.llm.decontaminate import GAP, MATCH, MISMATCH, align, clean_documents, contaminated, words_of
from tests.llm import nasty

ITEMS = "item_id long, text string, doc_id long, score double"


def brute_align(a, b):
    rows, best = [[0] * (len(b) + 1)], 0
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, rows[-1][j - 1] + (MATCH if x == y else MISMATCH), rows[-1][j] + GAP,
                           row[-1] + GAP))
        rows.append(row)
        best = max(best, max(row))
    return best


def test_alignment_against_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in "ab")
        score, end = align(np.array(a, np.int64), np.array(b, np.int64))
        assert score == brute_align(a, b)
        assert score == brute_align(a, b[:end]) and (not end or score > brute_align(a, b[:end - 1]))


def items(spark, more=()):
    return spark.createDataFrame([(1, nasty.words(101, 40), None, 0.5), (2, nasty.words(102, 25), 1, None),
                                  (3, None, 1, 1.0), (4, "", 1, 1.0), (None, nasty.words(103, 30), 1, 1.0),
                                  *more], ITEMS)


def edited(text, every, seed):
    rng, ws = random.Random(seed), text.split()
    for i in range(every - 1, len(ws), every):
        kind = rng.randrange(3)
        ws[i] = "" if kind == 0 else "qqz" if kind == 1 else ws[i] + " wwx"
    return " ".join(w for w in ws if w)


@pytest.fixture(scope="module")
def leaked(spark):
    first, second, third = (nasty.words(n, k) for n, k in ((101, 40), (102, 25), (103, 30)))
    rows = [(101, nasty.words(201, 300) + " " + first.upper() + ", " + nasty.words(202, 5000)),
            (102, edited(first, 5, 1)), (103, f"({second})\n{nasty.words(203, 80)} {third}"),
            (104, " ".join(second.split()[:8]) + " " + nasty.words(204, 100)), (105, third + " " + third)]
    return nasty.docs(spark).unionByName(
        spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)


def brute(docs, items):
    """Scores of all pairs by alignment with the whole text."""
    found = {}
    for doc in docs:
        for item in items:
            a, b = words_of(item.text), words_of(doc.text)
            if a and b and len(b) < 2000:
                share = brute_align(a, b) / (MATCH * len(a))
                if share >= 0.5:
                    found[doc.doc_id, item.item_id] = share
    return found


def test_against_alignment_of_all_pairs(spark, leaked):
    found = contaminated(leaked, items(spark)).collect()
    scores = {(r.doc_id, r.item_id): r.score for r in found}
    assert scores.pop((101, 1)) == 1.0
    assert scores == pytest.approx(brute(leaked.collect(), items(spark).collect()))
    place = next((r.first_word, r.end_word) for r in found if r.doc_id == 101)
    assert place == (300, 340)


def test_blocks_of_items_give_the_same(spark, leaked):
    whole, parts = (sorted(map(str, contaminated(leaked, items(spark), block_bytes=size).collect()))
                    for size in (1 << 20, 150))
    assert whole == parts and whole


def test_leaks_in_most_documents_are_found(spark):
    """What everybody copies is no less rare as a passage."""
    text = nasty.words(101, 40)
    rows = [(i, f"{nasty.words(300 + i, 30)} {text} {nasty.words(400 + i, 30)}" if i % 3
             else nasty.words(300 + i, 90)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = contaminated(docs, items(spark)).where("item_id = 1").collect()
    assert sorted(r.doc_id for r in found) == [i for i in range(60) if i % 3]


def test_items_of_common_words_are_found_as_they_stand(spark):
    """Every item has a seed, also one of a single word, and one whose words are all common."""
    common = "the cat is on the mat".split()
    rng = random.Random(4)
    texts = [" ".join(rng.choices([*common, "a", "b"], k=40)) for _ in range(30)]
    texts += ["x the cat is on the mat y", "THE CAT, is on the mat", "the cat is on mat the", "the", "rareword a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = spark.createDataFrame([(1, " ".join(common)), (2, "cat"), (3, "rareword"), (4, "is on")],
                                   "item_id long, text string")
    found = contaminated(docs, wanted, max_chance=1e-3).collect()
    verbatim = {(i, item) for i, text in enumerate(texts) for item, words in
                ((1, " ".join(common)), (2, "cat"), (3, "rareword"), (4, "is on"))
                if f" {words} " in f" {' '.join(words_of(text))} "}
    assert {(r.doc_id, r.item_id) for r in found} >= verbatim
    rare = {r.item_id: r.rare for r in found}
    assert not rare[2] and not rare[4]
    kept = {r.doc_id for r in clean_documents(docs, wanted.where("item_id IN (2, 4)")).collect()}
    assert kept == set(range(len(texts)))


def test_clean_documents(spark, leaked):
    kept = clean_documents(leaked, items(spark))
    assert kept.columns == leaked.columns
    gone = {r.doc_id for r in leaked.collect()} - {r.doc_id for r in kept.collect()}
    assert gone == {r.doc_id for r in contaminated(leaked, items(spark)).collect()}
    assert kept.count() == leaked.count() - len(gone)


def test_empty_tables(spark, leaked):
    assert contaminated(nasty.empty(spark), items(spark)).collect() == []
    assert contaminated(leaked, items(spark).where("false")).collect() == []
    assert clean_documents(leaked, items(spark).where("false")).count() == leaked.count()
    assert clean_documents(nasty.empty(spark), items(spark)).collect() == []
