import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import suffixes
from tagloom.llm.suffixes import Suffixes, repeats, runs
from tests.llm import nasty


def covered(texts, length):
    """For each text which of its bytes are in a string that starts anywhere else."""
    places = {}
    for d, text in enumerate(texts):
        for i in range(len(text) - length + 1):
            places.setdefault(text[i:i + length], []).append((d, i))
    marks = [np.zeros(len(text), bool) for text in texts]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                marks[d][i:i + length] = True
    return marks


def brute(rows, length):
    texts = [(text or "").encode() for _, text in rows]
    out = []
    for (doc_id, _), text, mark in zip(rows, texts, covered(texts, length)):
        kept = np.frombuffer(text, np.uint8)[~mark].tobytes()
        spans = int((np.diff(np.append(0, mark.astype(int))) > 0).sum())
        out.append((doc_id, len(text), int(mark.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    """Texts with shared passages at all places, periodic ones, and whole copies."""
    rng = random.Random(seed)
    base = "".join(rng.choices("abc de", k=300))
    texts = [None, "", base, base, base[10:200] + "zz" + base[50:90], "x" * 500, "ab" * 100, "x" * 30, "é" * 40]
    for _ in range(40):
        a = rng.randint(0, 100)
        texts.append("".join(rng.choices("ab cdefgh", k=rng.randint(0, 90))) + base[a:a + rng.randint(5, 200)]
                     + "".join(rng.choices("ab cdefg", k=60)))
    return list(enumerate(texts)) + [(None, base), (2, base[:60]), (None, None)]


def found(df, length):
    return sorted(map(tuple, repeats(df, length=length).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("length", [1, 20, 33])
def test_against_brute_force(spark, length):
    rows = passages(length)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df, length) == brute(rows, length)


def test_split_names_are_merged_across_shards(spark, monkeypatch):
    """One passage with different surroundings in all rows, over many small shards and merge blocks."""
    rng = random.Random(9)
    shared = "".join(rng.choices("abcdefgh ", k=80))
    rows = [(i, "".join(rng.choices("abcdefgh ", k=rng.randint(1, 50))) + shared + str(i % 7)
             + "".join(rng.choices("abcdefgh ", k=40))) for i in range(150)]
    rows += [(900, shared[:45]), (901, shared[30:] + "!")]
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 600)
    monkeypatch.setattr(suffixes, "_MERGE_ROWS", 500)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df, 40) == brute(rows, 40)


def test_long_texts_in_chunks(monkeypatch):
    """The same name for every window, and runs of bounded size."""
    def by_window():
        found = runs(text, 20)
        assert found[1].sum() == len(text) - 19
        return [int(name) for _, count, name, _ in zip(*found) for _ in range(count)], found[1].max()

    text = " ".join(t or "" for _, t in passages(3)).encode()
    names, longest = by_window()
    monkeypatch.setattr(suffixes, "_CHUNK_BYTES", 50)
    monkeypatch.setattr(suffixes, "_RUN_WINDOWS", 16)
    assert by_window() == (names, 16) and longest > 16


def test_nasty_rows(spark):
    rows = [(r.doc_id, r.text) for r in nasty.docs(spark).collect()]
    assert found(nasty.docs(spark), 400) == brute(rows, 400)
    assert repeats(nasty.empty(spark)).collect() == []


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert found(df, 400) == brute(rows, 400)


def test_order_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(60):
        pieces = list({bytes(rng.choices(b"ab\0", k=rng.randint(1, 60))) for _ in range(12)})
        sorted_ = Suffixes(pieces)
        tails = [p[i:] for p in pieces for i in range(len(p))]
        ends = [tuple(byte + 99 for byte in p[i:]) + (n,) for n, p in enumerate(pieces) for i in range(len(p))]
        order = sorted(range(len(tails)), key=ends.__getitem__)
        assert sorted_.order.tolist() == order
        for length in (1, 3, 8, 20):
            same = sorted_.same_as_previous(length)
            assert same.tolist() == [False] * bool(order) + [
                len(tails[a]) >= length and tails[a][:length] == tails[b][:length]
                for a, b in zip(order, order[1:])]


def test_equal_windows_have_equal_names():
    rng = random.Random(2)
    text = bytes(rng.choices(b"abcd", k=4000))
    text = text[:1000] + text[200:900] + text[1000:]
    names = {}
    starts, counts, hashes, again = runs(text, 50)
    assert counts.sum() == len(text) - 49 and (starts[1:] == np.cumsum(counts)[:-1]).all()
    for start, count, name in zip(starts, counts, hashes):
        for i in range(start, start + count):
            assert names.setdefault(text[i:i + 50], name) == name
    assert runs(b"x" * 300, 50)[3].all() and not runs(bytes(range(200)), 50)[3].any()


def test_memory_of_a_shard():
    """At most 72 bytes for each byte of a shard. With 64 bits for all places it was 107."""
    rng = random.Random(5)
    shared = bytes(rng.choices(b"abcdefgh ", k=3000))
    pieces = [bytes(rng.choices(b"abcdefgh ", k=2000)) + shared[i:i + 1000] for i in range(60)]
    shard = pa.table({"piece": pa.array(pieces, pa.binary()), "keys": [[bytes([i])] for i in range(60)],
                      "starts": [[0]] * 60, "split": [False] * 60})
    tracemalloc.start()
    ranges = suffixes._found(shard, 400, 1).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    marks = [np.zeros(3000, bool) for _ in pieces]
    for r in ranges:
        marks[r["key"][0]][r["start"]:r["stop"]] = True
    assert all((a == b).all() for a, b in zip(marks, covered(pieces, 400)))
    assert peak < 72 * sum(map(len, pieces))


@pytest.mark.parametrize("length", [3, 20])
def test_wide_numbers_find_the_same(monkeypatch, length):
    rng = random.Random(length)
    pieces = list({bytes(rng.choices(b"ab", k=rng.randint(1, 200))) for _ in range(30)})
    narrow = Suffixes(pieces)
    monkeypatch.setattr(suffixes, "_NARROW", 0)
    wide = Suffixes(pieces)
    assert (narrow.order.dtype, wide.order.dtype) == (np.int32, np.int64)
    assert narrow.order.tolist() == wide.order.tolist() and narrow.rank.tolist() == wide.rank.tolist()
    copies = np.ones(len(pieces), np.int64)
    for a, b in zip(narrow.windows(length, copies), wide.windows(length, copies)):
        assert a.tolist() == b.tolist()


def test_tables_on_the_way(spark, monkeypatch):
    """Each file that an executor writes may start a process, so what is read once is not written."""
    rng = random.Random(7)
    rows = []
    for i in range(0, 300, 2):
        shared = "".join(rng.choices("abcdefgh ", k=60))
        rows += [(i + k, "".join(rng.choices("abcdefgh ", k=50)) + shared + str(k)) for k in range(2)]
    saved, save = [], suffixes.Scratch.save
    monkeypatch.setattr(suffixes.Scratch, "save", lambda self, df, name: saved.append(name) or save(self, df, name))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df, 40) == brute(rows, 40)
    assert sorted(saved) == ["names", "rows", "runs", "verdicts"]
