import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tagloom.llm import tokenbin
from tests.llm import nasty

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENCODER, WHOLE = tokenbin.Encoder(PATH), Tokenizer.from_file(PATH)


@pytest.mark.parametrize("sizes", [[], [0], [1], [4], [3, 0, 5, 1], [1000, 7]])
def test_code_round_trip(sizes):
    rng, sizes = np.random.default_rng(1), np.array(sizes, np.int64)
    values = (rng.integers(0, 1 << 32, int(sizes.sum())) >> rng.integers(0, 32, int(sizes.sum()))) \
        .astype(np.uint32)
    control, data, at_control, at_data = tokenbin.pack(values, sizes)
    assert tokenbin.unpack(control, data, sizes).tolist() == values.tolist()
    start = 0
    for i, size in enumerate(sizes.tolist()):  # each document can be read on its own
        own = tokenbin.unpack(control[at_control[i]:at_control[i + 1]],
                              data[at_data[i]:at_data[i + 1]], sizes[i:i + 1])
        assert own.tolist() == values[start:start + size].tolist()
        start += size


def test_lengths_of_the_code():
    control, data, _, _ = tokenbin.pack(np.array([1, 256, 1 << 16, 1 << 24], np.uint32), np.array([4]))
    assert control == bytes([0b11100100]) and len(data) == 1 + 2 + 3 + 4


TEXTS = ["a  b \n c", " a", "a ", "\n\n x", "don't 1 2\t3 é ß", "x y  z", "a \x1c b", "a <|endoftext|> b",
         "   ", "中文 字 字", "it's 's ('s \n's 1's 's's 'sabc they'll", "x²y ⅷ", "a\n\nb", "a\n\n b", "a \n\n(b", "a_b _c",
         "e\u0301a \u0301", "a\xa0\xa0b \u2003 c", "\r\n\r\nA", "1st 2nd3", nasty.words(5, 300)]


def test_parts_give_the_tokenizers_ids():
    whole = Tokenizer.from_file(PATH)
    encoder = tokenbin.Encoder(PATH)
    assert encoder.by_parts
    for texts in (TEXTS, TEXTS, [t for t in nasty.texts().values() if t]):
        found = [np.frombuffer(ids, np.uint32).tolist() for ids in encoder.encode(texts)]
        assert found == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=" \n\t'stvrelma1_.-(é中²\u0301\xa0\x1c<|>A", max_size=14))
def test_parts_of_any_text(text):
    found = np.frombuffer(ENCODER.encode([text])[0], np.uint32).tolist()
    assert found == WHOLE.encode(text, add_special_tokens=False).ids


PARTS = re.compile(r"( ?[^\W\d_]+|(?<![ _])(?<![^\w\s])'(?:s|t|re|ve|m|ll|d)|(?<=\s)[^\S ](?=\S))")


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t'stvrelmda1_.-(é中\u0301\xa0<A𝒳", max_size=9), max_size=4))
def test_texts_are_cut_at_once_as_one_by_one(texts):
    joined = "".join(texts)
    if joined:
        bounds = np.cumsum([0, *map(len, texts)])
        at = [*tokenbin._cuts(tokenbin._codes(joined), bounds[:-1][np.diff(bounds) > 0]).tolist(), len(joined)]
        assert [joined[a:b] for a, b in zip(at, at[1:])] == [p for text in texts for p in PARTS.split(text) if p]
    assert ENCODER.encode(texts) == [ENCODER.encode([text])[0] for text in texts]


def test_a_part_is_looked_up_once_for_many_texts(monkeypatch):
    looked_up = []
    remember = tokenbin.Encoder._remember
    monkeypatch.setattr(tokenbin.Encoder, "_remember", lambda self, parts, is_word:
                        looked_up.extend(parts.to_pylist()) or remember(self, parts, is_word))
    texts = ["one two" + " two" * 500, "", "²", "two two two <|endoftext|>", "one two"] * 3
    assert [np.frombuffer(ids, np.uint32).tolist() for ids in ENCODER.encode(texts)] \
        == [WHOLE.encode(text, add_special_tokens=False).ids for text in texts]
    assert sorted(looked_up) == [" two", "one"]


def test_parts_are_remembered_within_a_bound(monkeypatch):
    monkeypatch.setattr(tokenbin, "_REMEMBERED", 40)
    few, texts = tokenbin.Encoder(PATH), [nasty.words(n, 30) for n in range(5)] * 2
    for text in texts:
        assert few.encode([text]) == ENCODER.encode([text])
        assert len(few.parts) <= 41 and len(few.before) <= 41


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, whole = tokenbin.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_parts
    found = np.frombuffer(encoder.encode([TEXTS[-1]])[0], np.uint32).tolist()
    assert found == whole.encode(TEXTS[-1], add_special_tokens=False).ids


def wanted(rows):
    whole, start, found = Tokenizer.from_file(PATH), 0, []
    for row in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = np.array(whole.encode(row.text or "", add_special_tokens=False).ids + [2], "<u4")
        found.append((row.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def test_round_trip_of_nasty_rows(spark):
    docs = nasty.docs(spark)
    found = sorted(map(tuple, tokenbin.round_trip(docs, PATH).collect()), key=lambda r: r[1])
    expected = wanted(docs.collect())
    assert [r for r in found if r[0] is not None] == [r for r in expected if r[0] is not None]
    assert sorted(r[2:] for r in found) == sorted(r[2:] for r in expected)
    starts = [r[1] for r in found]
    assert starts == [sum(r[2] for r in found[:i]) for i in range(len(found))]


def test_many_blocks_and_ranks(spark, tmp_path):
    docs = nasty.docs(spark).where("doc_id IS NOT NULL")
    path = str(tmp_path / "files")
    tokenbin.write(docs, path, PATH, block_ids=500)
    blocks = spark.read.parquet(f"{path}/blocks").orderBy("shard", "block").collect()
    assert len(blocks) > 20
    ids = [i for b in blocks for i in b.doc_ids]
    assert ids == sorted(ids)
    found = sorted(map(tuple, tokenbin.read(spark, path).collect()), key=lambda r: r[1])
    assert found == wanted(docs.collect())
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(len(ranks)))


def test_empty_table(spark):
    assert tokenbin.round_trip(nasty.empty(spark), PATH).collect() == []
