import public_tokenizers
import pytest
import sentencepiece

from tagloom.llm.pieces import BORDER, Pieces, encode
from tests.llm import nasty

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return Pieces(PATH)


def brute_score(pieces, text):
    """The best sum of scores of all segmentations of a normalized text."""
    names = {pieces.model.id_to_piece(i): pieces.model.get_score(i)
             for i in range(pieces.model.get_piece_size())
             if not (pieces.model.is_byte(i) or pieces.model.is_control(i) or pieces.model.is_unknown(i))}
    best = [0.0]
    for end in range(1, len(text) + 1):
        options = [best[start] + names[text[start:end]] for start in range(max(0, end - 20), end)
                   if text[start:end] in names]
        if text[end - 1] not in names:
            options.append(best[end - 1] + pieces.unknown_score)
        best.append(max(options))
    return best[-1]


def score(pieces, ids):
    total, skip = 0.0, 0
    for i in map(int, ids):
        if pieces.model.is_byte(i):
            if skip == 0:
                first = next(b for b, n in pieces.bytes.items() if n == i)
                skip = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                total += pieces.unknown_score
            skip -= 1
        else:
            total += pieces.model.get_score(i)
    return total


LINES = ["the cat sat", "Is and retitioning ouen the of,", "a  b   c ", " x", "\n\nab\tc", "é ü ß 中文",
         "\U0001F600 \U0001F600", BORDER, f"a{BORDER} b{BORDER}{BORDER}c", nasty.words(1, 40), "x" * 200]


@pytest.mark.parametrize("text", LINES)
def test_best_segmentation(pieces, text):
    ids = pieces.encode(text)
    normalized = pieces.model.normalize(text)
    assert score(pieces, ids) == pytest.approx(brute_score(pieces, normalized), abs=1e-3)
    assert "".join(map(chr, pieces.decode(ids))).encode("latin1").decode() == text.replace(BORDER, " ")


def test_no_worse_than_the_library_as_unigram_model(pieces):
    model = open(PATH, "rb").read().replace(b"\x06tok_v0\x18\x02", b"\x06tok_v0\x18\x01")
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    for text in LINES[:2]:
        assert score(pieces, pieces.encode(text)) >= score(pieces, library.encode(text))
    for text in ("with a plan", "he said that they were in"):
        best = library.nbest_encode_as_ids(text, 20)
        assert max(score(pieces, ids) for ids in best) == score(pieces, pieces.encode(text))


def test_words_are_remembered_within_a_bound(pieces, monkeypatch):
    monkeypatch.setattr("tagloom.llm.pieces._REMEMBERED_WORDS", 5)
    few, text = Pieces(PATH), nasty.words(3, 50)
    assert few.encode(text).tolist() == pieces.encode(text).tolist()
    assert len(few.remembered) <= 5


def test_round_trip_of_nasty_rows(spark, pieces):
    docs = nasty.docs(spark)
    found = encode(docs, PATH).collect()
    assert len(found) == docs.count()
    texts = nasty.texts()
    for row in found:
        text = texts.get(row.doc_id)
        if row.doc_id is not None:
            assert row.ids == pieces.encode(text or "").tolist()
            assert row.lossless == (BORDER not in (text or ""))
            assert row.n_pieces == len(row.ids)
    assert {r.n_pieces for r in found if r.doc_id in (4, 5)} == {0}
    assert encode(nasty.empty(spark), PATH).collect() == []
