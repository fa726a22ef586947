"""SentencePiece encoding and decoding: one pass of Viterbi over an Aho-Corasick automaton.

The automaton of all pieces gives, at each place, the pieces that end there, the longest first, by
following its output links; each relaxes the best score of a segmentation that ends there. The
scores are those in the model file. Characters that no piece holds become bytes, if the model
has byte pieces, or unknown.

No piece of usual models holds a word border after another character, so that a best segmentation
of a text consists of best ones of its words. Words are remembered, within a bound. For models with
other pieces the whole text is one word.
"""

import math
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from tagloom.llm.common import in_pieces

BORDER = "▁"
UNKNOWN_PENALTY = 10.0
_REMEMBERED_WORDS = 120_000
_WORD = re.compile(f"{BORDER}+[^{BORDER}]*|[^{BORDER}]+")


class Pieces:
    """A model file's pieces; encodes and decodes texts."""

    def __init__(self, path: str):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                   or model.is_unused(i)}
        names = [model.id_to_piece(i) for i in ids]
        self.automaton = ahocorasick.Automaton()
        for i in ids:
            if i not in special and names[i]:
                self.automaton.add_word(names[i], (len(names[i]), model.get_score(i), i))
        self.automaton.make_automaton()
        scores = [model.get_score(i) for i in ids if i not in special]
        self.unknown_score = min(scores, default=0.0) - UNKNOWN_PENALTY
        self.unknown = model.unk_id()
        self.bytes = {int(names[i][3:5], 16): i for i in ids if model.is_byte(i)}
        self.by_words = not any(BORDER in name.lstrip(BORDER) for i, name in enumerate(names)
                                if i not in special)
        self.texts = [b"" if model.is_control(i) else bytes([int(names[i][3:5], 16)])
                      if model.is_byte(i) else " ⁇ ".encode() if model.is_unknown(i)
                      else names[i].replace(BORDER, " ").encode() for i in ids]
        self.plain_prefix = model.normalize("a b\tc\n") == f"{BORDER}a{BORDER}b\tc\n"
        self.prefixed = model.normalize("a").startswith(BORDER)
        self.singles = frozenset(names[i] for i in ids if i not in special and len(names[i]) == 1)
        self.sizes = [len(name) for name in names]
        self.remembered = _Words(self)

    def segment(self, text: str) -> list[int]:
        """The ids of a best segmentation of a normalized text; of equals, that with the longest
        last piece."""
        return self._segment_known(text) if self.singles.issuperset(text) else self._segment_any(text)

    def _segment_known(self, text: str) -> list[int]:
        """Of a text whose characters are pieces, so that none is unknown."""
        best, back = [0.0] + [-math.inf] * len(text), [0] * (len(text) + 1)
        for end, (size, score, piece) in self.automaton.iter(text) if text else ():
            end += 1
            score += best[end - size]
            if score > best[end]:
                best[end], back[end] = score, piece
        ids, end, sizes = [], len(text), self.sizes
        while end:
            ids.append(back[end])
            end -= sizes[back[end]]
        ids.reverse()
        return ids

    def _segment_any(self, text: str) -> list[int]:
        best, back = [0.0] + [None] * len(text), [None] * (len(text) + 1)
        matches = self.automaton.iter(text) if len(self.automaton) else iter(())
        match = next(matches, None)
        for end in range(len(text)):
            single = False
            while match is not None and match[0] == end:
                size, score, piece = match[1]
                score += best[end + 1 - size]
                if best[end + 1] is None or score > best[end + 1]:
                    best[end + 1], back[end + 1] = score, (size, piece)
                single = single or size == 1
                match = next(matches, None)
            if not single:
                score = best[end] + self.unknown_score
                if best[end + 1] is None or score > best[end + 1]:
                    best[end + 1], back[end + 1] = score, (1, None)
        ids, end = [], len(text)
        while end:
            size, piece = back[end]
            if piece is not None:
                ids.append(piece)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in reversed(text[end - 1].encode()))
            elif not ids or ids[-1] != self.unknown:  # a run of unknown characters is one piece
                ids.append(self.unknown)
            end -= size
        return ids[::-1]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        if not text:
            return np.zeros(0, np.int32)
        words = text.split(" ")
        if not (self.by_words and self.plain_prefix and self.bytes) or "" in words or BORDER in text:
            normalized = self.model.normalize(text)
            words = _WORD.findall(normalized) if self.by_words and self.bytes else [normalized]
            return np.frombuffer(b"".join([self.remembered.of_marked(w) for w in words]), np.int32)
        return np.frombuffer(b"".join(map(self.remembered.__getitem__, words)), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids as UTF-8, without the border that was put in front."""
        text = b"".join(map(self.texts.__getitem__, ids.tolist()))
        return text[1:] if self.prefixed and text.startswith(b" ") else text


class _Words(dict):
    """Packed ids by word, without the border before it. When full, only the words that are seen again
    are taken over from the generation before."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces, self.before = pieces, {}

    def __missing__(self, word: str) -> bytes:
        return self._add(word, BORDER + word)

    def of_marked(self, marked: str) -> bytes:
        """Of a word with its borders; other keys than those without a border."""
        if marked[0] == BORDER and BORDER not in marked[1:]:
            return self[marked[1:]]
        key = marked if marked[0] == BORDER else (marked,)
        return self.get(key) or self._add(key, marked)

    def _add(self, key, marked: str) -> bytes:
        packed = self.before.get(key)
        if packed is None:
            packed = array("i", self.pieces.segment(marked)).tobytes()
        if len(marked) <= 100:
            if len(self) >= _REMEMBERED_WORDS:
                self.before = dict(self)
                self.clear()
            self[key] = packed
        return packed


def encode(docs: DataFrame, model_path: str, id_column: str = "doc_id",
           text: str = "text") -> DataFrame:
    """`doc_id`, `n_pieces`, `ids`, `n_unknown`, `decoded_bytes` and `lossless` of every row.

    `lossless` tells whether decoding the ids gives the text again; it does not where the text
    itself has the border character, or the model normalizes it. NULL texts are empty and have no
    ids. Ids of documents may be NULL. Repeated rows are encoded alike; an empty table gives no
    rows; other columns are not looked at. The model file is read by each task from `model_path`.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))

    def apply(batches):
        pieces = _loaded(model_path)
        for batch in in_pieces(batches, "text", 4 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = [pieces.encode(t) for t in texts]
            sizes = np.array([len(i) for i in ids], np.int64)
            decoded = [pieces.decode(i) for i in ids]
            unknown = [int((i == pieces.unknown).sum()) for i in ids]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(
                np.concatenate([*ids, np.zeros(0, np.int32)])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), lists, pa.array(unknown, pa.int64()),
                 pa.array([len(d) for d in decoded], pa.int64()),
                 pa.array([d == t.encode() for d, t in zip(decoded, texts)], pa.bool_())],
                ["doc_id", "n_pieces", "ids", "n_unknown", "decoded_bytes", "lossless"])

    return rows.mapInArrow(apply, "doc_id long, n_pieces long, ids array<int>, n_unknown long, "
                                  "decoded_bytes long, lossless boolean")


_models: dict[str, Pieces] = {}


def _loaded(path: str) -> Pieces:
    """One model per worker process."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]
