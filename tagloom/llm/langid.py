"""Language by words first, then by shorter and shorter character n-grams.

The model holds, per language, log frequencies of words and of the n-grams of words (with their
borders marked). A known word is scored by its own frequencies. An unseen word is covered from left
to right by the longest n-grams that are known, of up to `max_gram` and down to one character. The
language with the highest sum is predicted; the score is its posterior, tempered for the
dependence between words.

Words are runs of letters and marks, in fitting and in predicting alike.

The classifier is fitted on a bounded sample: up to `docs_per_language` labelled rows of every language,
fewer if there are so many that all would be more than `sample_docs` (but one of each at least), chosen by the
hash of the row. Of a text of more than `max_chars` characters a part of that length is learned, at a place chosen
by its hash. This bounds the model, which is sent to all tasks. Prediction reads every whole text.
"""

import math
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tagloom.llm.common import in_pieces, remainder

DOCS_PER_LANGUAGE = 1500
SAMPLE_DOCS = 96_000
MAX_SAMPLE_CHARS = 8000
MAX_GRAM = 4
UNDETERMINED = "und"
# As Java's and Python's patterns both understand it.
_WORD = r"[\p{L}\p{M}]+"
_WORDS = regex.compile(_WORD)
_REMEMBERED_WORDS = 50_000


@dataclass
class Model:
    """Log frequencies per language, in the order of `languages`."""

    languages: list[str]
    words: dict[str, list[float]]
    grams: dict[str, list[float]]
    unseen: list[float]
    max_gram: int = MAX_GRAM
    remembered: dict[str, list[float]] = field(default_factory=dict, repr=False)

    def word(self, word: str) -> list[float]:
        known = self.words.get(word) or self.remembered.get(word)
        if known is None:
            known = self._by_grams(word)
            if len(self.remembered) >= _REMEMBERED_WORDS:
                self.remembered.clear()
            self.remembered[word] = known
        return known

    def _by_grams(self, word: str) -> list[float]:
        marked, at, total = f"<{word}>", 0, [0.0] * len(self.languages)
        while at < len(marked):
            for size in range(min(self.max_gram, len(marked) - at), 0, -1):
                found = self.grams.get(marked[at:at + size])
                if found:
                    break
            else:
                found, size = self.unseen, 1
            total = [a + b for a, b in zip(total, found)]
            at += size
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        words = Counter(_WORDS.findall(text.lower())) if text else {}
        if not self.languages or not any(any(map(str.isalpha, word)) for word in words):
            return UNDETERMINED, 0.0
        sums = [0.0] * len(self.languages)
        for word, times in words.items():
            sums = [a + times * b for a, b in zip(sums, self.word(word))]
        best = max(range(len(sums)), key=sums.__getitem__)
        # Words of a text depend on each other: their evidence counts like that of the root of them.
        weight = math.sqrt(sum(words.values()))
        return self.languages[best], 1 / sum(math.exp((s - sums[best]) / weight) for s in sums)


def word_counts(rows: DataFrame) -> DataFrame:
    """`lang`, `word`, `n` of all words of `rows` (`lang`, `text`)."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(_WORD), 0)
    return (rows.select("lang", F.explode(words).alias("word"))
            .groupBy("lang", "word").agg(F.count("*").alias("n")))


def sample(rows: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE,
           sample_docs: int = SAMPLE_DOCS, max_chars: int = MAX_SAMPLE_CHARS) -> DataFrame:
    """`lang` and `text` of at most `docs_per_language` rows of each language, chosen by the hash of `id`
    and text, so that a text with many copies gets its share and no more."""
    usable = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"))
    languages = sizes.agg(F.count("*")).scalar()
    sizes = sizes.withColumn("wanted", F.greatest(F.lit(1), F.least(
        F.lit(docs_per_language), F.floor(sample_docs / languages))))
    place = F.xxhash64("id", "text")
    # First by a rate that leaves about twice as many as are wanted (and some more of rare languages), then
    # the first in order.
    rate = F.least(F.lit(1.0), (2.0 * F.col("wanted") + 20) / F.col("n"))
    # One row per language.
    drawn = (usable.join(F.broadcast(sizes), "lang").withColumn("place", place)
             .where(F.pmod(F.col("place"), F.lit(1 << 20)) < rate * (1 << 20)))
    long = F.length("text") > max_chars
    begin = (F.pmod(F.col("place"), F.length("text") - max_chars + 1) + 1).cast("int")
    # Without the words that the cut goes through. Long texts are cut before they are moved.
    part = F.regexp_replace(F.substring("text", begin, F.lit(max_chars)), r"^[\p{L}\p{M}]+|[\p{L}\p{M}]+$", "")
    parts = drawn.select("lang", "place", "wanted", F.when(long, part).otherwise(F.col("text")).alias("text"))
    order = Window.partitionBy("lang").orderBy("place", "text")
    return (parts.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= F.col("wanted")).select("lang", "text"))


def fit(rows: DataFrame, max_gram: int = MAX_GRAM, **bounds: int) -> Model:
    """The model of labelled rows (`id`, `lang`, `text`). The driver gets the sample's counts."""
    counts = word_counts(sample(rows, **bounds)).toArrow().to_pydict()
    words, grams = defaultdict(Counter), defaultdict(Counter)
    languages = sorted(set(counts["lang"]))
    for lang, word, n in zip(counts["lang"], counts["word"], counts["n"]):
        words[word][lang] += n
        marked = f"<{word}>"
        for size in range(1, max_gram + 1):
            for at in range(len(marked) - size + 1):
                grams[marked[at:at + size]][lang] += n
    # A word seen once tells no more than its n-grams, and such words are most of the model.
    known = {word: c for word, c in words.items() if c.total() > 1}
    return Model(languages, _logs(known, languages), _logs(grams, languages),
                 [0.0] * len(languages), max_gram)


def _logs(counts: dict[str, Counter], languages: list[str]) -> dict[str, list[float]]:
    """Log of the add-half frequency in each language."""
    totals = {lang: 0.5 * len(counts) + sum(c[lang] for c in counts.values()) for lang in languages}
    return {text: [math.log((c[lang] + 0.5) / totals[lang]) for lang in languages]
            for text, c in counts.items()}


def predict(docs: DataFrame, model: Model, text: str, carried: Column) -> DataFrame:
    """`carried`, `lang_pred` and `score` of every row."""
    rows = docs.select(carried.alias("carried"), F.col(text).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches):
        for batch in in_pieces(batches, "text"):
            found = [sent.value.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("carried"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["carried", "lang_pred", "score"])

    schema = (T.StructType([rows.schema["carried"]]).add("lang_pred", T.StringType())
              .add("score", T.DoubleType()))
    return rows.mapInArrow(apply, schema)


def _fitted(docs: DataFrame, id_column: str, text: str, lang: str, modulus: int) -> Model:
    training = F.coalesce(remainder(F.col(id_column), modulus) != 0, F.lit(True))
    return fit(docs.where(training).select(F.col(id_column).alias("id"),
                                           F.col(lang).cast("string").alias("lang"),
                                           F.col(text).cast("string").alias("text")))


def identify(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang",
             modulus: int = 5) -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred` and `score` of every row.

    Rows whose crc32 of the id leaves no remainder are held out and not learned from; rows
    without an id can be learned from. A text that is NULL or has no letter, or a table without any
    labelled row, gives `und` with score 0. Of languages with equal sums the first by name is
    predicted. Repeated rows are predicted alike; an empty table gives no rows; other columns are
    not looked at.
    """
    model = _fitted(docs, id_column, text, lang, modulus)
    held_out = F.coalesce(remainder(F.col(id_column), modulus) == 0, F.lit(False))
    return predict(docs, model, text, F.struct(F.col(id_column).alias("doc_id"),
                                               held_out.alias("held_out"))).select(
        "carried.doc_id", "carried.held_out", "lang_pred", "score")


def in_a_language(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The rows with a predicted language of at least `min_score`, with all their columns."""
    model = _fitted(docs, "doc_id", "text", "lang", 5)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = predict(docs, model, "text", row)
    return (found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
            .select("carried.*"))
