"""Quality rules with thresholds that follow the data: quantile sketches per language and source.

Each document is measured in one pass over its text, without a shuffle. A sketch is a histogram
of integer measures in buckets of 1/32 relative width; two sketches merge by adding counts, so that
the sketch of a language is the sum of those of its sources, in any order and with the same result.
The thresholds of each (language, source) are quantiles of its own sketch and a few buckets of margin.
They are drawn towards those of the language, and these towards those of all documents, as if `prior_docs`
more documents had given them, so that a group speaks for itself the more, the larger it is. Joining the
thresholds to the measures gives the verdict.

All of it is DataFrame expressions.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagloom.llm.common import SPACES
from tagloom.operators.skew import lookup_join
from tagloom.session import Scratch

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Of each measure: the share of documents below the lower threshold (None: there is none) and up to the
# upper one, in thousandths, and the margin in buckets. word_length is in thousandths of a code point,
# the others are per thousand.
RULES = {
    "word_length": (100, 900, 6),
    "symbols": (None, 900, 16),
    "dup_lines": (None, 998, 4),
    "repeats": (None, 998, 4),
}
PRIOR_DOCS = 200
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def _window_hashes(words: Column) -> Column:
    """64-bit hashes of all windows of five words: equal windows, equal hashes."""
    def window(word, at):
        return F.xxhash64(word, *[F.get(words, at + i) for i in range(1, WINDOW)])

    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - WINDOW + 1, F.lit(0))), window)


def measured(docs: DataFrame, text: Column, *carried: Column) -> DataFrame:
    """`carried` and the measures of `text` (NULL is empty), one row per row."""
    names = [f"_carried_{i}" for i in range(len(carried))]
    rows = docs.select(*[c.alias(n) for c, n in zip(carried, names)],
                       F.coalesce(text.cast("string"), F.lit("")).alias("_text"))
    rows = rows.withColumns({
        "_words": F.filter(F.split("_text", SPACES), lambda word: word != ""),
        "_lines": _lines_with_words(F.col("_text")),
    }).withColumns({
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.length("_text") - F.length(F.translate("_text", SYMBOLS, "")),
        "_n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "_hashes": _window_hashes(F.col("_words")),
    }).drop("_text", "_words", "_lines")
    # Only texts in which a window comes twice need to know where.
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    ordered = F.sort_array(F.transform(F.when(repeats, F.col("_hashes")),
                                       lambda hashed, at: F.struct(hashed.alias("h"), at.alias("i"))))
    rows = rows.withColumn("_ordered", ordered).drop("_hashes")
    seen = F.col("_ordered")
    again = F.filter(seen, lambda x, j: (x["h"] == F.get(seen, j + 1)["h"])
                     | ((j > 0) & (x["h"] == F.get(seen, j - 1)["h"])))
    rows = rows.withColumn("_starts", F.sort_array(F.transform(again, lambda x: x["i"])))
    rows = rows.drop("_ordered")
    starts = F.col("_starts")
    fresh = F.transform(starts, lambda at, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - at, F.lit(WINDOW))))
    covered = F.coalesce(F.aggregate(fresh, F.lit(0), lambda total, n: total + n), F.lit(0))
    return rows.withColumn("n_repeat_words", covered).select(
        *[F.col(n) for n in names], *[F.col(m).cast("long").alias(m) for m in MEASURES],
        F.col("_n_lines").cast("long").alias("n_lines"))


def _with_rates(rows: DataFrame) -> DataFrame:
    def per_thousand(part, whole):
        return F.floor(F.col(part) * 1000 / F.greatest(F.col(whole), F.lit(1))).cast("long")

    failed = ((F.col("n_words") < MIN_WORDS)
              | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))
    return rows.withColumns({
        "base_failed": failed,
        "word_length": per_thousand("word_chars", "n_words"),
        "symbols": per_thousand("n_symbols", "word_chars"),
        "dup_lines": per_thousand("n_dup_lines", "n_lines"),
        "repeats": per_thousand("n_repeat_words", "n_words"),
    })


def _bucket(value: Column) -> Column:
    """Number of the bucket of a whole number from 0: its first six binary digits and their place."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return 32 * shift + F.call_function("shiftright", value, shift)


def _bucket_start(bucket: Column) -> Column:
    shift = F.greatest(F.floor(bucket / 32) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", bucket - 32 * shift, shift)


def sketches(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`keys`, `measure`, `bucket`, `n`: the merged sketch of each group and measure."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), _bucket(F.col(m)).alias("bucket"))
                                for m in RULES]))
    return (rows.select(*keys, pairs.alias("pair")).groupBy(*keys, "pair.measure", "pair.bucket")
            .agg(F.count("*").alias("n")))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def _of_rule(place: int) -> Column:
    return F.coalesce(*[F.when(F.col("measure") == m, F.lit(rule[place])) for m, rule in RULES.items()])


def thresholds(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """`keys`, `measure`, `n`, `low`, `high`: what each group's own sketch says."""
    group = Window.partitionBy(*keys, "measure")
    counted = sketch.withColumns({
        "upto": F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)),
        "total": F.sum("n").over(group)})

    def quantile(thousandths):
        return F.min(F.when(F.col("upto") * 1000 >= F.col("total") * thousandths, F.col("bucket")))

    found = counted.groupBy(*keys, "measure").agg(
        F.max("total").alias("n"), quantile(F.coalesce(_of_rule(0), F.lit(0))).alias("lower"),
        quantile(_of_rule(1)).alias("upper"))
    return found.select(
        *keys, "measure", "n", _bucket_start(F.greatest(F.col("lower") - _of_rule(2), F.lit(0))).alias("low"),
        _bucket_start(F.col("upper") + _of_rule(2)).alias("high"))


def _drawn(own: DataFrame, wider: DataFrame, on: list[str], prior_docs: int) -> DataFrame:
    """Thresholds drawn towards those of the wider group, in whole numbers."""
    both = own.join(wider.select(*on, "measure", F.col("low").alias("w_low"), F.col("high").alias("w_high")),
                    [*on, "measure"])
    return both.withColumns({side: F.expr(f"({side} * n + w_{side} * {prior_docs}) div (n + {prior_docs})")
                             for side in ("low", "high")}).drop("w_low", "w_high")


def _group_bounds(sketch: DataFrame, prior_docs: int) -> DataFrame:
    """`group_key` and `bounds`, from `low` to `high` of each measure, of every (language, source)."""
    overall = thresholds(merged(sketch, []), [])
    language = _drawn(thresholds(merged(sketch, ["language_key"]), ["language_key"]), overall, [], prior_docs)
    own = _drawn(thresholds(sketch, ["group_key", "language_key"]), language, ["language_key"], prior_docs)
    return own.groupBy("group_key").agg(F.struct(*[
        F.max(F.when(F.col("measure") == m, F.struct("low", "high"))).alias(m) for m in RULES
    ]).alias("bounds"))


def _judged(docs: DataFrame, carried: Column, text: str, lang: str, source: str,
            prior_docs: int) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "quality")
    # As JSON, so that NULL is a key of its own and differs from the empty text.
    language = F.to_json(F.struct(F.col(lang).alias("l")))
    group = F.to_json(F.struct(F.col(lang).alias("l"), F.col(source).alias("s")))
    rows = measured(docs, F.col(text), carried, language, group)
    rows = rows.withColumnsRenamed({"_carried_0": "carried", "_carried_1": "language_key",
                                    "_carried_2": "group_key"})
    rows = scratch.save(_with_rates(rows), "measured")
    sketch = scratch.save(sketches(rows.where(~F.col("base_failed")), ["language_key", "group_key"]),
                          "sketch")
    bounds = scratch.save(_group_bounds(sketch, prior_docs), "bounds")
    within = [(F.col(m) <= F.col("bounds")[m]["high"]) for m in RULES]
    within += [(F.col(m) >= F.col("bounds")[m]["low"]) for m, rule in RULES.items()
               if rule[0] is not None]
    kept = ~F.col("base_failed") & F.coalesce(reduce(and_, within), F.lit(False))
    return lookup_join(rows, bounds, "group_key").withColumn("kept", kept)


def quality(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang",
            source: str = "source", prior_docs: int = PRIOR_DOCS) -> DataFrame:
    """`doc_id`, the measures, `base_failed` and `kept`, one row per row.

    A NULL text has no words and fails. NULL languages and sources are groups like any other; a NULL
    id stays NULL. Rows that fail the base rules are not sketched. An empty table gives no rows;
    other columns are not looked at. Repeated rows count as often as they are given. A measure
    that equals its threshold is kept.
    """
    return _judged(docs, F.col(id_column), text, lang, source, prior_docs).select(
        F.col("carried").alias("doc_id"), *MEASURES, "base_failed", "kept")


def kept_documents(docs: DataFrame, prior_docs: int = PRIOR_DOCS) -> DataFrame:
    """The rows that `quality` keeps, with all their columns."""
    rows = _judged(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]), "text", "lang", "source",
                   prior_docs)
    return rows.where("kept").select("carried.*")
