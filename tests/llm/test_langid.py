import math
import unicodedata
import zlib
from collections import Counter

import pytest

from tagloom.llm.langid import Model, fit, identify, in_a_language, sample
from tests.llm import nasty


def test_words_first_then_shorter_grams():
    model = Model(["a", "b"], {"cat": [-1.0, -9.0]},
                  {"<ca": [-2.0, -3.0], "t": [-1.0, -1.0], "s": [-4.0, -1.0], ">": [0.0, 0.0]},
                  [0.0, 0.0], max_gram=3)
    assert model.word("cat") == [-1.0, -9.0]
    assert model.word("cats") == [-7.0, -5.0]  # "<ca", "t", "s", ">"
    assert model.word("é") == [0.0, 0.0]
    language, score = model.predict("Cat cat 12")
    assert language == "a" and score == pytest.approx(1 / (1 + math.exp(-16 / math.sqrt(2))))


@pytest.mark.parametrize("text", [None, "", " \n", "123 !! ½ ²", "_"])
def test_undetermined(text):
    assert Model(["a"], {"x": [-1.0]}, {}, [0.0]).predict(text) == ("und", 0.0)


def test_ties_go_to_the_first_language():
    assert Model(["a", "b"], {"x": [-1.0, -1.0]}, {}, [0.0, 0.0]).predict("x") == ("a", 0.5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in found)
    assert len(found) > 100 and right / len(found) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.selectExpr("doc_id", "text", "source",
                              "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 'zz', lang) AS lang")
    assert sorted(identify(docs).collect()) == sorted(identify(changed).collect())


def test_nasty_rows(spark):
    docs = nasty.docs(spark)
    found = identify(docs).collect()
    assert len(found) == docs.count()
    assert {r.lang_pred for r in found if r.doc_id in (4, 5, 6, 42)} == {"und"}
    assert {r.lang_pred for r in found if r.doc_id in (1, 9, 43)} == {"en"}
    kept = in_a_language(docs)
    assert kept.columns == docs.columns
    assert {4, 5, 6, 42}.isdisjoint({r.doc_id for r in kept.collect()})


def test_without_labels_or_rows(spark):
    unlabelled = nasty.docs(spark).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in identify(unlabelled).collect()} == {"und"}
    assert identify(nasty.empty(spark)).collect() == []
    assert in_a_language(nasty.empty(spark)).collect() == []


def test_sample_is_bounded_and_leaves_no_language_out(spark):
    rows = spark.range(1000).selectExpr("id", "concat('l', id % 4) AS lang", "'same text' AS text")
    drawn = sample(rows, docs_per_language=20).groupBy("lang").count().collect()
    assert len(drawn) == 4 and all(0 < r["count"] <= 20 for r in drawn)
    many = spark.range(3000).selectExpr("id", "concat('l', least(id, 200)) AS lang", "'same text' AS text")
    drawn = {r.lang: r["count"] for r in sample(many, sample_docs=500).groupBy("lang").count().collect()}
    assert len(drawn) == 201 and set(drawn.values()) <= {1, 2} and drawn["l200"] == 2
    assert fit(rows, docs_per_language=20).languages == ["l0", "l1", "l2", "l3"]


def test_long_texts_give_a_part_of_whole_words(spark):
    text = " ".join(f"word{'abcdefghij'[i % 10]}" for i in range(4000))
    rows = spark.createDataFrame([(1, "long", text), (2, "short", "tiny text")], "id long, lang string, text string")
    drawn = {r.lang: r.text for r in sample(rows, max_chars=500).collect()}
    assert drawn["short"] == "tiny text" and 480 < len(drawn["long"]) <= 500 and drawn["long"] in text
    assert set(drawn["long"].split()) == set(text.split())
    assert fit(rows, max_chars=500).languages == ["long", "short"]


def words(text):
    """Runs of letters and marks, by the categories of the characters."""
    kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower())
    return kept.split()


def brute_prediction(text, training, max_gram=4):
    """Language and score out of the training rows, without a model."""
    seen = {lang: Counter(w for l, t in training if l == lang for w in words(t)) for lang in {l for l, _ in training}}
    languages = sorted(lang for lang in seen if seen[lang])
    grams = {lang: Counter() for lang in languages}
    for lang in languages:
        for word, n in seen[lang].items():
            for size in range(1, max_gram + 1):
                for at in range(len(word) + 2 - size + 1):
                    grams[lang][f"<{word}>"[at:at + size]] += n
    total = Counter()
    for lang in languages:
        total.update(seen[lang])
    known = {w for w in total if total[w] > 1}
    every_gram = {g for lang in languages for g in grams[lang]}

    def frequency(lang, text, counts, of):
        return math.log((counts[lang][text] + 0.5) / (0.5 * len(of) + sum(counts[lang][x] for x in of)))

    def word_score(lang, word):
        if word in known:
            return frequency(lang, word, seen, known)
        rest, score = f"<{word}>", 0.0
        while rest:
            size = next((k for k in range(min(max_gram, len(rest)), 0, -1) if rest[:k] in every_gram), 0)
            score += frequency(lang, rest[:size], grams, every_gram) if size else 0.0
            rest = rest[max(size, 1):]
        return score

    asked = words(text)
    if not any(c.isalpha() for w in asked for c in w):
        return "und", 0.0
    sums = {lang: sum(word_score(lang, w) for w in asked) for lang in languages}
    best = max(languages, key=sums.get)
    return best, 1 / sum(math.exp((s - sums[best]) / math.sqrt(len(asked))) for s in sums.values())


def test_against_brute_force(spark):
    """Also in scripts whose words hold marks."""
    lines = [("hi", "हिन्दी भाषा में लिखा हुआ पाठ"), ("hi", "यह हिन्दी है और यह भी हिन्दी"), ("bn", "বাংলা ভাষায় লেখা পাঠ্য"),
             ("bn", "এটি বাংলা এবং এটিও বাংলা"), ("en", "this is a text in a language"), ("en", "the language of this text"),
             ("fr", "ceci est un texte dans une langue été"), ("fr", "la langue de ce texte où"), (None, "no label here")]
    texts = lines + [(None, t) for t in ("हिन्दी", "बंगाली में पाठ", "বাংলাভাষা", "languages", "texte 12 où", "", "१२३ !", "zzz qqq", "का")]
    rows = [(i, text, lang) for i, (lang, text) in enumerate(texts * 3)]
    training = [(lang, text) for i, text, lang in rows
                if lang and zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for row in identify(docs).collect():
        lang, score = brute_prediction(rows[row.doc_id][1], training)
        assert row.lang_pred == lang, rows[row.doc_id]
        assert row.score == pytest.approx(score)
