"""The pipeline's stages against brute-force versions, on rows with every kind of trouble."""

import os

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tagloom.session import shared_folder
from tests.llm import nasty
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows before the first and after each stage, written and read again."""
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    item = benchmark.where("item_id = 0").collect()[0].text
    planted = [(i, f"{nasty.words(500 + i, 60)} {item} {nasty.words(600 + i, 60)}", "en", "s0") for i in (201, 202)]
    docs = nasty.docs(spark).unionByName(
        spark.createDataFrame(planted, "doc_id long, text string, lang string, source string"),
        allowMissingColumns=True)
    found, folder = [docs], tmp_path_factory.mktemp("stages")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, found[-1], SF).write.parquet(f"{folder}/{n}")
        found.append(spark.read.parquet(f"{folder}/{n}"))
    return found


def ids(df):
    return sorted(r.doc_id for r in df.collect() if r.doc_id is not None)


def test_columns(steps):
    for step in steps[1:-1]:
        assert step.columns == steps[0].columns


def test_filters_drop_junk_and_keep_the_rest(steps):
    quality, language = ids(steps[1]), ids(steps[2])
    assert {4, 5, 6, 7, 8, 40, 42, 43, 44}.isdisjoint(quality)
    assert {1, 2, 3, 9, 201, 202, *range(10, 30)} <= set(quality)
    assert set(language) == {i for i in quality if i != 41}


def test_one_of_each_group_stays(steps):
    rows = {r.doc_id: r.text for r in steps[2].collect() if r.doc_id is not None}
    order = sorted(rows)
    roots = brute_components([brute_fingerprint(rows[i]) for i in order])
    assert ids(steps[3]) == sorted({order[r] for r in roots})
    assert 2 not in ids(steps[3])


def test_leaks_go(steps):
    assert set(ids(steps[3])) - set(ids(steps[4])) == {201, 202}


def test_last_stage_encodes_all_that_is_left(steps):
    assert ids(steps[5]) == ids(steps[4])
    assert all(r.lossless and r.n_pieces == len(r.ids) > 0 for r in steps[5].collect())


def test_registered():
    assert queries()["pipeline"].__wrapped__ is corpus_pipeline.run
    assert ("pipeline" in oracle_sql()) == (corpus_pipeline.ORACLE_SQL is not None)
    assert [sum(name.startswith(f"op{n}_") for name in queries()) for n in range(1, 11)] == [1] * 10


def test_run_leaves_only_its_result(spark):
    def listed():
        folder = shared_folder(spark).removeprefix("file:")
        return {f"{name}/{part}" for name in os.listdir(folder) for part in os.listdir(f"{folder}/{name}")}

    before = listed()
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.lossless for r in rows)
    assert [name.partition("/")[2] for name in listed() - before] == ["stage_4"]


def test_empty_table(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nasty.empty(spark), SF).collect() == []
