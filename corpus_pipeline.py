"""The corpus pipeline: quality, language, near-duplicates, decontamination, pieces.

Every stage works on the whole of what its predecessor kept.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagloom.llm.common import table
from tagloom.llm.decontaminate import clean_documents
from tagloom.llm.langid import in_a_language
from tagloom.llm.pieces import encode
from tagloom.llm.quality import kept_documents
from tagloom.llm.simhash import one_of_each
from tagloom.session import Scratch, scratch_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. A NULL text has no words and goes; NULL languages and sources are
    groups like any other; a measure that equals its bound is kept; repeated rows are judged alike and all stay or go."""
    return kept_documents(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score of at least one half. A NULL text, and one without a letter,
    has no language and goes; of equal sums the first language by name counts; repeated rows are judged alike."""
    return in_a_language(docs, min_score=0.5)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of 4-word shingles differ in 4 bits or fewer: that of the
    smallest id, rows without an id last, and of equal ids that of the smallest fingerprint. Texts that are NULL or
    have no word are one group. Of repeated rows one stays."""
    return one_of_each(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item with a rare run of words aligns with. A NULL or empty text aligns with
    nothing and stays; a score that equals the bound goes; repeated rows stay or go together."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of each document that is left, one row per row. A NULL text is empty and has none; of equally
    good segmentations that with the longest last piece is taken."""
    return encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", decontamination),
    ("sentencepiece", sentencepiece_ids),
]

# SQL has neither the fingerprints' hash nor alignment nor Viterbi: the rows are tested against
# brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written as Parquet and read again for the next. What a stage needed besides
    is deleted at its end, and its input after it."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for step, (_, stage) in enumerate(STAGES):
        with scratch_scope(spark):
            docs = scratch.save(stage(spark, docs, sf_dir), f"stage_{step}")
        scratch.drop(f"stage_{step - 1}")
    return docs
