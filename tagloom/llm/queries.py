"""The registered queries of this package: each applies an operator to its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.llm import chat, ngrams, tokenbin, warc
from tagloom.llm.centroids import clusters
from tagloom.llm.common import table
from tagloom.llm.decontaminate import contaminated
from tagloom.llm.langid import identify
from tagloom.llm.pieces import encode
from tagloom.llm.quality import quality
from tagloom.llm.simhash import near_duplicates
from tagloom.llm.suffixes import repeats
from tagloom.llm.webtext import extract
from tagloom.llm.whitening import whiten


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_web_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score(table(spark, sf_dir, "documents"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings of a common template."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = "</s>[INST] ok [/INST]"
    more = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', :t), (-7L, 1L, 'assistant', :t) "
                     "AS more (conv_id, turn, role, text)", {"t": hostile})
    return chat.round_trip(rows.unionByName(more))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"), k=16, rounds=3, size=64, scale=64)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation that does not fit a long is NULL here; the operator returns decimals."""
    return (whiten(table(spark, sf_dir, "embeddings"), count=4, scale=256)
            .withColumn("deviation", F.col("deviation").try_cast("long")))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"), length=400)


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_web_text": op2_web_text,
    "op3_quality": op3_quality,
    "op4_language": op4_language,
    "op5_lm_score": op5_lm_score,
    "op6_pieces": op6_pieces,
    "op7_simhash": op7_simhash,
    "op8_token_files": op8_token_files,
    "op9_chat": op9_chat,
    "op10_warc": op10_warc,
    "op11_centroids": op11_centroids,
    "op12_whitening": op12_whitening,
    "op13_repeats": op13_repeats,
}
