"""A corpus from documents to packed sequences: each stage works on what the one before it kept, written and read again.

Stages take (spark, docs, sf_dir); all but the last return the columns of documents. Null, empty and wordless texts go with the first
stage, very long ones are read whole, an empty table gives an empty one. Names beginning with an underscore are reserved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnstat.llm import langid, linededup, neardup, packing, passages
from cairnstat.llm.common import SPACES, cut, row_id, table, text_hash, tokenizer_path

#: A document whose spans agree on one language in less than this share of its letters is rejected.
LEAST_SCORE = 0.5


def _words_left(text: str):
    return F.length(F.translate(F.coalesce(F.col(text), F.lit("")), SPACES, "")) > 0


def _recount(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters or without a main language go."""
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    judged = langid.label(docs, model, lang_as="_lang_pred", score_as="_score")
    return judged.filter((F.col("_lang_pred") != "und") & (F.col("_score") >= LEAST_SCORE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that came earlier; those of which nothing is left go."""
    return _recount(linededup.dedup_lines(docs)).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and one of rows that repeat doc_id and text. Rows with a null doc_id are near to nothing."""
    kept = cut(neardup.near_groups(docs).filter("first").select(row_id("doc_id").alias("_id"), F.col("th").alias("_th")).distinct(), "kept")
    own = docs.withColumns({"_id": row_id("doc_id"), "_th": text_hash("text")}).dropDuplicates(["_id", "_th"])
    return own.join(kept.hint("merge"), ["_id", "_th"], "left_semi").select(*docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 400 bytes or of 50 words that stand elsewhere too; those of which nothing is left go."""
    return _recount(passages.remove_passages(docs, words=passages.WORDS)).filter(_words_left("text")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and offset."""
    return packing.pack(cut(packing.pieces_of(docs, tokenizer_path("word_bpe_49k.json"), 1), "pieces"))


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("MinHash near-dedup", near),
    ("suffix-array dedup", repeats),
    ("best-fit packing", packed),
]

#: Models, signatures and tokens are not for SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"stage-{k}")
    return docs
