"""A corpus pipeline of the training-data operators: language, near duplicates, repeated passages, benchmark leaks, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import jaccard, langid, queries, spans, tiling
from tessera.llm.common import broadcast_if_small, scoped, unstaged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: texts that are null or have no letter, and predictions below 0.5.

    The model learns from the labelled rows of docs outside the held-out fold. No labelled row: nothing is predicted, so all go.
    """
    model = langid.fit(docs.filter(queries.fold("doc_id", 5) != 0), order="doc_id")
    return langid.predict(docs, model).filter((F.col("lang_pred") != "und") & (F.col("score") >= 0.5)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates: that with the smallest doc_id, then text digest.

    Ids may be null or stand for several texts, so a document is its doc_id and text. Rows that repeat both are one: the least
    in lang, source, n_chars stays.
    """
    classes = jaccard.join(docs.select("doc_id", "text"))
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("class_digest"))
    keep = classes.filter(first).select(F.col("doc_id").alias("kept"), F.col("digest").alias("kept_digest")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("kept")) & (jaccard.text_digest(F.col("text")) == F.col("kept_digest"))
    left = docs.join(broadcast_if_small(keep), same, "left_semi").select(*COLUMNS)
    # Texts are shuffled by id only where an id does occur more than once.
    if docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return left
    least = F.min(F.struct("lang", "source", "n_chars", "text")).alias("row")
    return left.groupBy("doc_id", jaccard.text_digest(F.col("text"))).agg(least).select("doc_id", "row.*").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages that an earlier document (or place) has; a document without a word left goes. n_chars follows."""
    cut = spans.dedup(docs).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"\S")).select(*COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item."""
    bad = tiling.leaks(docs, queries.table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("bad")).distinct()
    return docs.join(broadcast_if_small(bad), F.col("doc_id").eqNullSafe(F.col("bad")), "left_anti").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left and decodes it: doc_id, n_tokens and the digests of ids and decoded text."""
    return queries.bpe_digests(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("tokens", tokens),
]
#: Neither the language model nor the tokenizer is SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again; what a stage staged, and its input, is deleted after it."""
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with scoped(spark) as scope:
            done = scope.keep(stage(spark, docs, sf_dir))
        unstaged(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
