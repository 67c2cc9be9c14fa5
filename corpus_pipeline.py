"""From raw documents to token ids: five stages, each one of the training-data operators.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that
is written and read again as the next one's docs. All but the last return the columns of ``documents``.
No SQL counterpart: the classifier and the encoder cannot be written in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import bpe, decontaminate, jaccard_join, line_dedup, quality_mil
from millrace.llm.common import words_of
from millrace.llm.queries import fold, table, vocabulary
from millrace.workspace import temporary_copies

ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from two folds of three of the labels."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    # The labelled documents are looked up in the source table, so the model does not hang on ``docs``.
    model = quality_mil.train(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return docs.where(quality_mil.score_column(model, F.col("text")) >= 0.5)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites (long ones: on three) go but once; documents that thereby lose all their words go too."""
    rest = line_dedup.remove_boilerplate(docs, removed="_n_removed", by_length=True)
    left = rest.where((F.col("_n_removed") == 0) | (F.size(words_of(F.col("text"))) > 0))
    changed = F.when(F.col("_n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", changed).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.drop_similar(docs)


def drop_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding them gives its text."""
    encoded = bpe.encode_and_decode(docs, vocabulary())
    same = F.col("decoded_text") == F.coalesce("text", F.lit(""))
    return encoded.select(
        "doc_id", "lang", "source", "n_chars", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"),
        same.alias("round_trip"),
    )


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", drop_copies),
    ("benchmark_decontamination", drop_tests),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents. What a stage writes on its way goes when its rows are written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with temporary_copies(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
