"""The stages that turn `documents` into training tokens, in order; each works on what the one before kept.

Toxic documents go; of each group of near copies the document of least id stays; documents that hold a benchmark item go; live
secrets are masked; the texts that remain are encoded. NULL and empty texts pass every stage and end with no tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import bpe, decontamination, jaccard_join, secret_scan, toxicity
from tallyhouse.llm.learning import fold
from tallyhouse.llm.queries import byte_vocabulary, importable, table
from tallyhouse.session import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score doesn't reject (6); fold 2 of 4 is never learned from."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2)
    return toxicity.reject(docs, toxicity.train(docs, labels))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (7)."""
    importable(spark)
    return jaccard_join.deduplicate(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items (2)."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live secrets masked (5)."""
    return secret_scan.redact(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining texts as token ids, by count and digest (1)."""
    importable(spark)
    return bpe.digests(docs, byte_vocabulary())


STAGES: list[tuple[str, Stage]] = [("toxicity", harmless), ("jaccard_join", distinct), ("decontamination", unleaked), ("secrets", masked), ("bpe", tokens)]
# A learned score and merge rounds have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from the documents on, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
