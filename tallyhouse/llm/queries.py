"""The registered queries of the operators, each over its whole tables with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import bpe, conversation_repair, decontamination, jaccard_join, langid, licenses, oracles, pii, quality, ranked_search, secret_scan, toxicity, vector_search, winnowing
from tallyhouse.llm.learning import fold
from tallyhouse.session import SQL_SETTINGS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# The others have no SQL form; tests/llm holds them against plain loops, a library or held-out labels.
ORACLES: dict[str, str] = {"op5_secrets": oracles.op5(), "op9_licenses": oracles.op9(), "op11_vector_search": oracles.op11(), "op12_ranked_search": oracles.op12(), "op13_conversation_repair": oracles.op13()}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def importable(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it (installed or shipped packages are found anyway), and get
    texts in small batches."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    # Rows sent to a worker at once: some megabytes of text, of which the worker and the executor hold several copies.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    # Those that results depend on; sizes and numbers of partitions are the caller's.
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled", "spark.sql.unionOutputPartitioning"):
        spark.conf.set(key, SQL_SETTINGS[key])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text; digests of ids and of the decoded text."""
    return bpe.digests(table(spark, sf_dir, "documents"), byte_vocabulary())


def _judged(scored: DataFrame, folds: int, held: int) -> DataFrame:
    """The columns that both label scores return; 0.3 and above is label 1."""
    return scored.withColumn("held_out", F.coalesce(fold("doc_id", folds) == held, F.lit(False))).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of every document; rows of fold 2 of 4 are never learned from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(fold("doc_id", 4) != 2))
    return _judged(toxicity.scores(docs, model), 4, 2).select("doc_id", "held_out", "score", "predicted")


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document; rows of fold 0 of 5 are never learned from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(fold("doc_id", 5) != 0))
    return _judged(quality.scores(docs, model), 5, 0).select("doc_id", "held_out", "score", "predicted", "rank_score")


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; rows of fold 2 of 4 are never learned from."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, docs.where(fold("doc_id", 4) != 2))
    found = langid.predict(docs, model).withColumn("held_out", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)))
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document. The counts and the digest are of the base spans; `spans` has the disguised ones too."""
    return pii.digests(table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold benchmark items, with the items."""
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of every document and of its edited text."""
    return winnowing.against_next(table(spark, sf_dir, "documents"))


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; a document is a repository, its source the owner. Counts and digest are of the base spans."""
    return secret_scan.scan(table(spark, sf_dir, "documents")).drop("text_key", "live_spans")


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near copies that every document is in."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"), runs=True)


@query
def op11_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest other vectors, by integer inner product, of every vector whose id is divisible by 50."""
    return vector_search.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return ranked_search.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))
