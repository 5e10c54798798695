"""The queries of the training-data operators, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import backoff, decontaminate, embeddings, lines, minhash, mixing, quality, repeats, secrets, sql, toxicity
from .common import table


def _remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every overlap of a document with a benchmark item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(_remainder(3) != 1), "quality")
    out = quality.score(docs, model)
    return out.select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", "predicted")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(_remainder(5) != 0), "toxic")
    out = toxicity.score(docs, model)
    return out.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", "predicted", "restored")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed stream over all documents: as many tokens as there are, at 0.98 of the greatest entropy."""
    return mixing.mix(table(spark, sf_dir, "documents"), budget=1.0, entropy=0.98, max_epochs=4.0).select("doc_id", "source", "n_tokens", "epoch")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"), percent=80, least=5)


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op9_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = backoff.score(table(spark, sf_dir, "documents"), order=3, alpha=0.4)
    return out.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("per_word", 6).alias("per_word"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_repeats": op5_repeats,
    "op6_lines": op6_lines,
    "op7_embeddings": op7_embeddings,
    "op8_secrets": op8_secrets,
    "op9_backoff": op9_backoff,
    "op10_near_duplicates": op10_near_duplicates,
}
SQL: dict[str, str] = {
    "op4_mixing": sql.MIXING,
    "op6_lines": sql.LINES,
    "op7_embeddings": sql.VECTORS,
    "op9_backoff": sql.BACKOFF,
    "op10_near_duplicates": sql.NEAR,
}
