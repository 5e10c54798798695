"""A training corpus from raw documents: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexgraph.llm import decontaminate, lines, minhash, mixing, toxicity
from lexgraph.llm.common import keep_rows, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the toxicity model, learnt from the labels with crc32(doc_id) mod 5 not 0, finds toxic.

    Null and empty texts have no evidence and stay; rows without an id and repeated rows are judged one by one; texts are
    read whole. An empty table stays empty, and without labels of both classes nothing is rejected.
    """
    labels = table(spark, sf_dir, "labels").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
    model = toxicity.train(docs, labels, "toxic")
    scorer: list = []

    def clean(batch):
        if not scorer:
            scorer.append(model.scorer())
        x = [scorer[0](t or "")[0] for t in batch.column("text").to_pylist()]
        return list(model.probability(x) < 0.5)

    return keep_rows(docs, clean)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes every line out that nearly repeats an earlier one, in order of doc_id and line; all rows stay.

    Null texts stay null, rows without an id are left as they are, and rows that repeat an id lose the same lines.
    """
    return lines.clean(docs, percent=80, least=5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group (five-word shingles, similarity 0.8), the smallest doc_id.

    Null and empty texts are near to nothing and stay, as do rows without an id. Rows that repeat an id are judged by their
    own texts.
    """
    return minhash.one_of_each(docs, k=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage; null and empty texts and rows without an id are treated alike."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as are left, drawn at 0.98 of the greatest entropy of sources; a document has a row per epoch.

    Two columns follow, n_tokens and epoch; columns of these names give way to them. Texts without words are not drawn.
    """
    docs = docs.drop("n_tokens", "epoch")
    drawn = mixing.mix(docs, budget=1.0, entropy=0.98, max_epochs=4.0).select("doc_id", "source", "n_tokens", "epoch")
    rows = docs.select("doc_id", F.struct(*docs.columns).alias("row"))
    if not docs.groupBy("doc_id").count().where("doc_id is null or count > 1").limit(1).count():
        return rows.join(drawn.select("doc_id", "n_tokens", "epoch"), "doc_id").select("row.*", "n_tokens", "epoch")
    # rows without an id or with a repeated one are drawn one by one: those of equal id, source and tokens are numbered
    keys = ["doc_id", "source", "n_tokens"]
    rows = rows.withColumns({"source": F.col("row.source"), "n_tokens": mixing.token_count(F.col("row.text"))})
    rows = rows.withColumn("n", F.row_number().over(W.partitionBy(*keys).orderBy(F.xxhash64("row.text"), "row.text"))).alias("a")
    drawn = drawn.withColumn("n", F.row_number().over(W.partitionBy(*keys, "epoch").orderBy("epoch"))).alias("b")
    same = F.col("a.n") == F.col("b.n")
    for c in keys:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return rows.join(drawn, same).select("a.row.*", "a.n_tokens", "b.epoch")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The toxicity model and the register search have no SQL; tests compare run() with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
