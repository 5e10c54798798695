"""Extension: documents that land are folded into layer tables as they come. The sources themselves know no streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract as X


def documents(spark: SparkSession, path: str) -> DataFrame:
    """A stream of landed text files: file_name, text, landed."""
    return spark.readStream.format("text").option("wholetext", True).load(path).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"), F.col("_metadata.file_modification_time").alias("landed"))


def citation_counts(stream: DataFrame, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Citations per law and landing window, with a watermark for late files."""
    cites = X.citations(stream.withWatermark("landed", late), self_references=False)
    return cites.groupBy(F.window("landed", window), "law_ref").agg(F.sum(F.size("paragraphs")).alias("n"))


def rebuild_on_landing(stream: DataFrame, rebuild: Callable[[DataFrame], None], checkpoint: str):
    """Calls rebuild(batch) for every batch of landed documents; restarts go on from the checkpoint."""
    return stream.writeStream.foreachBatch(lambda df, _: rebuild(df)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
