"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, or else the one set on the context. Without either, a temporary folder
    serves on one machine only; on a cluster that is an error, as executors would not see each other's files."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="lexgraph-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def release(spark: SparkSession) -> None:
    """Lets the driver's collector run, which is what makes Spark delete the shuffle files of finished jobs.

    The listeners' queues hold the last event, and so the plan of the last query, until another comes: a tiny query takes
    its place, and the queues are waited for (a minute at most)."""
    spark.range(1).collect()
    with contextlib.suppress(Py4JJavaError):
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """Cuts the lineage through a columnar table in the shared checkpoint folder, removed when the driver ends."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/lexgraph-{uuid.uuid4().hex}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    df.write.parquet(path.toString())
    release(spark)
    return spark.read.schema(df.schema).parquet(path.toString())


def unstored(df: DataFrame) -> None:
    """Removes the table that `stored` gave, once nothing reads it any more."""
    jvm = df.sparkSession.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).getParent()
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
