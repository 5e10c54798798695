"""A migration of identifiers as one run over tables: preview, refusal on collisions, rename, verification."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repair import rename_edges, residue
from .resolve import collisions, rename_map


class Refused(ValueError):
    """Several old identifiers would become one."""


@dataclass(frozen=True)
class Preview:
    renames: DataFrame
    collisions: DataFrame
    per_file: DataFrame


def preview(nodes: DataFrame, mentions: DataFrame, registry: DataFrame, prefix: str) -> Preview:
    """What a migration would change: the rename map, new identifiers that clash, and occurrences per file.

    nodes: iri; mentions: file_name, iri, n; registry: slug, abbrev, old_prefix."""
    iris = nodes.select("iri").unionByName(mentions.select("iri")).distinct()
    renames = rename_map(iris, registry, prefix)
    per_file = mentions.join(renames, "iri").groupBy("file_name").agg(F.sum("n").alias("n"))
    return Preview(renames, collisions(renames, nodes), per_file)


def apply(nodes: DataFrame, edges: DataFrame, registry: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame]:
    """Renamed nodes and edges; refuses if identifiers would clash, so that nothing is written half."""
    ends = edges.select(F.col("src").alias("iri")).unionByName(edges.select(F.col("dst").alias("iri")))
    renames = rename_map(nodes.select("iri").unionByName(ends).distinct(), registry, prefix)
    clash = collisions(renames, nodes).orderBy("new_iri").limit(5).collect()
    if clash:
        raise Refused("several identifiers would become " + ", ".join(r.new_iri for r in clash))
    renamed = nodes.join(renames, "iri", "left").withColumn("iri", F.coalesce("new_iri", "iri")).select(*nodes.columns)
    return renamed, rename_edges(edges, renames)


def leftovers(nodes: DataFrame, edges: DataFrame, registry: DataFrame, prefix: str) -> DataFrame:
    """Identifiers that a migration should have changed and that are still in use; empty after a complete run."""
    iris = nodes.select("iri").unionByName(edges.select(F.col("src").alias("iri"))).unionByName(edges.select(F.col("dst").alias("iri"))).distinct()
    return residue(iris, rename_map(iris, registry, prefix))


def namespace(raw: DataFrame, old: str, new: str, column: str = "value") -> DataFrame:
    """Texts with one namespace in place of another, in keys and values alike, before they are parsed."""
    return raw.withColumn(column, F.replace(column, F.lit(old), F.lit(new)))
