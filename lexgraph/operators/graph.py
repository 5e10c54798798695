"""Edges: explosion, inversion, symmetry, closure of classes, adjacency, degrees, graph-pattern helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_edges(nodes: DataFrame, iri: str, predicates: dict[str, str]) -> DataFrame:
    """src, pred, dst, ord from array columns of a typed table: {column: predicate}."""
    out = None
    for column, predicate in predicates.items():
        e = nodes.select(F.col(iri).alias("src"), F.lit(predicate).alias("pred"), F.posexplode(column).alias("ord", "dst")).where("dst is not null")
        out = e if out is None else out.unionByName(e)
    return out.select("src", "pred", "dst", "ord")


def invert(edges: DataFrame, predicate: str) -> DataFrame:
    """The materialised inverse of an edge list, every link once."""
    return edges.where("src is not null and dst is not null").select(F.col("dst").alias("src"), F.lit(predicate).alias("pred"), F.col("src").alias("dst")).distinct()


def symmetry_issues(forward: DataFrame, backward: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links whose target does not exist, and links without their inverse: src, dst, issue."""
    f, b = forward.select("src", "dst").distinct(), backward.select(F.col("src").alias("dst"), F.col("dst").alias("src")).distinct()
    known = nodes.select(F.col("iri").alias("dst")).distinct()
    missing = f.join(known, "dst", "left_anti").withColumn("issue", F.lit("missing target"))
    one_way = f.join(known, "dst", "left_semi").join(b, ["src", "dst"], "left_anti").withColumn("issue", F.lit("no inverse"))
    orphan = b.join(f, ["src", "dst"], "left_anti").withColumn("issue", F.lit("no forward"))
    return missing.select("src", "dst", "issue").unionByName(one_way.select("src", "dst", "issue")).unionByName(orphan.select("src", "dst", "issue"))


def mutual(edges: DataFrame, forward: str, backward: str) -> DataFrame:
    """Pairs linked both ways by the two predicates."""
    f = edges.where(F.col("pred") == forward).select("src", "dst")
    b = edges.where(F.col("pred") == backward).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return f.join(b, ["src", "dst"], "left_semi").distinct()


def in_degree(edges: DataFrame, top: int | None = None) -> DataFrame:
    """dst and its number of links (repeated ones count), the largest first, ties by name."""
    out = edges.groupBy("dst").agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), "dst").limit(top) if top else out


def adjacency(edges: DataFrame) -> DataFrame:
    """dst and the ordered distinct list of its sources. edges: src, dst, ord."""
    first = edges.groupBy("dst", "src").agg(F.min("ord").alias("ord"))
    return first.groupBy("dst").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "src"))), lambda x: x.src).alias("sources"))


def subclass_closure(parents: DataFrame, depth: int = 1) -> DataFrame:
    """cls, ancestor, distance up to `depth`, each class its own ancestor at 0; shortest way. parents: cls, parent."""
    base = parents.where("cls is not null and parent is not null").select("cls", "parent").distinct()
    every = base.select("cls").union(base.select("parent")).distinct()
    out = step = every.select("cls", F.col("cls").alias("ancestor"), F.lit(0).alias("distance"))
    up = base.select(F.col("cls").alias("ancestor"), F.col("parent").alias("next"))
    for d in range(1, depth + 1):
        step = step.join(up, "ancestor").select("cls", F.col("next").alias("ancestor"), F.lit(d).alias("distance"))
        out = out.unionByName(step)
    return out.groupBy("cls", "ancestor").agg(F.min("distance").alias("distance"))


def of_class(nodes: DataFrame, closure: DataFrame, cls: str) -> DataFrame:
    """Nodes of a class or of one that descends from it. nodes: iri, types."""
    wanted = closure.where(F.col("ancestor") == cls).select(F.col("cls").alias("_t")).union(nodes.sparkSession.createDataFrame([(cls,)], "_t string")).distinct()
    typed = nodes.select("iri", F.explode("types").alias("_t")).join(wanted, "_t", "left_semi").select("iri").distinct()
    return nodes.join(typed, "iri", "left_semi")


def existing_minus(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Links to keep when new ones are merged: those not among the new."""
    return existing.join(new, existing.columns, "left_anti")


def merge_append(existing: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Existing values first, then new ones not present yet, in order: key and an array."""
    both = existing.select(key, value, F.lit(0).alias("_s"), "ord").unionByName(new.select(key, value, F.lit(1).alias("_s"), "ord"))
    first = both.groupBy(key, value).agg(F.min(F.struct("_s", "ord")).alias("_o"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", value))), lambda x: x[value]).alias(value))


def attach(nodes: DataFrame, edges: DataFrame, iri: str, name: str) -> DataFrame:
    """Nodes with the array of their links as a column: enrichment as a join, and rebuilding as an overwrite."""
    lists = edges.groupBy("src").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "dst"))), lambda x: x.dst).alias(name))
    base = nodes.drop(name) if name in nodes.columns else nodes
    return base.join(lists, F.col(iri) == F.col("src"), "left").drop("src")
