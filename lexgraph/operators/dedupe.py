"""Window-like operators: keep first or last, numbering of collisions, top-k per group, priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def _rank(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in order. Spark stops each group after one row before it shuffles."""
    return _rank(df, keys, order).where("_rn = 1").drop("_rn")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return keep_first(df, keys, [F.desc(c) for c in order])


def suffix_collisions(df: DataFrame, iri: str, order: list, mark: str = "_") -> DataFrame:
    """The 2nd, 3rd... row of an id gets `mark` and its number appended."""
    out = _rank(df, [iri], order)
    return out.withColumn(iri, F.when(F.col("_rn") > 1, F.concat(F.col(iri), F.lit(mark), F.col("_rn").cast("string"))).otherwise(F.col(iri))).drop("_rn")


def suffix_seen(df: DataFrame, group: list[str], iri: str, order: list) -> DataFrame:
    """A repeated id of a group gets the number of rows that came before it in the group."""
    seen = F.row_number().over(W.partitionBy(*group).orderBy(*order)) - 1
    out = df.withColumn("_seen", seen).withColumn("_rn", F.row_number().over(W.partitionBy(*group, iri).orderBy(*order)))
    return out.withColumn(iri, F.when(F.col("_rn") > 1, F.concat_ws("_", iri, F.col("_seen").cast("string"))).otherwise(F.col(iri))).drop("_seen", "_rn")


def suffix_attribute(df: DataFrame, iri: str, order: list, attribute: Column) -> DataFrame:
    """Later rows of an id get an attribute of theirs appended."""
    out = _rank(df, [iri], order)
    return out.withColumn(iri, F.when(F.col("_rn") > 1, F.concat_ws("_", F.col(iri), attribute)).otherwise(F.col(iri))).drop("_rn")


def suffix_or_drop(df: DataFrame, iri: str, order: list, attribute: Column) -> DataFrame:
    """A second row of an id gets an attribute appended; if that id is taken as well, the row goes."""
    return keep_first(suffix_attribute(df.withColumn("_o", F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])), iri, order, attribute), [iri], ["_o"]).drop("_o")


def top_k(df: DataFrame, keys: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def number_within(df: DataFrame, keys: list[str], order: list, name: str = "idx") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def first_by(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Per key the value of the row with the least order; nulls in order come last. One aggregation with partial sums."""
    return df.groupBy(*keys).agg(F.min_by(value, order).alias(value))


def capped_list(df: DataFrame, keys: list[str], value: str, order: list[str], cap: int, name: str) -> DataFrame:
    """The first `cap` values per key as an array; only that many rows of a group are gathered."""
    kept = top_k(df, keys, order, cap, "_r")
    return kept.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", value))), lambda x: x[value]).alias(name))


def unique_prefixes(files: DataFrame, slug: str = "slug", lengths: tuple[int, ...] = (50, 60, 70, 80)) -> DataFrame:
    """slug, prefix: the shortest of the lengths at which a file's identifier differs from all others, else all of it."""
    from ..functions.text import sanitize_id

    full = sanitize_id(F.col(slug), " -", cut=80)
    out = files.select(slug).distinct()
    for n in lengths:
        c = sanitize_id(F.left(slug, F.lit(n)), " -", cut=80)
        out = out.withColumn(f"_c{n}", c).withColumn(f"_n{n}", F.count("*").over(W.partitionBy(f"_c{n}")))
    return out.select(slug, F.coalesce(*(F.when(F.col(f"_n{n}") == 1, F.col(f"_c{n}")) for n in lengths), full).alias("prefix"))
