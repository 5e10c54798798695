"""Writers: tables by overwrite (rebuilding clears what was there), partitioned exports, JSON-LD and report files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rebuild(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Writes a derived table in place of its last version; partitioned by the columns of `by`."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).parquet(path)


def combined_graph(nodes: DataFrame) -> DataFrame:
    """All nodes, the first by (file_name, pos) of every identifier."""
    first = nodes.groupBy("iri").agg(F.min(F.struct("file_name", "pos")).alias("_k"))
    return nodes.join(first.select(F.col("iri").alias("_i"), "_k"), (F.col("iri") == F.col("_i")) & (F.struct("file_name", "pos") == F.col("_k"))).drop("_i", "_k")


def last_part(chains: DataFrame, slug: str = "slug") -> DataFrame:
    """One chain per base slug for an export with a file each: that of the last part, as its file overwrites the others'."""
    from ..functions import text as T
    from ..operators.dedupe import keep_last

    return keep_last(chains.withColumn("base_slug", T.base_slug(F.col(slug))), ["base_slug"], [slug])


def reference(iris: Column) -> Column:
    """Identifiers as JSON-LD values: none, one object, or a list of objects, as JSON text."""
    objects = F.transform(iris, lambda x: F.struct(x.alias("@id")))
    return F.when(F.size(iris) == 1, F.to_json(F.get(objects, F.lit(0)))).when(F.size(iris) > 1, F.to_json(objects))


def jsonld_lines(df: DataFrame, iri: str, types: str, properties: dict[str, str]) -> DataFrame:
    """A JSON-LD node per row as text: {column: property}; arrays are identifiers, dates become typed literals."""
    kinds = dict(df.dtypes)

    def member(column: str, name: str) -> Column:
        c = F.col(column)
        if kinds[column].startswith("array"):
            value = reference(c)
        elif kinds[column] == "date":
            value = F.to_json(F.struct(F.date_format(c, "yyyy-MM-dd").alias("@value"), F.lit("xsd:date").alias("@type")))
        elif kinds[column] in ("int", "bigint", "boolean", "double"):
            value = c.cast("string")
        else:
            value = F.regexp_extract(F.to_json(F.struct(c.alias("x"))), r'^\{"x":(.*)\}$', 1)
        return F.when(c.isNotNull() & value.isNotNull() & (value != ""), F.concat(F.lit(f'"{name}":'), value))

    head = F.concat(F.lit('"@id":"'), F.col(iri), F.lit('","@type":'), F.to_json(F.col(types)))
    return df.select(F.concat(F.lit("{"), F.concat_ws(",", head, *(member(c, n) for c, n in properties.items())), F.lit("}")).alias("value"))


def pretty(df: DataFrame) -> DataFrame:
    """Every row as indented JSON text, signs beyond ASCII as they are: an export for people to read."""
    return df.select(F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("value"))


def report(df: DataFrame, path: str) -> None:
    """A small report as JSON lines in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def markdown(df: DataFrame) -> str:
    """A report table as Markdown. Reports are top-k lists or counts per class; the text is built on the driver."""
    rows = df.collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else ", ".join(map(str, v)) if isinstance(v, list) else str(v) for v in r) + " |" for r in rows]) + "\n"
