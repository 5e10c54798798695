"""Duplicate identifiers and migrations: detection, remapping in a file and across files, verification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .dedupe import suffix_collisions, unique_prefixes


def duplicate_ids(nodes: DataFrame, shared: list[str] | None = None) -> DataFrame:
    """Identifiers of more than one file with the sorted list of files; `shared` ones (ontology classes) are fine."""
    out = nodes.groupBy("iri").agg(F.array_sort(F.collect_set("file_name")).alias("files")).where(F.size("files") > 1)
    return out.where(~F.col("iri").isin(*shared)) if shared else out


def within_file(nodes: DataFrame) -> DataFrame:
    """Second and later rows of an id in one file get _dup2, _dup3..."""
    key = nodes.withColumn("_k", F.concat_ws("\x01", "file_name", "iri"))
    fixed = suffix_collisions(key, "_k", ["pos"], "_dup")
    return fixed.withColumn("iri", F.substring_index("_k", "\x01", -1)).drop("_k")


def remap_table(duplicates: DataFrame, prefix: str) -> DataFrame:
    """file_name, iri, new_iri for identifiers that several files use.

    Parts of one act put their part number into the identifier; files of different acts get the shortest distinct
    prefix of their name. Provisions, clusters, maps and classes are rewritten; other identifiers stay.
    """
    d = duplicates.withColumn("bases", F.array_distinct(F.transform("files", lambda f: F.regexp_replace(F.replace(f, F.lit("_peep.json"), F.lit("")), r"_osa\d+(-\d+)?$", ""))))
    rows = d.select("iri", F.size("bases").alias("n_laws"), F.explode("files").alias("file_name")).withColumn("slug", F.replace("file_name", F.lit("_peep.json"), F.lit("")))
    part = F.nullif(F.regexp_extract("file_name", r"_osa(\d+(?:-\d+)?)", 1), F.lit(""))
    head, tail = T.provision_prefix(F.col("iri")), F.expr("substring(iri, length(substring_index(iri, '_Par_', 1)) + 6)")
    is_par, is_cluster = F.col("iri").contains("_Par_"), F.col("iri").startswith(f"{prefix}:Cluster_")
    same = F.when(part.isNull() | F.col("iri").contains(F.concat(F.lit("osa"), part)), F.col("iri")).when(is_par, F.concat(head, F.lit("_Osa"), part, F.lit("_Par_"), tail)).when(
        is_cluster, F.replace("iri", F.lit(f"{prefix}:Cluster_"), F.concat(F.lit(f"{prefix}:Cluster_Osa"), part, F.lit("_")))).otherwise(F.col("iri"))
    names = unique_prefixes(rows.where("n_laws > 1").select("slug"))
    rows = rows.join(names, "slug", "left")
    own = F.expr(f"substring(iri, {len(prefix) + 10})")
    other = (
        F.when(is_par, F.concat(F.lit(f"{prefix}:"), F.col("prefix"), F.lit("_Par_"), tail)).when(F.col("iri").contains("_Map_2026"), F.concat(F.lit(f"{prefix}:"), F.col("prefix"), F.lit("_Map_2026")))
        .when(is_cluster, F.concat(F.lit(f"{prefix}:Cluster_"), F.col("prefix"), F.lit("_"), own)).when(F.col("iri").startswith(f"{prefix}:LegalProvision_"), F.concat(F.lit(f"{prefix}:LegalProvision_"), F.col("prefix"))).otherwise(F.col("iri"))
    )
    out = rows.select("file_name", "iri", F.when(F.col("n_laws") == 1, same).otherwise(other).alias("new_iri"))
    return out.where("iri <> new_iri")


def apply_to_nodes(nodes: DataFrame, remap: DataFrame) -> DataFrame:
    """Renames ids in the files that the remap names."""
    r = remap.select("file_name", "iri", F.col("new_iri").alias("_n"))
    return nodes.join(r, ["file_name", "iri"], "left").withColumn("iri", F.coalesce("_n", "iri")).drop("_n").select(*nodes.columns)


def apply_to_edges(edges: DataFrame, remap: DataFrame) -> DataFrame:
    """Renames both ends of links: by the file's own remap, else by that of the id's home (its last remapped file) if
    that is another file."""
    own = remap.select("file_name", F.col("iri").alias("_i"), F.col("new_iri").alias("_own"))
    home = remap.groupBy("iri").agg(F.max_by(F.struct("file_name", "new_iri"), "file_name").alias("_h"))
    out = edges
    for end in ("src", "dst"):
        out = out.join(own.withColumnRenamed("file_name", "_f"), (F.col("file_name") == F.col("_f")) & (F.col(end) == F.col("_i")), "left")
        if end == "dst":
            out = out.join(home, F.col("dst") == F.col("iri"), "left")
            out = out.withColumn("dst", F.coalesce("_own", F.when(F.col("_h.file_name") != F.col("file_name"), F.col("_h.new_iri")), "dst")).drop("iri", "_h")
        else:
            out = out.withColumn("src", F.coalesce("_own", "src"))
        out = out.drop("_f", "_i", "_own")
    return out.select(*edges.columns)


def rename_edges(edges: DataFrame, renames: DataFrame) -> DataFrame:
    """Applies a migration's rename map to both ends."""
    out = edges
    for end in ("src", "dst"):
        r = renames.select(F.col("iri").alias(end), F.col("new_iri").alias("_n"))
        out = out.join(r, end, "left").withColumn(end, F.coalesce("_n", end)).drop("_n")
    return out.select(*edges.columns)


def residue(iris: DataFrame, renames: DataFrame) -> DataFrame:
    """Old identifiers that are still in use after a migration."""
    return iris.select("iri").distinct().join(renames.select("iri"), "iri", "left_semi")


def abbreviation_registry(laws: DataFrame, official: DataFrame, short: int = 12) -> DataFrame:
    """slug, abbrev, source, title, old_prefix. laws: slug, title, prefix; official: slug, abbrev (may be empty).

    Official names first, existing prefixes of at most `short` signs next, else a derived acronym; equal names are
    numbered in slug order.
    """
    j = laws.join(official.select("slug", F.nullif("abbrev", F.lit("")).alias("_a")), "slug", "left")
    kept = F.when(F.length("prefix") <= short, F.col("prefix"))
    j = j.withColumn("abbrev", F.coalesce("_a", kept, T.acronym(F.col("title"), F.col("slug")))).withColumn("source", F.when(F.col("_a").isNotNull(), "official").when(kept.isNotNull(), "existing").otherwise("auto"))
    return suffix_collisions(j, "abbrev", ["slug"]).select("slug", "abbrev", "source", "title", F.col("prefix").alias("old_prefix"))


def assign_prefixes(laws: list[dict], registry: dict[str, str], most: int = 10_000) -> dict[str, str]:
    """slug -> prefix, in the given order: the registry's, an abbreviation over three signs, the slug at 40 to 80 signs,
    then numbered. Each choice depends on all before it, so this runs on the driver, over a registry of acts of at most
    `most` rows (else it refuses)."""
    if len(laws) > most:
        raise ValueError(f"{len(laws)} acts; a registry of at most {most} is expected")
    taken, out = set(registry.values()), dict(registry)
    for law in laws:
        slug, short = law["slug"], law.get("abbrev") or ""
        if slug in out:
            continue
        tries = [short] * (len(short) > 3) + [slug[:n].rstrip("_") for n in (40, 50, 60, 70, 80)]
        name = next((x for x in tries if x not in taken), None)
        n = 2
        while name is None or name in taken:
            name, n = f"{slug[:80]}_{n}", n + 1
        taken.add(name)
        out[slug] = name
    return out


def repair(nodes: DataFrame, edges: DataFrame, prefix: str, shared: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, duplicates left) after the whole sequence: in-file numbering, remap, links, verification."""
    fixed = within_file(nodes)
    remap = remap_table(duplicate_ids(fixed, shared), prefix)
    done = apply_to_nodes(fixed, remap)
    return done, apply_to_edges(edges, remap), duplicate_ids(done, shared)
