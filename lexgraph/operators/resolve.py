"""Key resolution: citations, aliases, tiered fuzzy lookups, renames by longest prefix, date and chain joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as T
from .dedupe import keep_first, keep_last


def provision_index(provisions: DataFrame) -> DataFrame:
    """prefix, par_key, iri: every provision under the first prefix of its file; of equal keys the last row wins.

    provisions: file_name, pos, iri.
    """
    p = provisions.select("file_name", "pos", "iri", T.provision_prefix(F.col("iri")).alias("own"), T.provision_key(F.col("iri")).alias("par_key"))
    p = p.withColumn("prefix", F.first("own").over(W.partitionBy("file_name").orderBy("pos")))
    return keep_last(p, ["prefix", "par_key"], ["file_name", "pos"]).select("prefix", "par_key", "iri")


def act_prefixes(provisions: DataFrame) -> DataFrame:
    """source_act, prefix: from the first provision of each file only; the last file of an act wins; empty acts give nothing."""
    first = keep_first(provisions, ["file_name"], ["pos"]).where(F.coalesce("source_act", F.lit("")) != "")
    return keep_last(first.withColumn("prefix", T.provision_prefix(F.col("iri"))), ["source_act"], ["file_name"]).select("source_act", "prefix")


def resolve_citations(cites: DataFrame, index: DataFrame, abbreviations: DataFrame, own_prefix: str = "own_prefix", source: str = "iri") -> DataFrame:
    """Distinct links (source, dst) of citations with existing provisions, self-links left out.

    cites: extract.citations with columns `source` and `own_prefix`; abbreviations: law_ref, prefix. A paragraph is
    looked up as written, then without leading zeros.
    """
    c = cites.join(abbreviations.select("law_ref", F.col("prefix").alias("_p")), "law_ref", "left")
    c = c.withColumn("prefix", F.when(F.col("is_self"), F.col(own_prefix)).otherwise(F.col("_p")))
    c = c.select(source, "prefix", "pattern", "ord", F.posexplode("paragraphs").alias("n", "par")).where("prefix is not null")
    exact = index.select(F.col("prefix"), F.col("par_key").alias("par"), F.col("iri").alias("d1"))
    loose = index.select(F.col("prefix"), F.col("par_key").alias("bare"), F.col("iri").alias("d2"))
    hit = c.withColumn("bare", T.strip_zeros(F.col("par"))).join(exact, ["prefix", "par"], "left").join(loose, ["prefix", "bare"], "left")
    hit = hit.select(F.col(source).alias("src"), F.coalesce("d1", "d2").alias("dst"), "pattern", "ord", "n").where("dst is not null and src <> dst")
    return keep_first(hit, ["src", "dst"], ["pattern", "ord", "n"])


def resolve_aliases(edges: DataFrame, nodes: DataFrame, aliases: DataFrame) -> DataFrame:
    """edges with column target: dst if it exists, else the first alias (by priority) that has the paragraph, else null.

    edges: src, dst; nodes: iri; aliases: alias, canonical, priority (prefixes).
    """
    known = nodes.select(F.col("iri").alias("_k")).distinct()
    e = edges.join(known, F.col("dst") == F.col("_k"), "left").withColumn("_direct", F.col("_k")).drop("_k")
    missing = e.where("_direct is null").select("dst").distinct().withColumn("alias", T.provision_prefix(F.col("dst"))).withColumn("_par", F.substring(F.col("dst"), F.length("alias") + 1, F.lit(1 << 30)))
    tried = missing.join(aliases, "alias").withColumn("_c", F.concat("canonical", "_par")).join(known, F.col("_c") == F.col("_k"))
    best = tried.groupBy("dst").agg(F.min_by("_c", "priority").alias("_via"))
    return e.join(best, "dst", "left").select(*edges.columns, F.coalesce("_direct", "_via").alias("target"))


def tiered(left: DataFrame, name: str, right: DataFrame, order: str, tiers: list[tuple[str, Column, str | Column]]) -> DataFrame:
    """Fuzzy lookup: left with the best right row per distinct name and its tier (from 1).

    tiers: ("equal", expression over the name, right column) or ("match", condition over both, score). A lower tier wins,
    then a higher score, then `order`. Equality is a hash join; conditions are tried on all pairs, but only for names that
    no tier before has settled, and only with the registry of acts, whose size does not follow the left side.
    """
    open_, found = left.select(name).where(F.col(name).isNotNull()).distinct(), None
    for i, (kind, condition, value) in enumerate(tiers, 1):
        if kind == "equal":
            hit = open_.withColumn("_k", condition).join(right, F.col("_k") == F.col(value)).drop("_k").withColumn("_s", F.lit(0.0))
        else:
            hit = open_.join(right, condition).withColumn("_s", value.cast("double"))
        best = keep_first(hit, [name], [F.desc("_s"), order]).drop("_s").withColumn("tier", F.lit(i))
        found = best if found is None else found.unionByName(best)
        open_ = open_.join(best.select(name), name, "left_anti")
    return left.join(found, name, "left")


def draft_to_law(drafts: DataFrame, laws: DataFrame, name: str = "law_name") -> DataFrame:
    """Drafts with the registry entry their law name stands for. laws: key, ord, and more; keys in order of preference.

    Tiers: slug equal; slug in key or key in slug; at least two telling words in common (most first)."""
    norm = T.normalize_law_name(F.col(name))
    slug = T.slugify(norm)
    stop = F.array(*(F.lit(w) for w in ("ja", "ning", "seadus", "seadustik")))
    common = F.size(F.array_intersect(F.array_except(F.split(norm, " "), stop), F.array_except(F.split("key", " "), stop)))
    return tiered(drafts, name, laws, "ord", [("equal", slug, "key"), ("match", F.col("key").contains(slug) | slug.contains(F.col("key")), F.lit(0)), ("match", common >= 2, common)])


def name_to_slug(drafts: DataFrame, laws: DataFrame, name: str = "law_name") -> DataFrame:
    """Drafts with a law's slug. laws: title_lower, slug, ord. Tiers: title; slug of the name among titles, then slugs;
    containment either way; genitive turned to nominative as title, as slug among titles, then slugs."""
    low = F.trim(F.lower(F.col(name)))
    nominative = F.regexp_replace(F.regexp_replace(low, "seaduse$", "seadus"), "seadustiku$", "seadustik")
    t = F.col("title_lower")
    own = T.slugify(F.col(name))
    return tiered(drafts, name, laws, "ord", [
        ("equal", low, "title_lower"), ("equal", own, "title_lower"), ("equal", own, "slug"), ("match", t.contains(low) | low.contains(t), F.lit(0)),
        ("equal", nominative, "title_lower"), ("equal", T.slugify(nominative), "title_lower"), ("equal", T.slugify(nominative), "slug"),
    ])


def measure_to_law(measures: DataFrame, laws: DataFrame, title: str = "title") -> DataFrame:
    """Transposition measures with the act their title names. laws: key, source_act (both normalised), ord.

    Tiers: title equal; extracted act name equal; longest key (over 10 characters) inside the title; any source act
    inside the title."""
    whole = T.normalize_text(F.col(title))
    named = T.normalize_text(T.extract_law_name(F.col(title)))
    return tiered(measures, title, laws, "ord", [
        ("equal", whole, "key"), ("equal", named, "key"), ("match", (F.length("key") > 10) & whole.contains(F.col("key")), F.length("key")),
        ("match", (F.length("source_act") > 5) & whole.contains(F.col("source_act")), F.lit(0)),
    ])


def with_default(df: DataFrame, keys: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """Left join with a computed default for keys without a value."""
    return df.join(keys.select(key, F.col(value).alias("_v")), key, "left").withColumn(value, F.coalesce("_v", default)).drop("_v")


def coalesced_join(left: DataFrame, right: DataFrame, keys: list[Column], right_key: str, values: list[str]) -> DataFrame:
    """Values of the right row under the first of several left keys that has one (slug, else base slug)."""
    out = left
    for i, key in enumerate(keys):
        side = right.select(F.col(right_key).alias(f"_k{i}"), *(F.col(v).alias(f"_{v}{i}") for v in values))
        out = out.join(side, key == F.col(f"_k{i}"), "left")
    hit = [F.coalesce(*(F.when(F.col(f"_k{i}").isNotNull(), F.col(f"_{v}{i}")) for i in range(len(keys)))).alias(v) for v in values]
    return out.select(*left.columns, *hit)


def range_cluster(rows: DataFrame, number: str, clusters: DataFrame, name: str = "cluster") -> DataFrame:
    """Rows with the first cluster (by pos) whose list of numbers holds theirs. clusters: cluster, pos, numbers."""
    flat = clusters.select("cluster", "pos", F.explode("numbers").alias("_n")).groupBy("_n").agg(F.min_by("cluster", "pos").alias(name))
    return rows.join(flat, F.col(number) == F.col("_n"), "left").drop("_n")


def rename_map(iris: DataFrame, registry: DataFrame, prefix: str) -> DataFrame:
    """iri, new_iri of the identifiers that change. registry: slug, abbrev, old_prefix; the longest prefix wins.

    LegalConcept_x becomes Concept_x; LegalProvision_slug[_osaN] and Cluster_prefix_x and prefix_x take the abbreviation;
    _ParN becomes _Par_N. An identifier's beginnings that end before an underscore are looked up by equality.
    """
    local = F.substring("iri", len(prefix) + 2, 1 << 20)
    i = iris.select("iri", local.alias("local")).distinct()
    i = i.withColumn("kind", F.when(F.col("local").startswith("LegalConcept_"), "concept").when(F.col("local").startswith("LegalProvision_"), "provision").when(F.col("local").startswith("Cluster_"), "cluster").otherwise("other"))
    rest = F.when(F.col("kind") == "provision", F.expr("substring(local, 16)")).when(F.col("kind") == "cluster", F.expr("substring(local, 9)")).otherwise(F.col("local"))
    i = i.withColumn("rest", rest)
    # where a beginning may end: before any underscore, and for a provision's slug before a part number or at the end
    pieces = F.split("rest", "_")
    beginnings = F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda n: F.struct(F.array_join(F.slice(pieces, F.lit(1), n), "_").alias("old"), F.get(pieces, n).alias("next")))
    heads = i.where("kind <> 'concept'").select("iri", "kind", F.inline(beginnings))
    heads = heads.where("(kind = 'provision' and (next is null or startswith(next, 'osa'))) or (kind <> 'provision' and next is not null)")
    heads = heads.select("iri", "old", (F.col("kind") == "provision").alias("by_slug"))
    r = registry.select(F.col("slug").alias("old"), "abbrev", F.lit(True).alias("by_slug"))
    r = r.unionByName(registry.where("old_prefix <> '' and old_prefix <> abbrev").select(F.col("old_prefix").alias("old"), "abbrev", F.lit(False).alias("by_slug")))
    hits = heads.join(r, ["old", "by_slug"])
    best = hits.groupBy("iri").agg(F.max_by(F.struct("abbrev", "old"), F.length("old")).alias("b"))
    head = F.when(F.col("kind") == "provision", "LegalProvision_").when(F.col("kind") == "cluster", "Cluster_").otherwise("")
    renamed = F.concat(F.lit(f"{prefix}:"), head, F.col("b.abbrev"), F.expr("substring(rest, length(b.old) + 1)"))
    new = F.when(F.col("kind") == "concept", F.concat(F.lit(f"{prefix}:Concept_"), F.expr("substring(local, 14)"))).when(F.col("b").isNotNull(), renamed).otherwise(F.col("iri"))
    out = i.join(best, "iri", "left").select("iri", T.fix_par(new).alias("new_iri"))
    return out.where("iri <> new_iri")


def collisions(renames: DataFrame, iris: DataFrame) -> DataFrame:
    """New identifiers that several old ones would share (a migration with any is refused)."""
    whole = iris.select("iri").distinct().join(renames, "iri", "left").select("iri", F.coalesce("new_iri", "iri").alias("new_iri"))
    return whole.groupBy("new_iri").agg(F.count("*").alias("n")).where("n > 1")


def not_yet_present(wanted: DataFrame, slug: str, present: DataFrame, length: int = 20) -> DataFrame:
    """Rows for whose slug no present one starts with its first `length` characters (all of a shorter slug)."""
    starts = present.select(F.explode(F.transform(F.sequence(F.lit(0), F.least(F.length("slug"), F.lit(length))), lambda n: F.left("slug", n))).alias("_h")).distinct()
    return wanted.join(starts, F.left(F.col(slug), F.lit(length)) == F.col("_h"), "left_anti")


def located(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """edges with the file that holds their target (the first by name), null where there is none. nodes: iri, file_name."""
    home = nodes.groupBy("iri").agg(F.min("file_name").alias("target_file")).withColumnRenamed("iri", "dst")
    return edges.join(home, "dst", "left").select(*edges.columns, "target_file")


def unresolved(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """dst, n: targets that no node has, with the number of links to them."""
    return edges.join(nodes.select(F.col("iri").alias("dst")).distinct(), "dst", "left_anti").groupBy("dst").agg(F.count("*").alias("n"))


def registry_iris(registry: DataFrame, ontologies: DataFrame) -> DataFrame:
    """registry (name, files in order) with the identifier of the first of its files that has one. ontologies: file_name, iri."""
    files = registry.select("name", F.posexplode("files").alias("_n", "file_name")).join(ontologies, "file_name")
    return registry.join(files.groupBy("name").agg(F.min_by("iri", "_n").alias("iri")), "name", "left")
