"""Reports of the layers as aggregations. Orders are explicit, ties by name; top-k uses a bounded heap per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.constants import SEVERITY


def top(df: DataFrame, by: str, name: str, k: int) -> DataFrame:
    return df.orderBy(F.desc(by), name).limit(k)


def cross_references(found: DataFrame, edges: DataFrame) -> DataFrame:
    """Per file and in total (null file): citations (paragraphs, before links are made distinct), resolved, unresolved.

    found: file_name, paragraphs; edges: file_name, src, dst."""
    f = found.groupBy("file_name").agg(F.sum(F.size("paragraphs")).alias("citations"))
    e = edges.groupBy("file_name").agg(F.count("*").alias("resolved"), F.count_distinct("src").alias("provisions"))
    per = f.join(e, "file_name", "left").fillna(0, ["resolved", "provisions"])
    return per.rollup("file_name").agg(*(F.sum(c).alias(c) for c in ("citations", "resolved", "provisions"))).withColumn("unresolved", F.col("citations") - F.col("resolved"))


def counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def most_linked(edges: DataFrame, k: int = 100) -> DataFrame:
    return top(edges.groupBy("dst").agg(F.count("*").alias("n")), "n", "dst", k)


def norm_types(df: DataFrame, law: str, kind: str) -> DataFrame:
    """Per law the number of provisions of each normative type, and the share classified."""
    names = ["Obligation", "Right", "Permission", "Prohibition"]
    p = df.groupBy(law).agg(*(F.count_if(F.col(kind) == n).alias(n) for n in names), F.count(kind).alias("classified"), F.count("*").alias("total"))
    return p.withColumn("rate", T.percentage(F.col("classified"), F.col("total")))


def status_histogram(df: DataFrame, status: str = "temporal_status") -> DataFrame:
    """All statuses, empty ones with zero."""
    dim = df.sparkSession.createDataFrame([("inForce",), ("repealed",), ("notYetEffective",), ("unknown",)], f"{status} string")
    n = df.groupBy(F.coalesce(status, F.lit("unknown")).alias(status)).agg(F.count("*").alias("n"))
    return dim.join(n, status, "left").fillna(0, ["n"])


def amendments(events: DataFrame, titles: DataFrame, k: int = 30) -> DataFrame:
    """Events per law, then per title over its parts (parts of one act are added up, as each lists the act's events)."""
    per = events.groupBy("law_iri").agg(F.count("*").alias("n"))
    return top(per.join(titles, "law_iri").groupBy("title").agg(F.sum("n").alias("n")), "n", "title", k)


def concepts(df: DataFrame, k: int = 30) -> tuple[DataFrame, DataFrame]:
    """(concepts per law, terms of several laws)."""
    many = df.groupBy("term_lower").agg(F.count_distinct("law_slug").alias("n_laws"), F.array_sort(F.collect_set("law_slug")).alias("laws")).where("n_laws > 1")
    return top(counts(df, "law_slug"), "n", "law_slug", k), many


def domains(laws: DataFrame, hits: DataFrame) -> dict[str, DataFrame]:
    """Laws per domain, the domains of each law in order of rank, and the laws without any. hits: name, code, rank."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "code"))), lambda x: x.code)
    return {
        "domains": top(counts(hits, "code"), "n", "code", 1000), "classified": hits.groupBy("name").agg(listed.alias("codes")),
        "unclassified": laws.select("name").distinct().join(hits.select("name"), "name", "left_anti").orderBy("name"),
    }


def terms_of_several(df: DataFrame, term: str, of: str) -> DataFrame:
    """term, n, first: terms that stand under several values of a column (a null is a value, but never the first)."""
    return df.select(term, of).distinct().groupBy(term).agg(F.count("*").alias("n"), F.min(of).alias("first")).where("n > 1")


def institutions(df: DataFrame) -> DataFrame:
    """Per institution its provisions and distinct laws. df: suffix, name, iri, law."""
    return df.groupBy("suffix").agg(F.min("name").alias("name"), F.count("*").alias("n_provisions"), F.count_distinct("law").alias("n_laws"))


def institution_types(df: DataFrame) -> DataFrame:
    """One name per type, the last by name, as the source's report keeps it."""
    return df.groupBy("institution_type").agg(F.max("name").alias("name"))


def severity(sanctions: DataFrame, k: int = 50) -> DataFrame:
    """Per law: number of sanctions, greatest severity and its type."""
    s = sanctions.withColumn("sev", F.coalesce(T.look_up(SEVERITY, F.col("sanction_type")), F.lit(0)))
    per = s.groupBy("law").agg(F.count("*").alias("n"), F.max("sev").alias("max_severity"), F.max_by("sanction_type", "sev").alias("max_type"))
    return per.orderBy(F.desc("max_severity"), F.desc("n"), "law").limit(k)


def draft_impact(links: DataFrame, drafts: DataFrame, k: int = 20) -> dict[str, DataFrame]:
    """Counts by change type, drafts per law, per ministry (drafts with an affected law only), names without a law.

    links: iri, law_name, law_iri (null: unresolved); drafts: iri, initiator, change_type."""
    named = drafts.join(links.select("iri").distinct(), "iri", "left_semi")
    return {
        "change_types": counts(named, "change_type"), "laws": top(counts(links.where("law_iri is not null"), "law_iri"), "n", "law_iri", k), "ministries": counts(named, "initiator"),
        "unresolved": links.where("law_iri is null").select("law_name").distinct().orderBy("law_name"),
    }


def similarity(pairs: DataFrame, k: int = 20) -> dict[str, DataFrame]:
    """Number and mean of similarities, their tenths, and the first pairs in order of discovery."""
    return {
        "total": pairs.agg(F.count("*").alias("pairs"), T.round_even(F.avg("similarity"), 3).alias("mean")),
        "tenths": pairs.groupBy(T.bucket(F.col("similarity")).alias("bucket")).agg(F.count("*").alias("n")),
        "first": pairs.orderBy("oa", F.desc("similarity"), F.desc("ob")).limit(k).select("a", "b", "shared", T.round_even(F.col("similarity"), 3).alias("similarity")),
    }


def transposition(links: DataFrame, measures: DataFrame, countries: list[str]) -> tuple[DataFrame, DataFrame]:
    """(distinct directives and laws, measures per country with zeros)."""
    dim = links.sparkSession.createDataFrame([(c,) for c in countries], "country_code string")
    n = measures.groupBy("country_code").agg(F.count("*").alias("n"))
    return links.agg(F.count_distinct("celex_dir").alias("directives"), F.count_distinct("law").alias("laws")), dim.join(n, "country_code", "left").fillna(0, ["n"])


def by_year(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy(F.year("decision_date").alias("year"), "case_type").agg(F.count("*").alias("n"))


def eu_acts(acts: DataFrame) -> DataFrame:
    return acts.groupBy("doc_type").agg(F.count("*").alias("total"), F.count_if("in_force").alias("in_force"), F.count_if(~F.col("in_force")).alias("not_in_force"))


def eu_decisions(decisions: DataFrame) -> DataFrame:
    """Counts by type, by court and by category in one pass."""
    g = decisions.groupingSets([["decision_type"], ["court"], ["category"]], "decision_type", "court", "category")
    return g.agg(F.count("*").alias("n")).select("decision_type", "court", "category", "n")


def migration(registry: DataFrame, renames: DataFrame, mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(names per source, occurrences per file of identifiers that change)."""
    return counts(registry, "source"), mentions.join(renames, "iri").groupBy("file_name").agg(F.sum("n").alias("n"))
