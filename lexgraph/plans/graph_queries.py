"""Graph patterns that consumers ask, as functions over typed tables and edges(src, pred, dst)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import graph as G


def _newest(df: DataFrame, date: str, k: int | None, tie: str = "iri") -> DataFrame:
    out = df.where(F.col(date).isNotNull()).orderBy(F.desc(date), tie)
    return out.limit(k) if k else out


def decisions_citing(decisions: DataFrame, law: str, k: int = 20) -> DataFrame:
    """Newest decisions with a cited law that contains a text."""
    return _newest(decisions.where(F.exists("referenced_law", lambda x: x.contains(law))), "decision_date", k)


def drafts_amending(drafts: DataFrame, law: str, phases: DataFrame) -> DataFrame:
    """Drafts that affect a law named like this, with the phase's label. phases: phase, phase_label."""
    hit = drafts.where(F.exists("affected_law_name", lambda x: F.lower(x).contains(law.lower())))
    return hit.join(F.broadcast(phases), "phase")


def acts_in_force(acts: DataFrame, doc_type: str, k: int = 20) -> DataFrame:
    return _newest(acts.where(F.col("in_force") & (F.col("doc_type") == doc_type)), "document_date", k)


def judgments(decisions: DataFrame, kind: str = "Judgment", k: int = 20) -> DataFrame:
    return _newest(decisions.where((F.col("decision_type") == kind) & F.col("ecli").isNotNull()), "document_date", k)


def out_links(edges: DataFrame, predicate: str, src: Column | None = None) -> DataFrame:
    e = edges.where(F.col("pred") == predicate)
    return e.where(src) if src is not None else e


def in_links(edges: DataFrame, predicate: str, iri: str) -> DataFrame:
    """Who points at an identifier: a filter that reaches the scan."""
    return edges.where((F.col("pred") == predicate) & (F.col("dst") == iri)).select("src")


def references_of_law(edges: DataFrame, law_prefix: str) -> DataFrame:
    return out_links(edges, "references", T.provision_prefix(F.col("src")) == law_prefix)


def provision_links(edges: DataFrame, decisions: DataFrame) -> DataFrame:
    return out_links(edges, "interpretsLaw").join(decisions.select(F.col("iri").alias("src"), "case_number", "decision_date"), "src")


def provisions_of_cluster(provisions: DataFrame, cluster: str) -> DataFrame:
    return provisions.where(F.col("requested_cluster") == cluster)


def mutual_references(edges: DataFrame) -> DataFrame:
    return G.mutual(edges, "references", "referencedBy")


def drafts_on_law(edges: DataFrame, laws: DataFrame, drafts: DataFrame, title: str) -> DataFrame:
    e = out_links(edges, "amendsLaw").join(laws.where(F.col("title").contains(title)).select(F.col("iri").alias("dst"), "title"), "dst")
    return e.join(drafts.select(F.col("iri").alias("src"), "label", "phase"), "src")


def directive_pairs(edges: DataFrame) -> DataFrame:
    return out_links(edges, "transposesDirective").select(F.col("src").alias("law"), F.col("dst").alias("directive")).distinct()


def sanctions_of(sanctions: DataFrame, law_prefix: str | None = None) -> DataFrame:
    s = sanctions.where(T.provision_prefix(F.col("provision_iri")) == law_prefix) if law_prefix else sanctions
    return s.orderBy("provision_iri", "sanction_type", "max_penalty")


def authorities(edges: DataFrame, institutions: DataFrame) -> DataFrame:
    return out_links(edges, "competentAuthority").join(institutions.select(F.col("iri").alias("dst"), "label"), "dst")


def provisions_of_type(provisions: DataFrame, norm_type: str, law_prefix: str | None = None) -> DataFrame:
    p = provisions.where(F.col("normative_type") == norm_type)
    return p.where(T.provision_prefix(F.col("iri")) == law_prefix) if law_prefix else p


def amendment_timeline(edges: DataFrame, events: DataFrame, law: str) -> DataFrame:
    e = out_links(edges, "amendedBy", F.col("src") == law).join(events.select(F.col("iri").alias("dst"), "amendment_date", "rt_reference"), "dst")
    return e.orderBy("amendment_date", "dst")


def drafts_in_phase(drafts: DataFrame, phase: str) -> DataFrame:
    return drafts.where(F.col("phase") == phase)


def review_decisions(decisions: DataFrame, since: str, case_type: str = "ConstitutionalReview") -> DataFrame:
    return _newest(decisions.where((F.col("case_type") == case_type) & (F.col("decision_date") >= F.lit(since).cast("date"))), "decision_date", None)


def acts_by_institution(acts: DataFrame, institution: str, doc_type: str, k: int = 20) -> DataFrame:
    return _newest(acts.where(F.array_contains("authors", institution) & (F.col("doc_type") == doc_type)), "document_date", k)


def interpretations(edges: DataFrame, decisions: DataFrame, iri: str) -> DataFrame:
    e = in_links(edges, "interpretsLaw", iri).join(decisions.select(F.col("iri").alias("src"), "case_number", "decision_date"), "src")
    return _newest(e, "decision_date", None, "src")


def transposing_laws(edges: DataFrame, directive: str) -> DataFrame:
    return in_links(edges, "transposesDirective", directive)


def provisions_on_topic(edges: DataFrame, provisions: DataFrame, topic: str) -> DataFrame:
    """Topics hang on law documents: the join goes through a provision's file. provisions: iri, law_iri."""
    return provisions.join(in_links(edges, "subject", topic).select(F.col("src").alias("law_iri")), "law_iri", "left_semi")


def optional_pattern(base: DataFrame, key: str, optional: dict[str, DataFrame], k: int | None = None, offset: int = 0) -> DataFrame:
    """A basic pattern with optional parts: distinct left joins, and a page of the result in key order.

    optional: {variable: DataFrame(key, variable)}."""
    out = base
    for name, df in optional.items():
        out = out.join(df.select(key, name), key, "left")
    out = out.distinct()
    return out.orderBy(key).offset(offset).limit(k) if k else out


def union_classes(types: DataFrame, classes: list[str]) -> DataFrame:
    return types.where(F.col("type").isin(*classes)).select("iri").distinct()


def celex_starts(acts: DataFrame, start: str) -> DataFrame:
    return acts.where(F.col("celex").startswith(start))


def country_of(uri: Column, marker: str = "/country/") -> Column:
    """What follows a marker in a URI (STRAFTER)."""
    return F.when(uri.contains(marker), F.substring_index(uri, marker, -1))
