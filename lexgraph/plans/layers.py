"""The integration layers as a graph of pure functions: each takes the tables so far and gives new ones.

A layer whose prerequisite failed is skipped, with all that depend on it; nothing is changed in place, so running a
layer again simply rebuilds its tables. `as_of` is the day that statuses are judged on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..operators import classify as C
from ..operators import extract as X
from ..operators import graph as G
from ..operators import resolve as R
from ..operators import similar as S

Tables = dict[str, DataFrame]


@dataclass
class Context:
    spark: SparkSession
    prefix: str
    as_of: str
    tables: Tables = field(default_factory=dict)


def _text(t: Tables) -> DataFrame:
    """Provisions with statute text (if there is any for the paragraph) before the summary."""
    p = t["provisions"]
    if "paragraph_texts" in t:
        p = p.withColumn("_n", T.digits_int(F.col("paragrahv"))).join(t["paragraph_texts"].select("law_slug", F.col("number").alias("_n"), "full_text"), ["law_slug", "_n"], "left").drop("_n")
        return p.withColumn("text", F.trim(F.concat_ws(" ", "full_text", "summary")))
    return p.withColumn("text", F.coalesce("summary", F.lit("")))


def cross_references(x: Context) -> Tables:
    t = x.tables
    acts = R.act_prefixes(t["provisions"])
    names = x.spark.createDataFrame(list(K.ABBREVIATIONS.items()), "law_ref string, source_act string").join(acts, "source_act").select("law_ref", "prefix")
    own = _text(t).select("file_name", "iri", "pos", "text", T.provision_prefix(F.col("iri")).alias("own_prefix"))
    found = X.citations(own)
    links = R.resolve_citations(found, R.provision_index(t["provisions"]), names)
    return {"citations": found, "references": links.select("src", F.lit("references").alias("pred"), "dst", "pattern", "ord", "n")}


def inverse_references(x: Context) -> Tables:
    e = x.tables["references"]
    if "aliases" in x.tables:
        e = R.resolve_aliases(e.select("src", "dst"), x.tables["provisions"], x.tables["aliases"]).select("src", F.col("target").alias("dst")).where("dst is not null")
    return {"referencedBy": G.invert(e, "referencedBy")}


def court_links(x: Context) -> Tables:
    t = x.tables
    if "court_decisions" not in t:
        return {}
    acts = R.act_prefixes(t["provisions"])
    names = x.spark.createDataFrame(list(K.ABBREVIATIONS.items()), "law_ref string, source_act string").join(acts, "source_act").select("law_ref", "prefix")
    found = X.citations(t["court_decisions"].select("iri", F.lit(None).cast("string").alias("own_prefix"), F.col("summary").alias("text")), self_references=False, keep_empty=False)
    links = R.resolve_citations(found, R.provision_index(t["provisions"]), names).select("src", F.lit("interpretsLaw").alias("pred"), "dst")
    return {"interpretsLaw": links, "interpretedBy": G.invert(links, "interpretedBy")}


def norms(x: Context) -> Tables:
    p = x.tables["provisions"].where("coalesce(summary, '') <> ''")
    return {"norms": p.select("iri", C.norm_type(F.col("summary")).alias("normative_type"), X.duty_holder(F.col("summary")).alias("duty_holder")).where("normative_type is not null")}


def file_texts(rows: DataFrame, *columns: str) -> DataFrame:
    """file_name, text: the columns of a file's rows, in order of pos, as one text."""
    parts = F.array_sort(F.collect_list(F.struct("pos", F.concat_ws(" ", *columns).alias("t"))))
    return rows.groupBy("file_name").agg(F.array_join(F.transform(parts, lambda v: v.t), " ").alias("text"))


def subjects(x: Context) -> Tables:
    """Domains of each law by its first file's texts, given to all its files. Needs domains and laws(name, files)."""
    t = x.tables
    if "domains" not in t:
        return {}
    laws = t["laws"].where(F.size("files") > 0).select("name", "files", F.get("files", F.lit(0)).alias("file_name"))
    text = file_texts(t["provisions"], "label", "source_act", "summary")
    hits = C.keyword_hits(laws.join(text, "file_name"), "name", "text", t["domains"])
    return {"subjects": hits.join(laws.select("name", F.explode("files").alias("file_name")), "name")}


def temporal(x: Context) -> Tables:
    t = x.tables
    if "statute_dates" not in t:
        return {}
    d = t["statute_dates"].withColumn("temporal_status", C.temporal_status(F.col("invalidation_date"), F.col("valid_until"), F.col("entry_into_force"), F.lit(x.as_of).cast("date")))
    return {"temporal": d.withColumn("repeal_date", C.repeal_date(F.col("temporal_status"), F.col("valid_until"), F.col("invalidation_date")))}


def amendment_history(x: Context) -> Tables:
    """Events of each act from its marks and the bills that change it, their links, and the length of each act's chain.

    Needs amendment_marks and amended_laws(file_name, slug, law_iri); with drafts(iri, draft_type, affected_law_name) and
    law_titles(title_lower, slug, ord) the bills come in. An act's parts share its bills.
    """
    from ..operators.entities import amendment_events

    t = x.tables
    if "amendment_marks" not in t or "amended_laws" not in t:
        return {}
    laws = t["amended_laws"]
    events = amendment_events(t["amendment_marks"], laws, x.prefix).select("iri", "law_iri", "amendment_date", "rt_reference", F.lit("act").alias("origin"))
    if "drafts" in t and "law_titles" in t:
        bills = t["drafts"].where("draft_type = 'AmendmentBill'").select("iri", F.explode("affected_law_name").alias("law_name"))
        named = R.name_to_slug(bills, t["law_titles"]).where("slug is not null").select("iri", T.base_slug(F.col("slug")).alias("base")).distinct()
        own = laws.select("law_iri", T.base_slug(F.col("slug")).alias("base"))
        none = F.lit(None)
        events = events.unionByName(named.join(own, "base").select("iri", "law_iri", none.cast("date").alias("amendment_date"), none.cast("string").alias("rt_reference"), F.lit("draft").alias("origin")))
    links = events.select(F.col("law_iri").alias("src"), F.lit("amendedBy").alias("pred"), F.col("iri").alias("dst"))
    chains = events.groupBy("law_iri").agg(F.count_if(F.col("origin") == "act").alias("acts"), F.count_if(F.col("origin") == "draft").alias("drafts"), F.count("*").alias("total"))
    return {"amendment_events": events, "amendedBy": links, "amends": G.invert(links.select("src", "dst"), "amends"), "amendment_chains": chains}


def transposition(x: Context) -> Tables:
    """Measures of this state with the directive and the act that their titles name, and the links of both.

    Needs measures(celex_dir, title), eu_acts(celex, iri) and law_index(key, source_act, law_iri, ord)."""
    t = x.tables
    if not {"measures", "eu_acts", "law_index"} <= set(t):
        return {}
    found = R.measure_to_law(t["measures"], t["law_index"]).where("key is not null")
    mapped = found.join(t["eu_acts"].select(F.col("celex").alias("celex_dir"), F.col("iri").alias("directive_iri")), "celex_dir", "left")
    links = mapped.where("directive_iri is not null").select(F.col("law_iri").alias("src"), F.lit("transposesDirective").alias("pred"), F.col("directive_iri").alias("dst")).distinct()
    return {"transposed": mapped.select("celex_dir", "directive_iri", "title", "tier", "law_iri", F.col("key").alias("law_name")), "transposesDirective": links, "transposedBy": G.invert(links.select("src", "dst"), "transposedBy")}


def harmonisation(x: Context) -> Tables:
    """What other states enacted for the directives that acts here transpose. Needs foreign_measures(celex_dir,
    country_code, celex_nat)."""
    from ..operators.entities import harmonisation as measures

    t = x.tables
    if "foreign_measures" not in t or "transposed" not in t:
        return {}
    out = measures(t["foreign_measures"], t["transposed"].select("celex_dir", "law_name"), x.prefix)
    links = out.join(t["transposed"].select("celex_dir", "law_iri").distinct(), "celex_dir").select(F.col("law_iri").alias("src"), F.lit("harmonisedWith").alias("pred"), F.col("iri").alias("dst"))
    return {"harmonised": out, "harmonisedWith": links}


def sanctions(x: Context) -> Tables:
    from ..operators.entities import sanction_nodes

    return {"sanctions": sanction_nodes(X.sanctions(_text(x.tables).select("iri", "paragrahv", "text")), x.prefix)}


def authorities(x: Context) -> Tables:
    p = _text(x.tables).where("text <> ''").select("iri", F.struct("file_name", "pos").alias("ord"), "text")
    found = X.institutions(p)
    from ..operators.entities import competences

    return {"institutions": found.select("iri", "suffix", "name", "institution_type"), "competences": competences(found, "text", x.prefix)}


def concept_links(x: Context) -> Tables:
    t = x.tables
    if "concepts" not in t:
        return {}
    c = t["concepts"].select("iri", "term_lower", F.col("law_slug").alias("law"), F.struct("law_slug", "iri").alias("ord"))
    return {"exactMatch": S.shared_terms(c), "closeMatch": S.near_terms(c)}


def draft_impact(x: Context) -> Tables:
    t = x.tables
    if "drafts" not in t or "law_keys" not in t:
        return {}
    names = t["drafts"].select("iri", F.explode("affected_law_name").alias("law_name"))
    hit = R.draft_to_law(names, t["law_keys"])
    return {"amendsLaw": hit.select(F.col("iri").alias("src"), F.lit("amendsLaw").alias("pred"), F.col("law_iri").alias("dst"), "law_name"), "affectedBy": G.invert(hit.select(F.col("iri").alias("src"), F.col("law_iri").alias("dst")), "affectedBy")}


def similarity(x: Context) -> Tables:
    p = x.tables["provisions"]
    return {"similar": S.keyword_similarity(S.provisions_for_similarity(p, x.prefix), apart=S.APART)}


#: name, function, names of the layers that have to come first.
LAYERS: list[tuple[str, Callable[[Context], Tables], tuple[str, ...]]] = [
    ("cross references", cross_references, ()),
    ("inverse references", inverse_references, ("cross references",)),
    ("court links", court_links, ()),
    ("norm types", norms, ()),
    ("subjects", subjects, ()),
    ("temporal", temporal, ()),
    ("amendment history", amendment_history, ()),
    ("transposition", transposition, ()),
    ("harmonisation", harmonisation, ("transposition",)),
    ("sanctions", sanctions, ()),
    ("authorities", authorities, ()),
    ("concepts", concept_links, ()),
    ("draft impact", draft_impact, ()),
    ("similarity", similarity, ("cross references",)),
]


def run(x: Context, layers=LAYERS, only: set[str] | None = None) -> dict[str, str]:
    """Builds the layers in order into x.tables; the state of each: done, failed: reason, or skipped."""
    state: dict[str, str] = {}
    for name, build, needs in layers:
        if only and name not in only:
            continue
        if any(not state.get(n, "done").startswith("done") for n in needs):
            state[name] = "skipped"
            continue
        try:
            x.tables |= build(x)
            state[name] = "done"
        except Exception as e:  # noqa: BLE001 - a layer's failure is reported, its dependants are skipped
            state[name] = f"failed: {e}"
    return state
