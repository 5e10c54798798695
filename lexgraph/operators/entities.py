"""Typed entities from landed feeds: drafts, court decisions, union acts and case law, institutions, amendment events,
harmonisation records, statute hierarchy. Every function gives one table; links leave as arrays and explode to edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as T
from . import classify as C
from . import extract as X
from .dedupe import keep_first, suffix_attribute, suffix_or_drop, suffix_seen


def drafts(feed: DataFrame, ministries: DataFrame, prefix: str, order: list[str] | None = None) -> DataFrame:
    """Drafts of all feeds, the first per number: iri, label, phase, draft_type, eis_number, link, initiator,
    publication_date, affected_law_name, change_type. ministries: code, name. Ids come from the number, else the link's
    UUID (16 signs), else the title (40 signs)."""
    d = feed.withColumn("_key", F.coalesce("eis", T.link_uuid(F.col("link")), "full_title"))
    d = keep_first(d, ["_key"], order or ["phase", "full_title"])
    ident = F.coalesce(T.sanitize_id(F.replace("eis", F.lit("/"), F.lit("_")), " -", cut=80), F.left(T.link_uuid(F.col("link")), F.lit(16)), F.left(T.sanitize_id(F.col("title"), " -", cut=80), F.lit(40)))
    out = d.join(F.broadcast(ministries.select(F.col("code").alias("ministry"), "name")), "ministry", "left")
    return out.select(
        F.concat(F.lit(f"{prefix}:Draft_"), ident).alias("iri"), F.col("title").alias("label"), "phase", C.draft_type(F.col("title")).alias("draft_type"), F.col("eis").alias("eis_number"), "link",
        F.coalesce("name", "ministry").alias("initiator"), F.col("date").alias("publication_date"), X.affected_laws(F.col("title")).alias("affected_law_name"), C.change_type(F.col("title")).alias("change_type"),
    )


def court_decisions(rows: DataFrame, prefix: str) -> DataFrame:
    """Decisions of court pages; a case number that repeats gets its object id appended."""
    ident = T.sanitize_id(F.col("case_number"), "/-", other="_", cut=80)
    d = rows.select("*", F.concat(F.lit(f"{prefix}:RK_"), ident).alias("iri"))
    d = suffix_attribute(d, "iri", ["date", "object_id"], T.sanitize_id(F.col("object_id"), "/-", other="_", cut=80))
    return d.select(
        "iri", "case_number", C.case_type(F.col("case_number")).alias("case_type"), C.decision_type(F.col("decision_type")).alias("decision_type"), T.parse_date(F.col("date")).alias("decision_date"),
        F.left("summary", F.lit(800)).alias("summary"), "link", F.col("object_id").alias("rik_object_id"), X.law_mentions(F.col("summary")).alias("referenced_law"),
    )


def merge_authors(bindings: DataFrame, key: str = "celex", author: str = "author") -> DataFrame:
    """One row per document: the first row's columns, and its distinct authors in order. bindings has ord."""
    rest = [c for c in bindings.columns if c not in (key, author, "ord")]
    code = F.nullif(T.uri_tail(F.col(author)), F.lit(""))
    first = bindings.groupBy(key).agg(F.min_by(F.struct(*rest), "ord").alias("_r"), F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("ord", code.alias("a")))), lambda x: x.a)).alias("_a"))
    return first.select(key, *(F.col(f"_r.{c}").alias(c) for c in rest), F.array_compact("_a").alias("authors"))


def eu_acts(bindings: DataFrame, doc_type: str, prefix: str) -> DataFrame:
    d = merge_authors(bindings)
    return d.select(F.concat(F.lit(f"{prefix}:EU_"), T.sanitize_celex(F.col("celex"))).alias("iri"), "celex", F.left("title", F.lit(500)).alias("title"), F.lit(doc_type).alias("doc_type"),
                    T.parse_date(F.col("date")).alias("document_date"), F.col("inforce").isin("1", "true").alias("in_force"), "eli", "authors")


def eu_decisions(bindings: DataFrame, prefix: str) -> DataFrame:
    d = merge_authors(bindings).withColumn("c", C.celex(F.col("celex")))
    return d.select(F.concat(F.lit(f"{prefix}:EUCJ_"), T.sanitize_celex(F.col("celex"))).alias("iri"), "celex", T.clean_title(F.col("title")).alias("title"), "c.*", "ecli",
                    T.eu_case_number(F.col("title")).alias("case_number"), T.parse_date(F.col("date")).alias("document_date"), "authors")


def concepts(definitions: DataFrame, prefix: str) -> DataFrame:
    """iri, term, term_lower, definition, law_slug, provision_iri (built from the slug, not looked up), def_number.

    definitions: law_slug, par_nr, pos, def_number, term, definition. A second concept of a name gets its number, a third
    goes."""
    slug = F.col("law_slug")
    ident = F.concat_ws("_", F.lit(f"{prefix}:Concept"), T.sanitize_id(slug, " -", cut=80), T.sanitize_id(F.lower("term"), " -", cut=80))
    d = definitions.select("*", ident.alias("iri"))
    d = suffix_or_drop(d, "iri", ["law_slug", "pos", "def_number"], F.col("def_number"))
    return d.select("iri", "term", F.lower("term").alias("term_lower"), "definition", "law_slug", F.concat(F.lit(f"{prefix}:"), slug, F.lit("_Par_"), "par_nr").alias("provision_iri"), "def_number")


def sanction_nodes(found: DataFrame, prefix: str) -> DataFrame:
    """Nodes of extract.sanctions over provisions (iri, paragrahv): one per sanction, numbered where a type repeats."""
    ident = F.concat(F.lit(f"{prefix}:Sanction_"), T.sanitize_id(F.substring_index("iri", ":", -1), " -", cut=80), F.lit("_"), F.col("sanction_type"))
    rn = F.row_number().over(W.partitionBy("iri", "sanction_type").orderBy("ord"))
    ref = X.provision_reference(F.lit(None).cast("string"), F.col("iri"), F.col("paragrahv"))
    return found.withColumn("_n", rn).select(
        F.when(F.col("_n") > 1, F.concat_ws("_", ident, F.col("_n").cast("string"))).otherwise(ident).alias("iri"), F.col("iri").alias("provision_iri"), "sanction_type",
        T.singular(F.col("max_penalty")).alias("max_penalty"), T.singular(F.col("min_penalty")).alias("min_penalty"), X.sanction_label(F.col("sanction_type"), F.col("max_penalty"), F.col("min_penalty"), ref).alias("label"),
    )


def competences(found: DataFrame, text: str, prefix: str, cap: int = 50) -> DataFrame:
    """Institution, competence type and its provisions (at most `cap`, in order): the report side of institutions."""
    from .dedupe import capped_list

    f = found.withColumn("competence_type", C.competence_type(F.col(text))).select("suffix", "competence_type", "iri", "ord")
    out = capped_list(f, ["suffix", "competence_type"], "iri", ["ord", "iri"], cap, "provisions")
    inst = F.concat(F.lit(f"{prefix}:Institution_"), "suffix")
    return out.select(F.concat_ws("_", inst, F.lit("competence"), "competence_type").alias("iri"), inst.alias("institution"), "competence_type", "provisions")


def amendment_events(marks: DataFrame, laws: DataFrame, prefix: str) -> DataFrame:
    """Numbered events per law from amendment marks; laws: file_name, slug, law_iri. Parts without marks of their own share
    those of their act."""
    m = marks.withColumn("_s", F.regexp_replace("file_name", r"\.xml$", ""))
    keys = F.array_distinct(F.array("slug", T.base_slug(F.col("slug"))))
    j = laws.select("law_iri", "slug", F.explode(keys).alias("_s")).join(m, "_s").withColumn("_own", F.col("_s") == F.col("slug"))
    j = j.withColumn("_any", F.max("_own").over(W.partitionBy("law_iri"))).where("_own = _any")
    rn = F.row_number().over(W.partitionBy("law_iri").orderBy(F.col("amendment_date").asc_nulls_last(), "rt_reference"))
    j = j.withColumn("idx", rn)
    return j.select(F.concat(F.lit(f"{prefix}:Amendment_"), T.sanitize_id(F.col("slug"), " -", cut=80), F.lit("_"), F.col("idx").cast("string")).alias("iri"), "law_iri", "amendment_date", "entry_into_force", "rt_reference", "idx")


def harmonisation(measures: DataFrame, transposed: DataFrame, prefix: str) -> DataFrame:
    """Measures of other states per directive that a law here transposes: celex, iri, country, idx, celex_nat, laws.

    measures: celex_dir, country_code, celex_nat; transposed: celex_dir, law_name."""
    laws = transposed.groupBy("celex_dir").agg(F.array_sort(F.collect_set("law_name")).alias("laws"))
    m = measures.dropDuplicates(["celex_dir", "country_code", "celex_nat"]).join(laws, "celex_dir")
    m = m.withColumn("idx", F.row_number().over(W.partitionBy("celex_dir", "country_code").orderBy("celex_nat")))
    return m.select("celex_dir", F.concat_ws("_", F.lit(f"{prefix}:Harm"), T.sanitize_celex(F.col("celex_dir")), "country_code", F.col("idx").cast("string")).alias("iri"), "country_code", "idx", "celex_nat", "laws")


def statute_provisions(paragraphs: DataFrame, laws: DataFrame, prefix: str) -> DataFrame:
    """Provisions of statutes in document order. laws: file_name, law (its short name), source_act; part numbers enter
    the id of multi-part acts. A number that repeats gets the count of paragraphs of its part before it."""
    p = paragraphs.join(laws, "file_name")
    number = F.coalesce(T.digits_int(F.col("par_nr")), T.digits_int(F.col("display")))
    head = F.concat_ws("_", F.concat(F.lit(f"{prefix}:"), "law"), F.when(F.col("part").isNotNull(), F.concat(F.lit("Osa"), "part")))
    p = p.withColumn("number", number).withColumn("iri", F.concat_ws("_Par_", head, number.cast("string")))
    p = suffix_seen(p, ["file_name", "part"], "iri", ["pos"])
    return p.select("file_name", "pos", "iri", "number", F.coalesce("display", F.concat(F.lit("§ "), "par_nr")).alias("paragrahv"), T.label(F.col("title"), F.col("summary"), F.col("display")).alias("label"),
                    "source_act", F.nullif("summary", F.lit("")).alias("summary"), "full_text", "law", "part", "chapter", "division")


def statute_hierarchy(paragraphs: DataFrame, laws: DataFrame, prefix: str) -> DataFrame:
    """Chapters, divisions and subdivisions: iri, kind, label, parent, and the number, least and greatest of their paragraphs."""
    p = paragraphs.join(laws, "file_name").withColumn("number", T.digits_int(F.col("par_nr")))
    chapter = F.concat_ws("_", F.lit(f"{prefix}:Chapter"), "law", "chapter")
    division = F.concat_ws("_", F.lit(f"{prefix}:Division"), "law", "chapter", "division")
    size = [F.count_distinct("number").alias("n"), F.min("number").alias("first_par"), F.max("number").alias("last_par")]
    law = F.concat(F.lit(f"{prefix}:"), "law", F.lit("_Map_2026"))
    a = p.where("chapter is not null").groupBy(chapter.alias("iri"), F.lit("chapter").alias("kind"), law.alias("parent")).agg(F.first("chapter_title").alias("label"), *size)
    b = p.where("chapter is not null and division is not null").groupBy(division.alias("iri"), F.lit("division").alias("kind"), chapter.alias("parent")).agg(F.first("division_title").alias("label"), *size)
    sub = F.concat_ws("_", F.lit(f"{prefix}:Subdivision"), "law", "chapter", "division", "subdivision")
    c = p.where("chapter is not null and subdivision is not null").groupBy(sub.alias("iri"), F.lit("subdivision").alias("kind"), F.coalesce(F.when(F.col("division").isNotNull(), division), chapter).alias("parent")).agg(F.first("subdivision_title").alias("label"), *size)
    return a.unionByName(b).unionByName(c)


def topic_clusters(paragraphs: DataFrame, laws: DataFrame, prefix: str) -> DataFrame:
    """Topic clusters of an act, one per chapter (one for all of it without chapters), with their scheme and numbers."""
    p = paragraphs.join(laws, "file_name").withColumn("number", T.digits_int(F.col("par_nr")))
    nr = F.coalesce("chapter", F.lit("1"))
    out = p.groupBy("file_name", "law", nr.alias("nr")).agg(F.min("pos").alias("pos"), F.first("chapter_title").alias("title"), F.min("number").alias("first_par"), F.max("number").alias("last_par"), F.array_sort(F.collect_set("number")).alias("numbers"))
    return out.select(F.concat_ws("_", F.lit(f"{prefix}:Cluster"), "law", "nr").alias("cluster"), F.concat(F.lit(f"{prefix}:"), "law", F.lit("_TopicScheme")).alias("scheme"), "pos",
                      F.concat_ws(" ", F.coalesce("title", F.lit("Üldine")), F.concat(F.lit("("), range_label(F.col("first_par"), F.col("last_par")), F.lit(")"))).alias("label"), F.size("numbers").alias("n"), "numbers")


def range_label(first: Column, last: Column) -> Column:
    return F.concat(F.lit("§ "), first.cast("string"), F.when(first != last, F.concat(F.lit("–"), last.cast("string"))).otherwise(""))


def ontology(spark, prefix: str) -> DataFrame:
    """The classes, properties and inverses that the tables stand for: iri, kind, domain, range, inverse."""
    p = lambda x: f"{prefix}:{x}" if x else None
    classes = ("LegalProvision", "TopicCluster", "LegalConcept", "Section", "DraftLegislation", "LegislativePhase", "DraftType", "CourtDecision", "CaseType", "DecisionType", "EULegislation",
               "EUDocumentType", "EUInstitution", "EUCourtDecision", "EUCourtDecisionType", "EUCourt", "AmendmentEvent", "Sanction", "Institution", "NormativeType")
    links = (("references", "LegalProvision", "LegalProvision", "referencedBy"), ("interpretsLaw", "CourtDecision", "LegalProvision", "interpretedBy"), ("transposesDirective", None, "EULegislation", "transposedBy"),
             ("amendsLaw", "DraftLegislation", None, "affectedBy"), ("amends", "AmendmentEvent", None, "amendedBy"), ("hasSanction", "LegalProvision", "Sanction", "applicableProvision"),
             ("competentAuthority", "LegalProvision", "Institution", "appliesToProvision"), ("definedIn", "LegalConcept", "LegalProvision", "definesTerm"))
    rows = [(p(c), "class", None, None, None) for c in classes] + [(p(a), "property", p(d), p(r), p(i)) for a, d, r, i in links]
    return spark.createDataFrame(rows, "iri string, kind string, domain string, range string, inverse string")
