"""Readers of the landing zone: JSON-LD graphs, statute XML, RSS, court HTML, SPARQL result JSON, registries, raw text.

Files are read by Spark's own sources, so any file system works and partitions follow the files. Fetching from remote
services is left to an ingest job that lands files; paging and caching of the services do not concern the engine.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


def _file(c: str = "_metadata.file_name") -> Column:
    return F.col(c).alias("file_name")


def jsonld_documents(spark: SparkSession, path: str, recursive: bool = False, skip: tuple[str, ...] = (), suffixes: tuple[str, ...] = (".json", ".jsonld")) -> DataFrame:
    """file_name, v (variant): one row per readable document; names that start with one of `skip` are left out."""
    raw = spark.read.option("wholetext", True).option("recursiveFileLookup", recursive).text(path).select(_file(), F.col("value"))
    name = F.col("file_name")
    keep = F.greatest(F.lit(False), F.lit(False), *(name.endswith(s) for s in suffixes))
    for s in skip:
        keep = keep & ~name.startswith(s)
    return raw.where(keep).select("file_name", F.try_parse_json("value").alias("v"))


def nodes(documents: DataFrame) -> DataFrame:
    """file_name, pos, iri, types and node (variant) of all graph nodes of readable documents.

    A single type is an array of one, and the value of a language-tagged text counts like a plain string (see value_of).
    """
    d = documents.where("v is not null").select("file_name", F.expr("try_variant_get(v, '$[\"@graph\"]', 'array<variant>')").alias("g"))
    n = d.select("file_name", F.posexplode("g").alias("pos", "node"))
    types = F.expr("coalesce(try_variant_get(node, '$[\"@type\"]', 'array<string>'), case when try_variant_get(node, '$[\"@type\"]', 'string') is not null then array(try_variant_get(node, '$[\"@type\"]', 'string')) end)")
    return n.select("file_name", "pos", F.expr("try_variant_get(node, '$[\"@id\"]', 'string')").alias("iri"), types.alias("types"), "node")


def value_of(key: str, node: str = "node") -> Column:
    """Text of a property: plain, typed, language-tagged or an identifier; blank is null."""
    path = "$[\"" + key + "\"]"
    found = ", ".join(f"try_variant_get({node}, '{path}{tail}', 'string')" for tail in ('["@value"]', '["@id"]', ""))
    return F.nullif(F.expr(f"coalesce({found})"), F.lit(""))


def values_of(key: str, node: str = "node") -> Column:
    """All values of a property as an array, a single one included; objects give their identifier or value."""
    path = "$[\"" + key + "\"]"
    many = F.transform(F.expr(f"try_variant_get({node}, '{path}', 'array<variant>')"), lambda x: F.coalesce(F.try_variant_get(x, '$["@id"]', "string"), F.try_variant_get(x, '$["@value"]', "string"), F.try_variant_get(x, "$", "string")))
    one = value_of(key, node)
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>"))


def provisions(graph: DataFrame, prefix: str) -> DataFrame:
    """Typed provisions: file_name, pos, iri, paragrahv, label, source_act, summary."""
    p = graph.where(T.is_provision(F.col("iri"), prefix))
    own = lambda k: value_of(f"{prefix}:{k}")
    return p.select("file_name", "pos", "iri", "types", own("paragrahv").alias("paragrahv"), value_of("rdfs:label").alias("label"), own("sourceAct").alias("source_act"), own("summary").alias("summary"))


def dc_source(node: str = "node") -> Column:
    """The source of a node as one text; a list is joined."""
    return F.nullif(F.array_join(values_of("dc:source", node), "; "), F.lit(""))


def section_number(prefix: str, node: str = "node") -> Column:
    """The number of a section as text, also where the file has it as a number."""
    return value_of(f"{prefix}:sectionNumber", node)


def court_years(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """jsonld_documents of yearly court files (riigikohus_YYYY_peep.json), with the year, from `first` to `last`."""
    d = jsonld_documents(spark, path).withColumn("year", F.nullif(F.regexp_extract("file_name", r"^riigikohus_(\d{4})_peep\.json$", 1), F.lit("")).cast("int"))
    return d.where(F.col("year").isNotNull() & F.col("year").between(first or 0, last or 9999))


def abbreviation_registry(spark: SparkSession, path: str) -> DataFrame:
    """slug, abbrev, source, title, old_prefix from a registry file: a JSON object of entries by slug."""
    entry = "struct<abbrev: string, source: string, title: string, old_prefix: string>"
    d = spark.read.option("wholetext", True).text(path).select(F.explode(F.from_json("value", f"map<string, {entry}>")).alias("slug", "e"))
    return d.select("slug", "e.*")


def with_paragraphs(files: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """The files that have any paragraph; statutes without are skipped."""
    return files.join(paragraphs.select("file_name").distinct(), "file_name", "left_semi")


def ontology_iris(graph: DataFrame) -> DataFrame:
    """file_name, iri of the first ontology node of each file."""
    return graph.where(F.array_contains("types", "owl:Ontology")).groupBy("file_name").agg(F.min_by("iri", "pos").alias("iri"))


def mentioned_iris(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """file_name, iri, n: every identifier of a namespace in any text file."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(_file(), "value")
    hits = lines.select("file_name", F.explode(F.regexp_extract_all("value", F.lit(f"{T.quote(prefix)}:[A-Za-z0-9_]+"), F.lit(0))).alias("iri"))
    return hits.groupBy("file_name", "iri").agg(F.count("*").alias("n"))


# ---- statute XML: mixed content needs document order, which the XML source loses, so elements are walked in Arrow batches

_TEXT_TAGS = ("loige", "lauseOsa", "lause", "tavatekst")


def _local(tag) -> str:
    return tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""


def _child(e, name: str) -> str | None:
    for x in e:
        if _local(x.tag) == name and x.text and x.text.strip():
            return x.text.strip()
    return None


def _text(e, longest: int | None, least: int, tags: tuple[str, ...]) -> str:
    """Texts of the tags in document order, blanks collapsed; nested tags repeat theirs."""
    parts, size = [], 0
    for x in e.iter():
        if _local(x.tag) in tags:
            t = " ".join(" ".join(x.itertext()).split())
            if len(t) >= least:
                parts.append(t)
                size += len(t) + 1
                if longest and size > longest:
                    break
    joined = " ".join(parts)
    return joined[:longest] if longest else joined


_PARAGRAPH = "file_name string, pos int, part string, chapter string, chapter_title string, division string, division_title string, subdivision string, subdivision_title string, par_nr string, display string, title string, summary string, full_text string"


def statute_paragraphs(spark: SparkSession, path: str, longest: int = 500, least: int = 4, tags: tuple[str, ...] = _TEXT_TAGS) -> DataFrame:
    """A row per paragraph of statute XML in document order, with the part, chapter, division and subdivision it stands in."""

    def walk(name: str, raw: bytes):
        try:
            root = ET.fromstring(raw)
        except ET.ParseError:
            return
        pos = 0
        stack = [(root, {})]
        while stack:
            e, at = stack.pop()
            tag = _local(e.tag)
            if tag == "osa":
                at = at | {"part": _child(e, "osaNr")}
            elif tag == "peatykk":
                at = at | {"chapter": _child(e, "peatykkNr"), "chapter_title": _child(e, "peatykkPealkiri"), "division": None, "division_title": None, "subdivision": None, "subdivision_title": None}
            elif tag == "jagu":
                at = at | {"division": _child(e, "jaguNr"), "division_title": _child(e, "jaguPealkiri"), "subdivision": None, "subdivision_title": None}
            elif tag == "jaotis":
                at = at | {"subdivision": _child(e, "jaotisNr"), "subdivision_title": _child(e, "jaotisPealkiri")}
            elif tag == "paragrahv":
                yield (name, pos, at.get("part"), at.get("chapter"), at.get("chapter_title"), at.get("division"), at.get("division_title"), at.get("subdivision"), at.get("subdivision_title"), _child(e, "paragrahvNr"), _child(e, "kuvatavNr"), _child(e, "paragrahvPealkiri"), _text(e, longest, least, tags), _text(e, None, 1, tags))
                pos += 1
                continue
            stack += [(x, at) for x in reversed(list(e))]

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            out = [r for n, c in zip(batch.column("file_name").to_pylist(), batch.column("content").to_pylist(), strict=True) for r in walk(n, c)]
            if out:
                names = [x.split()[0] for x in _PARAGRAPH.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "pos" else pa.string()) for n, c in zip(names, zip(*out, strict=True), strict=True)], names)

    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "content")
    return files.mapInArrow(rows, _PARAGRAPH)


_DATES = ("kehtivuseAlgus", "kehtivAlates", "kehtivuseLopp", "kehtivKuni", "aktikuupaev", "joustumine", "joustumisKuupaev", "kehtetuKuupaev", "avaldamiseKuupaev", "RTaasta", "muutmisKuupaev")


def statute_dates(spark: SparkSession, path: str) -> DataFrame:
    """Temporal metadata per statute file: entry_into_force, valid_from, valid_until, invalidation_date,
    last_amendment_date, publication_date, adoption_date; explicit tags go before the blocks they summarise."""
    fields = ("begin1", "begin2", "end1", "end2", "adopted", "entry_block", "entry", "invalid", "published", "year", "changed")
    schema = "file_name string, " + ", ".join(f"{f} string" for f in fields) + ", amended array<string>"

    def read(raw: bytes):
        try:
            root = ET.fromstring(raw)
        except ET.ParseError:
            return None
        first = lambda top, name: next((x for x in top.iter() if _local(x.tag) == name), None)
        inside = lambda block, name: _child(block, name) if block is not None else None
        valid, adopted, mark = first(root, "kehtivus"), first(root, "vastuvoetud"), first(root, "avaldamismarge")
        meta = first(root, "metaandmed")
        top = root if meta is None else meta
        text = lambda t, name: next((x.text.strip() for x in t.iter() if _local(x.tag) == name and x.text and x.text.strip()), None)
        amended = [d for m in root.iter() if _local(m.tag) == "muutmismarge" and (d := _child(m, "aktikuupaev"))]
        return (inside(valid, "kehtivuseAlgus"), inside(valid, "kehtivAlates"), inside(valid, "kehtivuseLopp"), inside(valid, "kehtivKuni"), inside(adopted, "aktikuupaev"), inside(adopted, "joustumine"),
                text(top, "joustumisKuupaev"), text(top, "kehtetuKuupaev"), text(root, "avaldamiseKuupaev"), inside(mark, "RTaasta"), text(root, "muutmisKuupaev"), amended)

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            got = [(n, *r) for n, c in zip(batch.column("file_name").to_pylist(), batch.column("content").to_pylist(), strict=True) if (r := read(c))]
            if got:
                c = list(zip(*got, strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.string()) for x in c[:-1]), pa.array(c[-1], pa.list_(pa.string()))], ["file_name", *fields, "amended"])

    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "content")
    d = files.mapInArrow(rows, schema)
    date = lambda c: T.parse_date(F.col(c))
    begin = F.when(F.col("begin1").isNotNull(), date("begin1")).otherwise(date("begin2"))
    end = F.when(F.col("end1").isNotNull(), date("end1")).otherwise(date("end2"))
    last = F.greatest(F.array_max(F.transform("amended", T.parse_date)), date("changed"))
    return d.select(
        "file_name", F.coalesce(date("entry"), date("entry_block"), begin).alias("entry_into_force"), begin.alias("valid_from"), end.alias("valid_until"),
        date("invalid").alias("invalidation_date"), last.alias("last_amendment_date"), F.coalesce(date("published"), F.try_to_date(F.concat("year", F.lit("-01-01")))).alias("publication_date"), date("adopted").alias("adoption_date"),
    )


def amendment_marks(spark: SparkSession, path: str) -> DataFrame:
    """file_name, amendment_date, entry_into_force, rt_reference of every amendment mark with a date or a reference."""
    schema = "aktikuupaev string, joustumine string, avaldamismarge struct<RTosa:string,RTaasta:string,RTnr:string,RTartikkel:string>"
    m = spark.read.format("xml").option("rowTag", "muutmismarge").option("ignoreNamespace", True).schema(schema).load(path).select(_file(), "*")
    a = F.col("avaldamismarge")
    ref = F.concat_ws(", ", *(F.nullif(F.trim(a[c]), F.lit("")) for c in ("RTosa", "RTaasta", "RTnr", "RTartikkel")))
    out = m.select("file_name", T.parse_date(F.col("aktikuupaev")).alias("amendment_date"), T.parse_date(F.col("joustumine")).alias("entry_into_force"), F.nullif(ref, F.lit("")).alias("rt_reference"))
    return out.where("amendment_date is not null or rt_reference is not null")


# ---- feeds


def draft_feed(spark: SparkSession, path: str, phase: str) -> DataFrame:
    """Drafts of an RSS feed: phase, title, link, published, and the parts of the title; items without title go."""
    items = spark.read.format("xml").option("rowTag", "item").schema("title string, link string, pubDate string").load(path)
    items = items.select(F.lit(phase).alias("phase"), T.collapse(F.col("title")).alias("full_title"), F.trim("link").alias("link"), F.col("pubDate").alias("published")).where("full_title <> ''")
    return items.withColumn("p", T.rss_parts(F.col("full_title"))).select("phase", "full_title", "link", "published", "p.*")


def html_rows(html: Column) -> Column:
    """Cells of every table row of a page: array of arrays of HTML fragments, for rows of at least four cells."""
    rows = F.regexp_extract_all(html, F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    return F.filter(F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit(r"(?s)<td[^>]*>(.*?)</td>"), F.lit(1))), lambda c: F.size(c) >= 4)


def court_page(pages: DataFrame, html: str = "value", base: str = "") -> DataFrame:
    """Decisions of court result pages: date, case_number, decision_type, summary, object_id, link."""
    r = pages.select(F.explode(html_rows(F.col(html))).alias("c"))
    c = lambda i: F.get("c", F.lit(i))
    desc = T.html_text(c(2))
    cut = F.instr(desc, "|")
    link = F.regexp_extract(c(1), 'href="([^"]+)"', 1)
    out = r.select(
        T.html_text(c(0)).alias("date"), T.html_text(c(1)).alias("case_number"), F.when(cut > 0, F.trim(F.substring_index(desc, "|", 1))).otherwise("").alias("decision_type"),
        F.when(cut > 0, F.trim(F.substring(desc, cut + 1, F.length(desc)))).otherwise(desc).alias("summary"), T.html_text(c(3)).alias("object_id"),
        F.when((link != "") & ~link.startswith("http"), F.concat(F.lit(base), link)).otherwise(link).alias("link"),
    )
    return out.where("date <> '' and case_number <> ''")


def sparql_bindings(spark: SparkSession, path: str, variables: list[str]) -> DataFrame:
    """A row per binding with the value of each variable, null where it is optional and absent."""
    d = spark.read.option("wholetext", True).text(path).select(F.try_parse_json("value").alias("v"))
    b = d.select(F.explode(F.expr("try_variant_get(v, '$.results.bindings', 'array<variant>')")).alias("b"))
    return b.select(*(F.expr(f"try_variant_get(b, '$.{x}.value', 'string')").alias(x) for x in variables))


def law_registry(documents: DataFrame) -> DataFrame:
    """name, files (sorted) of acts from the file names of their parts."""
    slug = F.regexp_replace("file_name", "_peep\\.json$", "")
    return documents.select("file_name", F.regexp_extract(slug, r"^(.+?)(_osa\d+.*)?$", 1).alias("name")).groupBy("name").agg(F.array_sort(F.collect_set("file_name")).alias("files"))


def latest_versions(search: DataFrame) -> DataFrame:
    """Per title the row with the greatest id, ids compared as text. search: title, gid (text), and more."""
    rest = [c for c in search.columns if c != "title"]
    return search.groupBy("title").agg(F.max_by(F.struct(*rest), F.col("gid").cast("string")).alias("_r")).select("title", *(F.col(f"_r.{c}").alias(c) for c in rest))
