"""Layers over small tables: amendment history, transposition, harmonisation."""

from datetime import date

import pytest

from lexgraph.operators import migrate as M
from lexgraph.operators import resolve as R
from lexgraph.operators import validate as V
from lexgraph.plans import layers, reports
from lexgraph.sources import readers, writers


def test_amendment_history(spark):
    marks = spark.createDataFrame(
        [("liiklusseadus.xml", date(2018, 5, 1), None, "RT I, 2018, 5"), ("liiklusseadus.xml", date(2017, 1, 1), None, "RT I, 2017, 1"), ("karistus_osa2.xml", date(2020, 1, 1), None, "RT I, 2020, 9"), ("karistus.xml", date(2019, 1, 1), None, "RT I, 2019, 1")],
        "file_name string, amendment_date date, entry_into_force date, rt_reference string")
    laws = spark.createDataFrame([("a.json", "liiklusseadus", "lex:LS"), ("b.json", "karistus_osa1", "lex:K1"), ("c.json", "karistus_osa2", "lex:K2"), ("d.json", "muu", "lex:M")], "file_name string, slug string, law_iri string")
    drafts = spark.createDataFrame([("lex:D1", "AmendmentBill", ["Liiklusseaduse"]), ("lex:D2", "Bill", ["Liiklusseaduse"]), ("lex:D3", "AmendmentBill", ["tundmatu"])], "iri string, draft_type string, affected_law_name array<string>")
    titles = spark.createDataFrame([("liiklusseadus", "liiklusseadus", 0)], "title_lower string, slug string, ord int")
    x = layers.Context(spark, "lex", "2026-01-01", {"amendment_marks": marks, "amended_laws": laws, "drafts": drafts, "law_titles": titles})
    assert layers.run(x, only={"amendment history"}) == {"amendment history": "done"}
    got = sorted((r.law_iri, r.iri, r.rt_reference) for r in x.tables["amendment_events"].collect() if r.origin == "act")
    # a part with marks of its own has those, another has its act's
    assert got == [("lex:K1", "lex:Amendment_karistus_osa1_1", "RT I, 2019, 1"), ("lex:K2", "lex:Amendment_karistus_osa2_1", "RT I, 2020, 9"),
                   ("lex:LS", "lex:Amendment_liiklusseadus_1", "RT I, 2017, 1"), ("lex:LS", "lex:Amendment_liiklusseadus_2", "RT I, 2018, 5")]
    assert {(r.law_iri, r.acts, r.drafts, r.total) for r in x.tables["amendment_chains"].collect()} == {("lex:K1", 1, 0, 1), ("lex:K2", 1, 0, 1), ("lex:LS", 2, 1, 3)}
    assert ("lex:D1", "lex:LS") in {(r.src, r.dst) for r in x.tables["amends"].collect()}


def test_transposition_and_harmonisation(spark):
    measures = spark.createDataFrame([("32010L0001", "Liiklusseadus"), ("32010L0001", "vastavalt isikuandmete kaitse seadus jne"), ("32011L0002", "Liiklusseadus"), ("39999L0009", "Liiklusseadus"), ("32011L0002", "tundmatu")], "celex_dir string, title string")
    acts = spark.createDataFrame([("32010L0001", "lex:EU_1"), ("32011L0002", "lex:EU_2")], "celex string, iri string")
    index = spark.createDataFrame([("liiklusseadus", "liiklusseadus", "lex:LS", 0), ("isikuandmete kaitse seadus", "x", "lex:IKS", 1)], "key string, source_act string, law_iri string, ord int")
    foreign = spark.createDataFrame([("32010L0001", "FI", "n2"), ("32010L0001", "FI", "n1"), ("32010L0001", "FI", "n1"), ("32012L0003", "FI", "n3")], "celex_dir string, country_code string, celex_nat string")
    x = layers.Context(spark, "lex", "2026-01-01", {"measures": measures, "eu_acts": acts, "law_index": index, "foreign_measures": foreign})
    assert layers.run(x, only={"transposition", "harmonisation"}) == {"transposition": "done", "harmonisation": "done"}
    assert {(r.src, r.dst) for r in x.tables["transposesDirective"].collect()} == {("lex:LS", "lex:EU_1"), ("lex:IKS", "lex:EU_1"), ("lex:LS", "lex:EU_2")}
    assert x.tables["transposedBy"].count() == 3
    assert sorted((r.country_code, r.celex_nat, r.idx, r.laws) for r in x.tables["harmonised"].collect()) == [("FI", "n1", 1, ["isikuandmete kaitse seadus", "liiklusseadus"]), ("FI", "n2", 2, ["isikuandmete kaitse seadus", "liiklusseadus"])]
    assert {(r.src, r.dst) for r in x.tables["harmonisedWith"].collect()} == {(law, f"lex:Harm_32010L0001_FI_{n}") for law in ("lex:LS", "lex:IKS") for n in (1, 2)}


def test_provision_shape(spark):
    assert len([r for r in V.RULES if r[0] == "LegalProvision"]) == 25
    values = spark.createDataFrame([("p", "paragrahv", "§ 1", "string"), ("p", "summary", "x", "string"), ("p", "subject", "tax", "string"), ("p", "publicationDate", "2020-01-01", "date"), ("p", "publicationDate", "2021-01-01", "date"), ("p", "dutyHolder", "x", "iri")], "iri string, path string, value string, datatype string")
    got = {(r.path, r.kind) for r in V.violations(values, spark.createDataFrame([], "iri string, type string"), V.rules(spark)).collect()}
    assert got == {("subject", "nodeKind"), ("publicationDate", "maxCount"), ("dutyHolder", "datatype")}


def test_migration_run(spark):
    registry = spark.createDataFrame([("liiklusseadus", "LS", "LiiklS"), ("karistusseadustik", "KarS", "KS"), ("karistusseadustik_eri", "KarE", "KS_Eri")], "slug string, abbrev string, old_prefix string")
    nodes = spark.createDataFrame([("lex:LiiklS_Par_1",), ("lex:KS_Eri_Par5",), ("lex:KS_Par_5",), ("lex:LegalProvision_liiklusseadus_osa1",), ("lex:LegalConcept_auto",), ("lex:X_Par_1",)], "iri string")
    edges = spark.createDataFrame([("lex:LiiklS_Par_1", "references", "lex:KS_Eri_Par5"), ("lex:X_Par_1", "references", "lex:Cluster_LiiklS_1")], "src string, pred string, dst string")
    mentions = spark.createDataFrame([("a.json", "lex:LiiklS_Par_1", 3), ("a.json", "lex:X_Par_1", 9), ("b.json", "lex:KS_Par_5", 1)], "file_name string, iri string, n bigint")
    p = M.preview(nodes, mentions, registry, "lex")
    assert {(r.file_name, r.n) for r in p.per_file.collect()} == {("a.json", 3), ("b.json", 1)} and p.collisions.count() == 0
    n, e = M.apply(nodes, edges, registry, "lex")
    assert sorted(r.iri for r in n.collect()) == ["lex:Concept_auto", "lex:KarE_Par_5", "lex:KarS_Par_5", "lex:LS_Par_1", "lex:LegalProvision_LS_osa1", "lex:X_Par_1"]
    assert {(r.src, r.dst) for r in e.collect()} == {("lex:LS_Par_1", "lex:KarE_Par_5"), ("lex:X_Par_1", "lex:Cluster_LS_1")}
    assert M.leftovers(n, e, registry, "lex").count() == 0 and M.leftovers(nodes, edges, registry, "lex").count() == 6
    clash = nodes.unionByName(spark.createDataFrame([("lex:LS_Par_1",)], "iri string"))
    with pytest.raises(M.Refused, match="lex:LS_Par_1"):
        M.apply(clash, edges, registry, "lex")
    raw = spark.createDataFrame([('{"http://old/a": "http://old/b"}',)], "value string")
    assert M.namespace(raw, "http://old/", "http://new/").first().value == '{"http://new/a": "http://new/b"}'


def test_validation_status(spark):
    of = lambda *checks: spark.createDataFrame([("a", c, "") for c in checks], "file_name string, check string, detail string")
    assert [V.exit_status(of()), V.exit_status(of("id across files")), V.exit_status(of("id across files", "json"))] == [0, 0, 1]


def test_structure(spark):
    documents = spark.createDataFrame([("a", True, "n"), ("b", False, None), ("c", True, "m")], "file_name string, valid boolean, namespace string")
    nodes = spark.createDataFrame([("a", 0, "x", True), ("a", 1, "x", True), ("c", 0, "x", False), ("c", 1, "y", True)], "file_name string, pos int, iri string, type_is_array boolean")
    keys = spark.createDataFrame([("a", "x", "references", "object"), ("a", "x", "sectionNumber", "number"), ("c", "y", "source", "array"), ("c", "y", "hasSection", "array")], "file_name string, iri string, key string, kind string")
    got = sorted((r.file_name, r.check) for r in V.structure_issues(documents, nodes, keys, "n").collect())
    assert got == [("a", "array"), ("a", "id across files"), ("a", "id in file"), ("a", "section number"), ("b", "json"), ("c", "namespace"), ("c", "source"), ("c", "type")]
    assert V.exit_status(V.structure_issues(documents, nodes, keys, "n")) == 1


def test_targets_and_registries(spark, tmp_path):
    nodes = spark.createDataFrame([("x", "b.json"), ("x", "a.json"), ("y", "c.json")], "iri string, file_name string")
    edges = spark.createDataFrame([("p", "x"), ("q", "z"), ("r", "z")], "src string, dst string")
    assert {(r.src, r.target_file) for r in R.located(edges, nodes).collect()} == {("p", "a.json"), ("q", None), ("r", None)}
    assert [(r.dst, r.n) for r in R.unresolved(edges, nodes).collect()] == [("z", 2)]
    registry = spark.createDataFrame([("A", ["1.json", "2.json", "3.json"]), ("B", ["4.json"])], "name string, files array<string>")
    own = spark.createDataFrame([("3.json", "iri3"), ("2.json", "iri2")], "file_name string, iri string")
    assert {(r.name, r.iri) for r in R.registry_iris(registry, own).collect()} == {("A", "iri2"), ("B", None)}
    (tmp_path / "reg.json").write_text('{"a_seadus": {"abbrev": "AS", "source": "official", "title": "A", "old_prefix": "ASead"}, "b": {"abbrev": "B"}}')
    assert {(r.slug, r.abbrev, r.old_prefix) for r in readers.abbreviation_registry(spark, str(tmp_path / "reg.json")).collect()} == {("a_seadus", "AS", "ASead"), ("b", "B", None)}
    for year in (1999, 2005):
        (tmp_path / f"riigikohus_{year}_peep.json").write_text('{"@graph": [{"@id": "lex:1", "dc:source": ["a", "b"], "lex:sectionNumber": 7}]}')
    d = readers.court_years(spark, str(tmp_path), first=2000)
    assert [r.year for r in d.collect()] == [2005]
    n = readers.nodes(d).select(readers.dc_source().alias("s"), readers.section_number("lex").alias("n")).first()
    assert (n.s, n.n) == ("a; b", "7")
    chains = spark.createDataFrame([("k_osa1", 1), ("k_osa2", 2), ("m", 3)], "slug string, total int")
    assert {(r.base_slug, r.total) for r in writers.last_part(chains).collect()} == {("k", 2), ("m", 3)}
    text = writers.pretty(spark.createDataFrame([("õigus", [1])], "a string, b array<int>")).first().value
    assert "\n" in text and '"a" : "õigus"' in text
    files = spark.createDataFrame([("1.xml",), ("2.xml",)], "file_name string")
    assert [r.file_name for r in readers.with_paragraphs(files, files.limit(1)).collect()] == ["1.xml"]
    hits = spark.createDataFrame([("A", "tax", 1), ("A", "law", 2), ("B", "tax", 1)], "name string, code string, rank int")
    got = reports.domains(spark.createDataFrame([("A",), ("B",), ("C",)], "name string"), hits)
    assert [(r.code, r.n) for r in got["domains"].collect()] == [("tax", 2), ("law", 1)] and [r.name for r in got["unclassified"].collect()] == ["C"]
    assert {(r.name, tuple(r.codes)) for r in got["classified"].collect()} == {("A", ("tax", "law")), ("B", ("tax",))}
