import json
from datetime import date

from pyspark.sql import functions as F

from lexgraph.operators import entities as E
from lexgraph.plans import layers
from lexgraph.plans import reports
from lexgraph.sources import readers, writers


def test_jsonld(spark, tmp_path):
    g = [
        {"@id": "lex:A_Map", "@type": "owl:Ontology", "rdfs:label": {"@value": "Seadus", "@language": "et"}},
        {"@id": "lex:KarS_Par_121", "@type": ["lex:LegalProvision_a"], "lex:summary": "KarS § 12, käesoleva seaduse § 13", "lex:sourceAct": "Karistusseadustik", "lex:paragrahv": "§ 121"},
        {"@id": "lex:KarS_Par_12", "@type": ["lex:LegalProvision_a"], "lex:summary": {"@value": "Tööandja on kohustatud tasuma", "@language": "et"}, "lex:references": {"@id": "lex:KarS_Par_121"}},
        {"@id": "lex:KarS_Par_13", "@type": ["lex:LegalProvision_a"], "lex:references": [{"@id": "a"}, {"@id": "b"}]},
    ]
    (tmp_path / "a_peep.json").write_text(json.dumps({"@graph": g}))
    (tmp_path / "b_peep.json").write_text("{broken")
    docs = readers.jsonld_documents(spark, str(tmp_path), skip=("court",))
    assert docs.count() == 2 and docs.where("v is null").count() == 1
    nodes = readers.nodes(docs).cache()
    assert [(r.iri, r.types) for r in nodes.orderBy("pos").limit(1).collect()] == [("lex:A_Map", ["owl:Ontology"])]
    assert {r.iri: r.v for r in nodes.select("iri", readers.values_of("lex:references").alias("v")).collect()}["lex:KarS_Par_13"] == ["a", "b"]
    p = readers.provisions(nodes, "lex").cache()
    assert p.count() == 3 and p.where("summary = 'Tööandja on kohustatud tasuma'").count() == 1
    assert readers.ontology_iris(nodes).first().iri == "lex:A_Map"
    x = layers.Context(spark, "lex", "2026-01-01", {"provisions": p})
    state = layers.run(x)
    assert set(state.values()) == {"done"}
    assert {(r.src, r.dst) for r in x.tables["references"].collect()} == {("lex:KarS_Par_121", "lex:KarS_Par_12"), ("lex:KarS_Par_121", "lex:KarS_Par_13")}
    assert x.tables["referencedBy"].count() == 2
    assert {r.normative_type for r in x.tables["norms"].collect()} == {"Obligation"}
    bad = [("cross references", lambda c: 1 / 0, ()), ("inverse references", layers.inverse_references, ("cross references",))]
    assert layers.run(x, bad) == {"cross references": "failed: division by zero", "inverse references": "skipped"}


STATUTE = """<o:oigusakt xmlns:o="x"><o:metaandmed><o:kehtivus><o:kehtivuseAlgus>2017-02-26+02:00</o:kehtivuseAlgus></o:kehtivus>
<o:vastuvoetud><o:aktikuupaev>01.02.2017</o:aktikuupaev></o:vastuvoetud><o:muutmismarge><o:aktikuupaev>2018-05-01</o:aktikuupaev><o:joustumine>2018-06-01</o:joustumine>
<o:avaldamismarge><o:RTosa>RT I</o:RTosa><o:RTaasta>2018</o:RTaasta><o:RTnr>5</o:RTnr></o:avaldamismarge></o:muutmismarge></o:metaandmed>
<o:sisu><o:peatykk><o:peatykkNr>1</o:peatykkNr><o:peatykkPealkiri>Üld</o:peatykkPealkiri>
<o:paragrahv><o:paragrahvNr>1</o:paragrahvNr><o:paragrahvPealkiri>Algus</o:paragrahvPealkiri><o:loige>Tekst <o:b>rasvane</o:b> lõpp.</o:loige></o:paragrahv>
<o:jagu><o:jaguNr>2</o:jaguNr><o:jaguPealkiri>Jagu</o:jaguPealkiri><o:paragrahv><o:paragrahvNr>76</o:paragrahvNr><o:loige>Esimene.</o:loige></o:paragrahv>
<o:paragrahv><o:paragrahvNr>76</o:paragrahvNr><o:loige>Teine.</o:loige></o:paragrahv></o:jagu></o:peatykk></o:sisu></o:oigusakt>"""


def test_statutes(spark, tmp_path):
    (tmp_path / "a.xml").write_text(STATUTE)
    (tmp_path / "bad.xml").write_text("<x>")
    p = readers.statute_paragraphs(spark, str(tmp_path / "*.xml")).cache()
    got = [(r.pos, r.chapter, r.division, r.par_nr, r.summary) for r in p.orderBy("pos").collect()]
    assert got == [(0, "1", None, "1", "Tekst rasvane lõpp."), (1, "1", "2", "76", "Esimene."), (2, "1", "2", "76", "Teine.")]
    laws = spark.createDataFrame([("a.xml", "AS", "Aseadus")], "file_name string, law string, source_act string")
    assert [r.iri for r in E.statute_provisions(p, laws, "lex").orderBy("pos").collect()] == ["lex:AS_Par_1", "lex:AS_Par_76", "lex:AS_Par_76_2"]
    parts = spark.createDataFrame([("b.xml", i, p, n) for i, (p, n) in enumerate([("1", "1"), ("1", "2"), ("2", "1"), ("2", "1"), ("2", "2")])], "file_name string, pos int, part string, par_nr string")
    rest = "cast(null as string) display, cast(null as string) title, cast(null as string) summary, cast(null as string) full_text, cast(null as string) chapter, cast(null as string) division"
    numbered = E.statute_provisions(parts.selectExpr("*", *rest.split(", ")), spark.createDataFrame([("b.xml", "B", "Bseadus")], "file_name string, law string, source_act string"), "lex")
    assert [r.iri for r in numbered.orderBy("pos").collect()] == ["lex:B_Osa1_Par_1", "lex:B_Osa1_Par_2", "lex:B_Osa2_Par_1", "lex:B_Osa2_Par_1_1", "lex:B_Osa2_Par_2"]
    assert {(r.iri, r.kind, r.n) for r in E.statute_hierarchy(p, laws, "lex").collect()} == {("lex:Chapter_AS_1", "chapter", 2), ("lex:Division_AS_1_2", "division", 1)}
    clusters = E.topic_clusters(p, laws, "lex").collect()
    assert [(c.cluster, c.n, c.label) for c in clusters] == [("lex:Cluster_AS_1", 2, "Üld (§ 1–76)")]
    d = readers.statute_dates(spark, str(tmp_path / "*.xml")).first()
    assert (d.entry_into_force, d.adoption_date, d.last_amendment_date) == (date(2017, 2, 26), date(2017, 2, 1), date(2018, 5, 1))
    m = readers.amendment_marks(spark, str(tmp_path / "a.xml")).first()
    assert (m.amendment_date, m.rt_reference) == (date(2018, 5, 1), "RT I, 2018, 5")


def test_feeds(spark, tmp_path):
    (tmp_path / "feed.xml").write_text("<rss><channel><item><title>Liiklusseaduse muutmise seaduse eelnõu - JDM/24-0123 (05.02.2024)</title><link>http://x/docList/1</link></item><item><title> </title></item></channel></rss>")
    f = readers.draft_feed(spark, str(tmp_path / "feed.xml"), "Review")
    ministries = spark.createDataFrame([("JDM", "Justiitsministeerium")], "code string, name string")
    r = E.drafts(f.unionByName(f), ministries, "lex").collect()
    assert len(r) == 1 and (r[0].iri, r[0].draft_type, r[0].initiator, r[0].change_type) == ("lex:Draft_JDM_24_0123", "AmendmentBill", "Justiitsministeerium", "amends")
    html = "<tr><td>05.02.2024</td><td><a href='x' href=\"/k/1\">3-1-1</a></td><td>Kohtuotsus | KarS § 121 &amp; muu</td><td>77</td></tr><tr><td>1</td></tr>"
    c = readers.court_page(spark.createDataFrame([(html,), (html,)], "value string"), base="https://h")
    got = E.court_decisions(c, "lex").orderBy("iri").collect()
    assert [(g.iri, g.case_type, g.decision_type, g.link, g.referenced_law) for g in got] == [(i, "Administrative", "Judgment", "https://h/k/1", ["KarS"]) for i in ("lex:RK_3_1_1", "lex:RK_3_1_1_77")]
    (tmp_path / "s.json").write_text(json.dumps({"results": {"bindings": [{"celex": {"value": "32014L0104"}, "title": {"value": "t"}, "author": {"value": "http://x/CJ"}}, {"celex": {"value": "32014L0104"}, "title": {"value": "u"}, "author": {"value": "http://x/EP"}}]}}))
    b = readers.sparql_bindings(spark, str(tmp_path / "s.json"), ["celex", "title", "date", "inforce", "eli", "author"]).withColumn("ord", F.monotonically_increasing_id())
    a = E.eu_acts(b, "Directive", "lex").collect()
    assert len(a) == 1 and (a[0].iri, a[0].title, a[0].authors) == ("lex:EU_32014L0104", "t", ["CJ", "EP"])


def test_writers(spark, tmp_path):
    n = spark.createDataFrame([("b", 0, "i", 1), ("a", 1, "i", 2), ("a", 2, "j", 3)], "file_name string, pos int, iri string, v int")
    assert {(r.iri, r.v) for r in writers.combined_graph(n).collect()} == {("i", 2), ("j", 3)}
    d = spark.createDataFrame([("lex:A", ["T"], ["x"], date(2020, 1, 2), 'q"t')], "iri string, types array<string>, links array<string>, day date, label string")
    line = json.loads(writers.jsonld_lines(d, "iri", "types", {"links": "lex:references", "day": "lex:day", "label": "rdfs:label"}).first().value)
    assert line == {"@id": "lex:A", "@type": ["T"], "lex:references": {"@id": "x"}, "lex:day": {"@value": "2020-01-02", "@type": "xsd:date"}, "rdfs:label": 'q"t'}
    writers.rebuild(n, str(tmp_path / "t"), ["file_name"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    assert writers.markdown(n.limit(1)).count("|") == 15
    s = spark.createDataFrame([("l", "fine"), ("l", "arrest"), ("m", "fine")], "law string, sanction_type string")
    assert [(r.law, r.max_severity, r.max_type) for r in reports.severity(s).collect()] == [("l", 4, "arrest"), ("m", 2, "fine")]
