from pyspark.sql import functions as F

from lexgraph.operators import dedupe as U
from lexgraph.operators import graph as G
from lexgraph.operators import repair as P
from lexgraph.operators import resolve as R
from lexgraph.operators import similar as S
from lexgraph.operators import validate as V


def test_rename_map(spark):
    reg = spark.createDataFrame(
        [("perekonnaseadus", "PKS", "PKS"), ("alkoholi_tubaka_kutuse_ja_elektriaktsiisi_seadus", "ATKE", "Alkoholi_tubaka_ktuse_ja"), ("volaigusseadus", "VOS", "VOS")], "slug string, abbrev string, old_prefix string")
    iris = ["PKS_Par_1", "Alkoholi_tubaka_ktuse_ja_Map_2026", "Cluster_Alkoholi_tubaka_ktuse_ja_Aktsiis", "LegalProvision_alkoholi_tubaka_kutuse_ja_elektriaktsiisi_seadus", "LegalProvision_volaigusseadus_osa11", "LegalConcept_alkoholiseadus", "VOS_Par271"]
    got = {r.iri[4:]: r.new_iri[4:] for r in R.rename_map(spark.createDataFrame([(f"lex:{i}",) for i in iris], "iri string"), reg, "lex").collect()}
    assert got == {
        "Alkoholi_tubaka_ktuse_ja_Map_2026": "ATKE_Map_2026", "Cluster_Alkoholi_tubaka_ktuse_ja_Aktsiis": "Cluster_ATKE_Aktsiis",
        "LegalProvision_alkoholi_tubaka_kutuse_ja_elektriaktsiisi_seadus": "LegalProvision_ATKE", "LegalProvision_volaigusseadus_osa11": "LegalProvision_VOS_osa11",
        "LegalConcept_alkoholiseadus": "Concept_alkoholiseadus", "VOS_Par271": "VOS_Par_271",
    }


def test_index_and_aliases(spark):
    p = spark.createDataFrame([("a", 0, "lex:A_Par_1", ""), ("a", 1, "lex:B_Par_2", "x"), ("b", 0, "lex:A_Par_1", "Law b"), ("c", 0, "lex:C_Par_14", "Law c")], "file_name string, pos int, iri string, source_act string")
    got = {(r.prefix, r.par_key): r.iri for r in R.provision_index(p).collect()}
    assert got == {("lex:A", "1"): "lex:A_Par_1", ("lex:A", "2"): "lex:B_Par_2", ("lex:C", "14"): "lex:C_Par_14"}
    assert {r.source_act for r in R.act_prefixes(p).collect()} == {"Law b", "Law c"}
    e = spark.createDataFrame([("s", "lex:Old_Par_14"), ("s", "lex:C_Par_14"), ("s", "lex:Old_Par_99")], "src string, dst string")
    al = spark.createDataFrame([("lex:Old", "lex:A", 1), ("lex:Old", "lex:C", 2)], "alias string, canonical string, priority int")
    assert {r.dst: r.target for r in R.resolve_aliases(e, p.select("iri").distinct(), al).collect()} == {"lex:Old_Par_14": "lex:C_Par_14", "lex:C_Par_14": "lex:C_Par_14", "lex:Old_Par_99": None}


def test_similarity_is_exact(spark):
    import itertools
    import random

    rng = random.Random(3)
    sets = [sorted({rng.choice("abcdefghijkl") for _ in range(rng.randint(3, 8))}) for _ in range(60)]
    d = spark.createDataFrame([(i, i, i % 4, s) for i, s in enumerate(sets)], "id int, ord int, grp int, keywords array<string>")
    got = {(r.a, r.b): r.shared for r in S.keyword_similarity(d, 3, 0.3, None).collect()}
    want = {}
    for i, j in itertools.combinations(range(60), 2):
        a, b = set(sets[i]), set(sets[j])
        if i % 4 != j % 4 and len(a) >= 3 and len(b) >= 3 and len(a & b) >= 3 and len(a & b) / len(a | b) >= 0.3:
            want[i, j] = len(a & b)
    assert got == want


def test_similar_provisions_of_one_act_or_file_are_left_out(spark):
    words = "lepingu sõlmimine tähtaeg kohustus täitmine"
    rows = [("lex:A_Par_1", "Aseadus", "a.json", 0), ("lex:A2_Par_1", "Aseadus", "b.json", 0), ("lex:B_Par_1", "", "a.json", 1), ("lex:C_Par_1", "", "c.json", 0), ("lex:C_Par_2", None, "d.json", 0), ("lex:D_Par_1", "Dseadus", "e.json", 0)]
    n = spark.createDataFrame([(i, ["lex:LegalProvision"], words, words, act, f, p) for i, act, f, p in rows], "iri string, types array<string>, label string, summary string, source_act string, file_name string, pos int")
    got = {frozenset((r.a, r.b)) for r in S.keyword_similarity(S.provisions_for_similarity(n, "lex"), apart=S.APART, top=None).collect()}
    # apart: one act (A, A2), one file (A, B), one prefix (C, C); an act without a name is no common act (B, C)
    every = {frozenset((x[0], y[0])) for x in rows for y in rows if x[0] < y[0]}
    assert got == every - {frozenset(p) for p in (("lex:A_Par_1", "lex:A2_Par_1"), ("lex:A_Par_1", "lex:B_Par_1"), ("lex:C_Par_1", "lex:C_Par_2"))}


def test_not_yet_present(spark):
    wanted = spark.createDataFrame([("abc",), ("abcd",), ("x" * 20 + "one",), ("x" * 20 + "two",), ("y" * 20 + "one",), ("zz",), (None,)], "slug string")
    present = spark.createDataFrame([("abc_osa1",), ("x" * 20 + "three",), ("z",), (None,)], "slug string")
    got = {r.slug for r in R.not_yet_present(wanted, "slug", present).collect()}
    assert got == {"abcd", "y" * 20 + "one", "zz", None}
    assert R.not_yet_present(wanted, "slug", present.limit(0)).count() == 7


def test_keyword_hits(spark):
    from lexgraph.operators import classify as C

    d = spark.createDataFrame([("tax", "maks", False, 2), ("tax", "aktsiis", False, 2), ("law", "k[o]hus", True, 1), ("dot", "a.b", False, 1), ("env", "vesi", False, 1)], "code string, keyword string, is_pattern boolean, threshold int")
    t = spark.createDataFrame([(1, "Maks ja AKTSIIS, kohus kohus kohus"), (2, "maks"), (3, None), (4, "axb a.b vesi"), (5, "vesi vesi kohus")], "id int, text string")
    got = [(r.id, r.code, r.hits, r["rank"]) for r in C.keyword_hits(t, "id", "text", d, 2).orderBy("id", "rank").collect()]
    assert got == [(1, "law", 3, 1), (1, "tax", 2, 2), (4, "dot", 1, 1), (4, "env", 1, 2), (5, "env", 2, 1), (5, "law", 1, 2)]
    assert C.keyword_hits(t, "id", "text", d.limit(0)).count() == 0


def test_near_terms(spark):
    c = spark.createDataFrame([("1", "kaubad", 1), ("2", "kaubas", 2), ("3", "kaup", 3), ("4", "kaubadega", 4), ("5", "kabadd", 5)], "iri string, term_lower string, ord int")
    assert {(r.src, r.dst, r.distance) for r in S.near_terms(c).collect()} == {("1", "2", 1), ("1", "5", 2)}
    assert S.near_terms(c, most_terms=2).count() == 0


def test_edges(spark):
    f = spark.createDataFrame([("a", "b"), ("a", "b"), ("c", "x"), ("b", "c")], "src string, dst string")
    back = G.invert(f.where("src = 'a'"), "inverse")
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "iri string")
    assert back.count() == 1
    assert {(r.src, r.dst, r.issue) for r in G.symmetry_issues(f, back, nodes).collect()} == {("c", "x", "missing target"), ("b", "c", "no inverse")}
    assert [(r.dst, r.n) for r in G.in_degree(f, 2).collect()] == [("b", 2), ("c", 1)]
    p = spark.createDataFrame([("k1", "k2"), ("k2", "k3")], "cls string, parent string")
    assert {(r.cls, r.ancestor, r.distance) for r in G.subclass_closure(p, 2).where("distance > 0").collect()} == {("k1", "k2", 1), ("k2", "k3", 1), ("k1", "k3", 2)}


def test_duplicates(spark):
    n = spark.createDataFrame(
        [("law_osa1_peep.json", 0, "lex:L_Par_1"), ("law_osa2_peep.json", 0, "lex:L_Par_1"), ("x_act_peep.json", 0, "lex:S_Par_5"), ("y_act_peep.json", 0, "lex:S_Par_5"), ("y_act_peep.json", 1, "lex:Q"), ("y_act_peep.json", 2, "lex:Q")],
        "file_name string, pos int, iri string")
    e = spark.createDataFrame([("x_act_peep.json", "lex:S_Par_5", "ref", "lex:L_Par_1"), ("y_act_peep.json", "lex:S_Par_5", "ref", "lex:Q")], "file_name string, src string, pred string, dst string")
    nodes, edges, left = P.repair(n, e, "lex")
    assert left.count() == 0
    assert {r.iri for r in nodes.collect()} == {"lex:L_Osa1_Par_1", "lex:L_Osa2_Par_1", "lex:x_act_Par_5", "lex:y_act_Par_5", "lex:Q", "lex:Q_dup2"}
    assert {(r.src, r.dst) for r in edges.collect()} == {("lex:x_act_Par_5", "lex:L_Osa2_Par_1"), ("lex:y_act_Par_5", "lex:Q")}


def test_windows(spark):
    d = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("a", 3)], "iri string, o int")
    assert sorted(r.iri for r in U.suffix_collisions(d, "iri", ["o"]).collect()) == ["a", "a_2", "a_3", "b"]
    s = spark.createDataFrame([("l", 0, "p1"), ("l", 1, "p76"), ("l", 2, "p76"), ("l", 3, "p76")], "law string, o int, iri string")
    assert [r.iri for r in U.suffix_seen(s, ["law"], "iri", ["o"]).orderBy("o").collect()] == ["p1", "p76", "p76_2", "p76_3"]
    assert [r.v for r in U.capped_list(d, ["iri"], "o", ["o"], 2, "v").orderBy("iri").collect()] == [[1, 2], [1]]


def test_shapes(spark):
    types = spark.createDataFrame([("d1", "Draft"), ("d2", "Draft")], "iri string, type string")
    values = spark.createDataFrame([("d1", "label", "x", "string"), ("d1", "link", "a", "string"), ("d1", "link", "b", "string"), ("p", "paragrahv", "1", "string"), ("p", "ref", "x", "string")], "iri string, path string, value string, datatype string")
    rules = spark.createDataFrame([("D", "Draft", "label", 1, None, "string", None), ("D", "Draft", "link", None, 1, None, None), ("P", "@paragrahv", "ref", None, None, None, "IRI"), ("P", "@paragrahv", "summary", 1, None, None, None)], "shape string, target string, path string, least int, most int, datatype string, kind string")
    got = {(r.iri, r.path, r.kind) for r in V.violations(values, types, rules).collect()}
    assert got == {("d2", "label", "minCount"), ("d1", "link", "maxCount"), ("p", "ref", "nodeKind"), ("p", "summary", "minCount")}
    assert V.rules(spark).count() > 40


def test_fuzzy(spark):
    laws = spark.createDataFrame([("alkoholiseadus", "alkoholiseadus", "alkoholiseadus", 0), ("isikuandmete kaitse seadus", "isikuandmete kaitse seadus", "x", 1)], "key string, source_act string, slug string, ord int")
    m = spark.createDataFrame([("Alkoholiseadus",), ("Isikuandmete kaitse seadus (RT)",), ("vastavalt isikuandmete kaitse seadus jne",), ("muu",)], "title string")
    got = {r.title: (r.key, r.tier) for r in R.measure_to_law(m, laws).collect()}
    assert got["Alkoholiseadus"] == ("alkoholiseadus", 1) and got["Isikuandmete kaitse seadus (RT)"] == ("isikuandmete kaitse seadus", 2)
    assert got["vastavalt isikuandmete kaitse seadus jne"] == ("isikuandmete kaitse seadus", 3) and got["muu"] == (None, None)
    d = spark.createDataFrame([("Liiklusseaduse",), ("liiklus",), ("zzz",)], "law_name string")
    reg = spark.createDataFrame([("liiklusseadus", "liiklusseadus", 0)], "title_lower string, slug string, ord int")
    assert {r.law_name: r.slug for r in R.name_to_slug(d, reg).collect()} == {"Liiklusseaduse": "liiklusseadus", "liiklus": "liiklusseadus", "zzz": None}
    assert F is not None


def test_prefixes():
    laws = [{"slug": "a" * 45, "abbrev": "ABCD"}, {"slug": "a" * 45 + "x", "abbrev": "ABCD"}, {"slug": "b", "abbrev": "PS"}, {"slug": "r"}]
    assert P.assign_prefixes(laws, {"r": "REG"}) == {"r": "REG", "a" * 45: "ABCD", "a" * 45 + "x": "a" * 40, "b": "b"}
