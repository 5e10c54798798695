import pytest
from pyspark.sql import functions as F

from lexgraph.operators import classify as C
from lexgraph.operators import extract as X


def frame(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("KarS § 121", [("KarS", False, ["121"])]), ("KarS § 121 lg 2 p 3", [("KarS", False, ["121"])]), ("VÕS §-de 208-210", [("VÕS", False, ["208", "209", "210"])]),
        ("käesoleva seaduse § 12", [(None, True, ["12"])]), ("tsiviilseadustiku üldosa seaduse § 67", [("TsÜS", False, ["67"])]), ("xKarS §§ 1–2", [("KarS", False, ["1", "2"])]), ("kars § 1", []), (None, []), ("", []),
    ],
)
def test_citations(spark, text, want):
    rows = X.citations(frame(spark, text)).orderBy("pattern", "ord").collect()
    assert [(r.law_ref, r.is_self, r.paragraphs) for r in rows] == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("kuue- kuni viieteistaastase vangistusega", [("imprisonment", "15 years", "6 years")]), ("kuni viieaastase vangistusega", [("imprisonment", "5 years", None)]),
        ("rahatrahviga kuni kolmsada trahviühikut", [("fine", "300 fine units", None)]), ("karistatakse arestiga", [("arrest", "30 days", None)]),
        ("sunniraha kuni 2 000 eurot", [("coercive_payment", "2000 EUR", None)]), ("sunniraha", [("coercive_payment", None, None)]),
        ("karistatakse rahalise karistusega või kuni 3-aastase vangistusega", [("imprisonment", "3 years", None), ("pecuniary_punishment", "500 daily rates", None)]),
        ("eluaegse vangistusega", [("imprisonment", "life", None)]), ("vangistus 30", [("imprisonment", "30 months", None)]), (None, []), ("midagi", []),
    ],
)
def test_sanctions(spark, text, want):
    rows = X.sanctions(frame(spark, text)).orderBy("ord").collect()
    assert [(r.sanction_type, r.max_penalty, r.min_penalty) for r in rows] == want


def test_labels(spark):
    d = spark.createDataFrame([("imprisonment", "5 years", None, "KarS § 121"), ("imprisonment", "life", None, ""), ("fine", "3 years", "1 years", None)], "k string, m string, l string, r string")
    got = [r.x for r in d.select(X.sanction_label(F.col("k"), F.col("m"), F.col("l"), F.col("r")).alias("x")).collect()]
    assert got == ["Imprisonment, max 5 years (KarS § 121)", "Imprisonment, life", "Fine, 1 year to 3 years"]


def test_definitions_and_holders(spark):
    d = X.definitions(frame(spark, "1) kaup – asi mida müüakse; 2) a – b; 3) muu aine - mingi selgitus")).orderBy("def_number").collect()
    assert [(r.def_number, r.term, r.definition) for r in d] == [("1", "kaup", "asi mida müüakse"), ("3", "muu aine", "mingi selgitus")]
    f = frame(spark, "Tööandja peab tasuma", "Käesolev seadus tuleb", "midagi").select(X.duty_holder(F.col("text")).alias("x"))
    assert [r.x for r in f.collect()] == ["Tööandja", None, None]


def test_institutions(spark):
    got = X.institutions(frame(spark, "Riigikohus ja kohus, MTA ning Kaitseministeerium; kohaliku omavalitsuse linn")).collect()
    assert {(r.suffix, r.institution_type) for r in got} == {("maksu__ja_tolliamet", "agency"), ("riigikohus", "court"), ("kaitseministeerium", "ministry"), ("kohalik_omavalitsus", "local_government"), ("linn", "local_government")}


def test_classes(spark):
    rows = [("ta võib", "Right"), ("on kohustatud ja võib", "Obligation"), ("ei tohi", "Prohibition"), ("on lubatud", "Permission"), ("näoõigus on", None), ("midagi", None)]
    got = frame(spark, *(t for t, _ in rows)).select(C.norm_type(F.col("text")).alias("x")).collect()
    assert [r.x for r in got] == [w for _, w in rows]
    rows = [("Liiklusseaduse muutmise seaduse eelnõu", "AmendmentBill"), ("Uus seadus", "Bill"), ("Vabariigi Valitsuse määrus", "GovernmentRegulation"), ("ministri määrus", "MinisterialRegulation"), ("määrus", "Regulation"), ("korraldus", "GovernmentOrder"), ("Eesti seisukoht", "EUPosition"), ("ülevaade", "Report"), ("kodakondsus", "CitizenshipDecision"), ("kavatsus", "DraftIntent"), ("strateegia", "ActionPlan"), ("muu", "Other")]
    got = frame(spark, *(t for t, _ in rows)).select(C.draft_type(F.col("text")).alias("x")).collect()
    assert [r.x for r in got] == [w for _, w in rows]
    rows = [("62014CJ0438", ("Judgment", "CourtOfJustice", "judgments")), ("62014TO0001", ("Order", "GeneralCourt", "orders")), ("62014ZZ0001", ("Other", "CourtOfJustice", "other")), ("x", ("Other", "CourtOfJustice", "other"))]
    got = frame(spark, *(t for t, _ in rows)).select(C.celex(F.col("text")).alias("x")).collect()
    assert [tuple(r.x) for r in got] == [w for _, w in rows]


def test_temporal(spark):
    d = spark.createDataFrame([("2025-12-31", None, None), (None, "2026-01-01", None), (None, None, "2026-01-02"), (None, None, None)], "i string, u string, e string")
    day = lambda c: F.col(c).cast("date")
    got = d.select(C.temporal_status(day("i"), day("u"), day("e"), F.lit("2026-01-01").cast("date")).alias("x")).collect()
    assert [r.x for r in got] == ["repealed", "repealed", "notYetEffective", "inForce"]
