from datetime import date

import pytest
from pyspark.sql import functions as F

from lexgraph.functions import text as T


def one(spark, column, *values):
    names = "abc"[: len(values)]
    return spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names)).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("value", "want"),
    [("121", ["121"]), ("208-210", ["208", "209", "210"]), ("208–210", ["208", "209", "210"]), ("208-300", ["208300"]), ("10-5", []), ("7 - 9", ["7", "8", "9"])],
)
def test_expand_range(spark, value, want):
    assert one(spark, T.expand_range(F.col("a")), value) == want


@pytest.mark.parametrize(
    ("value", "want"),
    [("2017-02-26", date(2017, 2, 26)), ("2017-02-26+02:00", date(2017, 2, 26)), ("26.02.2017", date(2017, 2, 26)), ("2011+02:00-01-01", date(2011, 1, 1)), ("1.2.2003", date(2003, 2, 1)), ("2017-02-26T10:00:00", date(2017, 2, 26)), ("2017-02-30", None), ("n.d.", None), (None, None)],
)
def test_parse_date(spark, value, want):
    assert one(spark, T.parse_date(F.col("a")), value) == want


def test_identifiers(spark):
    assert one(spark, T.sanitize_id(F.col("a")), "Öö ja š-ž!") == "Oo_ja_sz"
    assert one(spark, T.sanitize_id(F.col("a"), " -"), "Öö ja š-ž!") == "Oo_ja_s_z"
    assert one(spark, T.sanitize_id(F.col("a"), "/-", other="_"), "3-1-1/5 x") == "3_1_1_5_x"
    assert one(spark, T.sanitize_id(F.col("a")), "!!") == "Unknown"
    assert one(spark, T.sanitize_celex(F.col("a")), "32014L0104(01)") == "32014L010401"
    assert one(spark, T.slugify(F.col("a")), " Võla-õigus seadus! ") == "vola_oigus_seadus"
    assert one(spark, T.provision_key(F.col("a")), "lex:AOS_Par_92_asja_Par_2") == "92_asja"
    assert one(spark, T.provision_prefix(F.col("a")), "lex:AOS_Par_92_x") == "lex:AOS"
    assert one(spark, T.strip_zeros(F.col("a")), "0012") == "12"
    assert one(spark, T.strip_zeros(F.col("a")), "000") == "0"


def test_names(spark):
    assert one(spark, T.normalize_law_name(F.col("a")), "Riigilõivuseaduse ,") == "riigilõivuseadus"
    assert one(spark, T.extract_law_name(F.col("a")), "Alkoholiseadus") == "Alkoholiseadus"
    assert one(spark, T.extract_law_name(F.col("a")), "Isikuandmete kaitse seadus (RT I)") == "Isikuandmete kaitse seadus"
    assert one(spark, T.extract_law_name(F.col("a")), "määrus") is None
    assert one(spark, T.normalize_text(F.col("a")), "  Õigus  ") == "o\u0303igus"
    assert one(spark, T.eu_case_number(F.col("a")), "Kohtuasi C-438/14") == "C-438/14"
    assert one(spark, T.clean_title(F.col("a")), "a#  #b ") == "a — b"
    assert one(spark, T.html_text(F.col("a")), "<b>x &amp;</b>  y") == "x & y"
    assert one(spark, T.html_unescape(F.col("a")), "&Otilde;&#228;") == "Õä"
    r = one(spark, T.rss_parts(F.col("a")), "Uue seaduse eelnõu - JDM/24-0123 (05.02.2024)")
    assert (r.eis, r.ministry, r.date, r.title) == ("JDM/24-0123", "JDM", date(2024, 2, 5), "Uue seaduse eelnõu")
    assert one(spark, T.rss_parts(F.col("a")), "Ilma numbrita").eis is None


@pytest.mark.parametrize(
    ("title", "slug", "check"),
    [
        ("Alkoholi-, tubaka-, kütuse- ja elektriaktsiisi seadus", "alkoholi_tubaka_kutuse_ja_elektriaktsiisi_seadus", lambda x: x == "ATKE"),
        ("1974. aasta rahvusvahelise konventsiooni inimelude ohutusest merel protokoll", "1974_aasta_rahvusvahelise_konventsiooni", lambda x: x.endswith("1974") and len(x) <= 12),
        ("Seadus", "seadus", lambda x: 3 <= len(x) <= 12),
        ("Väga pikk nimetus mille sisu on keeruline ja raske kirjeldada", "vaga_pikk", lambda x: len(x) <= 12),
        ("Öökülma tõrje ühingu põhikiri", "ookulma_torje_uhingu_pohikiri", lambda x: x == "OTUP"),
        ("Arhiiviseadus", "arhiiviseadus", lambda x: len(x) >= 3),
    ],
)
def test_acronym(spark, title, slug, check):
    assert check(one(spark, T.acronym(F.col("a"), F.col("b")), title, slug))


def test_small_ones(spark):
    assert one(spark, T.fix_par(F.col("a")), "VOS_Par271") == "VOS_Par_271"
    assert one(spark, T.fix_par(F.col("a")), "VOS_Par_271") == "VOS_Par_271"
    assert one(spark, T.singular(F.col("a")), "1 years") == "1 year"
    assert one(spark, T.singular(F.col("a")), "1 daily rates") == "1 daily rate"
    assert one(spark, T.singular(F.col("a")), "11 years") == "11 years"
    assert one(spark, T.keywords(F.col("a")), "Seadus kaitseb keskkonda ja keskkonda, loodus!") == ["kaitseb", "keskkonda", "loodus"]
    assert one(spark, T.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c"))), "x") == pytest.approx(1 / 3)
    assert one(spark, T.round_even(F.lit(0.3125), 3), "x") == 0.312
    assert one(spark, T.bucket(F.lit(0.37)), "x") == "0.3"
    assert one(spark, T.percentage(F.lit(1), F.lit(3)), "x") == "33.3%"
    assert one(spark, T.number(F.col("a")), "Viie") == 5
    assert one(spark, T.label(F.col("a"), F.col("b"), F.col("c")), "", "x" * 90, "§ 1") == "x" * 80 + "..."
