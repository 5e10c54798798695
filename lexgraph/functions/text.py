"""Scalar functions on text, identifiers and dates, all as Column expressions (one exception: NFKD).

Java's regular expressions need (?U) for Unicode word characters and borders; every pattern below sets it.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import ACRONYM_STOPS, INSTITUTION_KEYS, NUMBER_WORDS, STOPWORDS, TREATY_MARKS


def literal_map(values: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))


def look_up(values: dict, key: Column) -> Column:
    """The value of a constant map, null for other keys."""
    return F.try_element_at(literal_map(values), key)


def quote(text: str) -> str:
    """A Java pattern that matches the text itself."""
    return re.sub(r"([\\.^$|?*+(){}\[\]])", r"\\\1", text)


def translit(c: Column) -> Column:
    return F.translate(c, "öäüõÖÄÜÕšžŠŽ", "oauoOAUOszSZ")


def sanitize_id(c: Column, separators: str = " ", other: str = "", keep: str = "_", cut: int | None = None) -> Column:
    """An identifier from text: separators become _, accents go, and characters besides letters, digits and `keep` become
    `other`; an empty result is Unknown. The variants of the sources differ in these parameters only."""
    s = F.translate(c, separators, "_" * len(separators)) if separators else c
    s = F.regexp_replace(translit(s), f"[^0-9A-Za-z{keep}]", other)
    s = F.left(s, F.lit(cut)) if cut else s
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("Unknown"))


def sanitize_celex(c: Column) -> Column:
    return sanitize_id(c, separators="", keep="", cut=40)


def slugify(c: Column) -> Column:
    s = F.regexp_replace(F.trim(F.lower(translit(c))), "[^a-z0-9]+", "_")
    return F.left(F.regexp_replace(s, "^_+|_+$", ""), F.lit(80))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalize_law_name(c: Column) -> Column:
    s = F.trim(F.lower(c))
    s = F.regexp_replace(s, r"(?U)seaduse\b", "seadus")
    s = F.regexp_replace(s, r"(?U)seadustiku\b", "seadustik")
    return F.regexp_replace(F.regexp_replace(s, r"(?U)[\s,;.]+$", ""), r"(?U)\s+", " ")


def normalize_text(c: Column) -> Column:
    """Lower case, compatibility decomposition (marks stay), single spaces. Spark has no builtin for the decomposition."""

    @F.pandas_udf("string")
    def decompose(s):
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x))

    return F.regexp_replace(decompose(F.trim(F.lower(c))), r"(?U)\s+", " ")


def extract_law_name(c: Column) -> Column:
    t = F.trim(c)
    head = F.regexp_extract(t, r"(?iU)^(.+?\s*seadus(?:tik)?)\b", 1)
    return F.when(t.rlike(r"(?iU)seadus(?:tik)?$"), t).otherwise(F.nullif(F.trim(head), F.lit("")))


def institution_key(c: Column) -> Column:
    k = F.lower(c)
    return F.coalesce(look_up(INSTITUTION_KEYS, k), k)


def parse_date(c: Column) -> Column:
    """Dates as the gazette writes them: ISO, day first with dots, date-times, zone offsets even in the middle."""
    s = F.regexp_replace(F.regexp_replace(F.trim(c), r"\+\d{2}:\d{2}", ""), r"-\d{2}:\d{2}$", "")
    iso = F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(s, "y-M-d"))
    dots = F.when(s.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"), F.try_to_date(s, "d.M.y"))
    stamp = F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$"), F.try_to_date(F.substring_index(s, "T", 1), "y-M-d"))
    return F.coalesce(iso, dots, stamp)


def rss_parts(title: Column) -> Column:
    """struct(eis, ministry, date, title) of a draft feed's title `Text - MIN/YY-NNNN (DD.MM.YYYY)`; parts may be null."""
    tail = r"-\s*([A-ZÄÖÜÕa-z]+/\d{2}-\d{4})\s*\((\d{2}\.\d{2}\.\d{4})\)\s*$"
    eis = F.nullif(F.regexp_extract(title, tail, 1), F.lit(""))
    return F.struct(
        eis.alias("eis"), F.substring_index(eis, "/", 1).alias("ministry"), parse_date(F.nullif(F.regexp_extract(title, tail, 2), F.lit(""))).alias("date"),
        F.trim(F.regexp_replace(title, r"\s*" + tail, "")).alias("title"),
    )


def link_uuid(link: Column) -> Column:
    return F.nullif(F.regexp_extract(link, "/docList/([0-9a-f-]{36})", 1), F.lit(""))


def eu_case_number(title: Column) -> Column:
    one = r"[CTFP]-\d+/\d+"
    return F.nullif(F.regexp_extract(title, rf"({one}(?:\s+ja\s+{one})*)", 1), F.lit(""))


def clean_title(title: Column) -> Column:
    parts = F.filter(F.transform(F.split(title, "#"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(parts) > 0, F.array_join(parts, " — ")).otherwise(title)


_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&ndash;", "–"), ("&auml;", "ä"), ("&ouml;", "ö"), ("&uuml;", "ü"), ("&otilde;", "õ"), ("&amp;", "&"))


def html_text(c: Column) -> Column:
    """Text of an HTML fragment: tags out, blanks collapsed, entities resolved (the common names, else by Arrow UDF)."""
    s = F.regexp_replace(F.trim(F.regexp_replace(c, "<[^>]+>", "")), r"(?U)\s+", " ")
    for name, sign in _ENTITIES:
        s = F.replace(s, F.lit(name), F.lit(sign))
    return s


def html_unescape(c: Column) -> Column:
    """Every HTML entity, by an Arrow UDF; used where the common names of html_text do not do."""

    @F.pandas_udf("string")
    def unescape(s):
        import html

        return s.map(lambda x: None if x is None else html.unescape(x))

    return unescape(c)


def uri_tail(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def expand_range(c: Column, widest: int = 50) -> Column:
    """Numbers of `208-210`. A range that descends is empty; one wider than `widest`, and a plain number, is its digits."""
    s = F.translate(c, "–‑", "--")
    a = F.trim(F.substring_index(s, "-", 1)).try_cast("int")
    b = F.trim(F.regexp_extract(s, "^[^-]*-(.*)$", 1)).try_cast("int")
    digits = F.regexp_replace(s, "[^0-9]", "")
    whole = F.when(digits != "", F.array(digits)).otherwise(F.array().cast("array<string>"))
    span = F.when(b >= a, F.transform(F.sequence(a, b), lambda x: x.cast("string"))).otherwise(F.array().cast("array<string>"))
    return F.when(s.contains("-") & (b - a <= widest), span).otherwise(whole)


def strip_zeros(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(c, "^0+", ""), F.lit("")), F.lit("0"))


def digits_int(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "").try_cast("int")


def number_word(c: Column) -> Column:
    return look_up(NUMBER_WORDS, F.lower(c))


def number(c: Column) -> Column:
    """A number in digits or as a word."""
    return F.coalesce(F.when(c.rlike("^[0-9]+$"), c.try_cast("int")), number_word(c))


def singular(c: Column) -> Column:
    one = F.regexp_extract(c, r"^1\s+(year|day|daily rate|fine unit)s$", 1)
    return F.when(one != "", F.concat(F.lit("1 "), one)).otherwise(c)


def keywords(c: Column, least: int = 4, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    """The set of telling words of a text, in order of appearance."""
    words = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"[a-zäöüõšž]{{{max(1, least)},}}"), F.lit(0))
    stop = F.array(*(F.lit(w) for w in stopwords)) if stopwords else F.array().cast("array<string>")
    return F.array_except(words, stop)


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), common / (F.size(a) + F.size(b) - common)).otherwise(0.0)


def round_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def pattern_score(c: Column, patterns) -> Column:
    """Sum of the weights of the patterns that occur, each once."""
    total = F.lit(0)
    for pattern, weight in patterns:
        total = total + F.when(c.rlike(f"(?iU){pattern}"), weight).otherwise(0)
    return total


def bucket(c: Column) -> Column:
    """Lower border of the tenth that a similarity falls in, as text."""
    return F.format_string("%.1f", F.floor(c * 10) / 10)


def percentage(part: Column, whole: Column) -> Column:
    return F.format_string("%.1f%%", F.when(whole > 0, 100.0 * part / whole).otherwise(0.0))


def acronym(title: Column, slug: Column) -> Column:
    """A short name of an act: initials of its telling words, the year for treaties, at least 3 and at most 12 signs."""
    words = F.regexp_extract_all(translit(title), F.lit("[A-Za-z]+"), F.lit(0))
    stop = F.array(*(F.lit(w) for w in ACRONYM_STOPS))
    initials = F.array_join(F.transform(F.filter(words, lambda w: ~F.array_contains(stop, F.lower(w))), lambda w: F.upper(F.left(w, F.lit(1)))), "")
    year = F.regexp_extract(title, r"(\d{4})", 1)
    treaty = F.lit(False)
    for mark in TREATY_MARKS:
        treaty = treaty | slug.contains(mark)
    short = F.when(treaty & (year != ""), F.concat(F.left(initials, F.lit(8)), year)).otherwise(initials)
    spare = F.upper(F.regexp_replace(F.left(slug, F.lit(6)), "[^a-z0-9]", ""))
    spare = F.when(F.length(spare) >= 3, spare).otherwise(F.upper(F.left(slug, F.lit(8))))
    return F.left(F.when(F.length(short) < 3, spare).otherwise(short), F.lit(12))


def fix_par(c: Column) -> Column:
    return F.regexp_replace(c, r"_Par(\d)", "_Par_$1")


# ---- identifiers


def is_provision(iri: Column, prefix: str) -> Column:
    return iri.startswith(f"{prefix}:") & iri.contains("_Par_")


def provision_prefix(iri: Column) -> Column:
    """Everything before the first _Par_, the whole identifier if it has none."""
    return F.substring_index(iri, "_Par_", 1)


def provision_key(iri: Column) -> Column:
    """What stands between the first and the second _Par_."""
    return F.get(F.split(iri, "_Par_"), F.lit(1))


def base_slug(slug: Column) -> Column:
    return F.regexp_replace(slug, r"_osa\d+.*$", "")


def label(title: Column, text: Column, display: Column) -> Column:
    """Title, else an 80-character excerpt, else the display number."""
    excerpt = F.when(F.length(text) > 80, F.concat(F.rtrim(F.left(text, F.lit(80))), F.lit("..."))).otherwise(text)
    return F.coalesce(F.nullif(title, F.lit("")), F.nullif(excerpt, F.lit("")), display)
