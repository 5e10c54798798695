"""Extractors: citations, law mentions, definitions, sanctions, institutions, gazette references. One row in, many out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T

_SELF = r"k[äa]esoleva\s+seadus(?:e|tiku)?\s*"


def _longest_first(names) -> str:
    return "|".join(T.quote(n) for n in sorted(names, key=len, reverse=True))


def _all(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def citations(df: DataFrame, text: str = "text", self_references: bool = True, abbreviations=None, genitives=None, keep_empty: bool = True) -> DataFrame:
    """A row per citation in df[text], with all columns of df: pattern (1 abbreviation, 2 self, 3 genitive name), ord,
    law_ref, is_self and the array of paragraphs. No border is asked for before an abbreviation; abbreviations match
    in their case, the other two in any. With keep_empty false, citations without paragraphs are left out."""
    abbreviations, genitives = abbreviations or K.ABBREVIATIONS, genitives or K.GENITIVES
    c = F.coalesce(F.col(text), F.lit(""))
    tail = rf"\s*{K.SECTION}\s*{K.NUMBERS}"
    families = [(1, rf"(?U)({_longest_first(abbreviations)}){tail}")]
    families += [(2, rf"(?iU)({_SELF}){K.SECTION}\s*{K.NUMBERS}")] if self_references else []
    families += [(3, rf"(?iU)({_longest_first(genitives)}){tail}")]
    hits = F.concat(*(_family(c, n, p) for n, p in families))
    rows = df.withColumn("_hit", F.explode(hits)).select(*df.columns, "_hit.*")
    ref = F.when(F.col("pattern") == 1, F.col("ref")).when(F.col("pattern") == 3, T.look_up(genitives, F.lower("ref")))
    rows = rows.select(*df.columns, "pattern", "ord", ref.alias("law_ref"), (F.col("pattern") == 2).alias("is_self"), T.expand_range(F.trim("num")).alias("paragraphs"))
    return rows if keep_empty else rows.where(F.size("paragraphs") > 0)


def _family(c: Column, n: int, pattern: str) -> Column:
    found = F.arrays_zip(_all(c, pattern, 1).alias("ref"), _all(c, pattern, 2).alias("num"))
    return F.transform(found, lambda z, i: F.struct(F.lit(n).alias("pattern"), i.alias("ord"), z["ref"].alias("ref"), z["num"].alias("num")))


def law_mentions(c: Column) -> Column:
    """Distinct law names that a court summary cites, abbreviations first."""
    short = "|".join(list(K.ABBREVIATIONS)[:15])  # the codes that courts cite by abbreviation come first
    return F.array_distinct(F.concat(_all(c, rf"(?iU)({short})\s*§\s*[\d\-]+", 1), _all(c, K.LAW_BEFORE_SECTION, 1)))


def affected_laws(title: Column) -> Column:
    """Distinct laws that a draft's title says it changes."""
    found = F.concat(*(_all(title, rf"(?iU)(\w+(?:\s+\w+)*?\s+{p}", 1) for p in (r"seaduse)\s+(?:muutmi|täiendami)", r"seadustiku)\s+(?:muutmi|täiendami)", r"seadus)\b", r"seadustik)\b")))
    return F.array_distinct(F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: ~F.lower(x).contains("eelnõu") & (F.length(x) > 5)))


def gazette_references(c: Column) -> Column:
    found = _all(c, K.GAZETTE, 0)
    return F.array_distinct(F.transform(found, T.collapse))


def duty_holder(c: Column) -> Column:
    who = F.trim(F.regexp_extract(c, f"(?U){K.HOLDER}", 1))
    return F.when((who != "") & ~F.regexp_extract(who, r"(?U)^(\S+)", 1).isin(*K.NOBODY), who)


def is_definition_section(title: Column, text: Column) -> Column:
    titled = F.lit(False)
    for t in K.DEFINITION_TITLES:
        titled = titled | F.lower(F.coalesce(title, F.lit(""))).contains(t)
    return titled | F.lower(F.coalesce(text, F.lit(""))).rlike("(?U)" + "|".join(K.DEFINITION_INTROS))


def definitions(df: DataFrame, text: str = "text") -> DataFrame:
    """A row per numbered definition: def_number, term, definition."""
    c, p = F.col(text), f"(?Ud){K.DEFINITION}"
    rows = df.withColumn("_d", F.explode(F.arrays_zip(_all(c, p, 1).alias("n"), _all(c, p, 2).alias("t"), _all(c, p, 3).alias("d"))))
    rows = rows.select(*df.columns, F.col("_d.n").alias("def_number"), F.trim("_d.t").alias("term"), F.trim("_d.d").alias("definition"))
    return rows.where((F.length("term") >= 2) & (F.length("definition") >= 5) & ~F.col("term").rlike(r"^\d+$"))


# ---- sanctions

_YEARS = r"\s*[\-\s]*aasta(?:se)?\s+vangistus"
_SANCTION = "struct<sanction_type:string,max_penalty:string,min_penalty:string>"


def _sanction(kind: str, most: Column | None = None, least: Column | None = None) -> Column:
    null = F.lit(None).cast("string")
    return F.struct(F.lit(kind).alias("sanction_type"), (null if most is None else most.cast("string")).alias("max_penalty"), (null if least is None else least.cast("string")).alias("min_penalty"))


def _none() -> Column:
    return F.array().cast(f"array<{_SANCTION}>")


def _unless_said(found: Column, more: Column) -> Column:
    """Appends candidates one by one unless their maximum is already the maximum or minimum of an earlier one."""
    said = lambda s, x: F.exists(s, lambda y: F.coalesce(y.max_penalty == x.max_penalty, F.lit(False)) | F.coalesce(y.min_penalty == x.max_penalty, F.lit(False)))
    return F.aggregate(more, found, lambda s, x: F.when(said(s, x), s).otherwise(F.concat(s, F.array(x))))


def _unit(c: Column, unit: str) -> Column:
    return F.concat(c.cast("string"), F.lit(f" {unit}"))


def imprisonment(c: Column) -> Column:
    """Stages: life; range in words; maximum in words; range and maximum in digits; two digit fallbacks."""
    kind = "imprisonment"
    life = F.when(c.rlike(K.LIFE_IMPRISONMENT), F.array(_sanction(kind, F.lit("life")))).otherwise(_none())
    words = K.YEARS_IN_WORDS_RANGE
    pairs = F.transform(F.arrays_zip(_all(c, words, 1).alias("a"), _all(c, words, 2).alias("b")), lambda z: F.struct(T.number(z["a"]).alias("a"), T.number(z["b"]).alias("b")))
    both = F.filter(pairs, lambda z: z["a"].isNotNull() & z["b"].isNotNull())
    found = F.concat(life, F.transform(both, lambda z: _sanction(kind, _unit(z["b"], "years"), _unit(z["a"], "years"))))
    upto = F.filter(F.transform(_all(c, K.YEARS_IN_WORDS, 1), T.number), lambda x: x.isNotNull())
    found = _unless_said(found, F.transform(upto, lambda x: _sanction(kind, _unit(x, "years"))))
    digits = r"(?iU)(\d+)\s*[\-–—]?\s*kuni\s+(\d+)" + _YEARS
    found = _unless_said(found, F.transform(F.arrays_zip(_all(c, digits, 1).alias("a"), _all(c, digits, 2).alias("b")), lambda z: _sanction(kind, _unit(z["b"], "years"), _unit(z["a"], "years"))))
    for pattern in (r"(?iU)kuni\s+(\d+)" + _YEARS, K.YEARS_NEAR_PUNISHED):
        found = _unless_said(found, F.transform(_all(c, pattern, 1), lambda x: _sanction(kind, _unit(x, "years"))))
    months = lambda x: _sanction(kind, F.when(x.try_cast("int") <= 20, _unit(x, "years")).otherwise(_unit(x, "months")))
    return _unless_said(found, F.transform(_all(c, K.IMPRISONMENT_NUMBER, 1), months))


def pecuniary(c: Column) -> Column:
    return F.when(c.rlike(K.PECUNIARY), F.array(_sanction("pecuniary_punishment", F.lit("500 daily rates")))).otherwise(_none())


def fines(c: Column) -> Column:
    head = r"(?iU)(?:raha)?trahv(?:iga)?\s+(?:kuni\s+)?"
    units = F.concat(
        _all(c, head + r"(\d+)\s+trahviühiku", 1),
        F.transform(F.filter(_all(c, head + r"(\w+)\s+trahviühiku", 1), lambda x: ~x.rlike("^[0-9]+$") & T.number_word(x).isNotNull()), lambda x: T.number_word(x).cast("string")),
    )
    euros = F.transform(_all(c, K.FINE_IN_EUROS, 1), lambda x: F.replace(x, F.lit(" "), F.lit("")))
    return F.concat(
        F.transform(F.array_distinct(units), lambda x: _sanction("fine", _unit(x, "fine units"))),
        F.transform(F.array_distinct(euros), lambda x: _sanction("fine", _unit(x, "EUR"))),
    )


def coercive(c: Column) -> Column:
    sums = F.transform(_all(c, K.COERCIVE_IN_EUROS, 1), lambda x: _sanction("coercive_payment", _unit(F.replace(x, F.lit(" "), F.lit("")), "EUR")))
    return F.when(F.size(sums) > 0, sums).when(c.rlike(K.COERCIVE), F.array(_sanction("coercive_payment"))).otherwise(_none())


def arrest(c: Column) -> Column:
    days = _all(c, K.ARREST_DAYS, 1)
    words = F.filter(F.transform(_all(c, K.ARREST_DAYS_IN_WORDS, 1), T.number_word), lambda x: x.isNotNull())
    of = lambda a: F.transform(a, lambda x: _sanction("arrest", _unit(x, "days")))
    return F.when(F.size(days) > 0, of(days)).when(F.size(words) > 0, of(words)).when(c.rlike(K.ARREST), F.array(_sanction("arrest", F.lit("30 days")))).otherwise(_none())


def penalty_fallback(c: Column, kind: Column) -> Column:
    """Maximum penalty by type where the extractor gave none."""
    years = F.coalesce(F.nullif(F.regexp_extract(c, K.ANY_YEARS, 1), F.lit("")), T.number_word(F.regexp_extract(c, K.ANY_YEARS_IN_WORDS, 1)).cast("string"))
    amount = F.nullif(F.replace(F.regexp_extract(c, K.ANY_AMOUNT, 1), F.lit(" "), F.lit("")), F.lit(""))
    days = F.nullif(F.regexp_extract(c, K.ANY_ARREST_DAYS, 1), F.lit(""))
    coerce = F.nullif(F.replace(F.regexp_extract(c, K.ANY_COERCIVE, 1), F.lit(" "), F.lit("")), F.lit(""))
    return (
        F.when(kind == "imprisonment", _unit(years, "years")).when(kind == "pecuniary_punishment", F.lit("500 daily rates"))
        .when(kind == "fine", F.concat(amount, F.when(F.lower(c).contains("eurot"), F.lit(" EUR")).otherwise(F.lit(" fine units"))))
        .when(kind == "arrest", F.coalesce(_unit(days, "days"), F.lit("30 days"))).when(kind == "coercive_payment", _unit(coerce, "EUR"))
    )


def sanctions(df: DataFrame, text: str = "text") -> DataFrame:
    """A row per distinct sanction of a text, in extractor order: ord, sanction_type, max_penalty, min_penalty."""
    c = F.coalesce(F.col(text), F.lit(""))
    every = F.array_distinct(F.concat(imprisonment(c), pecuniary(c), fines(c), coercive(c), arrest(c)))
    rows = df.select(*df.columns, F.posexplode(every).alias("ord", "_s")).select(*df.columns, "ord", "_s.*")
    return rows.withColumn("max_penalty", F.coalesce("max_penalty", penalty_fallback(c, F.col("sanction_type"))))


def sanction_label(kind: Column, most: Column, least: Column, reference: Column) -> Column:
    name = F.coalesce(T.look_up(K.SANCTION_LABELS, kind), kind)
    most, least = T.singular(F.nullif(most, F.lit(""))), T.singular(F.nullif(least, F.lit("")))
    text = (
        F.when(most == "life", F.concat(name, F.lit(", life"))).when(most.isNotNull() & least.isNotNull(), F.concat(name, F.lit(", "), least, F.lit(" to "), most))
        .when(most.isNotNull(), F.concat(name, F.lit(", max "), most)).otherwise(name)
    )
    return F.when(F.coalesce(reference, F.lit("")) != "", F.concat(text, F.lit(" ("), reference, F.lit(")"))).otherwise(text)


def provision_reference(abbreviation: Column, iri: Column, paragraph: Column) -> Column:
    """`<abbreviation or first part of the id> § <paragraph>`; the paragraph brings its own sign, so it is doubled."""
    law = F.coalesce(F.nullif(abbreviation, F.lit("")), F.substring_index(F.substring_index(iri, ":", -1), "_", 1))
    return F.concat_ws(" § ", law, F.nullif(paragraph, F.lit("")))


# ---- institutions


def _generic(c: Column, i: int, pattern: str, kind: str) -> Column:
    def one(m, j):
        suffix = T.institution_key(T.sanitize_id(m, " -", cut=80))
        name = F.when(suffix == "kohalik_omavalitsus", F.lit("Kohalik omavalitsus")).otherwise(m)
        return F.struct((F.lit(1000 * (i + 1)) + j).alias("p"), name.alias("name"), suffix.alias("suffix"), F.lit(kind).alias("kind"))

    return F.transform(_all(c, pattern, 1), one)


def institutions(df: DataFrame, text: str = "text") -> DataFrame:
    """A row per institution of a text: name, suffix, institution_type. Named ones come first and are matched as plain
    lower-case substrings; per suffix the first wins; the bare word for court gives way to any court found before it."""
    c = F.coalesce(F.col(text), F.lit(""))
    named = [F.when(F.lower(c).contains(n.lower()), F.struct(F.lit(i).alias("p"), F.lit(n).alias("name"), F.lit(K.INSTITUTION_KEYS.get(s, s)).alias("suffix"), F.lit(t).alias("kind"))) for i, (n, s, t) in enumerate(K.INSTITUTIONS)]
    named = F.filter(F.array(*named), lambda x: x.isNotNull())
    every = F.concat(named, *(_generic(c, i, pattern, kind) for i, (pattern, kind) in enumerate(K.INSTITUTION_PATTERNS)))
    first = F.aggregate(
        every, F.array().cast("array<struct<p:int,name:string,suffix:string,kind:string>>"),
        lambda s, x: F.when(F.exists(s, lambda y: (y.suffix == x.suffix) | ((x.suffix == "kohus") & (y.kind == "court"))), s).otherwise(F.concat(s, F.array(x))),
    )
    return df.select(*df.columns, F.explode(first).alias("_i")).select(*df.columns, "_i.name", "_i.suffix", F.col("_i.kind").alias("institution_type"))
