"""Row-level classifiers as CASE expressions, and the keyword classifier as sums of counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T


def first_match(c: Column, patterns, default: str | None = None, flags: str = "(?iU)") -> Column:
    """Name of the first pattern, in order, that occurs."""
    out = None
    for pattern, name in patterns:
        hit = c.rlike(flags + pattern)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out.otherwise(F.lit(default))


def argmax(scores: dict[str, Column]) -> Column:
    """Name with the greatest positive score; ties go to the earlier name; null if all are zero."""
    best = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
    out = F.when(best <= 0, F.lit(None).cast("string"))
    for name, score in scores.items():
        out = out.when(score == best, F.lit(name))
    return out


def norm_type(text: Column) -> Column:
    return argmax({name: T.pattern_score(text, patterns) for name, patterns in K.NORMS.items()})


def change_type(title: Column) -> Column:
    return first_match(title, K.CHANGES)


def competence_type(text: Column) -> Column:
    return first_match(text, K.COMPETENCES, "general")


def case_type(case_number: Column) -> Column:
    return F.coalesce(T.look_up(K.CASE_TYPES, F.left(case_number, F.lit(1))), F.lit("Other"))


def decision_type(name: Column) -> Column:
    return T.look_up(K.DECISION_TYPES, name)


def draft_type(title: Column) -> Column:
    """Type of a draft by an ordered cascade of substrings of its title."""
    t = F.lower(title)
    has = lambda *words: F.greatest(*(t.contains(w) for w in words)) if len(words) > 1 else t.contains(words[0])
    law = F.when(has("muutmi"), "AmendmentBill").otherwise("Bill")
    rule = F.when(has("vabariigi valitsuse"), "GovernmentRegulation").when(has("ministri"), "MinisterialRegulation").otherwise("Regulation")
    return (
        F.when(has("seaduse eelnõu", "seadus"), law).when(has("määrus"), rule).when(has("korraldus"), "GovernmentOrder")
        .when(has("seisukoht", "euroopa liidu"), "EUPosition").when(has("ülevaade"), "Report").when(has("kodakondsus"), "CitizenshipDecision")
        .when(has("kavatsus", "väljatöötamis"), "DraftIntent").when(has("tegevuskava", "strateegia"), "ActionPlan").otherwise("Other")
    )


def celex(number: Column) -> Column:
    """struct(decision_type, court, category) of a case-law document number."""
    code = F.regexp_extract(number, r"^6\d{4}([A-Z]{2})", 1)
    kind = F.coalesce(T.look_up({c: t for c, t, _ in K.CELEX_CODES}, code), F.lit("Other"))
    court = F.coalesce(T.look_up({c: k for c, _, k in K.CELEX_CODES}, code), F.lit("CourtOfJustice"))
    return F.struct(kind.alias("decision_type"), court.alias("court"), F.coalesce(T.look_up(K.CELEX_CATEGORIES, kind), F.lit("other")).alias("category"))


def matches_any(text: Column, patterns) -> Column:
    return F.coalesce(text.rlike("(?iUd)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def is_boilerplate(text: Column) -> Column:
    return matches_any(text, K.BOILERPLATE)


def temporal_status(invalidation: Column, valid_until: Column, entry: Column, as_of: Column) -> Column:
    return F.when((invalidation <= as_of) | (valid_until <= as_of), "repealed").when(entry > as_of, "notYetEffective").otherwise("inForce")


def repeal_date(status: Column, valid_until: Column, invalidation: Column) -> Column:
    """The end of validity of repealed acts, else the date of invalidation, which may lie ahead."""
    return F.coalesce(F.when(status == "repealed", valid_until), invalidation)


def keyword_hits(df: DataFrame, key: str, text: str, domains: DataFrame, top: int = 5) -> DataFrame:
    """The `top` domains of every text by number of keyword hits: key, code, hits, rank (ties by code).

    domains: code, keyword, is_pattern, threshold - a catalogue of fixed size, which becomes one expression per domain; a
    keyword is a plain lower-case string unless is_pattern. A domain counts from `threshold` hits. One pass, no shuffle.
    """
    lower = df.select(F.col(key), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_t"))
    catalogue: dict[tuple, list[str]] = {}
    for r in domains.orderBy("code", "keyword").collect():
        catalogue.setdefault((r.code, r.threshold), []).append(r.keyword if r.is_pattern else f"\\Q{r.keyword}\\E")
    if not catalogue:
        return lower.limit(0).select(key, F.lit("").alias("code"), F.lit(0).alias("hits"), F.lit(0).alias("rank"))
    hits = lambda patterns: reduce(lambda a, b: a + b, (F.regexp_count("_t", F.lit(f"(?U){p}")) for p in patterns))
    scored = F.array(*(F.struct((-hits(p)).alias("n"), F.lit(code).alias("code"), F.lit(least).alias("least")) for (code, least), p in catalogue.items()))
    best = F.slice(F.array_sort(F.filter(scored, lambda x: -x.n >= x.least)), F.lit(1), F.lit(top))
    out = lower.select(key, F.posexplode(best).alias("rank", "x"))
    return out.select(key, "x.code", (-F.col("x.n")).alias("hits"), (F.col("rank") + 1).alias("rank"))
