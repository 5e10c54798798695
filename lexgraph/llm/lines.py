"""Operator 6: near-duplicate lines by an exact set-similarity join (prefix, length and positional filters).

DataFrame operations only. A line is the set of its lower-cased words; two lines match at Jaccard >= 0.8, and a line
that matches any earlier one (order: doc_id, line number) is removed. Lines under `least` distinct words are left alone.

1. Equal lines are counted under their first occurrence; the later ones are removed, the first stands for them.
2. The words of a line are ordered by rarity: those that show in a table of frequencies by their class, before them all
   others, the longest first, as these are rare in most texts, then by hash. Lines that match share two words of their
   prefixes and are brought together by the first that they share; where that word is a very common one, by it and the
   second. A parity bitmap bounds the difference of two sets.
3. The entries that may match another one of their group are stored, with the texts of their lines; the rest plays no part
   any more. In every group of a key, a line is compared with a pivot first, the most copied line of those stored.
4. Pairs are verified on the full sets, first those of a line and its closest pivot. A line whose pivot fails is then
   compared with everything in its groups, so that a group of near copies costs as many pairs as it has lines.

Null texts have no lines, empty texts one empty line. Lines of any length count whole (up to 2**24 distinct words). Rows
that repeat a doc_id share their line numbers, so a line removed in one of them is removed in all; rows without a doc_id
are left alone. Of equal lines the first in order stays, so ties cannot arise. Empty tables give empty results.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored

PERCENT = 80
LEAST_WORDS = 5
#: Size of the table of word frequencies by hash: fixed, whatever the vocabulary.
BUCKETS = 1 << 16
#: A word is very common if its bucket of the frequency table holds this many times the mean of 2**14 buckets.
COMMON = 16
#: First order class of words whose bucket holds more than the mean; below it are the others, by length.
SHOWN = 64
#: Lines of so many words have bitmaps of 128 bits, shorter ones of 64.
LONG = 96

_WORD = (1 << 32) - 1


def _split(line: Column) -> Column:
    """Lower-cased words between white space, some of them empty."""
    odd = F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\x0b")) | F.contains(line, F.lit("\f")) | F.contains(line, F.lit("\r"))
    return F.split(F.lower(F.when(odd, F.translate(line, "\t\x0b\f\r", "    ")).otherwise(line)), " ")


def _words(line: Column) -> Column:
    """Lower-cased words of a line."""
    return F.array_remove(_split(line), "")


def _hashes(line: Column) -> Column:
    """Distinct words of a line as 64-bit hashes, in no order."""
    return F.array_distinct(F.transform(_words(line), lambda w: F.xxhash64(w)))


def rarity(docs: DataFrame) -> tuple[list[int], int]:
    """Order class of each hash bucket of words, over all texts, and the least class of very common words: 0 for buckets
    that hold no more than the mean, for the others their frequency in quarter octaves, from SHOWN on."""
    word = F.explode(_split(F.replace(F.col("text"), F.lit("\n"), F.lit(" "))))
    counts = docs.select(word.alias("w")).where("w <> ''").groupBy(F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).alias("b")).count().collect()
    total = sum(n for _, n in counts)
    octaves = lambda n: 4 * (n.bit_length() - 1) + int(4 * n / (1 << (n.bit_length() - 1))) - 4
    mean = 1 + total // BUCKETS
    # three digits at most, and few buckets: the table stands in the plan of the query, which Spark keeps and logs as text
    grade = lambda n: min(127, SHOWN + octaves(n) - octaves(mean)) if n > mean else 0
    out = [0] * BUCKETS
    for b, n in counts:
        out[b] = grade(n)
    return out, grade(2 + mean + COMMON * total // (1 << 14))


def _keys(line: Column, classes: Column) -> Column:
    """Distinct words of a line as 64-bit keys in order of rarity: the class in the high byte, then 56 bits of hash. Words
    of class 0 have one by their length instead: long ones are rare, though their buckets do not tell."""
    of = lambda w: F.get(classes, F.xxhash64(w).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")).cast("int")
    graded = lambda w: F.greatest(of(w), F.lit(SHOWN - 1) - F.octet_length(w)).cast("bigint")
    key = lambda w: F.shiftleft(graded(w), 56).bitwiseOR(F.shiftrightunsigned(F.xxhash64(w), 8))
    return F.sort_array(F.array_distinct(F.transform(_words(line), key)))


def _parity(keys: Column, upper: bool = False) -> Column:
    """64 bits, each the parity of the number of words that hash to it; two sets differ in at least as many words as
    their bitmaps in bits. With `upper` only words with the next bit set count, which makes it half of 128 bits."""
    one = (lambda x: F.shiftrightunsigned(x, 6).bitwiseAND(F.lit(1))) if upper else (lambda x: F.lit(1).cast("bigint"))
    return F.aggregate(keys, F.lit(0).cast("bigint"), lambda s, x: s.bitwiseXOR(F.call_function("shiftleft", one(x), x.bitwiseAND(F.lit(63)).cast("int"))))


def _signatures(keys: Column, n: Column, common: int, percent: int) -> Column:
    """Position and word of each word of the prefix, as position << 40 | word; a very common word goes with each of the
    words after it, up to one past the prefix."""
    k = (n * (100 - percent) / 100 + 1e-9).cast("int") + 1
    first = F.lit(common << 56)
    item = lambda i, w: F.call_function("shiftleft", i.cast("bigint"), F.lit(40)).bitwiseOR(w.bitwiseAND(F.lit(_WORD)))
    prefix = F.slice(keys, F.lit(1), k)
    plain = F.transform(prefix, lambda x, i: item(i, x))
    paired = F.flatten(F.transform(prefix, lambda x, i: F.when(x < first, F.array(item(i, x))).otherwise(
        F.transform(F.slice(keys, i + 2, F.greatest(F.lit(0), F.least(n, k + 1) - i - 1)), lambda y: item(i, F.xxhash64(x, y))))))
    return F.when(F.get(keys, F.least(n, k) - 1) < first, plain).otherwise(paired)


def _fields(of: str) -> dict[str, str]:
    """SQL of the fields of an index entry whose columns start with `of`. From the low byte of ucnp: the upper two bytes of
    position and size, which are mostly zero and lie beside other zeros, then copies, hash, and their low bytes."""
    return {
        "d": f"{of}d", "t": f"{of}t", "m": f"{of}m", "h": f"{of}h", "u": f"cast(shiftrightunsigned({of}ucnp, 40) & 255 as int)",
        "c": f"(shiftright({of}ucnp, 32) & 255)", "n": f"((shiftright({of}ucnp, 48) & 255) | (shiftright({of}ucnp, 8) & 16776960))",
        "p": f"(shiftrightunsigned({of}ucnp, 56) | (shiftleft({of}ucnp, 8) & 16776960))",
    }


def _distance(x: dict[str, str], y: dict[str, str]) -> str:
    """Bits in which the bitmaps of two entries differ, as SQL."""
    return (
        f"(case when {x['n']} >= {LONG} and {y['n']} >= {LONG} then bit_count({x['m']} ^ {y['m']} ^ {x['h']} ^ {y['h']}) + bit_count({x['h']} ^ {y['h']})"
        f" else bit_count({x['m']} ^ {y['m']}) end)"
    )


def _may_match(x: dict[str, str], y: dict[str, str], percent: int, ordered: bool = True) -> str:
    """Length, bitmap, positional and order filters of an entry x and one of a line y that is earlier or of the same
    document, or any other line unless `ordered`, as SQL. The word of the entries counts as the first that the lines share,
    so all they share follows it."""
    # cheap and strict ones first: order, then the bits of m alone, in which two lines never differ more than in all
    order = f"({y['d']} < {x['d']} or ({y['d']} = {x['d']} and {y['t']} <> {x['t']}))" if ordered else f"({y['d']} <> {x['d']} or {y['t']} <> {x['t']})"
    return (
        f"{order} and bit_count({x['m']} ^ {y['m']}) * {100 + percent} <= ({x['n']} + {y['n']}) * {100 - percent}"
        f" and {x['n']} * 100 >= {y['n']} * {percent} and {y['n']} * 100 >= {x['n']} * {percent}"
        f" and {_distance(x, y)} * {100 + percent} <= ({x['n']} + {y['n']}) * {100 - percent}"
        f" and least({x['n']} - {x['p']}, {y['n']} - {y['p']}) * {100 + percent} >= ({x['n']} + {y['n']}) * {percent}"
    )


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, line and its 72-bit hash (t, u) of documents that have an id."""
    out = docs.where("doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return out.select("doc_id", "line_no", "line", F.xxhash64("line").alias("t"), F.shiftrightunsigned(F.hash("line"), 24).alias("u"))


def _entries(distinct: DataFrame, classes: Column, common: int, percent: int, least: int) -> DataFrame:
    """Prefix index of distinct lines: w (key), t (hash), d (document), m and h (bitmap) and ucnp (more of the hash,
    copies, size and position in one number)."""
    # the word keys are a lambda's variable and then a generator's output, so they are computed once a line
    keyed = distinct.select("t", "u", "r", "copies", F.explode(F.array(_keys(F.col("line"), classes))).alias("k")).withColumn("n", F.size("k")).where(F.col("n") >= least)
    keyed = keyed.select(
        "t", F.col("r.doc_id").alias("d"), _parity(F.col("k")).alias("m"),
        F.when(F.col("n") >= LONG, _parity(F.col("k"), True)).otherwise(F.lit(0).cast("bigint")).alias("h"),
        F.expr("(cast(n & 255 as bigint) << 48) | (cast(u as bigint) << 40) | (least(copies, 255) << 32) | (cast(n & 16776960 as bigint) << 8)").alias("ucn"), _signatures(F.col("k"), F.col("n"), common, percent).alias("s"),
    )
    # a second step, so that the bitmaps are not computed again for each word
    # (s is never empty, but only explode_outer does without a filter that computes it once more)
    keyed = keyed.select("t", "d", "m", "h", "ucn", F.explode_outer("s").alias("pw"))
    # none of the columns is ever null, but only coalesce says so: no filter on nulls then tells one use from another
    sure = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    # in an order that puts the zero bytes of w and ucnp, and of d and h, beside each other, which the exchange then compresses
    ucnp = F.expr("ucn | (shiftright(pw, 40) << 56) | shiftright(pw, 48)")
    out = {"m": F.col("m"), "w": F.col("pw").bitwiseAND(F.lit(_WORD)), "ucnp": ucnp, "d": F.col("d"), "h": F.col("h")}
    return keyed.select("t", *(sure(c).alias(name) for name, c in out.items()))


def removed_lines(docs: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """doc_id, line_no of every line that matches an earlier one. docs: doc_id (the key) and text."""
    grades, common = rarity(docs)
    classes = F.from_json(F.lit(json.dumps(grades, separators=(",", ":"))), "array<tinyint>")
    every = lines(docs)
    distinct = every.groupBy("t", "u").agg(F.min(F.struct("doc_id", "line_no")).alias("r"), F.count("*").alias("copies"), F.first("line").alias("line"))
    # one exchange by word serves both sides of the join, which therefore use the same columns; in it, w and the upper half
    # of ucnp are one number, so that all zero bytes of an entry lie together
    word = F.expr("shiftrightunsigned(wu, 32)")
    packed = _entries(distinct, classes, common, percent, least).select(
        "t", "m", F.expr("(w << 32) | shiftrightunsigned(ucnp, 32)").alias("wu"), "d", "h", F.col("ucnp").bitwiseAND(F.lit(_WORD)).alias("rest"))
    entries = packed.repartition(word).select(word.alias("w"), "t", "d", "m", "h", F.expr("(wu << 32) | rest").alias("ucnp"))
    columns = ("w", "t", "d", "m", "h", "ucnp")
    own, x, other = _fields(""), _fields("x."), _fields("o_")
    named = lambda df: df.select(*(F.col(c).alias(f"o_{c}") for c in df.columns))

    # per line: its entries that may match any other of their groups. Every line that has some is stored once with its text,
    # as is the first of equal lines, so that the exchanges of texts and entries are gone before the rest
    # the optimiser would move the semi-join in front of the exchange, but not past this filter, which is always true
    # most pairs end at a bound that needs little more than the bitmaps: the other line has at most 100 / percent times the words
    rows = entries.where(F.spark_partition_id() >= 0).withColumn("bound", F.expr(f"{own['n']} * {100 - percent} div {percent}"))
    rows = rows.join(named(entries), F.expr(f"w = o_w and bit_count(m ^ o_m) <= bound and {_may_match(own, other, percent, ordered=False)}"), "left_semi")
    found = rows.withColumn("u", F.expr(own["u"])).groupBy("t", "u").agg(F.collect_list(F.struct("w", "d", "m", "h", "ucnp")).alias("rows"))
    enough = F.size(F.array_distinct(_words(F.col("line")))) >= least
    lone = F.col("rows").isNull()
    kept = distinct.join(found, ["t", "u"], "left").select("t", "u", "r", ((F.col("copies") > 1) & enough).alias("first"), F.when(~lone, F.col("line")).alias("line"), "rows")
    kept = stored(kept.where("rows is not null or first"))
    texts = kept.where("rows is not null").select("t", "u", "r", "line")
    listed = kept.where("rows is not null").select("t", "u", F.inline("rows"))

    # the closest pivot of each line
    me = F.struct(F.expr(own["c"]).alias("c"), (-F.col("d")).alias("nd"), "d", "t", "m", "h", "ucnp")
    far = F.expr(f"{_distance(own, x)} * 4096 div ({own['n']} + {x['n']})").alias("far")
    pivots = listed.withColumn("x", F.max(me).over(W.partitionBy("w"))).where(_may_match(own, x, percent))
    pivots = pivots.groupBy("t", "u").agg(F.min(F.struct(far, *(F.expr(x[c]).alias(f"o{c}") for c in "tu"))).alias("x"))
    checked = stored(_compared(pivots.select("t", "u", "x.ot", "x.ou"), texts, percent).where("ok").drop("ok"))
    late, done = checked.select(F.struct(F.col("d").alias("doc_id"), F.col("l").alias("line_no")).alias("r")), checked.select("t", "u")

    # the rows of lines that do not match their pivot, and in turn all lines that may match one of these, meet with their
    # words, and it is asked whether any matches: nowhere is a row made for a pair
    full = lambda rows: rows.join(texts.select("t", "u", "r", _hashes(F.col("line")).alias("words")), ["t", "u"])
    named_rows = named(listed.select(*columns))
    open_ = listed.join(done, ["t", "u"], "left_anti").join(named_rows, F.expr(f"w = o_w and {_may_match(own, other, percent)}"), "left_semi")
    near = listed.join(named(open_.select(*columns)), F.expr(f"w = o_w and {_may_match(other, own, percent)}"), "left_semi")
    shared = "size(array_intersect(words, o_words))"
    match = f"w = o_w and {_may_match(own, other, percent)} and o_r < r and {shared} * {100 + percent} >= (size(words) + size(o_words)) * {percent}"
    more = full(open_).join(named(full(near)), F.expr(match), "left_semi").select("r")
    late = late.unionByName(more).distinct().select("r.doc_id", "r.line_no")

    # later copies of a line: found by hash
    copies = every.select("doc_id", "line_no", "t", "u").join(kept.where("first").select("t", "u", "r"), ["t", "u"]).where("doc_id <> r.doc_id or line_no <> r.line_no").select("doc_id", "line_no")
    return late.unionByName(copies)


def _compared(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (t, u) and (ot, ou) with d, l of the first line and ok: whether the second is earlier and the word sets reach
    the similarity."""
    side = F.explode(F.array(F.struct(F.lit(True).alias("mine"), "t", "u"), F.struct(F.lit(False).alias("mine"), F.col("ot").alias("t"), F.col("ou").alias("u"))))
    sides = pairs.select(F.struct("t", "u", "ot", "ou").alias("pair"), side.alias("s")).select("pair", "s.mine", "s.t", "s.u")
    full = sides.join(texts, ["t", "u"])
    of = lambda mine, c: F.max(F.when(F.col("mine") == mine, F.col(c)))
    both = full.groupBy("pair").agg(of(True, "r").alias("r"), of(False, "r").alias("before"), of(True, "line").alias("a"), of(False, "line").alias("b"))
    both = both.select("pair.t", "pair.u", "r", "before", *(_hashes(F.col(c)).alias(c) for c in "ab"))
    shared = F.size(F.array_intersect("a", "b"))
    ok = (F.col("before") < F.col("r")) & (shared * (100 + percent) >= (F.size("a") + F.size("b")) * percent)
    return both.select("t", "u", F.col("r.doc_id").alias("d"), F.col("r.line_no").alias("l"), ok.alias("ok"))


def report(docs: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed and the removed line numbers (comma-joined, in order), one row per doc_id."""
    gone = removed_lines(docs, percent, least).distinct().groupBy("doc_id").agg(F.count("*").alias("n_removed"), F.array_join(F.transform(F.array_sort(F.collect_list("line_no")), lambda x: x.cast("string")), ",").alias("removed"))
    breaks = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    own = docs.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce(breaks + 1, F.lit(0))).alias("n"))
    out = own.join(gone, "doc_id", "left")
    return out.select("doc_id", F.col("n").cast("bigint").alias("n_lines"), F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce("removed", F.lit("")).alias("removed"))


def clean(docs: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """docs with the removed lines taken out of text; all rows and columns stay."""
    # stored first, so that the shuffle files of the search are gone before the texts are shuffled
    gone = stored(removed_lines(docs, percent, least)).groupBy("doc_id").agg(F.collect_set("line_no").alias("gone"))
    # both sides under one name each, so that no column of docs can clash
    joined = docs.select(F.col("doc_id").alias("id"), F.struct(*docs.columns).alias("row")).join(gone.withColumnRenamed("doc_id", "id"), "id", "left")
    parts = F.split("row.text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n"))
    return joined.select(*((text if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns))
