"""Operator 4: mixing sources to target weights by temperature, realised as budgeted block permutations.

DataFrame operations only. Shares p_s of a source's tokens become weights p_s**a / sum(p**a). The exponent a in [0, 1]
is the largest (closest to the natural mix) that meets a least entropy, bisected inside SQL over the table of sources.
Every source's documents are dealt to blocks by hash; per epoch the blocks, and the documents in a block, are permuted
by hash, and documents are taken in that order until the source's token budget is spent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import durable

#: Halvings of the exponent's interval, and documents a block has on average.
STEPS = 50
BLOCK = 512


def token_count(text: Column) -> Column:
    """Words of a text (runs without spaces, tabs or line breaks); null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("bigint")


def _weights(shares: Column, a: Column) -> Column:
    raw = F.transform(shares, lambda p: F.pow(p, a))
    total = F.aggregate(raw, F.lit(0.0), lambda s, x: s + x)
    return F.transform(raw, lambda x: x / total)


def _entropy(weights: Column) -> Column:
    return F.aggregate(weights, F.lit(0.0), lambda s, w: s - F.when(w > 0, w * F.log(w)).otherwise(0.0))


def _order(seed: int, *columns: str) -> Column:
    """A permutation key that any SQL engine can repeat: the MD5 of the columns and the seed."""
    return F.md5(F.concat_ws(":", *(F.col(c).cast("string") for c in columns), F.lit(str(seed))))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")


def plan(sizes: DataFrame, budget: float = 1.0, entropy: float = 0.9, max_epochs: float = 4.0) -> DataFrame:
    """Weights and token budgets per source from sizes(source, n_docs, n_tokens): one row per source with tokens.

    The budget is `budget` times all tokens. The wanted mix has at least `entropy` times the greatest entropy log(k),
    unless some source would then be repeated more than max_epochs times; the exponent is bisected for both, the
    repetition limit prevailing. The table has a row per source and is folded into arrays in one row; sources are
    names of crawls or collections, whose number does not follow the number of documents.
    """
    known = sizes.where("n_tokens > 0").withColumn("key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    folded = known.agg(F.array_sort(F.collect_list(F.struct("key", "source", "n_docs", "n_tokens"))).alias("s")).where(F.size("s") > 0)
    total = F.aggregate("s", F.lit(0).cast("bigint"), lambda t, x: t + x.n_tokens)
    folded = folded.withColumn("total", total).withColumn("p", F.transform("s", lambda x: x.n_tokens / F.col("total")))

    def meets(a: Column) -> Column:
        return _entropy(_weights(F.col("p"), a)) >= entropy * F.log(F.size("s"))

    def repeats(a: Column) -> Column:
        w = _weights(F.col("p"), a)
        return F.array_max(F.zip_with(w, F.col("p"), lambda x, p: x * budget / p)) > max_epochs

    def bisect(ok) -> Column:
        """Largest exponent with ok(a), for an ok that holds from 0 up to some point."""
        start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
        halved = F.aggregate(
            F.sequence(F.lit(1), F.lit(STEPS)), start,
            lambda s, _: F.when(ok((s.lo + s.hi) / 2), F.struct(((s.lo + s.hi) / 2).alias("lo"), s.hi.alias("hi"))).otherwise(F.struct(s.lo.alias("lo"), ((s.lo + s.hi) / 2).alias("hi"))),
        )
        return F.when(ok(F.lit(1.0)), F.lit(1.0)).otherwise(halved.lo)

    flat = bisect(meets)
    # repetition falls as the exponent rises: the least exponent without too much repetition
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    least = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)), start,
        lambda s, _: F.when(repeats((s.lo + s.hi) / 2), F.struct(((s.lo + s.hi) / 2).alias("lo"), s.hi.alias("hi"))).otherwise(F.struct(s.lo.alias("lo"), ((s.lo + s.hi) / 2).alias("hi"))),
    )
    folded = folded.withColumn("flat", flat).withColumn("least", F.when(repeats(F.lit(0.0)), least.hi).otherwise(F.lit(0.0)))
    folded = folded.withColumn("exponent", F.greatest("flat", "least"))
    folded = folded.withColumn("w", _weights(F.col("p"), F.col("exponent")))
    rows = folded.select("total", "exponent", F.explode(F.arrays_zip("s", "w")).alias("x"))
    return rows.select(
        F.col("x.s.source").alias("source"), F.col("x.s.n_docs").alias("n_docs"), F.col("x.s.n_tokens").alias("n_tokens"), "exponent",
        F.col("x.w").alias("weight"), F.floor(F.col("x.w") * F.col("total") * budget + 1e-6).cast("bigint").alias("budget_tokens"),
    )


def mix(docs: DataFrame, budget: float = 1.0, entropy: float = 0.9, max_epochs: float = 4.0, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """The mixed stream as rows (doc_id, source, n_tokens, epoch, block): a document occurs once per epoch it is taken in.

    Whole epochs take every document; in the last one, blocks come in permuted order and documents are taken while
    the tokens before them stay under what is left of the budget. Documents without words are never taken, a null
    source is a source, null doc_ids and repeated rows are documents of their own, ties in the hash order go by doc_id.
    Large sources have many blocks, so no task ever holds a source.
    """
    own = docs.select("doc_id", "source", token_count(F.col("text")).alias("n_tokens")).where("n_tokens > 0")
    own = durable(own)
    sizes = own.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    sources = plan(sizes, budget, entropy, max_epochs)
    sources = sources.select(
        F.col("source").alias("of"), F.greatest(F.lit(1), F.ceil(F.col("n_docs") / block)).cast("bigint").alias("n_blocks"),
        F.expr("budget_tokens div n_tokens").alias("whole"), (F.col("budget_tokens") % F.col("n_tokens")).alias("rest"),
    )
    # at most one row per source: joined by source, split by adaptive execution where a source is hot
    dealt = own.join(sources, F.col("source").eqNullSafe(F.col("of"))).withColumn("block", _number(_order(seed, "doc_id")) % F.col("n_blocks"))
    dealt = dealt.select("doc_id", "source", "n_tokens", "block", "whole", "rest")
    sums = dealt.groupBy("source", "block").agg(F.sum("n_tokens").alias("t"), F.first("rest").alias("rest"))
    order = _order(seed, "source", "block")
    # cumulative over blocks in two levels: bins of the permuted order first, then the blocks of a bin
    bins = sums.withColumn("o", order).withColumn("bin", F.substring("o", 1, 3))
    per_bin = bins.groupBy("source", "bin").agg(F.sum("t").alias("bt")).withColumn(
        "before_bin", F.coalesce(F.sum("bt").over(W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    in_bin = F.coalesce(F.sum("t").over(W.partitionBy("source", "bin").orderBy("o", "block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    p = per_bin.select(F.col("source").alias("ps"), F.col("bin").alias("pb"), "before_bin")
    starts = bins.withColumn("in_bin", in_bin).join(p, F.col("source").eqNullSafe(F.col("ps")) & (F.col("bin") == F.col("pb")))
    starts = starts.select(F.col("source").alias("bs"), F.col("block").alias("bb"), (F.col("before_bin") + F.col("in_bin")).alias("before_block")).where("before_block < rest")
    within = F.coalesce(F.sum("n_tokens").over(W.partitionBy("source", "block").orderBy(_order(seed + 1, "doc_id"), "doc_id", "n_tokens").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    last = dealt.join(starts, F.col("source").eqNullSafe(F.col("bs")) & (F.col("block") == F.col("bb"))).withColumn("within", within)
    last = last.where("before_block + within < rest").select("doc_id", "source", "n_tokens", F.col("whole").alias("epoch"), "block")
    full = dealt.where("whole > 0").select("doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1)).alias("epoch"), "block")
    return full.unionByName(last)
