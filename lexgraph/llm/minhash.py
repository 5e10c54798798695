"""Operator 10: near-duplicate documents by SetSketch registers.

A register keeps the exponentially spaced, truncated minimum of a hash over a document's word shingles, so registers of
unions are the maxima of registers (mergeable) and agree with a probability close to the Jaccard similarity (locality-
sensitive). Bands of registers propose pairs, a joint likelihood of the register comparison estimates their similarity,
and pairs that may qualify are verified on the full shingle sets.
"""

from __future__ import annotations

from math import log

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _U, components, durable, map_texts, mix, ngrams, slices, stored, text_buffers, word_hashes

#: Registers, bands and registers per band, base and rate of the exponential spacing, largest value.
M, BANDS, ROWS, BASE, RATE, TOP = 256, 32, 4, 1.1, 20.0, 254
#: A pair goes to verification unless its estimate is this far (four standard errors) under the threshold.
SLACK = 0.1
#: Documents of a family that one block holds at most (on average), and shingles; more are dealt to pairs of blocks.
BLOCK, SHINGLES = 1024, 4_000_000

_ODD = mix(np.arange(1, M + 1, dtype=_U) * _U(0x9FB21C651E98DF25)) | _U(1)
_ADD = mix(np.arange(1, M + 1, dtype=_U) * _U(0xC6BC279692B5CC83))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Distinct shingle hashes of one document's word hashes; a shorter text is one shingle, none without words."""
    if not len(h):
        return h
    return np.unique(ngrams(h, min(k, len(h)))) if len(h) >= k else mix(ngrams(h, len(h)) + _U(len(h)))


def text_sets(texts, k: int) -> list[np.ndarray]:
    """Shingle sets of an Arrow column of texts."""
    h, _, _, first = word_hashes(*text_buffers(texts))
    return [shingles(h[a:b], k) for a, b in zip(first[:-1], first[1:], strict=True)]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, M) register values; a document without shingles has all registers at 0."""
    sizes = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), M), dtype=np.uint8)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    x = np.concatenate([sets[i] for i in full])
    start = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    least = np.empty((len(full), M), dtype=_U)
    for i in range(M):
        least[:, i] = np.minimum.reduceat(x * _ODD[i] + _ADD[i], start)
    value = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    out[full] = np.clip(np.floor(1 - np.log(np.maximum(value, 1e-300)) / log(BASE)), 0, TOP + 1)
    return out


_GRID = np.linspace(0, 1, 101)


def joint_estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of rows of registers, given the sizes of the sets."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    u = (na / (na + nb))[:, None]
    v = 1 - u
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / log(BASE)
    pu, pv = p(u - v * _GRID), p(v - u * _GRID)
    like = above[:, None] * np.log(np.maximum(pu, 1e-12)) + below[:, None] * np.log(np.maximum(pv, 1e-12)) + (a.shape[1] - above - below)[:, None] * np.log(np.maximum(1 - pu - pv, 1e-12))
    like = np.where(_GRID <= np.minimum(u / v, v / u) + 0.01, like, -np.inf)
    return _GRID[like.argmax(axis=1)]


def sketches(docs: DataFrame, k: int = 4) -> DataFrame:
    """doc_id, n_shingles, a 128-bit hash of the shingle set (h1, h2) and the registers, one row per row of docs."""

    def rows(batch):
        import pyarrow as pa

        out: list[tuple] = []
        for part in slices(batch, 1 << 20):
            sets = text_sets(part.column("text"), k)
            regs = registers(sets)
            one = [int(mix(s ^ _U(0x1234567)).sum(dtype=_U)) for s in sets]
            two = [int(mix(s + _U(0x89ABCDEF01)).sum(dtype=_U)) for s in sets]
            out += [(len(s), a, b, r.tobytes()) for s, a, b, r in zip(sets, one, two, regs, strict=True)]
        n, one, two, regs = zip(*out, strict=True)
        signed = lambda x: pa.array(np.array(x, dtype=_U).view(np.int64))
        return [batch.column("doc_id"), pa.array(n, pa.int64()), signed(one), signed(two), pa.array(regs, pa.binary())]

    return map_texts(docs, rows, "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, regs binary")


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int, least: float) -> DataFrame:
    """Pairs (a, b) whose estimated similarity may reach the threshold, with the estimate."""
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))
    full = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").where(f"na * 100 >= nb * {percent} and nb * 100 >= na * {percent}")

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, M) for c in ("ra", "rb"))
            e = joint_estimate(ra, rb, *(batch.column(c).to_numpy().astype(float) for c in ("na", "nb")))
            ok = pa.array(e >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(e)], ["a", "b", "e"]).filter(ok)

    return full.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(rows, "a bigint, b bigint, e double")


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the similarity."""
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}"))
    full = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def rows(batches):
        import pyarrow as pa

        last: tuple = (None, None)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                left = text_sets(part.column("ta"), k)
                keep = []
                for j, (b, s) in enumerate(zip(part.column("b").to_pylist(), left, strict=True)):
                    if last[0] != b:
                        last = (b, text_sets(part.column("tb").slice(j, 1), k)[0])
                    t = last[1]
                    common = len(np.intersect1d(s, t, assume_unique=True))
                    keep.append(100 * common >= percent * (len(s) + len(t) - common) and common > 0)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return full.select("a", "b", "ta", "tb").mapInArrow(rows, "a bigint, b bigint")


class _Family:
    """Rows of a family in one block, or in two of its blocks, that one task holds."""

    def __init__(self, table, percent: int, least: float):
        self.rep, self.n, comp = (table.column(c).to_numpy() for c in ("rep", "n", "c"))
        self.side, self.main = (table.column(c).to_numpy(zero_copy_only=False) for c in ("side", "main"))
        self.cross = table.column("low")[0].as_py() != table.column("high")[0].as_py()
        self.regs = np.frombuffer(b"".join(table.column("regs").to_pylist()), np.uint8).reshape(-1, M)
        self.bands = np.ascontiguousarray(self.regs[:, : BANDS * ROWS]).view(np.uint32)  # a band in one number
        self.percent, self.least = percent, least
        self.group = np.unique(comp, return_inverse=True)[1]

    def candidates(self):
        """Rows outside the main component, each with the rows, likeliest first, that share a band with it, lie in another
        component, may qualify by size and whose joint estimate reaches the least. Main rows are only looked up."""
        rep, n, main = self.rep, self.n, self.main
        for i in np.lexsort((rep, main)):
            if main[i]:
                return
            ok = (self.group != self.group[i]) & (main | (rep > rep[i])) & (n * 100 >= n[i] * self.percent) & (n[i] * 100 >= n * self.percent)
            if self.cross:
                ok &= self.side != self.side[i]
            j = np.flatnonzero(ok)
            j = j[(self.bands[j] == self.bands[i]).any(axis=1)]
            if len(j):
                e = joint_estimate(np.broadcast_to(self.regs[i], (len(j), M)), self.regs[j], np.full(len(j), float(n[i])), n[j].astype(float))
                yield i, j[np.argsort(-e, kind="stable")][: int((e >= self.least).sum())]


def _touched(percent: int, least: float):
    """The rows of a family, between two of its blocks, that have a candidate or are one."""

    def run(table):
        import pyarrow as pa

        family = _Family(table, percent, least)
        hit = np.zeros(table.num_rows, bool)
        for i, found in family.candidates():
            hit[found] = True
            hit[i] |= len(found) > 0
        return table.filter(pa.array(hit))

    return run


def _search(k: int, percent: int, least: float):
    """Links of a family between two of its blocks, as a spanning forest of what they join.

    Candidates are verified on the full sets, likeliest first. What a found link has joined is one component from then on,
    so links are as few as the rows, and a row of near copies costs one verification.
    """

    def run(table):
        import pyarrow as pa

        family, texts, sets = _Family(table, percent, least), table.column("text"), {}
        group, rep = family.group, family.rep
        out: list[tuple[int, int]] = []

        def of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = text_sets(texts.slice(i, 1), k)[0]
            return sets[i]

        for i, found in family.candidates():
            for x in found:
                if group[x] == group[i]:
                    continue
                a, b = of(i), of(x)
                common = len(np.intersect1d(a, b, assume_unique=True))
                if common and 100 * common >= percent * (len(a) + len(b) - common):
                    out.append((int(rep[i]), int(rep[x])))
                    group[group == group[x]] = group[i]
        return pa.Table.from_arrays([pa.array([p[c] for p in out], pa.int64()) for c in (0, 1)], ["a", "b"])

    return run


def _across(shared: DataFrame, label: DataFrame, classes: DataFrame, texts: DataFrame, k: int, percent: int, least: float) -> DataFrame:
    """Verified links among all pairs that share a bucket and lie in different components, as forests.

    Buckets whose pivots lie in one component form a family. Its rows outside that component (the rest) are compared with
    its rows inside it (the main ones) and with each other, in pairs of blocks; two main rows never are. Registers decide
    which rows have a candidate; only these are joined with their texts and verified.
    """
    of = label.select(F.col("node").alias("rep"), "component")
    placed = shared.join(of, "rep", "left").select("key", "rep", "pivot", F.coalesce("component", "rep").alias("c"))
    mixed = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min(F.when(F.col("rep") == F.col("pivot"), F.col("c"))).alias("family"))
    members = durable(placed.join(mixed.where("lo < hi").select("key", "family"), "key").select("family", "rep", "c").distinct())
    rows = members.join(classes.select("rep", "n", "regs"), "rep").withColumn("main", F.col("c") == F.col("family"))
    count = lambda main: F.greatest(F.ceil(F.sum(F.when(F.col("main") == main, 1).otherwise(0)) / BLOCK), F.ceil(F.sum(F.when(F.col("main") == main, F.col("n")).otherwise(0)) / SHINGLES)).cast("int")
    blocks = rows.groupBy("family").agg(count(False).alias("nr"), count(True).alias("nm"))
    # blocks of the rest are numbered from 0, those of the main rows after them
    side = F.when(F.col("main"), F.col("nr") + F.pmod(F.xxhash64("rep"), F.col("nm"))).otherwise(F.pmod(F.xxhash64("rep"), F.col("nr"))).cast("int")
    dealt = rows.join(blocks, "family").withColumn("side", side)
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.when(F.col("main"), F.col("nr")).otherwise(F.col("nr") + F.col("nm")) - 1)))
    dealt = dealt.select("family", "rep", "c", "n", "regs", "main", "side", F.least("side", "o").alias("low"), F.greatest("side", "o").alias("high"))
    touched = durable(dealt.groupBy("family", "low", "high").applyInArrow(_touched(percent, least), dealt.schema))
    full = touched.join(texts.select(F.col("doc_id").alias("rep"), "text"), "rep")
    return full.groupBy("family", "low", "high").applyInArrow(_search(k, percent, least), "a bigint, b bigint")


def _repeats(own: DataFrame) -> bool:
    return own.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs that has a doc_id.

    Documents with equal shingle sets form a class, held by its smallest doc_id; classes stand for their members in
    all that follows. Null and empty texts and texts of spaces have no shingles and link with nothing. Rows that repeat
    a doc_id are documents of their own with the same name: links are those of each row's text. Texts of any length are
    read whole; an empty table gives an empty result. The bands are made for thresholds of 70 % or more: a pair at the
    threshold shares none of them with a probability of 9e-5 at 70 %.

    1. In every band's bucket each class is compared with one pivot; each class verifies its best such pair.
    2. Other pivot pairs are verified where they would join different components.
    3. All other pairs of a bucket that lie in different components are estimated and verified, so no link is lost.
    """
    own = docs.where("doc_id is not null").select("doc_id", "text")
    if not _repeats(own):
        out = _groups(own, k, percent)
    else:
        rows = stored(own.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
        found = _groups(rows.select(F.col("row").alias("doc_id"), "text"), k, percent).withColumnRenamed("doc_id", "row").join(rows.select("row", "doc_id"), "row")
        first = found.groupBy(F.col("component_id").alias("c")).agg(F.min("doc_id").alias("first"))
        out = found.join(first, F.col("component_id") == F.col("c")).select("doc_id", "n_shingles", F.col("first").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each group of near-duplicates, that of the smallest doc_id; rows without an id, and those whose
    text is null or has no words, stay."""
    known, none = docs.where("doc_id is not null"), docs.where("doc_id is null")
    if not _repeats(known):
        kept = _groups(known.select("doc_id", "text"), k, percent).where("doc_id = component_id").select("doc_id")
        return known.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(none)
    rows = stored(known.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("d")))
    found = _groups(rows.select(F.col("row").alias("doc_id"), F.col("d.text").alias("text")), k, percent).withColumnRenamed("doc_id", "row")
    first = found.join(rows.select("row", "d.doc_id"), "row").groupBy("component_id").agg(F.min(F.struct("doc_id", "row")).alias("x")).select("x.row")
    return rows.join(first, "row", "left_semi").select("d.*").unionByName(none)


def _groups(own: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id of rows with unique ids."""
    least = percent / 100 - SLACK
    sketch = durable(sketches(own, k))
    classes = durable(sketch.where("n_shingles > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs")))
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    keyed = classes.select("rep", "regs", band.alias("band")).select("rep", "band", F.xxhash64("band", F.expr(f"substring(regs, band * {ROWS} + 1, {ROWS})")).alias("key"))
    groups = keyed.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("n")).where("n > 1").select("key", "pivot")
    shared = durable(keyed.join(groups, "key"))
    pairs = shared.where("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
    pairs = durable(_estimated(pairs, classes, percent, least))
    best = pairs.groupBy("a").agg(F.max(F.struct("e", (-F.col("b")).alias("m"))).alias("x")).select("a", (-F.col("x.m")).alias("b"))
    edges = durable(_verified(best, own, k, percent))
    label = components(edges)

    def named(p: DataFrame) -> DataFrame:
        """Pairs of different components."""
        la, lb = (label.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
        p = p.join(la, "a", "left").join(lb, "b", "left")
        return p.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    rest = named(pairs.join(best, ["a", "b"], "left_anti").select("a", "b"))
    edges = durable(edges.unionByName(_verified(rest, own, k, percent)))
    label = components(edges)
    more = durable(_across(shared, label, classes, own, k, percent, least))
    label = components(edges.unionByName(more))
    of = classes.select("h1", "h2", "rep").join(label.select(F.col("node").alias("rep"), "component"), "rep", "left").select("h1", "h2", F.coalesce("component", "rep").alias("c"))
    out = sketch.select("doc_id", "n_shingles", "h1", "h2").join(of, ["h1", "h2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("c")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))
