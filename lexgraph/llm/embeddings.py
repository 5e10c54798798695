"""Operator 7: near-duplicate vectors by spherical-cap filters with structured random product codes.

A rotated unit vector is cut into blocks; every block has a codebook of random directions, and a filter is one codeword
per block, so a filter's score is a sum of block scores. A vector belongs to all filters whose score exceeds a level,
found by list decoding over the sorted block scores. Vectors that share a filter (and a label) are compared in double
precision.
"""

from __future__ import annotations

from math import ceil

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, durable

COSINE = 0.98
#: Blocks of the product code: a block's codebook has as many words as the cube root of the filters.
PARTS = 3
#: Filters that a vector exceeds on average.
LISTED = 20
#: Filters that every vector has at least: its own level falls until it exceeds so many.
LEAST = 12
#: Vectors of a filter that are compared in one task; a larger filter is dealt to pairs of blocks.
BLOCK = 1024
SEED = 20240607


class Code:
    """The product code for vectors of one dimension: a rotation, codebooks, and the level with `listed` filters on average."""

    def __init__(self, dim: int, size: int, listed: int = LISTED, seed: int = SEED):
        rng = np.random.default_rng([seed, dim])
        self.dim = dim
        self.blocks = max(1, min(dim, PARTS))
        self.words = max(4, ceil(size ** (1 / self.blocks)))
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cuts = [int(round(i * dim / self.blocks)) for i in range(self.blocks + 1)]
        self.books = []
        for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True):
            book = rng.standard_normal((self.words, b - a))
            self.books.append((book / np.linalg.norm(book, axis=1, keepdims=True) / np.sqrt(self.blocks)).astype(np.float32))
        # the level follows from the code alone: filter scores of random directions, not of the data
        probe = rng.standard_normal((256, dim))
        probe = (probe / np.linalg.norm(probe, axis=1, keepdims=True)).astype(np.float32)
        listed = min(listed, self.words**self.blocks // 2)
        top = np.concatenate([self.highest(x, 64 * listed) for x in self.scores(probe)])
        self.level = float(np.partition(top, len(top) - listed * len(probe))[len(top) - listed * len(probe)])

    def highest(self, scores: tuple[np.ndarray, ...], n: int) -> np.ndarray:
        """The n highest filter scores (or all), from above: of two falling rows, sums of ranks i and j can only be among
        the n highest if i * j <= n."""
        out = np.zeros(1)
        for s in scores:
            a, b = -np.sort(-out)[:n], -np.sort(-s)[:n]
            sums = [a[: n // (j + 1)] + b[j] for j in range(len(b))]
            out = np.concatenate(sums)
        return -np.sort(-out)[:n]

    def scores(self, x: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        y = x @ self.rotation.astype(np.float32)
        per = [y[:, a:b] @ book.T for (a, b), book in zip(zip(self.cuts[:-1], self.cuts[1:], strict=True), self.books, strict=True)]
        return list(zip(*per, strict=True))

    def filters(self, scores: tuple[np.ndarray, ...]) -> np.ndarray:
        """All filters over the level, or over the first lower level (in steps) that LEAST filters exceed."""
        level, least = self.level, min(LEAST, self.words**self.blocks)
        while len(got := self.decode(scores, level)) < least:
            level -= 0.01
        return got

    def decode(self, scores: tuple[np.ndarray, ...], level: float) -> np.ndarray:
        """All filters whose block scores add up to the level or more, by extending only what can still reach it."""
        best_rest = np.cumsum([0.0, *(s.max() for s in reversed(scores))])[::-1]
        ids, sums = np.zeros(1, np.int64), np.zeros(1)
        for k, s in enumerate(scores):
            order = np.argsort(-s)
            ranked = s[order]
            need = level - best_rest[k + 1] - sums
            n = np.searchsorted(-ranked, -need, side="right")
            keep = np.repeat(np.arange(len(ids)), n)
            j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            ids, sums = ids[keep] * self.words + order[j], sums[keep] + ranked[j]
        return np.sort(ids)


def _valid(vectors: DataFrame) -> DataFrame:
    """Distinct (label, embedding) of the vectors that can link, with the smallest vec_id and the number of copies."""
    v = F.col("embedding").cast("array<double>")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    ok = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & some, F.lit(False)))
    return ok.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))


def _unit(column) -> np.ndarray:
    """Rows of an Arrow list column (all of one length) as unit vectors in double precision."""
    x = np.array(column.to_pylist(), dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _listed(classes: DataFrame, codes: dict[int, Code]) -> DataFrame:
    """rep and the sorted filters of each class."""

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                code = codes[int(dim)]
                x = _unit(part.column("embedding")).astype(np.float32)
                got = [code.filters(s) for s in code.scores(x)]
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(got, pa.list_(pa.int64()))], ["rep", "filters"])

    return classes.select("rep", "dim", "embedding").mapInArrow(rows, "rep bigint, filters array<bigint>")


_LINKS = "node bigint, links bigint, other bigint"


def _compare(cosine: float):
    """One filter, or one pair of its blocks: links of every vector that are counted here, and a spanning edge each.

    A pair is counted under the smallest filter that both exceed only.
    """

    def run(table):
        import pyarrow as pa

        n = table.num_rows
        x = _unit(table.column("embedding"))
        rep, copies, side = (table.column(c).to_numpy() for c in ("rep", "copies", "side"))
        mine = table.column("filter")[0].as_py()
        lists = table.column("filters").to_pylist()
        flat = np.array([f for fs in lists for f in fs if f < mine], dtype=np.int64)
        owner = np.repeat(np.arange(n), [sum(f < mine for f in fs) for fs in lists])
        smaller, at, seen = np.unique(flat, return_inverse=True, return_counts=True)
        shared = seen[at] > 1
        column = np.cumsum(seen > 1) - 1
        member = np.zeros((n, int((seen > 1).sum())), dtype=np.float32)
        member[owner[shared], column[at[shared]]] = 1
        near = x @ x.T >= cosine
        np.fill_diagonal(near, False)
        if table.column("cross")[0].as_py():  # only pairs between the two blocks
            near &= side[:, None] != side[None, :]
        count = near & ~(member @ member.T > 0) if member.shape[1] else near
        links = count.astype(np.float64) @ copies.astype(np.float64)
        label = np.arange(n)
        order = np.argsort(rep, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        label = place.copy()  # rank of the smallest vec_id reached so far
        while True:
            step = np.minimum(label, np.where(near, label[None, :], n).min(axis=1, initial=n))
            if (step == label).all():
                break
            label = step
        low = rep[order[label]]
        out = (links > 0) | (low != rep)
        return pa.Table.from_arrays([pa.array(rep[out], pa.int64()), pa.array(links[out].astype(np.int64)), pa.array(low[out], pa.int64())], ["node", "links", "other"])

    return run


def links(vectors: DataFrame, cosine: float = COSINE, listed: int = LISTED, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(classes with rep and copies, their links: node, links, other)."""
    classes = durable(_valid(vectors).withColumn("dim", F.size("embedding")))
    sizes = {r.dim: r["count"] for r in classes.groupBy("dim").count().collect()}
    codes = {dim: Code(dim, max(256, 4 * n * listed), listed) for dim, n in sizes.items()}
    own = durable(_listed(classes, codes).where(F.size("filters") > 0))
    keyed = own.select("rep", F.explode("filters").alias("filter"))
    keyed = keyed.join(classes.select("rep", "label", "dim"), "rep")
    group = ["label", "dim", "filter"]
    full = keyed.groupBy(*group).agg(F.count("*").alias("n")).where("n > 1")
    members = keyed.join(full, group).select(*group, "rep", F.ceil(F.col("n") / block).cast("int").alias("nb"))
    side = F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int")
    members = members.withColumn("side", side)
    # a block meets itself and every other block once: (low, high) names the task
    members = members.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    members = members.select(*group, "rep", "side", F.least("side", "o").alias("low"), F.greatest("side", "o").alias("high"))
    rows = members.join(own, "rep").join(classes.select("rep", "copies", "embedding"), "rep").withColumn("cross", F.col("low") != F.col("high"))
    found = rows.groupBy(*group, "low", "high").applyInArrow(_compare(cosine), _LINKS)
    return classes, durable(found)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, listed: int = LISTED, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of vectors (vec_id, embedding, label).

    Equal vectors of a label form a class whose members link with each other; classes are compared once. Null, zero,
    non-finite or partly null vectors and null labels link with nothing, nor do vectors of different lengths; rows
    without vec_id come back with null as component and are kept.
    """
    classes, found = links(vectors, cosine, listed, block)
    label = components(found, "node", "other")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    of = (
        classes.join(sums, F.col("rep") == F.col("node"), "left").drop("node")
        .join(label, F.col("rep") == F.col("node"), "left")
        .select(F.col("label").alias("l"), F.col("embedding").alias("e"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    )
    rows = vectors.select("vec_id", "embedding", "label")
    out = rows.join(of, (rows["label"] == of["l"]) & (rows["embedding"] == of["e"]) & rows["vec_id"].isNotNull(), "left")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
