import math

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("lexgraph.llm")
from lexgraph.llm import embeddings, mixing  # noqa: E402


def brute_vectors(rows, cosine=0.98):
    ok = [i for i, (_, v, label) in enumerate(rows) if label is not None and v is not None and None not in v and all(map(math.isfinite, v)) and any(v)]
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in ok}
    links, comp = {i: 0 for i in range(len(rows))}, {i: i for i in range(len(rows))}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for n, a in enumerate(ok):
        for b in ok[n + 1:]:
            if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                lo = min(x, y, key=lambda i: rows[i][0])
                comp[x] = comp[y] = lo
    return {rows[i][0]: (links[i], rows[find(i)][0]) for i in range(len(rows))}


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors(spark, block):
    rng = np.random.default_rng(0)
    rows = []
    for c in range(8):
        base = rng.standard_normal(24)
        for _ in range(30):
            rows.append((len(rows), (base + rng.normal(0, 0.1, 24)).astype(np.float32).tolist(), c % 3))
    rows += [(1000 + i, rng.standard_normal(24).astype(np.float32).tolist(), i % 3) for i in range(100)]
    rows += [(2000, rows[0][1], 0), (2001, rows[0][1], 1), (2002, None, 0), (2003, [0.0] * 24, 0), (2004, [None] + rows[0][1][1:], 0), (2005, [float("nan")] * 24, 0), (2006, rows[0][1], None), (2007, rows[0][1][:10], 0), (2008, [float("inf")] + rows[0][1][1:], 0), (2009, [], 0)]
    df = spark.createDataFrame([(i, v, x, "clash") for i, v, x in rows], "vec_id bigint, embedding array<float>, label int, n_links string")
    out = embeddings.near_duplicates(df, block=block)
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    want = brute_vectors(rows)
    assert set(got) == set(want)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g for g, _ in got.values()) >= 0.99 * sum(w for w, _ in want.values()) and sum(got[i] == want[i] for i in want) >= 0.98 * len(want)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    assert embeddings.near_duplicates(spark.createDataFrame([(None, [1.0, 2.0], 1)], "vec_id bigint, embedding array<float>, label int")).first().kept


def test_list_decoding_is_complete():
    code = embeddings.Code(16, 400, listed=10)
    x = np.random.default_rng(1).standard_normal((20, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for s in code.scores(x):
        sums, ids = np.zeros(1, np.float32), np.zeros(1, np.int64)
        for block in s:
            sums, ids = (sums[:, None] + block).ravel(), (ids[:, None] * code.words + np.arange(code.words)).ravel()
        every = set(ids[sums >= code.level].tolist())
        assert np.allclose(code.highest(s, 50), -np.sort(-sums)[:50])
        assert every == set(code.decode(s, code.level).tolist())
        assert len(code.filters(s)) >= embeddings.LEAST


@pytest.mark.parametrize("n", [500, 50_000, 5_000_000, 1_000_000_000])
def test_recall_of_codes_of_every_size(n):
    """Pairs just over the threshold share a filter, whatever the number of vectors the code is made for."""
    code = embeddings.Code(48, max(256, 4 * n * embeddings.LISTED))
    rng = np.random.default_rng(5)
    x, z = rng.standard_normal((2, 150, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.981 * x + np.sqrt(1 - 0.981**2) * z
    own, other = ([set(code.filters(s).tolist()) for s in code.scores(v.astype(np.float32))] for v in (x, y))
    assert np.mean([bool(a & b) for a, b in zip(own, other, strict=True)]) >= 0.97
    assert np.mean([len(a) for a in own]) < 4 * embeddings.LISTED


# ---- mixing


def brute_plan(tokens, entropy, budget=1.0, most=4.0):
    p = np.array(tokens) / sum(tokens)
    weights = lambda a: p**a / (p**a).sum()
    h = lambda w: -(w * np.log(w)).sum()
    grid = np.linspace(0, 1, 200_001)
    flat = next((a for a in grid[::-1] if h(weights(a)) >= entropy * np.log(len(p)) - 1e-12), 0)
    least = next(a for a in grid if (weights(a) * budget / p).max() <= most)
    return weights(max(flat, least))


def test_mixing(docs, prose):
    rows = [(i, prose(20 + i % 5, i)) for i in range(900)]
    where = lambda i: "big" if i is None or i % 10 < 7 else ("mid" if i % 10 < 9 else "small")
    d = docs(rows + [(9001, None), (9002, ""), (9003, " ")], source=where)
    sizes = d.select("source", mixing.token_count(F.col("text")).alias("n")).where("n > 0").groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_tokens"))
    plan = {r.source: r for r in mixing.plan(sizes, entropy=0.95).collect()}
    names = sorted(plan)
    want = brute_plan([plan[n].n_tokens for n in names], 0.95)
    assert np.allclose([plan[n].weight for n in names], want, atol=1e-4)
    out = mixing.mix(d, entropy=0.95, block=32).collect()
    for n in names:
        got = sum(r.n_tokens for r in out if r.source == n)
        assert plan[n].budget_tokens <= got < plan[n].budget_tokens + 30 * 32
        taken = [(r.doc_id, r.epoch) for r in out if r.source == n]
        assert len(taken) == len(set(taken))
        for e in range(max(r.epoch for r in out if r.source == n)):
            assert sum(r.epoch == e for r in out if r.source == n) == plan[n].n_docs
    assert {r.doc_id for r in out}.isdisjoint({9001, 9002, 9003})
    assert mixing.mix(docs([])).count() == 0


def test_repetition_limit_and_odd_rows(docs, prose):
    rows = [(i, prose(10, i)) for i in range(200)] + [(None, prose(10, "x")), (7, prose(10, 7))]
    d = docs(rows, source=lambda i: None if i == 0 else ("a" if i is None or i % 20 else "b"))
    sizes = d.select("source", mixing.token_count(F.col("text")).alias("n")).groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_tokens"))
    plan = mixing.plan(sizes, entropy=1.0, max_epochs=2.0).collect()
    total = sum(r.n_tokens for r in plan)
    assert all(r.weight * total / r.n_tokens <= 2.0 + 1e-6 for r in plan) and len(plan) == 3
    out = mixing.mix(d, entropy=1.0, max_epochs=2.0).collect()
    assert {r.source for r in out} == {None, "a", "b"}
