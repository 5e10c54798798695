"""The join of word sets: against all pairs, over blocks, and without a row per pair."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from lexgraph.operators import setjoin
from lexgraph.operators import similar as S


def similar(sets, groups, least_shared, least):
    out = {}
    for i, j in itertools.combinations(range(len(sets)), 2):
        shared = len(sets[i] & sets[j])
        if (groups[i] is None or groups[i] != groups[j]) and min(len(sets[i]), len(sets[j])) >= least_shared and shared >= least_shared and shared / len(sets[i] | sets[j]) >= least:
            out[i, j] = shared
    return out


def drawn(rng, n, words):
    """Sets of many sizes, some of them near copies."""
    sets = [{rng.randrange(words) ** 2 // words for _ in range(rng.choice((3, 5, 8, 20, 60)))} for _ in range(n)]
    for k in range(0, n, 3):
        sets[k] = {w for w in sets[k - 1] if rng.random() < 0.8} | {rng.randrange(words)}
    return sets


@pytest.mark.parametrize(("coded", "least_shared", "least"), [(0, 3, 0.3), (40, 3, 0.3), (400, 3, 0.3), (40, 1, 0.05), (40, 1, 0.8), (40, 2, 1.0)])
def test_blocks_against_all_pairs(coded, least_shared, least):
    rng = random.Random(coded)
    sets, groups = drawn(rng, 150, 400), [rng.choice((None, "a", "b", "c")) for _ in range(150)]
    key = lambda w: (w * 0x9E3779B97F4A7C15) % (1 << 63) - (1 << 62)
    known = sorted((key(w), 399 - w) for w in range(400) if w < coded)
    pack = setjoin.packer(np.array([k for k, _ in known], np.int64), np.array([c for _, c in known], np.uint16))
    kept = [i for i, s in enumerate(sets) if len(s) >= least_shared]
    rows = pa.record_batch({"rid": pa.array(kept, pa.int64()), "n": pa.array([len(sets[i]) for i in kept], pa.int32()), "grp": pa.array([groups[i] for i in kept], pa.string()), "h": pa.array([[key(w) for w in sets[i]] for i in kept], pa.list_(pa.int64()))})
    table = pa.Table.from_batches(pack([rows.slice(0, 7), rows.slice(7)]))
    one = pa.array(np.arange(len(kept)) % 3 == 0)
    parts = [table.filter(one), table.filter(pa.compute.invert(one))]
    want = similar(sets, groups, least_shared, least)
    for tasks in ([(table, None)], [(parts[0], None), (parts[1], None), (parts[0], parts[1])], [(parts[0], None), (parts[1], None), (parts[1], parts[0])]):
        found = np.concatenate([setjoin.matches(x, y, ("grp",), least_shared, least, None) for x, y in tasks], axis=1)
        assert len(found.T) == len(want) and {(a, b): n for a, b, n, _ in found.T.tolist()} == want
    best = setjoin.matches(table, None, ("grp",), least_shared, least, 2)
    rank = lambda i, j: (want[i, j] / len(sets[i] | sets[j]), j)
    assert {(a, b) for a, b, _, _ in best.T.tolist()} == {(i, j) for i, j in want if sum(a == i and rank(a, b) > rank(i, j) for a, b in want) < 2}


def test_blocks_in_waves(spark, monkeypatch):
    rng = random.Random(7)
    sets, groups = drawn(rng, 200, 300), [rng.choice((None, "a", "b")) for _ in range(200)]
    monkeypatch.setattr(S, "BLOCK_POSTINGS", 500)
    monkeypatch.setattr(S, "COPIES", 2)
    for order, kind in ((str, "string"), (int, "bigint")):
        d = spark.createDataFrame([(f"id{i}", order(1000 + i), g, [str(w) for w in s] * 2) for i, (s, g) in enumerate(zip(sets, groups))], f"id string, ord {kind}, grp string, keywords array<string>")
        got = {(int(r.a[2:]), int(r.b[2:])): r.shared for r in S.keyword_similarity(d, 3, 0.3, None).collect()}
        assert got == similar(sets, groups, 3, 0.3) and len(got) > 50


def written(spark):
    """Rows that all stages so far have written to shuffles."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    sc._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_no_row_per_pair_of_sets_that_share_a_rare_word(spark):
    rng = random.Random(8)
    sets = [{f"rare{i % 6}", *(f"word{w}" for w in rng.sample(range(40), 10))} for i in range(600)]
    d = spark.createDataFrame([(i, i, None, sorted(s)) for i, s in enumerate(sets)], "id int, ord int, grp int, keywords array<string>")
    before = written(spark)
    got = S.keyword_similarity(d, 3, 0.6, None).collect()
    assert {(r.a, r.b): r.shared for r in got} == similar(sets, [None] * 600, 3, 0.6)
    assert written(spark) - before < 5_000
