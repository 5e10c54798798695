"""Operator 6 in two phases: what the last joins read, and lines that only match lines which are no pivots."""

import random

import pytest

lines = pytest.importorskip("lexgraph.llm.lines")


def chains(rng, n):
    """Lines in chains, each a step away from the one before it, so that most match others than the pivot of a group."""
    out = []
    for c in range(n):
        words = [f"c{c}w{i}" for i in range(20)]
        for step in range(8):
            words[step] = f"c{c}s{step}"
            out.append(" ".join(rng.sample(words, len(words))))
    return out + rng.sample(out, n)


def test_the_last_joins_read_stored_parts(spark):
    rng = random.Random(11)
    own = chains(rng, 12)
    rng.shuffle(own)
    docs = [(i, "\n".join(own[i::9])) for i in range(9)]
    out = lines.removed_lines(spark.createDataFrame(docs, "doc_id bigint, text string"))
    seen, want = [], set()
    for d, text in docs:
        for k, line in enumerate(text.split("\n")):
            words = set(line.split(" "))
            if any(len(words & x) * 100 >= len(words | x) * 80 for x in seen):
                want.add((d, k))
            seen.append(words)
    assert {(r.doc_id, r.line_no) for r in out.collect()} == want and 40 < len(want) < len(own)
    # neither the entries of words nor the lines with their texts are exchanged any more
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "RepartitionByExpression" not in plan


def test_entries_keep_their_fields_and_compress(spark):
    """Fields of index entries come back whole, sizes over 255 and 65535 too; of a usual line, only few bytes are not zero."""
    from pyspark.sql import functions as F

    sizes = {1: 12, 2: 300, 3: 70_000}
    rows = [(i, 1, (i, 0), i * 100, " ".join(f"l{i}w{k}" for k in range(n))) for i, n in sizes.items()]
    distinct = spark.createDataFrame(rows, "t bigint, u int, r struct<doc_id:bigint,line_no:int>, copies bigint, line string").withColumn("u", F.col("t").cast("int") * 85)
    out = lines._entries(distinct, F.array_repeat(F.lit(1).cast("tinyint"), lines.BUCKETS), 99, 80, 5)
    got = out.select("t", "d", "ucnp", *(F.expr(lines._fields("")[c]).alias(f"f_{c}") for c in "ucnp")).collect()
    for i, n in sizes.items():
        own = [r for r in got if r.t == i]
        assert {(r.d, r.f_u, r.f_c, r.f_n) for r in own} == {(i, i * 85, min(i * 100, 255), n)}
        assert sorted(r.f_p for r in own) == list(range(n // 5 + 1))
    assert all(r.ucnp & 0xFFFFFFFF == 0 for r in got if r.t == 1)


def test_rare_words_come_first(spark):
    """The prefix of a line holds words that are rare over all texts, of those that the table cannot tell the longest."""
    from pyspark.sql import functions as F

    common = [f"everywhere{i}" for i in range(20)]
    docs = spark.createDataFrame([(i, " ".join(common * 20 + [f"r{i}"])) for i in range(400)], "doc_id bigint, text string")
    grades, _ = lines.rarity(docs)
    keys = lambda *words: spark.range(1).select(lines._keys(F.lit(" ".join(words)), F.lit(grades).cast("array<tinyint>")).alias("k")).first().k
    order = [keys(w)[0] for w in ("somewhatlonger", "rather", "r1", common[0])]
    assert order == sorted(order) and keys("r1", common[0], "rather", "somewhatlonger") == order


def test_the_search_reads_each_exchange_once_more_at_most(spark, monkeypatch):
    """Lines are made distinct for the two sides of the search and for what is stored of it, and no window sorts all entries."""
    seen, stored = [], lines.stored
    monkeypatch.setattr(lines, "stored", lambda df: (seen.append(df._jdf.queryExecution().optimizedPlan().toString()), stored(df))[1])
    docs = spark.createDataFrame([(i, " ".join(f"w{i % 3}x{k}" for k in range(9))) for i in range(9)], "doc_id bigint, text string")
    assert {r.doc_id for r in lines.removed_lines(docs).collect()} == set(range(3, 9))
    assert seen[0].count("first(line") == 3 and "Window" not in seen[0]
