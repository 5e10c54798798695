"""Queries against brute force over whole tables."""

import itertools
import random
import re

import pytest

from lexgraph.operators import similar as S
from lexgraph.plans import queries as Q


def test_shared_term_links(spark, tmp_path):
    rows = [(k, c, p, s) for k, (c, p, s) in enumerate([(1, "1-URGENT", "O"), (1, "5-LOW", "O"), (1, "1-URGENT", "O"), (1, "2-HIGH", "F"), (700, "2-HIGH", "F"), (700, "2-HIGH", "F"), (31, "5-LOW", "P"), (31, "2-HIGH", "P")])]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    terms = {}
    for k, c, p, s in rows:
        terms.setdefault(f"{c}/{s}", []).append((k, p))
    want = sorted((a, b, t) for t, of in terms.items() if len({p for _, p in of}) > 1 for a, _ in of for b, _ in of if a < b)
    assert sorted((r.src, r.dst, r.term_lower) for r in Q.shared_term_links(spark, str(tmp_path)).collect()) == want and len(want) == 4


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def variants(rng, letters, sizes):
    words = []
    for n in sizes:
        w = [rng.choice(letters) for _ in range(n)]
        words.append("".join(w))
        for _ in range(8):
            v = list(w)
            for _ in range(rng.randint(1, 3)):
                i = rng.randrange(len(v))
                v[i: i + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters)])
            words.append("".join(v))
    return sorted(set(words))


@pytest.mark.parametrize("most", [1, 2, 3])
def test_near_terms_against_all_pairs(spark, most):
    words = [w for w in variants(random.Random(4), "abc", [*range(2, 24), 60]) if w]
    c = spark.createDataFrame([(w, w, -i) for i, w in enumerate(words)], "iri string, term_lower string, ord int")
    got = [(r.src, r.dst, r.distance) for r in S.near_terms(c, most_terms=None, least_length=1, distance=most).collect()]
    want = {(b, a, d) for a, b in itertools.combinations(words, 2) if 1 <= (d := distance(a, b)) <= most}
    assert len(got) == len(set(got)) and set(got) == want


def test_edit_distance_band(spark, tmp_path):
    words = [w for w in variants(random.Random(5), "abcdefgh", [3, 4, 5, 8, 9, 10, 11, 16, 18, 30])]
    rows = [(i, " ".join(words[i::7]).title(), ("en", "de")[i % 2]) for i in range(7)] + [(8, None, "en")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.term_a, r.term_b, r.distance) for r in Q.edit_distance_band(spark, str(tmp_path)).collect())
    own = sorted({w for _, t, _ in rows for w in re.findall("[a-z]+", (t or "").lower()) if len(w) >= 4})
    assert got == [(a, b, d) for a, b in itertools.combinations(own, 2) if 1 <= (d := distance(a, b)) <= 2]


def test_exact_term_multi_source(spark, tmp_path):
    rows = [(1, "Lex dura lex extraordinarily", "b"), (2, "lex, a LEX-extraordinarily", "a"), (3, "dura a", None), (4, None, "c"), (5, "sola", "c"), (6, "sola a", "c")]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.term, r.n_sources, r.first_source) for r in Q.exact_term_multi_source(spark, str(tmp_path)).collect()}
    assert got == {("lex", 2, "a"), ("extraordinarily", 2, "a"), ("dura", 2, "b"), ("a", 3, "a")}
