"""Every overlap that the rule accepts is found, by enumeration of the substituted words."""

import itertools

import pytest

pytest.importorskip("lexgraph.llm")
import numpy as np  # noqa: E402

from lexgraph.llm import decontaminate as D  # noqa: E402


def longest(same, rule, least):
    """Most agreeing words of a stretch that the rule accepts, over all stretches."""
    best = 0
    for i, j in itertools.combinations(range(len(same) + 1), 2):
        part = same[i:j]
        gone = part.count("0")
        if part[0] == part[-1] == "1" and gone * rule.one_in <= len(part) and "0" * (rule.gap + 1) not in part:
            best = max(best, len(part) - gone)
    return best if best >= least else 0


def found(docs, item):
    """Words that agree in the best overlap of each text, by number."""
    number = {}
    hashes = lambda words: np.array([number.setdefault(w, len(number) + 1) for w in words], dtype=np.uint64)
    got = {d: D.overlap(hashes(words), hashes(item)) for d, words in enumerate(docs)}
    return {d: x[0] for d, x in got.items() if x}


@pytest.mark.parametrize(("size", "most"), [(13, 1), (14, 2), (15, 3), (16, 3), (18, 3), (20, 4)])
def test_substitutions(size, most):
    rule = D.Rule()
    item = [f"b{i}" for i in range(size)]
    gone = [g for m in range(most + 1) for g in itertools.combinations(range(size), m)]
    docs = [["x", *(f"z{i}" if i in g else w for i, w in enumerate(item)), "y"] for g in gone]
    want = {d: n for d, g in enumerate(gone) if (n := longest("".join("01"[i not in g] for i in range(size)), rule, 13))}
    assert found(docs, item) == want


def test_dense_substitutions():
    rng, rule = np.random.default_rng(1), D.Rule()
    item = [f"b{i}" for i in range(60)]
    rows = [rng.random(60) < 0.25 for _ in range(150)]
    docs = [["z" if x else w for x, w in zip(r, item, strict=True)] for r in rows]
    assert found(docs, item) == {d: n for d, r in enumerate(rows) if (n := longest("".join("10"[int(x)] for x in r), rule, 13))}


def test_masks_meet_every_accepted_overlap():
    """All patterns of agreeing words (1) and substitutions (0) with 13 to 25 agreeing words. A longer one need not be
    tried: cut after its 13th agreeing word, one of its parts is accepted and has 13 agreeing words or more."""
    rule = D.Rule()
    patterns = []
    for ones in range(rule.least, 2 * rule.least):
        grown = {0: (np.ones(1, np.uint64), np.ones(1, np.uint64))}
        for _ in range(ones - 1):
            new = {}
            for zeros, (bits, size) in grown.items():
                for gap in range(rule.gap + 1):
                    if (zeros + gap) * (rule.one_in - 1) <= ones:
                        new.setdefault(zeros + gap, []).append((bits | np.uint64(1) << (size + np.uint64(gap)), size + np.uint64(gap + 1)))
            grown = {z: tuple(np.concatenate(x) for x in zip(*parts, strict=True)) for z, parts in new.items()}
        patterns += [bits for bits, _ in grown.values()]
    p = np.concatenate(patterns)
    met = np.zeros(len(p), bool)
    for mask in rule.masks:
        m = np.uint64(int(mask, 2))
        for shift in range(34 - len(mask)):
            met |= (p >> np.uint64(shift)) & m == m
    assert len(p) > 1_000_000 and met.all()


def test_long_and_repetitive_texts(spark, docs):
    """Texts whose windows are all alike meet in every alignment, which must not be held at once."""
    rows = [(1, "buy now " * 6_000), (2, "never " * 3_000), (3, "x")]
    items = spark.createDataFrame([(7, "now buy " * 400), (8, "never " * 200), (9, "")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.n_match, r.n_item) for r in D.contaminated(docs(rows), items).collect()}
    assert got == {(1, 7): (800, 800), (2, 8): (200, 200)}


def test_against_all_pairs(spark, docs, prose):
    """Every document with every item, null and repeated rows among them."""
    items = [(i, prose(n, f"i{i}")) for i, n in enumerate([1, 3, 6, 7, 8, 10, 12, 13, 14, 20, 35, 60])] + [(3, prose(6, "i2")), (90, None)]
    rng = np.random.default_rng(4)
    rows = []
    for d in range(120):
        words = prose(60, f"d{d}").split()
        own = (items[d % 12][1]).split()
        own = [w if rng.random() > 0.12 * (d % 3) else f"q{d}" for w in own]
        rows.append((d if d % 9 else None, " ".join(words[:20] + own + words[20:])))
    rows += rows[:5] + [(500, None), (501, "")]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.n_match) for r in D.contaminated(docs(rows), spark.createDataFrame(items, "item_id bigint, text string")).collect())
    want = []
    for d, t in rows:
        for i, x in items:
            if t and x and (n := found([t.split()], x.split())):
                want.append((d if d is not None else -1, i, n[0]))
    assert got == sorted(want) and len(got) > 80
