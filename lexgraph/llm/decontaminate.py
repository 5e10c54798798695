"""Operator 1: benchmark decontamination by spaced-seed hashing.

A mask selects some words of a window and ignores the others, so that a hash of the selected words survives substitutions
at the ignored places. The masks are chosen so that every overlap that the rule accepts has a window in which one of them
meets no substitution (tested by enumeration). Hashes of documents and benchmark items are joined; for every pair that
shares one, the texts are compared along the alignments of the shared hashes, and an overlap counts if enough words agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _ROLE, _U, keep_rows, map_texts, mix, stored, text_buffers, word_hashes


@dataclass(frozen=True)
class Rule:
    """An alignment counts if `least` words (or all of a shorter item) agree in a stretch with at most one word in
    `one_in` substituted, and no run of substitutions longer than `gap`. Every such stretch has a window of `masks`
    without a substitution at a selected word; this is a property of the default masks and the default rule."""

    least: int = 13
    one_in: int = 5
    gap: int = 2
    masks: tuple[str, ...] = ("1111011", "11101011", "10001001111")

    def shapes(self, n: int) -> list[int]:
        """Numbers of the masks that serve an item of n words; -n stands for a run of n words, the whole of a short item."""
        return [i for i, m in enumerate(self.masks) if len(m) <= n] or [-n]


def seeds(hashes: np.ndarray, first: np.ndarray, shape: int, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of a shape within texts whose words start at `first`, and the positions of the windows."""
    chosen = [i for i, c in enumerate(rule.masks[shape]) if c == "1"] if shape >= 0 else list(range(-shape))
    span = chosen[-1] + 1
    m = max(0, len(hashes) - span + 1)
    end = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(m) + span <= end[:m])
    total = np.full(len(at), _ROLE[40 + shape % 24], _U)
    for k, i in enumerate(chosen):
        total += hashes[at + i] * _ROLE[k]
    return mix(total), at


def _strip(texts):
    """Word hashes of lower-cased texts without punctuation at the words' ends, and the first word of each text."""
    import pyarrow.compute as pc

    t = pc.replace_substring_regex(texts.fill_null(""), r"[.,;:!?\"'()\[\]|]+", " ")
    h, _, _, first = word_hashes(*text_buffers(t))
    return h, first


#: Combinations of a document's and an item's windows, and words, that one step of a comparison holds.
STEP = 2_000_000


def _diagonals(own: np.ndarray, item: np.ndarray, rule: Rule) -> np.ndarray:
    """Alignments (document position - item position) at which some window of both is equal, in steps of bounded size."""
    met = np.zeros(len(own) + len(item) + 1, bool)
    for shape in rule.shapes(len(item)):
        (s, at), (t, where) = (seeds(x, np.array([0, len(x)]), shape, rule) for x in (own, item))
        order = np.argsort(t, kind="stable")
        t, where = t[order], where[order]
        lo, hi = np.searchsorted(t, s), np.searchsorted(t, s, side="right")
        hit = np.flatnonzero(hi > lo)
        reps = (hi - lo)[hit]
        for part in np.split(np.arange(len(hit)), np.flatnonzero(np.diff(np.cumsum(reps) // STEP)) + 1) if len(hit) else ():
            n = reps[part]
            which = np.repeat(lo[hit[part]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            met[np.repeat(at[hit[part]], n) - where[which] + len(item)] = True
    return np.flatnonzero(met) - len(item)


def _stretch(same: np.ndarray, need: int, rule: Rule) -> tuple[int, int, int] | None:
    """(words that agree, first, last + 1) of the best stretch of a comparison word by word, or None."""
    at = np.flatnonzero(same)
    if len(at) < need:
        return None
    best = None
    for part in np.split(at, np.flatnonzero(np.diff(at) > rule.gap + 1) + 1):
        # most words from i to j with one_in (words that agree) >= (one_in - 1) (words in all)
        g = rule.one_in * np.arange(len(part)) - (rule.one_in - 1) * part
        low = np.minimum.accumulate(g)
        i = np.searchsorted(-low, -(g + 1), side="left")
        n = np.arange(1, len(part) + 1) - i
        j = int(np.argmax(n))
        if n[j] >= need and (best is None or n[j] > best[0]):
            best = (int(n[j]), int(part[i[j]]), int(part[j]) + 1)
    return best


def overlap(own: np.ndarray, item: np.ndarray, rule: Rule = Rule()) -> tuple[int, int, int] | None:
    """(words that agree, first, last + 1 word of the document) of the best overlap with an item, ties to the earliest."""
    best = None
    for shift in _diagonals(own, item, rule).tolist():
        lo, hi = max(0, -shift), min(len(item), len(own) - shift)
        got = _stretch(own[lo + shift: hi + shift] == item[lo:hi], min(rule.least, len(item)), rule)
        if got:
            got = (got[0], got[1] + lo + shift, got[2] + lo + shift)
            if best is None or (got[0], -got[1]) > (best[0], -best[1]):
                best = got
    return best


#: Bits of the table of hashes that spares documents without any shared hash the join. Its size is fixed: where a benchmark
#: fills it, more documents take part in the join, and results stay the same.
TABLE_BITS = 25


def _slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return h >> _U(64 - TABLE_BITS), (h >> _U(8)) & _U((1 << TABLE_BITS) - 1)


def _index(items: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, list[int], np.ndarray]:
    """(benchmark rows with a number, seeds: h and number, shapes in use, table of hashes)."""
    rows = stored(items.where("item_id is not null").select(F.monotonically_increasing_id().alias("doc_id"), "item_id", "text"))

    def of(batch):
        import pyarrow as pa

        h, first = _strip(batch.column("text"))
        own, hashes, kinds = [], [], []
        for row, a, b in zip(batch.column("doc_id").to_pylist(), first[:-1], first[1:], strict=True):
            for shape in rule.shapes(int(b - a)) if b > a else ():
                got = np.unique(seeds(h[a:b], np.array([0, b - a]), shape, rule)[0])
                own.append(np.full(len(got), row))
                hashes.append(got.view(np.int64))
                kinds.append(np.full(len(got), shape))
        if not own:
            return None
        return [pa.array(np.concatenate(own), pa.int64()), pa.array(np.concatenate(hashes)), pa.array(np.concatenate(kinds), pa.int32())]

    found = stored(map_texts(rows, of, "item bigint, h bigint, shape int"))
    shapes = sorted(r.shape for r in found.select("shape").distinct().collect())  # at most one per mask and short length
    slot = F.explode(F.array(F.shiftrightunsigned("h", 64 - TABLE_BITS), F.shiftrightunsigned("h", 8).bitwiseAND(F.lit((1 << TABLE_BITS) - 1))))
    words = found.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits"))
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    got = words.toArrow()
    table[got.column("w").to_numpy()] = got.column("bits").to_numpy()
    return rows, found.select("item", "h").distinct(), shapes, table.view(_U)


def _hits(texts, shapes: list[int], table: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of a run of texts that the table has."""
    h, first = _strip(texts)
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    rows, hashes = [np.zeros(0, np.int64)], [np.zeros(0, _U)]
    for shape in shapes:
        s, at = seeds(h, first, shape, rule)
        for k in range(2):
            slot = _slots(s)[k]
            keep = (table[slot >> _U(6)] >> (slot & _U(63))) & _U(1) == 1
            s, at = s[keep], at[keep]
        rows.append(of[at])
        hashes.append(s)
    return np.concatenate(rows), np.concatenate(hashes)


def _search(docs: DataFrame, items: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows of docs without any shared hash, the other rows as row and d, their overlaps by row).

    Documents are read twice, without a shuffle; only rows that share a hash with the benchmark take part in the join.
    """
    rows, index, shapes, table = _index(items, rule)

    def touched(batch):
        out = np.zeros(batch.num_rows, bool)
        out[_hits(batch.column("text"), shapes, table, rule)[0]] = True
        return out

    def shared(batch):
        import pyarrow as pa

        i, h = _hits(batch.column("text"), shapes, table, rule)
        got = np.unique(np.stack([i.astype(np.uint64), h]), axis=1)
        return [batch.column("doc_id").take(pa.array(got[0].astype(np.int64))), pa.array(got[1].view(np.int64))]

    some = stored(keep_rows(docs, touched).select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("d")))
    hashes = map_texts(some.select(F.col("row").alias("doc_id"), F.col("d.text").alias("text")), shared, "row bigint, h bigint")
    pairs = hashes.join(index, "h").select("row", "item").distinct()
    full = pairs.join(rows.select(F.col("doc_id").alias("item"), "item_id", F.col("text").alias("wanted")), "item")
    full = full.join(some.select("row", F.col("d.doc_id").alias("doc_id"), F.col("d.text").alias("text")), "row")
    found = full.select("row", "doc_id", "text", "item", "item_id", "wanted").mapInArrow(_verify(rule), f"row bigint, {SCHEMA}")
    return keep_rows(docs, lambda batch: ~touched(batch)), some, found


SCHEMA = "doc_id bigint, item_id bigint, n_match bigint, n_item bigint, first_word bigint, end_word bigint"


def _verify(rule: Rule):
    """The best overlap of each pair of a document and an item that has one."""

    def run(batches):
        import pyarrow as pa

        last: tuple = (None, None)  # rows come in order, so that a document is hashed once for its items
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            out = []
            for i, (row, doc, item, name) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "item", "item_id")), strict=True)):
                if last[0] != row:
                    last = (row, _strip(batch.column("text").slice(i, 1))[0])
                if item not in known:
                    if len(known) >= 256:
                        known.clear()
                    known[item] = _strip(batch.column("wanted").slice(i, 1))[0]
                if got := overlap(last[1], known[item], rule):
                    out.append((row, doc, name, got[0], len(known[item]), got[1], got[2]))
            columns = zip(*out, strict=True) if out else [[] for _ in range(7)]
            names = ["row", *(part.split()[0] for part in SCHEMA.split(", "))]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names)

    return run


def contaminated(docs: DataFrame, items: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per (row of docs, item) with an overlap: doc_id, item_id, n_match, n_item, first_word, end_word.

    Null and empty texts have no words and match nothing; items whose id is null are left out; rows and items that are
    repeated each give rows, with a null doc_id too; the best alignment of a pair is reported, ties to the earliest. Texts
    of any length and repetition are compared in steps of bounded size. Empty tables give an empty result, and other
    columns of docs are not looked at.
    """
    return _search(docs.select("doc_id", "text"), items, rule)[2].drop("row")


def clean(docs: DataFrame, items: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """docs without the rows that overlap any item; all columns and all other rows stay, those without an id too."""
    untouched, some, found = _search(docs, items, rule)
    return untouched.unionByName(some.join(found.select("row").distinct(), "row", "left_anti").select("d.*"))
