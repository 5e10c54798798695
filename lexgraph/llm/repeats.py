"""Operator 5: removal of repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

1. Every window of `length` bytes belongs to its minimiser (the least hash of its k-byte substrings, leftmost on ties),
   a function of the window's content, so equal windows meet under equal minimisers. Neighbouring windows with one
   minimiser position form a segment; segments are grouped by minimiser.
2. A minimiser that occurs once has no repeated window. Equal segments are counted by hash and stand for each other:
   all their windows repeat.
3. What is left - segments with distinct contents under a shared minimiser - is dealt to bounded chunks. In a chunk,
   a breadth-first backward extension on the transform of the segments derives common prefixes by increasing value and
   stops at `length`: neighbours in suffix order that no interval has separated by then share a window.
4. A group too large for one chunk is dealt to several; windows that are single in their chunk are then compared
   between chunks by a 128-bit hash, combined before it is shuffled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _U, _powers, _P, _P_INV, mix, slices, stored, text_buffers

LENGTH = 200
K = 48
#: Bytes of segment text that one chunk holds on average.
CHUNK = 1 << 20


# ---------------------------------------------------------------- windows and minimisers

_PIECE = 1 << 18
_POW, _INV = _powers(_P, _PIECE + 1024), _powers(_P_INV, _PIECE + 1024)
_VALUE = mix((np.arange(256, dtype=_U) + _U(1)) * _U(0xD6E8FEB86659FD93))


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k-byte substring."""
    n = len(data) - k + 1
    out = np.empty(max(n, 0), dtype=_U)
    for i in range(0, n, _PIECE):
        m = min(_PIECE, n - i)
        total = np.zeros(m + k, dtype=_U)
        np.cumsum(_VALUE[data[i: i + m + k - 1]] * _POW[: m + k - 1], out=total[1:])
        out[i: i + m] = (total[k: k + m] - total[:m]) * _INV[:m]
    return mix(out)


_PLACE = 20  # bits of a packed position


def _sliding_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the least hash (by its high bits, leftmost on ties) in every run of w, by doubling of packed keys."""
    n = len(h) - w + 1
    out = np.empty(max(n, 0), dtype=np.int64)
    piece = (1 << _PLACE) - w
    mask = _U((1 << _PLACE) - 1)
    for i in range(0, n, piece):
        m = min(piece, n - i)
        best = (h[i: i + m + w - 1] & ~mask) | np.arange(m + w - 1, dtype=_U)
        span = 1
        while span < w:
            step = min(span, w - span)
            best = np.minimum(best[:-step], best[step:])
            span += step
        out[i: i + m] = (best & mask).astype(np.int64) + i
    return out


def segments(data: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser hash, first window, windows, minimiser position) of the segments of one document's bytes."""
    if len(data) < length:
        e = np.zeros(0, dtype=np.int64)
        return e.astype(_U), e, e, e
    h = _gram_hashes(data, k)
    at = _sliding_argmin(h, length - k + 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.append(first, len(at)))
    return h[at[first]], first, count, at[first]


# ---------------------------------------------------------------- the transform and its expansion


_PACKED = 7  # symbols under 2**9 in one 64-bit key


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by at least their first `depth` symbols (ties in any order), and the places where the order of
    the first _PACKED symbols changes. Doubling; only suffixes that still share their rank are sorted again."""
    n = len(text)
    padded = np.concatenate([text.astype(np.int64), np.zeros(_PACKED, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(_PACKED):
        key = (key << 9) | padded[i: i + n]
    order = np.argsort(key)
    rank = np.empty(n, dtype=np.int64)
    s = key[order]
    start = first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    size = np.diff(np.append(first, n))
    rank[order] = np.repeat(first, size)  # the place of the first suffix of a tie
    at = np.flatnonzero(np.repeat(size, size) > 1)  # places in ties
    span = _PACKED
    while span < depth and len(at):
        own = order[at]
        second = np.zeros(len(own), dtype=np.int64)
        inside = own + span < n
        second[inside] = rank[own[inside] + span] + 1
        key = rank[own] * (n + 1) + second
        o = np.argsort(key)
        key = key[o]
        order[at] = own[o]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(key)))
        rank[order[at]] = np.repeat(at[first], size)
        at = at[np.repeat(size, size) > 1]
        span *= 2
    return order, start


def common_prefixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, joined): joined[i] says that suffixes i-1 and i of the order share at least `length` symbols.

    Intervals of the transform are extended backwards level by level. An interval of a string w found at level |w| sets
    the boundary after it, if none has, to the value |w| - 1 of the common prefix there; boundaries still unset after
    level `length` have a common prefix of at least `length`. The sort already separates the intervals of all strings of
    _PACKED symbols, so the search starts at that level.
    """
    n = len(text)
    order, start = suffix_order(text, length)
    before = text[order - 1]  # the transform; position 0 takes the last symbol
    by_symbol = np.argsort(before.astype(np.uint16), kind="stable").astype(np.int32)
    lf = np.empty(n, dtype=np.int32)
    lf[by_symbol] = np.arange(n, dtype=np.int32)
    # neighbours with the same symbol in the transform
    nxt, prv = np.full(n, n, np.int32), np.full(n, -1, np.int32)
    same = before[by_symbol][1:] == before[by_symbol][:-1]
    nxt[by_symbol[:-1][same]] = by_symbol[1:][same]
    prv[by_symbol[1:][same]] = by_symbol[:-1][same]
    unset = np.ones(n + 1, dtype=bool)
    if length >= _PACKED:
        level, lo, hi = _PACKED, start.astype(np.int32), (np.append(start[1:], n) - 1).astype(np.int32)
        unset[hi + 1] = False
    else:
        level, lo, hi = 0, np.array([0], np.int32), np.array([n - 1], np.int32)
    for _ in range(level, length):
        if not len(lo):
            break
        # single suffixes step by themselves, larger intervals by their last and first of every symbol
        alone = lo == hi
        new_lo = new_hi = lf[lo[alone]]
        big_lo, big_hi = lo[~alone], hi[~alone]
        if len(big_lo):
            size = big_hi - big_lo + 1
            owner = np.repeat(np.arange(len(size)), size)
            i = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - big_lo, size)
            last, first = nxt[i] > np.repeat(big_hi, size), prv[i] < np.repeat(big_lo, size)
            a, b = lf[i[first]], lf[i[last]]
            # within an owner both lists hold one entry per symbol; the step keeps symbols apart and in order
            ka = np.argsort(owner[first] * n + a)
            kb = np.argsort(owner[last] * n + b)
            new_lo, new_hi = np.concatenate([new_lo, a[ka]]), np.concatenate([new_hi, b[kb]])
        fresh = unset[new_hi + 1]
        lo, hi = new_lo[fresh], new_hi[fresh]
        unset[hi + 1] = False
    joined = unset[:n].copy()
    joined[0] = False
    return order, joined


def repeated_windows(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of the pieces: (piece, start, whether it occurs at another place in the pieces)."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    start = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
    raw = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    text[:] = raw.astype(np.int64) + 2
    text[start + sizes] = 1  # ends of pieces; a window never holds one
    order, joined = common_prefixes(text, length)
    twin = joined.copy()
    twin[:-1] |= joined[1:]
    hit = np.zeros(len(text), dtype=bool)
    hit[order[twin]] = True
    n_windows = np.maximum(sizes - length + 1, 0)
    piece = np.repeat(np.arange(len(pieces)), n_windows)
    at = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    return piece, at, hit[start[piece] + at]


# ---------------------------------------------------------------- the distributed operator

_SEGMENT = "m bigint, s bigint, doc_id bigint, at bigint, n int"


def _segments(docs: DataFrame, length: int, k: int) -> DataFrame:
    """A row per segment: minimiser, hash of its bytes, document, first window and number of windows."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for part in slices(batch):
                data, offsets = text_buffers(part.column("text"))
                ids = part.column("doc_id").to_pylist()
                ms, ss, ds, ats, ns = [], [], [], [], []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    if b - a < length:
                        continue
                    m, first, count, _ = segments(data[a:b], length, k)
                    raw = data[a:b].tobytes()
                    ms.append(m)
                    ats.append(first)
                    ns.append(count)
                    ss += [xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip(first.tolist(), (first + count + length - 1).tolist(), strict=True)]
                    ds += [ids[i]] * len(m)
                if ds:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(ms).view(np.int64)), pa.array(np.array(ss, dtype=_U).view(np.int64)), pa.array(ds, pa.int64()), pa.array(np.concatenate(ats)), pa.array(np.concatenate(ns).astype(np.int32))],
                        ["m", "s", "doc_id", "at", "n"],
                    )

    return docs.mapInArrow(run, _SEGMENT)


def _runs(flags: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
    """[a, b) runs of flagged windows with consecutive starts."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(starts[at]) != 1))
    a, b = np.concatenate([[0], cut + 1]), np.append(cut, len(at) - 1)
    return list(zip(starts[at[a]].tolist(), (starts[at[b]] + 1).tolist(), strict=True))


_FOUND = "doc_id bigint, a bigint, b bigint, h1 bigint, h2 bigint"


def _chunk(length: int):
    """Searches one chunk: rows with null hashes are repeated byte ranges [a, b); the others are windows at a whose
    hash has to be compared with the other chunks of a large group (b = 1: still without a twin)."""

    def run(table):
        import pyarrow as pa
        import xxhash

        pieces = table.column("bytes").to_pylist()
        ids, at, copies, split = (table.column(c).to_numpy() for c in ("doc_id", "at", "copies", "split"))
        piece, start, hit = repeated_windows(pieces, length)
        out: list[tuple] = []
        border = np.searchsorted(piece, np.arange(len(pieces) + 1))
        emitted: set[int] = set()
        for i in range(len(pieces)):
            lo, hi = border[i], border[i + 1]
            if copies[i] == 1:
                out += [(int(ids[i]), int(at[i]) + a, int(at[i]) + b - 1 + length, None, None) for a, b in _runs(hit[lo:hi], start[lo:hi])]
            if split[i] > 1:
                for w, h in zip(start[lo:hi].tolist(), hit[lo:hi].tolist(), strict=True):
                    x = xxhash.xxh3_128_intdigest(pieces[i][w: w + length])
                    if x not in emitted:
                        emitted.add(x)
                        need = not h and copies[i] == 1
                        out.append((int(ids[i]), int(at[i]) + w, int(need), (x >> 64) - (1 << 63), (x & (1 << 64) - 1) - (1 << 63)))
        columns = zip(*out, strict=True) if out else [[]] * 5
        return pa.Table.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["doc_id", "a", "b", "h1", "h2"])

    return run


def repeated_ranges(docs: DataFrame, length: int = LENGTH, k: int = K, chunk: int = CHUNK) -> DataFrame:
    """doc_id, a, b: byte ranges [a, b) that repeated windows cover (they may overlap); docs: one row per doc_id."""
    found = stored(_segments(docs, length, k))
    contents = found.groupBy("m", "s").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "at", "n")).alias("r"))
    contents = stored(contents.select("m", "s", "copies", "r.doc_id", "r.at", "r.n"))
    same = found.join(contents.where("copies > 1").select("m", "s"), ["m", "s"], "left_semi")
    same = same.select("doc_id", F.col("at").alias("a"), (F.col("at") + F.col("n") + length - 1).alias("b"))
    groups = contents.groupBy("m").agg(F.count("*").alias("d"), F.sum(F.col("n") + length).alias("size")).where("d > 1")
    groups = groups.select("m", F.ceil(F.col("size") / (2 * chunk)).cast("int").alias("split"), "size")
    picked = stored(contents.join(groups, "m").select("m", "s", "copies", "doc_id", "at", "n", "split"))
    total = picked.where("split = 1").agg(F.coalesce(F.sum(F.col("n") + length), F.lit(0)).alias("x")).first().x
    n_chunks = int(total // chunk) + 1
    of = F.when(F.col("split") == 1, F.pmod(F.col("m"), F.lit(n_chunks))).otherwise(F.xxhash64("m", F.pmod("s", F.col("split"))) .bitwiseOR(F.lit(-(1 << 63))))
    wanted = picked.withColumn("chunk", of).groupBy("doc_id").agg(F.collect_list(F.struct("chunk", "at", "n", "copies", "split")).alias("w"))
    texts = docs.select("doc_id", "text").join(wanted, "doc_id")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                rows = []
                for i, t, w in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), part.column("w").to_pylist(), strict=True):
                    raw = t.encode()
                    rows += [(x["chunk"], i, x["at"], x["copies"], x["split"], raw[x["at"]: x["at"] + x["n"] + length - 1]) for x in w]
                c = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(c, kinds, strict=True)], ["chunk", "doc_id", "at", "copies", "split", "bytes"])

    pieces = texts.mapInArrow(cut, "chunk bigint, doc_id bigint, at bigint, copies bigint, split int, bytes binary")
    searched = pieces.groupBy("chunk").applyInArrow(_chunk(length), _FOUND)
    if not picked.where("split > 1").limit(1).count():
        return same.unionByName(searched.select("doc_id", "a", "b"))
    searched = stored(searched)
    inside = searched.where("h1 is null").select("doc_id", "a", "b")
    open_ = searched.where("h1 is not null")
    twice = open_.groupBy("h1", "h2").agg(F.count("*").alias("c"), F.max("b").alias("need")).where("c > 1 and need = 1").select("h1", "h2")
    across = open_.where("b = 1").join(twice, ["h1", "h2"], "left_semi").select("doc_id", "a", (F.col("a") + length).alias("b"))
    return same.unionByName(inside).unionByName(across)


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = K, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes), one row per doc_id of docs that is not null.

    Every byte covered by a `length`-byte string that also starts elsewhere, in the same document or another, goes;
    strings are judged on the input. Null texts are empty; texts under `length` bytes have nothing to remove; rows that
    repeat a doc_id are one document (see one_per_id).
    """
    from .common import one_per_id

    own = one_per_id(docs)
    ranges = repeated_ranges(own, length, k, chunk).groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("w"))
    joined = own.select("doc_id", "text").join(ranges, "doc_id", "left")

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                out = []
                for t, w in zip(part.column("text").to_pylist(), part.column("w").to_pylist(), strict=True):
                    raw = (t or "").encode()
                    spans = merge([(x["a"], x["b"]) for x in w or ()])
                    keep, p = [], 0
                    for a, b in spans:
                        keep.append(raw[p:a])
                        p = b
                    keep.append(raw[p:])
                    out.append((len(raw), sum(b - a for a, b in spans), len(spans), b"".join(keep)))
                n, gone, spans, kept = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(rows, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
