"""Exact self-join of word sets by Jaccard similarity: sets packed as codes, dealt to pairs of blocks, counted with NumPy.

A word is known by 64 bits of hash. Words that make up a fixed share of all postings get 16-bit codes in order of
frequency; the others are rarer and stand before them, in order of their hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words with codes; as many as 16 bits hold.
CODES = 1 << 16
#: Postings that are looked up at once, and cells of the table in which they are counted.
_LOOKUPS, _CELLS = 1 << 18, 1 << 18
#: Greatest ratio of the sizes of one step, and the share of the words needed that must be found before two sets are compared.
_STEP, _MORE = 1.25, 0.2
#: Pairs that may wait before they are cut to the best of each set.
_WAITING = 1 << 20


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per count, of so many items each."""
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * values.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _items(column: pa.ChunkedArray | pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The items of all values of a binary column, and how many each value has."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), kind), np.diff(offsets) // np.dtype(kind).itemsize


def packer(hashes: np.ndarray, codes: np.ndarray):
    """A function for mapInArrow that replaces the column h (hashes of a set's words) by rare (hashes) and common (codes),
    both in order. hashes: in order, those of the words with codes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h")
            size = pc.list_value_length(h).to_numpy(zero_copy_only=False).astype(np.int64)
            word, of = h.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(size)), size)
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, word), len(hashes) - 1)
                known = hashes[at] == word
            else:
                at, known = np.zeros(len(word), np.int64), np.zeros(len(word), bool)
            common = np.sort((of[known] << 16) | codes[at[known]].astype(np.int64)) & (CODES - 1) if known.any() else np.zeros(0, np.int64)
            rare, doc = word[~known], of[~known]
            rare = rare[np.lexsort((rare, doc))]
            keep = [c for c in batch.schema.names if c != "h"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), _binary(rare, np.bincount(doc, minlength=len(size))), _binary(common.astype(np.uint16), np.bincount(of[known], minlength=len(size)))],
                [*keep, "rare", "common"],
            )

    return pack


class _Sets:
    """The sets of a block in order of size. Words are local numbers, in order within a set; those that stand in no set of
    the other block are left out, but count in n and in `left`."""

    def __init__(self, rows: pa.Table):
        self.order = np.argsort(rows.column("n").to_numpy(), kind="stable")
        rows = rows.select(["rid", "n", "rare", "common"]).take(pa.array(self.order))
        self.rid, self.n = rows.column("rid").to_numpy(), rows.column("n").to_numpy().astype(np.int64)
        self.rare, self.rares = _items(rows.column("rare"), np.int64)
        self.common, self.commons = _items(rows.column("common"), np.uint16)

    def name(self, names: np.ndarray) -> None:
        """Numbers the words: rare ones by their place in names, the others by their codes after those."""
        at = np.searchsorted(names, self.rare).astype(np.int32)
        known = np.append(names, 0)[at] == self.rare
        known &= at < len(names)
        row = np.arange(len(self.n), dtype=np.int32)
        of = np.repeat(row, self.rares)
        here = np.bincount(of[known], minlength=len(row)) + self.commons
        self.start = np.concatenate([[0], np.cumsum(here)])
        self.of = np.repeat(row, here)
        # first the rare words of a set that have names, then its common ones
        first = np.ones(len(self.of), bool)
        common = np.arange(len(self.common), dtype=np.int32) + np.repeat((self.start[1:] - np.cumsum(self.commons)).astype(np.int32), self.commons)
        first[common] = False
        self.word, self.left = np.empty(len(first), np.int32), np.empty(len(first), np.int32)
        self.word[common] = self.common
        self.word[common] += np.int32(len(names))
        self.word[first] = at[known]
        # with each word the number of its set's words from it on
        self.left[common] = np.repeat(np.cumsum(self.commons).astype(np.int32), self.commons) - np.arange(len(self.common), dtype=np.int32)
        self.left[first] = (np.repeat(np.cumsum(self.rares) - self.rares + self.n, self.rares) - np.arange(len(self.rare)))[known]
        del self.rare, self.common

    def steps(self, ratio: float) -> list[tuple[int, int]]:
        """Runs of sets of much the same size."""
        out, at = [], 0
        while at < len(self.n):
            to = int(np.searchsorted(self.n, self.n[at] * ratio, side="right"))
            out.append((at, to))
            at = to
        return out

    def heads(self, step: tuple[int, int], rest: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of a step's sets, without the last `rest` words of each, and their sets, counted from the step's first."""
        own = slice(self.start[step[0]], self.start[step[1]])
        head = np.flatnonzero(self.left[own] > rest)
        return self.word[own][head], self.of[own][head] - np.int32(step[0])


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1 and so on, `size` numbers for each."""
    end = np.cumsum(size)
    out = np.repeat(start - end + size, size)
    out += np.arange(len(out))
    return out


def _best(found: list[np.ndarray], top: int | None) -> np.ndarray:
    """Rows a, b, shared, similarity (as bits) of the `top` most similar b of each a, the last b first among equals."""
    rows = np.concatenate(found, axis=1)
    if top is None:
        return rows
    order = np.lexsort((-rows[1], -rows[3].view(np.float64), rows[0]))
    rows = rows[:, order]
    first = np.flatnonzero(np.diff(rows[0], prepend=rows[0][:1] - 1))
    rank = np.arange(rows.shape[1]) - np.repeat(first, np.diff(np.append(first, rows.shape[1])))
    return rows[:, rank < top]


def matches(left: pa.Table, right: pa.Table | None, apart: tuple[str, ...], least_shared: int, least: float, top: int | None) -> np.ndarray:
    """Rows a, b (a before b), shared and similarity (as bits) of all similar pairs of a set of `left` and one of `right`,
    or of two sets of `left`; with `top` at least the most similar of each a. The tables have rid, n, rare, common and `apart`.

    Sets are taken in steps of size. Similar sets of two steps share at least `need` words, so at least _MORE of them
    stand in front of the last need - _MORE words of both; these are counted through an index, and only pairs that reach
    that number are compared whole.
    """
    itself = right is None
    x = _Sets(left)
    y = x if itself else _Sets(right)
    if itself:
        names, times = np.unique(x.rare, return_counts=True)
        names = names[times > 1]
    else:
        names = np.intersect1d(np.unique(x.rare), np.unique(y.rare), assume_unique=True)
    x.name(names)
    if not itself:
        y.name(names)
    words = len(names) + CODES
    groups = []
    for c in apart:
        both = pa.concat_tables([left.select([c]), *([] if itself else [right.select([c])])]).combine_chunks()
        codes = pc.fill_null(pc.cast(both.column(c).combine_chunks().dictionary_encode().indices, pa.int32()), -1).to_numpy()
        groups.append((codes[x.order], codes[y.order if itself else y.order + left.num_rows]))
    mark = np.zeros(words, np.int8)
    found, waiting = [np.zeros((4, 0), np.int64)], 0
    x_steps = x.steps(_STEP)
    for ys in y.steps(_STEP):
        low, high = y.n[ys[0]], y.n[ys[1] - 1]
        for xs in x_steps:
            if x.n[xs[0]] * least > high + 1e-9 or x.n[xs[1] - 1] < low * least - 1e-9 or (itself and xs[0] > ys[0]):
                continue
            need = max(least_shared, int(np.ceil(least / (1 + least) * (x.n[xs[0]] + low) - 1e-9)), int(np.ceil(least * max(x.n[xs[0]], low) - 1e-9)))
            enough = min(need, 1 + int(need * _MORE))
            y_word, y_set = y.heads(ys, need - enough)
            x_word, x_set = x.heads(xs, need - enough)
            if not len(y_word) or not len(x_word):
                continue
            m = ys[1] - ys[0]
            keys = np.sort((y_word.astype(np.int64) << 32) | y_set)
            begin = np.zeros(words + 1, np.int64)
            np.cumsum(np.bincount(y_word, minlength=words), out=begin[1:])
            sets = (keys & 0xFFFFFFFF).astype(np.int32)
            start, size = begin[x_word], begin[x_word + 1]
            size -= start
            kept = np.flatnonzero(size)
            start, size, x_set = start[kept], size[kept], x_set[kept]
            first = np.searchsorted(x_set, np.arange(xs[1] - xs[0] + 1))
            before = np.concatenate([[0], np.cumsum(size)])[first]
            at = 0
            while at < xs[1] - xs[0]:
                to = max(at + 1, min(at + max(1, _CELLS // m), int(np.searchsorted(before, before[at] + _LOOKUPS, side="right")) - 1))
                own = slice(first[at], first[to])
                begun, at = at, to
                if before[to] == before[begun]:
                    continue
                count = size[own]
                cell = sets[_ranges(start[own], count)] + np.repeat((x_set[own] - begun).astype(np.int64) * m, count)
                i, j = np.divmod(np.flatnonzero(np.bincount(cell, minlength=(to - begun) * m) >= enough), m)
                if not len(i):
                    continue
                i += begun + xs[0]
                j += ys[0]
                ok = (x.n[i] >= least * y.n[j] - 1e-9) & (y.n[j] >= least * x.n[i] - 1e-9)
                ok &= i < j if itself else x.rid[i] != y.rid[j]
                for of_x, of_y in groups:
                    ok &= (of_x[i] != of_y[j]) | (of_x[i] < 0)
                i, j = i[ok], j[ok]
                if not len(i):
                    continue
                out = _whole(x, y, i, j, mark, least_shared, least)
                found.append(out)
                waiting += out.shape[1]
                if top is not None and waiting > _WAITING:
                    found = [_best(found, top)]
                    waiting = found[0].shape[1] // 2
    return _best(found, top)


def _whole(x: _Sets, y: _Sets, i: np.ndarray, j: np.ndarray, mark: np.ndarray, least_shared: int, least: float) -> np.ndarray:
    """Those pairs of sets i of x (in order) and j of y that are similar, compared whole. mark: zeros, one per word."""
    shared, begins = np.zeros(len(i), np.int64), np.flatnonzero(np.diff(i, prepend=-1))
    for k, stop in zip(begins, [*begins[1:], len(i)]):
        own = x.word[x.start[i[k]]: x.start[i[k] + 1]]
        mark[own] = 1
        while k < stop:
            # so many sets at once that their words stay few
            held = y.start[j[k:stop] + 1] - y.start[j[k:stop]]
            ends = np.cumsum(held)
            take = max(1, int(np.searchsorted(ends, _LOOKUPS, side="right")))
            held, ends = held[:take], ends[:take]
            hits = np.zeros(int(ends[-1]) + 1, np.int64)
            np.cumsum(mark[y.word[_ranges(y.start[j[k: k + take]], held)]], out=hits[1:])
            shared[k: k + take] = hits[ends] - hits[ends - held]
            k += take
        mark[own] = 0
    similarity = shared / (x.n[i] + y.n[j] - shared)
    ok = (shared >= least_shared) & (similarity >= least)
    a, b = x.rid[i[ok]], y.rid[j[ok]]
    return np.stack([np.minimum(a, b), np.maximum(a, b), shared[ok], similarity[ok].view(np.int64)])
