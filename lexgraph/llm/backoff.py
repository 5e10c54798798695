"""Operator 9: stupid-backoff scores from n-gram count tables partitioned by hash.

The documents are dealt to blocks. Each block sends its distinct n-grams to the partitions of the count tables, packed
per partition; a partition adds the counts of all blocks and joins them back to the blocks' n-grams; each block then
scores its documents, leaving a document's own counts out, so that a text is judged by the rest of the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _U, mix, ngrams, one_per_id, slices, text_buffers, word_hashes

ORDER = 3
ALPHA = 0.4
#: Text bytes of a block on average.
BLOCK = 8 << 20


def hash_bits(n_bytes: int) -> int:
    """Bits of an n-gram's hash that are kept: so many more than the corpus has bytes that chance meetings stay rare."""
    return min(64, max(44, n_bytes.bit_length() + 22))


def grams(h: np.ndarray, first: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the n-gram that ends at each word, whether it lies inside its document)."""
    out = np.zeros(len(h), dtype=_U)
    if len(h) >= n:
        out[n - 1:] = (h if n == 1 else ngrams(h, n)) >> _U(64 - bits)
    return out, np.arange(len(h)) - np.repeat(first[:-1], np.diff(first)) >= n - 1


def pack(x: np.ndarray) -> bytes:
    """Sorted unsigned values as low halves and coded gaps of the high ones."""
    low = (x & _U(0xFFFFFFFF)).astype(np.uint32)
    high = np.diff((x >> _U(32)).astype(np.int64), prepend=0).astype(np.uint32)
    return len(x).to_bytes(4, "little") + low.tobytes() + zlib.compress(high.tobytes(), 1)


def unpack(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    low = np.frombuffer(raw, np.uint32, n, 4)
    high = np.cumsum(np.frombuffer(zlib.decompress(raw[4 + 4 * n:]), np.uint32).astype(_U))
    return (high << _U(32)) | low


def pack_counts(x: np.ndarray) -> bytes:
    """Counts by byte planes, of which the high ones are mostly zero."""
    return zlib.compress(x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_counts(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)


def _block_words(texts) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a block's texts and the first word of each."""
    hashes, counts = [], []
    for text in texts.chunks if hasattr(texts, "chunks") else [texts]:
        h, _, _, first = word_hashes(*text_buffers(text))
        hashes.append(h)
        counts.append(np.diff(first))
    h = np.concatenate(hashes) if hashes else np.zeros(0, _U)
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    return h, np.concatenate([[0], np.cumsum(n)])


def _distinct(g: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct n-grams, their counts, and which of them ends at each word (0 where none does)."""
    at = np.flatnonzero(ok)
    own = g[at]
    order = np.argsort(own)
    s = own[order]
    start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(s)))
    which = np.zeros(len(g), dtype=np.int64)
    which[at[order]] = np.repeat(np.arange(len(start)), size)
    return s[start], size, which


def _send(order: int, parts: int, bits: int):
    """A block's distinct n-grams with counts, a row per order and partition."""

    def run(table):
        import pyarrow as pa

        h, first = _block_words(table.column("text"))
        block = table.column("block")[0].as_py()
        rows = []
        for n in range(1, order + 1):
            g, c, _ = _distinct(*grams(h, first, n, bits))
            cut = np.append(np.searchsorted(g, _edges(parts, bits)), len(g))
            rows += [(n * parts + p, block, pack(g[a:b]), pack_counts(c[a:b])) for p, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        return pa.Table.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())], ["part", "block", "grams", "counts"])

    return run


def _edges(parts: int, bits: int) -> np.ndarray:
    """Lower borders of the hash ranges."""
    return np.array([(p << bits) // parts for p in range(parts)], dtype=_U)


def _count(table):
    """Adds up one partition of a count table and answers every block in the order in which it asked."""
    import pyarrow as pa

    asked = [unpack(x) for x in table.column("grams").to_pylist()]
    own = [unpack_counts(x) for x in table.column("counts").to_pylist()]
    flat = np.concatenate(asked)
    order = np.argsort(flat, kind="stable")
    s = flat[order]
    start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    sums = np.add.reduceat(np.concatenate(own)[order], start)
    total = np.empty(len(flat), dtype=np.int64)
    total[order] = np.repeat(sums, np.diff(np.append(start, len(s))))
    border = np.cumsum([0, *map(len, asked)])
    back = [pack_counts(total[a:b]) for a, b in zip(border[:-1], border[1:], strict=True)]
    return pa.Table.from_arrays([table.column("block").cast(pa.int64()).combine_chunks(), table.column("part").combine_chunks(), pa.array(back, pa.binary())], ["block", "part", "total"])


def document_scores(h: np.ndarray, first: np.ndarray, totals, n_words: int, order: int, alpha: float, bits: int) -> np.ndarray:
    """Sum of log scores per document; totals(n): corpus counts of the block's sorted distinct n-grams.

    S(w | c) = f(c w) / f(c) if the n-gram occurs in other documents, else alpha S(w | shorter c); the last resort is
    add-one over the words of the others. Counts f leave out the document itself.
    """
    size = np.diff(first)
    docs = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(h)) - first[docs]
    others = n_words - size[docs]
    score = np.zeros(len(h))
    shorter = others
    for n in range(1, order + 1):
        g, ok = grams(h, first, n, bits)
        keys, _, which = _distinct(g, ok)
        f = np.where(ok, totals(n)[which], 0) if len(keys) else np.zeros(len(h), np.int64)
        # less how often each n-gram occurs in its own document
        key = docs * max(len(keys), 1) + which
        key[~ok] = -1
        by = np.argsort(key)
        s = key[by]
        start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        own = np.diff(np.append(start, len(s)))
        f[by] -= np.where(s < 0, 0, np.repeat(own, own))
        if n == 1:
            score = np.log(np.where(f > 0, f, (f + 1)) / np.where(f > 0, others, others + n_words)) if len(h) else score
        else:
            # the context that ends before word i is the (n-1)-gram that ends at word i-1
            context = np.concatenate([[0], shorter[:-1]]) if len(h) else shorter
            seen = (f > 0) & (context > 0)
            direct = np.log(np.where(seen, f, 1) / np.where(seen, context, 1))
            score = np.where(seen, direct, score + np.where(place >= n - 1, np.log(alpha), 0.0))
        shorter = f
    return np.bincount(docs, weights=score, minlength=len(size))


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, log_score (sum over the words), per_word (its mean; null without words), one row per doc_id.

    Words are lower-cased runs of non-space. Null and empty texts have no words and a sum of 0; rows that repeat a
    doc_id are one document (see one_per_id). The tables of all orders cover all documents; equal texts of other ids
    count as other documents. A text of any length stands whole in one block. A block sends a row per hash range that has
    any of its n-grams, so rows never outnumber the distinct n-grams of the blocks; n-grams are known by hash_bits of hash.
    """
    own = one_per_id(docs)
    size = own.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    n_blocks = int(size.b // block) + 1
    parts, bits = max(4, n_blocks), hash_bits(int(size.b))
    dealt = own.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)))
    sent = dealt.groupBy("block").applyInArrow(_send(order, parts, bits), "part bigint, block bigint, grams binary, counts binary")
    answers = sent.groupBy("part").applyInArrow(_count, "block bigint, part bigint, total binary")

    n_words = _total_words(own)

    def finish(key, left, right):
        import pyarrow as pa

        if not left.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], ["doc_id", "n_words", "log_score"])
        h, first = _block_words(left.column("text"))
        got = dict(zip(right.column("part").to_pylist(), right.column("total").to_pylist(), strict=True))

        def totals(n: int) -> np.ndarray:
            return np.concatenate([unpack_counts(got[p]) for p in range(n * parts, (n + 1) * parts) if p in got] or [np.zeros(0, np.int64)])

        s = document_scores(h, first, totals, n_words, order, alpha, bits)
        return pa.Table.from_arrays([left.column("doc_id").combine_chunks(), pa.array(np.diff(first)), pa.array(s)], ["doc_id", "n_words", "log_score"])

    out = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, "doc_id bigint, n_words bigint, log_score double")
    return out.withColumn("per_word", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))


def _total_words(docs: DataFrame) -> int:
    def rows(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                from .common import words

                yield pa.RecordBatch.from_arrays([pa.array([len(words(*text_buffers(part.column("text")))[0])], pa.int64())], ["n"])

    return docs.select("text").mapInArrow(rows, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
