"""Shared pieces of the training-data operators: table access, durable lineage cuts, vectorised token hashing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stage import release, shared_folder, stored  # noqa: F401

_U = np.uint64
#: Odd multiplier of the polynomial hash and its inverse modulo 2**64.
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_CHUNK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Cuts the lineage through the shared checkpoint folder, so a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    out = df.checkpoint(eager=True)
    release(df.sparkSession)
    return out


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list: (node, component) with the smallest node as component.

    Every round moves each node to the smallest label among its neighbours and then follows that label's own label
    (pointer jumping), so the number of rounds grows with the logarithm of the diameter. State lives in DataFrames;
    only a count per round reaches the driver. Nulls in either column are ignored; an empty list gives an empty result.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    both = durable(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    label = durable(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("component")))
    while True:
        near = (
            both.join(label.select(F.col("node").alias("v"), "component"), "v")
            .groupBy("u").agg(F.min("component").alias("m"))
        )
        stepped = label.join(near, F.col("node") == F.col("u"), "left").select("node", "component", F.least("component", "m").alias("m"))
        # hook: a component root also learns the smallest label any of its members has seen
        roots = stepped.groupBy("component").agg(F.min("m").alias("r"))
        hooked = stepped.join(roots, "component").select("node", F.col("component").alias("old"), F.least("m", "r").alias("component"))
        jump = hooked.select(F.col("node").alias("component"), F.col("component").alias("j"))
        new = durable(
            hooked.join(jump, "component", "left")
            .select("node", "old", F.least("component", F.coalesce("j", "component")).alias("component"))
        )
        changed = new.where("component <> old").limit(1).count()
        label = new.select("node", "component")
        if not changed:
            return label


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_P, _CHUNK + 1)
_POW_INV = _powers(_P_INV, _CHUNK + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """The murmur3 64-bit finaliser: a bijection that spreads every input bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x = x * _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def _byte_table(lower: bool) -> np.ndarray:
    values = np.arange(256, dtype=_U)
    if lower:
        values[65:91] += _U(32)
    return mix((values + _U(1)) * _U(0xD6E8FEB86659FD93)) | _U(1)


_LOWER, _EXACT = _byte_table(True), _byte_table(False)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null counts as the empty string."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of non-space bytes; document borders end a word too."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets[:-1]] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span (spans in order of start); A-Z count as a-z if lower."""
    out = np.zeros(len(start), dtype=_U)
    byte = _LOWER if lower else _EXACT
    i = 0
    while i < len(start):
        base = start[i]
        j = int(np.searchsorted(end, base + _CHUNK, side="right")) if len(end) else i
        if j <= i:  # a span longer than a chunk: fold it piece by piece
            acc, p = 0, int(base)
            while p < end[i]:
                q = min(p + _CHUNK, int(end[i]))
                part = int((byte[data[p:q]] * _POW[: q - p]).sum(dtype=_U))
                acc = int(mix(np.array([acc ^ part], dtype=_U))[0])
                p = q
            out[i] = acc
            i += 1
            continue
        stop = int(end[j - 1])
        total = np.zeros(stop - base + 1, dtype=_U)
        np.cumsum(byte[data[base:stop]] * _POW[: stop - base], out=total[1:])
        s, e = start[i:j] - base, end[i:j] - base
        out[i:j] = (total[e] - total[s]) * _POW_INV[s] + (e - s).astype(_U)
        i = j
    return mix(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, and for each document the index of its first word (one more at the end)."""
    start, end = words(data, offsets)
    return span_hashes(data, start, end), start, end, np.searchsorted(start, offsets)


_ROLE = mix(np.arange(1, 65, dtype=_U) * _U(0xA0761D6478BD642F)) | _U(1)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive word hashes (borders of documents are the caller's concern)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=_U)
    total = hashes[:m] * _ROLE[0]
    for k in range(1, n):
        total = total + hashes[k: k + m] * _ROLE[k]
    return mix(total)


def slices(batch, limit: int = 1 << 22):
    """Splits an Arrow record batch into runs of rows with about `limit` text bytes each (always whole rows)."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < batch.num_rows:
        base = size[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield batch.slice(i, j - i)
        i = j


def map_texts(docs: DataFrame, fn, schema: str) -> DataFrame:
    """Applies fn(record batch of doc_id, text) -> list of columns in schema order, over runs of whole texts."""
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                columns = fn(part)
                if columns is not None and len(columns[0]):
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep_rows(docs: DataFrame, fn) -> DataFrame:
    """The rows of docs, all columns, for which fn(record batch with doc_id and text) gives True; no shuffle."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(fn(part), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def one_per_id(docs: DataFrame) -> DataFrame:
    """doc_id and text, one row per doc_id that is not null: of rows that repeat an id, the smallest text that is not
    null counts. The shuffle this takes is only paid where an id does occur twice."""
    own = docs.where("doc_id is not null").select("doc_id", "text")
    repeated = own.groupBy("doc_id").count().where("count > 1").limit(1).count()
    return own.groupBy("doc_id").agg(F.min("text").alias("text")) if repeated else own
