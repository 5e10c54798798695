"""Operator 2: quality classifier, a regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

FEATURES = (
    "log_bytes", "mean_word", "upper", "digit", "space", "punct", "symbol", "bang", "pipe", "newline",
    "distinct_words", "top_word", "repeat_pairs", "distinct_lines", "stop_rate", "line_words", "byte_entropy", "tail_symbols",
)
#: Labelled rows used for the fit at most, by hash order of doc_id; the bound is this parameter.
SAMPLE = 20_000

_KIND = np.zeros(256, dtype=np.uint8)  # 1 upper, 2 digit, 3 space, 4 plain punctuation, 5 symbol, 0 letters and the rest
_KIND[65:91], _KIND[48:58] = 1, 2
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_KIND[list(b".,;:'\"()-?")] = 4
_KIND[list(b"#$%&*+/<=>@[]\\^_`{}|~!")] = 5
_TAIL = re.compile(r"[^\w\s.,;:'\"()?-]{2,}(?=\s|\Z)")


def statistics(text: str) -> list[float]:
    """Transformed statistics of one whole text; an empty text has all of them at the value of no evidence."""
    raw = text.encode()
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=hist, minlength=6)
    w = text.split()
    k = max(1, len(w))
    seen: dict[str, int] = {}
    for x in w:
        seen[x] = seen.get(x, 0) + 1
    lines = text.split("\n")
    p = hist[hist > 0] / n
    repeats = sum(a == b for a, b in zip(w, w[1:], strict=False))
    short = sum(len(x) <= 4 for x in w)
    root = math.sqrt
    return [
        math.log1p(n), math.log1p(n / k), root(kinds[1] / n), root(kinds[2] / n), kinds[3] / n, root(kinds[4] / n), root(kinds[5] / n),
        root(hist[33] / n), root(hist[124] / n), root(hist[10] / n), (len(seen) / k) ** 0.5 * math.log1p(k), root(max(seen.values(), default=0) / k),
        root(repeats / k), len(set(lines)) / len(lines), short / k, math.log1p(k / len(lines)), float(-(p * np.log2(p)).sum()),
        root(len(_TAIL.findall(text)) / k),
    ]


@dataclass(frozen=True)
class Model:
    """Per class: prior, mean, Cholesky factor of the shrunken covariance and the factor's inverse; both are made once at the
    fit, so that scoring only multiplies."""

    center: np.ndarray
    scale: np.ndarray
    log_prior: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    inverses: np.ndarray
    log_dets: np.ndarray
    temperature: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.center) / self.scale
        out = []
        for c in (0, 1):
            y = self.inverses[c] @ (z - self.means[c]).T
            out.append(self.log_prior[c] - 0.5 * ((y * y).sum(axis=0) + self.log_dets[c]))
        return out[1] - out[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x) * self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, own: float = 0.7, ridge: float = 0.1, temperature: float = 0.5) -> Model:
    """Covariance of class c: (1 - ridge) (own S_c + (1 - own) S_pooled) + ridge diag(S_pooled), after standardising.

    Without rows of both classes the factors are equal and only the smoothed prior speaks.
    """
    x = np.asarray(x, dtype=float).reshape(-1, len(FEATURES))
    y = np.asarray(y)
    d = x.shape[1]
    center = x.mean(axis=0) if len(x) else np.zeros(d)
    scale = x.std(axis=0) if len(x) else np.ones(d)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.clip((x - center) / scale, -8, 8)
    counts = np.array([(y == c).sum() for c in (0, 1)], dtype=float)
    both = counts.min() >= 2
    means = np.stack([z[y == c].mean(axis=0) if both else np.zeros(d) for c in (0, 1)])
    covs = [np.cov(z[y == c].T, bias=True) if both else np.eye(d) for c in (0, 1)]
    pooled = sum(n * s for n, s in zip(counts, covs, strict=True)) / counts.sum() if both else np.eye(d)
    ground = np.diag(np.diag(pooled) + 1e-3)
    factors = np.stack([np.linalg.cholesky((1 - ridge) * (own * s + (1 - own) * pooled) + ridge * ground) for s in covs])
    log_dets = np.array([2 * np.log(np.diag(f)).sum() for f in factors])
    return Model(center, scale, np.log((counts + 1) / (counts.sum() + 2)), means, factors, np.linalg.inv(factors), log_dets, temperature)


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the array of statistics, one row per row of docs; a null text counts as empty."""

    def rows(batch):
        import pyarrow as pa

        x = [statistics(t or "") for t in batch.column("text").to_pylist()]
        return [batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))]

    return map_texts(docs, rows, "doc_id bigint, x array<double>")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fits on at most `sample` labelled documents, the first by hash of doc_id. labels: doc_id and a 0/1 column.

    Documents with several labels count once per distinct label; null labels and ids are left out.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    rows = features(docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi"))
    got = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "x", "y").toPandas().sort_values(["doc_id", "y"], kind="stable")
    return fit(np.array(got["x"].tolist(), dtype=float).reshape(-1, len(FEATURES)), got["y"].to_numpy())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (nearer 1: label 1 likelier) and predicted, one row per row of docs.

    Null and empty texts have the statistics of no evidence; repeated rows and rows without an id are scored each; texts of
    any length are read whole, one at a time. No other column is looked at, and an empty table gives an empty result.
    """

    def rows(batch):
        import pyarrow as pa

        x = np.array([statistics(t or "") for t in batch.column("text").to_pylist()], dtype=float)
        s = model.score(np.clip((x - model.center) / model.scale, -8, 8) * model.scale + model.center)
        return [batch.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))]

    return map_texts(docs, rows, "doc_id bigint, score double, predicted int")
