"""Operator 3: toxicity by noisy-channel deobfuscation.

A character trigram model of the whole corpus decodes lattices of leetspeak, spaced-out letters and repetition by
k-best Viterbi search; a lexicon learnt from labelled rows scores the restored text.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, map_texts, text_buffers

#: Labelled rows used for the fit at most, by hash order of doc_id; the bound is this parameter.
SAMPLE = 20_000
#: Entries of the learnt lexicon at most (a feature table, not a candidate cap: the strongest by likelihood ratio).
LEXICON = 20_000
#: Letters up to which a token is read as one word; what is longer is restored as a row of words.
LONGEST = 40

#: Signs that stand for letters.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou", "#": "h",
}
_SIGNS = "".join(LEET)
_ODD = re.compile(rf"[a-z][{re.escape(_SIGNS)}]|[{re.escape(_SIGNS)}][a-z]|([a-z])\1\1")
_STRETCHED = re.compile(r"(.)\1{3,}")
_DOTTED = re.compile(r"[^\W_]([.\-_*])[^\W_](?:\1[^\W_]){2,}")
_EDGE = ".,;:?!\"'()[]{}|&%$#*<>«»¿¡-_"
_SOFT = re.compile("[­​-‍⁠﻿]")

A = 28  # border, a-z, any other letter
_CODE = np.zeros(256, dtype=np.int64)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[128:] = 27


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of character trigrams over every text (a table of fixed size 28**3)."""

    def rows(batch):
        data, offsets = text_buffers(batch.column("text"))
        if not len(data):
            return None
        code = np.zeros(len(data) + 2 * (len(offsets) - 1) + 2, dtype=np.int64)  # two borders before each text
        shift = np.repeat(np.arange(1, len(offsets)), np.diff(offsets)) * 2
        code[np.arange(len(data)) + shift] = _CODE[data]
        index = (code[:-2] * A + code[1:-1]) * A + code[2:]
        hit, n = np.unique(index, return_counts=True)
        return [hit, n.astype(np.int64)]

    sums = map_texts(docs, rows, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(A**3)
    for r in sums:
        out[r.t] = r.n
    return out.reshape(A, A, A)


class Channel:
    """Decoder of single obfuscated words."""

    def __init__(self, counts: np.ndarray):
        tri = counts + 0.02 * (counts.sum(axis=0, keepdims=True) + 1) / (counts.sum() + A * A) * 50
        self.log_p = np.log(tri / tri.sum(axis=2, keepdims=True)).tolist()

    def lattice(self, word: str) -> list[list[tuple[str, float]]]:
        """Per position: strings of letters it may stand for, with channel costs."""
        out: list[list[tuple[str, float]]] = []
        i = 0
        while i < len(word):
            c = word[i]
            j = i
            while j < len(word) and word[j] == c:
                j += 1
            letters = c if c.isalpha() else LEET.get(c, "")
            run = j - i
            if letters:
                options = [(x, 0.0 if len(letters) == 1 else -0.3) for x in letters]
                if run >= 3:  # a stretched letter: once or twice
                    out.append([(x * k, s - 0.2 * k) for x, s in options for k in (1, 2)])
                else:
                    out += [options] * run
            elif c == "?":
                out.append([("", -0.5)])
            else:
                out += [[("", -0.7)]] * run
            i = j
        return out

    def decode(self, word: str, k: int = 6) -> list[str]:
        """The k likeliest readings of a word in which every sign is a letter."""
        return self.search(self.lattice(word), k)

    def segment(self, run: str, k: int = 6, border: float = 0.0) -> list[str]:
        """The k likeliest readings of a run of letters as words, with a border or none (at a cost) after each letter."""
        options: list[list[tuple[str, float]]] = []
        for x in self.lattice(run):
            if options:
                options.append([("", 0.0), (" ", border)])
            options.append(x)
        return self.search(options, k)

    def search(self, lattice: list[list[tuple[str, float]]], k: int) -> list[str]:
        """k-best Viterbi search: a state is the last two letters, which is all that the model looks at, and each state
        keeps its k likeliest texts. Nothing else is cut, so these are the k likeliest texts of the whole lattice."""
        states: dict[tuple[int, int], list[tuple]] = {(0, 0): [(0.0, 0, None)]}  # score, number of the text, chain of pieces
        for options in lattice:
            moved: dict[tuple[int, int], list[tuple]] = {}
            for (a, b), paths in states.items():
                for letters, cost in options:
                    x, y = a, b
                    codes = [ord(ch) - 96 if "a" <= ch <= "z" else 0 if ch == " " else 27 for ch in letters]
                    for c in codes:
                        cost += self.log_p[x][y][c]
                        x, y = y, c
                    to = moved.setdefault((x, y), [])
                    for s, number, chain in paths:
                        for ch in letters:
                            number = (number * _MULTIPLIER + ord(ch)) & _MASK
                        to.append((s + cost, number, (chain, letters) if letters else chain))
            states = {at: _likeliest(paths, k) for at, paths in moved.items()}
        ends = [(s + self.log_p[a][b][0], number, chain) for (a, b), paths in states.items() for s, number, chain in paths]
        return [_unwound(chain) for _, _, chain in _likeliest(ends, k) if chain]


#: Texts of a lattice are told apart by a polynomial number modulo 2**61.
_MULTIPLIER, _MASK = 0x9E3779B97F4A7C15, (1 << 61) - 1


def _likeliest(paths: list[tuple], k: int) -> list[tuple]:
    """The k likeliest paths of different texts; ties by the text's number."""
    if len(paths) == 1:
        return paths
    out: dict[int, tuple] = {}
    for path in sorted(paths, key=lambda p: (-p[0], p[1])):
        if path[1] not in out:
            out[path[1]] = path
            if len(out) == k:
                break
    return list(out.values())


def _unwound(chain) -> str:
    pieces = []
    while chain:
        chain, letters = chain
        pieces.append(letters)
    return "".join(reversed(pieces))


def hidden(token: str) -> list[str]:
    """Lower-cased words a token may hide, for the decoder: signs among letters, stretched or dotted letters."""
    if m := _DOTTED.search(token):
        return [m[0].replace(m[1], "")]
    if not _ODD.search(token):
        return []
    token = _STRETCHED.sub(r"\1\1\1", token)
    words = dict.fromkeys((token.strip(_EDGE), token.strip(".,;:?\"'()[]{}")))
    return [w for w in words if len(w) >= 3]


def spaced(words: list[str]) -> list[str]:
    """Maximal runs of three or more single letters or signs among lower-cased words, without the signs at their edges."""
    out: list[str] = []
    run: list[str] = []
    for w in [*words, "  "]:
        c = w.strip(_EDGE) or w[:1] if len(w) <= 4 else w
        if len(c) == 1 and w != "  ":
            run.append(c)
        elif run:
            if sum(x.isalpha() or x in LEET for x in run) >= 3 and any(x.isalpha() for x in run):
                out.append("".join(run))
            run = []
    return out


def cues(word: str) -> list[str]:
    """Lexicon keys of a restored word: itself and its beginnings."""
    return [word, *(f"{word[:k]}*" for k in (5, 6, 7, 8) if len(word) >= k)]


def split(text: str) -> list[str]:
    return _SOFT.sub("", text).lower().split()


def tokens(text: str) -> Counter:
    return Counter(split(text))


@dataclass(frozen=True)
class Model:
    counts: np.ndarray
    lexicon: dict[str, float]
    beta: np.ndarray

    def scorer(self):
        channel, lexicon = Channel(self.counts), self.lexicon

        @lru_cache(maxsize=100_000)
        def weight(token: str) -> tuple[float, str]:
            """Weight of a token as it stands, else as restored (with the reading)."""
            word = token.strip(_EDGE)
            if not word:
                return 0.0, ""
            w = plain(word)
            if not w and (odd := hidden(token)):
                return max(segmented(x)[::2] if len(x) > LONGEST or _DOTTED.search(token) else restored(x) for x in odd)
            return w, ""

        def plain(word: str) -> float:
            return max(lexicon.get(c, 0.0) for c in cues(word))

        @lru_cache(maxsize=30_000)
        def restored(word: str) -> tuple[float, str]:
            return max(((plain(r), r) for r in channel.decode(word)), default=(0.0, ""))

        @lru_cache(maxsize=30_000)
        def segmented(run: str) -> tuple[float, int, str]:
            """Weight of a run of single letters, its words with weight and how many they are."""
            w, reading = restored(run) if len(run) <= LONGEST else (0.0, "")
            best = (w, int(w > 0), reading if w else "")
            for r in channel.segment(run):
                found = [(x, v) for x in r.split() if len(x) > 1 and (v := plain(x))]
                best = max(best, (sum(v for _, v in found), len(found), " ".join(x for x, _ in found)))
            return best

        def evidence(text: str) -> tuple[list[float], list[str]]:
            words = split(text)
            bag = Counter(words)
            n = len(words)
            total = hits = 0.0
            back = []
            singles = 0
            for token, k in bag.items():
                if len(token) <= 4 and len(token.strip(_EDGE)) <= 1:
                    singles += k
                w, reading = weight(token)
                if w:
                    total += w * k
                    hits += k
                    if reading:
                        back.append(f"{token}={reading}")
            for run in spaced(words) if singles > 2 else ():
                w, k, reading = segmented(run)
                if w:
                    total += w
                    hits += k
                    back.append(f"{run}={reading}")
            return describe(total, hits, n), back

        return evidence

    def probability(self, x: list[list[float]]) -> np.ndarray:
        z = np.asarray(x, dtype=float).reshape(-1, len(self.beta) - 1)
        return 1 / (1 + np.exp(-np.clip(self.beta[0] + z @ self.beta[1:], -40, 40)))


def describe(total: float, hits: float, n: int) -> list[float]:
    rate = 1000 * total / max(n, 20)
    return [np.log1p(rate), np.log1p(total), float(hits > 0)]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps for a ridge logistic regression; the intercept is the smoothed prior if a class is missing."""
    x = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros(x.shape[1])
    if y.min(initial=1) == y.max(initial=0):
        beta[0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 5))
        beta[1] = 1.0
        return beta
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Character counts of all docs; lexicon from two thirds of the labelled sample, calibration from the rest.

    labels: doc_id and a 0/1 column. Null labels, ids and texts are left out; a document labelled both ways counts twice.
    """
    counts = trigram_counts(docs)
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)))
    own = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def cue_counts(batches):
        import pyarrow as pa

        seen: Counter = Counter()
        used: Counter = Counter()
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                per: Counter = Counter()
                for token, k in tokens(text or "").items():
                    for c in cues(token.strip(_EDGE)):
                        per[c] += k
                per.pop("", None)
                per["\x00"] = sum(tokens(text or "").values())
                for c, k in per.items():
                    seen[c, y] += k
                    used[c, y] += 1
                if len(seen) > 400_000:
                    yield flush(pa, seen, used)
        if seen:
            yield flush(pa, seen, used)

    def flush(pa, seen, used):
        keys = list(seen)
        out = pa.RecordBatch.from_arrays([pa.array([c for c, _ in keys]), pa.array([y for _, y in keys], pa.int32()), pa.array([seen[k] for k in keys], pa.int64()), pa.array([used[k] for k in keys], pa.int64())], ["cue", "y", "n", "d"])
        seen.clear()
        used.clear()
        return out

    one = lambda c, y: F.sum(F.when(F.col("y") == y, F.col(c)).otherwise(0))
    per = own.where("part > 0").select("text", "y").mapInArrow(cue_counts, "cue string, y int, n bigint, d bigint")
    per = durable(per.groupBy("cue").agg(one("n", 1).alias("a"), one("n", 0).alias("b"), one("d", 1).alias("d")).where("a > 0 and (d >= 5 or cue = '\x00')"))
    whole = per.where("cue = '\x00'").select(F.col("a").cast("double").alias("wa"), F.col("b").cast("double").alias("wb")).where("a > 0 and b > 0").first()
    lexicon: dict[str, float] = {}
    if whole:
        # likelihood ratio of a word's rates in both classes; the strongest LEXICON of those over both bounds are kept
        wa, wb = F.lit(whole.wa), F.lit(whole.wb)
        e = (F.col("a") + F.col("b")) / (wa + wb)
        part = lambda n, w: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (w * e))).otherwise(0.0)
        ratio = ((F.col("a") + 0.1) / wa) / ((F.col("b") + 0.5) / wb)
        ranked = per.where("cue <> '\x00'").select("cue", (2 * (part("a", wa) + part("b", wb))).alias("g"), ratio.alias("ratio"))
        best = ranked.where("g > 60 and ratio > 4").orderBy(F.desc("g"), "cue").limit(LEXICON)
        lexicon = {r.cue: float(min(np.log(r.ratio), 6.0)) for r in best.collect()}
    raw = Model(counts, lexicon, np.zeros(4))

    def evidence(batches):
        import pyarrow as pa

        of = raw.scorer()
        for batch in batches:
            x = [of(t or "")[0] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    held = own.where("part = 0").select("doc_id", "y", "text").mapInArrow(evidence, "doc_id bigint, y int, x array<double>").toPandas()
    held = held.sort_values(["doc_id", "y"], kind="stable")
    x = np.array(held["x"].tolist(), dtype=float).reshape(-1, 3)
    return Model(counts, lexicon, logistic(x, held["y"].to_numpy(dtype=float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (nearer 1: toxic likelier), predicted and the restored words, one row per row of docs.

    Null and empty texts have no evidence and get the score of a text without hits; repeated rows and rows without an id are
    scored each; texts and tokens of any length are read whole. An empty table gives an empty result.
    """
    kept: list = []

    def rows(batch):
        import pyarrow as pa

        if not kept:
            kept.append(model.scorer())
        got = [kept[0](t or "") for t in batch.column("text").to_pylist()]
        p = model.probability([x for x, _ in got])
        return [batch.column("doc_id"), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32)), pa.array([",".join(b) for _, b in got])]

    return map_texts(docs, rows, "doc_id bigint, score double, predicted int, restored string")
