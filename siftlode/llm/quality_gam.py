"""Quality by a generalised additive model with pairwise interactions.

Features of the whole text are cut into quantile bins. Boosting goes round the features again and again; each
step fits a shallow tree to the gradient over one feature's bins and adds a little of it to that feature's
table. The pairs of features whose joint bins explain most of what is left then get tables of their own in the
same way. A score is the logistic of a sum of table entries.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlode.llm import textvec as tv
from siftlode.llm.labels import SAMPLE, id_crc, labelled_sample, sampled_texts

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "marks", "bars", "other_bytes", "distinct_words", "top_word",
    "distinct_pairs", "lines_per_word", "words_per_stop", "marked_words", "byte_entropy", "repeated_neighbours",
)
BINS, PAIR_BINS, PAIRS = 32, 6, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAF = 120, 60, 0.15, 5.0

_UPPER, _DIGIT, _BAR, _LINE = tv.table(range(65, 91)), tv.table(range(48, 58)), tv.table(b"|"), tv.table(b"\n")
_STOP = tv.table(b".!?")
_HIGH = tv.table(range(128, 256))
_MARK = tv.table([c for c in range(33, 127) if not chr(c).isalnum()])


def features(texts) -> np.ndarray:
    """(rows, features); an empty text has zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    for lo, hi, data, offsets in tv.chunks(texts):
        starts, ends = tv.spans(data, offsets, tv.NOT_WHITE)
        h = tv.hashes(tv.LOWER[data], starts, ends)
        first, number = tv.counts_by_text(tv.owners(offsets, starts), hi - lo)
        marked = _MARK[data[ends - 1]] & (np.where(ends - starts > 1, _MARK[data[np.maximum(ends - 2, 0)]], False)) if len(ends) else np.empty(0, bool)
        for row in np.flatnonzero(number):
            raw = data[offsets[row] : offsets[row + 1]]
            counts = np.bincount(raw, minlength=256)
            n, b = int(number[row]), len(raw)
            words = h[first[row] : first[row] + n]
            _, times = np.unique(words, return_counts=True)
            pairs = words[1:] * np.uint64(3) + words[:-1]
            share = counts[counts > 0] / b
            of = lambda t: counts[t].sum()  # noqa: B023, E731
            out[lo + row] = (
                np.log1p(b), np.log1p(n), (b - of(tv.WHITE)) / n, of(_UPPER) / b, of(_DIGIT) / b, of(_MARK) / b, of(_BAR) / b, of(_HIGH) / b, len(times) / n, times.max() / n,
                len(np.unique(pairs)) / max(1, n - 1), of(_LINE) / n, n / (1 + of(_STOP)), marked[first[row] : first[row] + n].mean(), -(share * np.log2(share)).sum(), (words[1:] == words[:-1]).sum() / n,
            )
    return out


@dataclass(frozen=True)
class Gam:
    cuts: list[np.ndarray]
    base: float
    tables: np.ndarray  # (features, BINS)
    pairs: list[tuple[int, int]]
    pair_cuts: list[np.ndarray]
    pair_tables: np.ndarray  # (pairs, PAIR_BINS ** 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, cut in enumerate(self.cuts):
            total += self.tables[f][np.searchsorted(cut, x[:, f], side="right")]
        if self.pairs:
            coarse = [np.searchsorted(cut, x[:, f], side="right") for f, cut in enumerate(self.pair_cuts)]
            for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
                total += t[coarse[i] * PAIR_BINS + coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _gain(g, h):
    return g * g / (h + LEAF)


def _split(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf value per bin of a tree over ordered bins."""
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h)
        at = int(gains.argmax()) + 1
        if gains[at - 1] > _gain(g.sum(), h.sum()) + 1e-9:
            return np.concatenate([_split(g[:at], h[:at], depth - 1), _split(g[at:], h[at:], depth - 1)])
    return np.full(len(g), g.sum() / (h.sum() + LEAF))


def _split_pair(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value per cell of a tree that cuts one feature's bins, then the other's on either side."""
    best, out = -1.0, np.full(g.shape, 0.0)
    for axis in (0, 1):
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        for cut in range(1, len(a)):
            leaf = np.concatenate([np.tile(_split(x.sum(0), y.sum(0), 1), (len(x), 1)) for x, y in ((a[:cut], b[:cut]), (a[cut:], b[cut:]))])
            gain = float((2 * leaf * a - leaf * leaf * b).sum())
            if gain > best:
                best, out = gain, leaf if axis == 0 else leaf.T
    return out


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """The model of labels 0 and 1. With one class only, or none, the score is a constant."""
    n = x.shape[1]
    share = (y.sum() + 0.5) / (len(y) + 1)
    base, tables = float(np.log(share / (1 - share))), np.zeros((n, BINS))
    if len(y) == 0 or y.min() == y.max():
        return Gam([np.empty(0)] * n, base, tables, [], [], np.zeros((0, PAIR_BINS**2)))
    cuts, coarse = [_cuts(c, BINS) for c in x.T], [_cuts(c, PAIR_BINS) for c in x.T]
    at = [np.searchsorted(c, v, side="right") for c, v in zip(cuts, x.T, strict=True)]
    total = np.full(len(y), base)

    def step(index, size, tree):
        p = 1 / (1 + np.exp(-total))
        return RATE * tree(np.bincount(index, weights=y - p, minlength=size), np.bincount(index, weights=p * (1 - p), minlength=size))

    for _ in range(ROUNDS):
        for f in range(n):
            size = len(cuts[f]) + 1
            change = step(at[f], size, lambda g, h: _split(g, h, 2))
            tables[f, :size] += change
            total += change[at[f]]
    rough = [np.searchsorted(c, v, side="right") for c, v in zip(coarse, x.T, strict=True)]
    p = 1 / (1 + np.exp(-total))
    cell = lambda i, j: rough[i] * PAIR_BINS + rough[j]
    joint = lambda i, j: _gain(np.bincount(cell(i, j), weights=y - p, minlength=PAIR_BINS**2), np.bincount(cell(i, j), weights=p * (1 - p), minlength=PAIR_BINS**2)).sum()
    pairs = sorted(combinations(range(n), 2), key=lambda ij: -joint(*ij))[:PAIRS]
    pair_tables = np.zeros((len(pairs), PAIR_BINS**2))
    square = lambda g, h: _split_pair(g.reshape(PAIR_BINS, -1), h.reshape(PAIR_BINS, -1)).ravel()
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(pairs):
            change = step(cell(i, j), PAIR_BINS**2, square)
            pair_tables[k] += change
            total += change[cell(i, j)]
    return Gam(cuts, base, tables, pairs, coarse, pair_tables)


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Gam:
    """A model from at most ``limit`` labelled documents outside the held-out fold; their features go to the driver."""
    texts = sampled_texts(docs, labelled_sample(labels, "quality", 4, 2, limit))

    def run(batches):
        for b in batches:
            x = features(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))], ["label", "x"])

    rows = texts.mapInArrow(run, "label int, x array<double>").collect()
    rows.sort(key=lambda r: (r.label, r.x))
    return fit(np.array([r.x for r in rows], float).reshape(len(rows), len(FEATURES)), np.array([r.label for r in rows], float))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, limit: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` per row of ``docs``.

    A row with a null id is not held out; null, empty and blank texts have zero features and are scored like any;
    repeated rows are each returned; an empty table gives an empty result. Other columns are ignored.
    """
    model = train(docs, labels, limit)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(features(b.column(1))))], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    held = F.coalesce(id_crc() % 4 == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
