"""Toxic passages as maximum-scoring segments of token log-odds.

The log-odds of every word between toxic and clean labelled documents have a Dirichlet prior in proportion to the two
classes and are drawn towards zero by two standard errors; a small fixed amount off every word keeps chance
from adding up. A linear scan then finds all maximal scoring segments of a text (Ruzzo and Tompa), and Karlin-Altschul
statistics, whose lambda follows from the clean word frequencies and whose K is fitted to the clean documents, turn a
segment's score and the text's length into the number of segments as good expected by chance. A logistic curve over
that value gives the probability.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftlode.llm import textvec as tv
from siftlode.llm.labels import SAMPLE, id_crc, labelled_sample, sampled_texts
from siftlode.llm.workspace import Workspace, fresh

#: Bytes of words: ASCII letters and digits, and all of non-ASCII characters.
WORD = tv.table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: Weight of a word's prior in documents, standard errors off its log-odds, and what every word loses besides.
PRIOR, ERRORS, LOSS = 2.0, 2.0, 1.0
#: Segments expected by chance up to which a passage is significant.
SIGNIFICANT = 0.01
_MOST = 80.0


@dataclass(frozen=True)
class ToxicModel:
    words: np.ndarray  # sorted hashes of those whose log-odds differ from 0
    scores: np.ndarray
    other: float  # score of all others
    scale: float  # lambda
    chance: float  # K
    intercept: float
    slope: float


def words_of(texts):
    """(first row, texts, bytes, offsets, starts, ends, hashes, first word, number of words) by chunk."""
    for lo, hi, data, offsets in tv.chunks(texts):
        data = tv.LOWER[data]
        starts, ends = tv.spans(data, offsets, WORD)
        first, number = tv.counts_by_text(tv.owners(offsets, starts), hi - lo)
        yield lo, hi - lo, data, offsets, starts, ends, tv.hashes(data, starts, ends), first, number


def word_counts(texts: DataFrame) -> DataFrame:
    """By word hash over (label, text): occurrences in toxic and clean texts, and numbers of such texts."""
    names = ("toxic", "clean", "toxic_texts", "clean_texts")

    def run(batches):
        for b in batches:
            label = np.asarray(b.column(0))
            for lo, rows, *_, h, _, number in words_of(b.column(1)):
                word, at = np.unique(h, return_inverse=True)
                text = np.repeat(np.arange(rows), number)
                once = np.unique(at * np.int64(rows) + text)
                n = []
                for i, t in ((at, text), (once // rows, once % rows)):
                    toxic = label[lo + t] == 1
                    n += [np.bincount(i[own], minlength=len(word)) for own in (toxic, ~toxic)]
                yield pa.RecordBatch.from_arrays([pa.array(tv.signed(word)), *map(pa.array, n)], ["word", *names])

    parts = texts.mapInArrow(run, "word long, " + ", ".join(f"{n} long" for n in names))
    return parts.groupBy("word").agg(*(F.sum(n).alias(n) for n in names))


def log_odds(counts: DataFrame, toxic: int, clean: int) -> DataFrame:
    """(word, score, clean) of the words whose log-odds differ from 0 by more than the error; of documents, as a word comes in bursts."""
    share = toxic / (toxic + clean)
    t, c = F.col("toxic_texts") + PRIOR * share, F.col("clean_texts") + PRIOR * (1 - share)
    odds = F.log(t / (toxic + PRIOR * share)) - F.log(c / (clean + PRIOR * (1 - share)))
    certain = F.abs(odds) - ERRORS * F.sqrt(1 / t + 1 / c)
    return counts.withColumn("certain", certain).filter("certain > 0").select("word", (F.signum(odds) * F.col("certain") - LOSS).alias("score"), "clean")


def token_scores(model: ToxicModel, h: np.ndarray) -> np.ndarray:
    """The score of each word, by hash."""
    if not len(model.words):
        return np.full(len(h), model.other)
    i = np.minimum(np.searchsorted(model.words, h), len(model.words) - 1)
    return np.where(model.words[i] == h, model.scores[i], model.other)


def segments(score: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments of a text's word scores as (score, first word, last word)."""
    at = np.flatnonzero(score > 0)
    after = np.cumsum(score)[at]
    stack: list[tuple[float, float, int, int]] = []  # totals before and after the segment, first and last word
    for p, lo, hi in zip(at.tolist(), (after - score[at]).tolist(), after.tolist(), strict=True):
        start = p
        while True:
            i = len(stack) - 1
            while i >= 0 and stack[i][0] >= lo:
                i -= 1
            if i < 0 or stack[i][1] >= hi:
                stack.append((lo, hi, start, p))
                break
            lo, start = stack[i][0], stack[i][2]
            del stack[i:]
    return [(hi - lo, a, b) for lo, hi, a, b in stack]


def expected(model: ToxicModel, score: float, words: int) -> float:
    """Natural logarithm of the number of segments as good that chance gives in a text of so many words."""
    return math.log(model.chance * max(words, 1)) - model.scale * score


def surprise(model: ToxicModel, score: float, words: int) -> float:
    """Minus the logarithm of the probability of a segment as good (Gumbel)."""
    log_e = expected(model, score, words)
    return min(_MOST, -log_e if log_e < -30 else -math.log(-math.expm1(-math.exp(min(log_e, 30.0)))))


def _scored(model: ToxicModel, h: np.ndarray, first: np.ndarray, number: np.ndarray):
    """(text, scores of its words) of the texts of a chunk with any word above 0."""
    value = token_scores(model, h)
    up = np.flatnonzero(value > 0)
    for t in np.unique(np.searchsorted(first + number, up, side="right")):
        yield int(t), value[first[t] : first[t] + number[t]]


def _best(texts: DataFrame, model: ToxicModel) -> list:
    """(label, words, best score) of the bounded sample."""

    def run(batches):
        for b in batches:
            n, best = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for lo, rows, *_, h, first, number in words_of(b.column(1)):
                n[lo : lo + rows] = number
                for t, value in _scored(model, h, first, number):
                    best[lo + t] = max(s for s, _, _ in segments(value))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(best)], ["label", "n", "best"])

    return texts.mapInArrow(run, "label int, n long, best double").collect()


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps, a little shrunk."""
    design, w = np.column_stack([np.ones_like(x), x]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-3, 1e-1])
        step = np.linalg.solve(hessian, design.T @ (y - p) - np.array([1e-3, 1e-1]) * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> ToxicModel:
    """A model from labelled documents outside the held-out fold, ``limit`` of them at most."""
    ws = Workspace(docs.sparkSession, "toxicity")
    texts = ws.write(sampled_texts(docs, labelled_sample(labels, "toxic", 3, 1, limit)), "sample")
    number = dict(texts.groupBy("label").count().collect())
    toxic, clean = number.get(1, 0), number.get(0, 0)
    if not toxic or not clean:
        ws.keep()
        share = (toxic + 0.5) / (toxic + clean + 1)
        return ToxicModel(np.empty(0, np.uint64), np.empty(0), -LOSS, 1.0, 1.0, math.log(share / (1 - share)), 0.0)
    counts = ws.write(word_counts(texts), "counts")
    total = counts.agg(F.sum("clean")).first()[0]
    marked = sorted(log_odds(counts, toxic, clean).collect(), key=lambda r: np.int64(r.word).view(np.uint64))
    words = np.array([r.word for r in marked], np.int64).view(np.uint64)
    scores = np.array([r.score for r in marked])
    rate = np.array([(r.clean + 0.5) / (total + 1) for r in marked])
    model = ToxicModel(words, scores, -LOSS, _scale(scores, rate, -LOSS), 1.0, 0.0, 0.0)
    seen = _best(texts, model)
    ws.keep()
    y, n, best = (np.array([r[i] for r in seen], float) for i in range(3))
    none = y == 0
    chance = none.sum() / float((n[none].clip(1) * np.exp(-model.scale * best[none])).sum())
    model = replace(model, chance=chance)
    x = np.array([surprise(model, b, int(k)) for b, k in zip(best, n, strict=True)])
    intercept, slope = _logistic(x, y)
    return replace(model, intercept=intercept, slope=slope)


def _scale(scores: np.ndarray, rate: np.ndarray, other: float) -> float:
    """The positive lambda at which scores of clean words have a mean exp(lambda * score) of 1."""
    if not (scores > 0).any():
        return 1.0
    mean = lambda x: float(rate @ np.exp(x * scores)) + (1 - float(rate.sum())) * math.exp(x * other) - 1
    lo, hi = 0.0, 1.0
    while mean(hi) < 0 and hi < 64:
        lo, hi = hi, hi * 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 0 else (lo, mid)
    return hi


def score(docs: DataFrame, model: ToxicModel, passages: bool = True) -> DataFrame:
    """All columns of ``docs`` with ``score``, ``n_words`` and the significant ``passages``.

    A passage has its bytes' bounds in the UTF-8 text, its lower-cased text, score and logarithm of the expectation.
    Null and empty texts score like texts without any word above 0. Columns named like the added ones are replaced, all others kept; texts
    of any length are read whole.
    """
    kind = pa.list_(pa.struct([("first_byte", pa.int64()), ("end_byte", pa.int64()), ("text", pa.string()), ("score", pa.float64()), ("log_expected", pa.float64())]))

    def run(batches):
        floor = 1 / (1 + math.exp(-model.intercept))
        for b in batches:
            text_column = b.column(b.schema.get_field_index(own))
            value = np.full(b.num_rows, floor)
            n = np.zeros(b.num_rows, np.int64)
            found: list[list] = [[]] * b.num_rows
            for lo, rows, data, offsets, starts, ends, h, first, number in words_of(text_column):
                n[lo : lo + rows] = number
                value[lo : lo + rows] = 1 / (1 + np.exp(-model.intercept - model.slope * surprise_of_none(model, number)))
                for t, marks in _scored(model, h, first, number):
                    got = segments(marks)
                    best = max(s for s, _, _ in got)
                    value[lo + t] = 1 / (1 + math.exp(-model.intercept - model.slope * surprise(model, best, int(number[t]))))
                    if passages:
                        found[lo + t] = [
                            {"first_byte": int(starts[first[t] + i] - offsets[t]), "end_byte": int(ends[first[t] + j] - offsets[t]), "text": data[starts[first[t] + i] : ends[first[t] + j]].tobytes().decode("utf-8", "replace"), "score": s, "log_expected": e}
                            for s, i, j in got
                            if (e := expected(model, s, int(number[t]))) <= math.log(SIGNIFICANT)
                        ]
            kept = [b.column(i) for i, name in enumerate(b.schema.names) if name != own]
            names = [name for name in b.schema.names if name != own]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(value), pa.array(n), pa.array(found, kind)], [*names, "score", "n_words", "passages"])

    carried = docs.drop("score", "n_words", "passages")
    (own,) = fresh(carried.columns, "text")
    carried = carried.withColumn(own, F.col("text"))
    added = StructType.fromDDL("score double, n_words long, passages array<struct<first_byte: long, end_byte: long, text: string, score: double, log_expected: double>>")
    schema = StructType(carried.drop(own).schema.fields + added.fields)
    return carried.mapInArrow(run, schema)


def surprise_of_none(model: ToxicModel, words: np.ndarray) -> np.ndarray:
    """``surprise`` of a segment without any score, by number of words."""
    e = np.minimum(model.chance * np.maximum(words, 1), 1e13)
    return np.minimum(_MOST, -np.log(-np.expm1(-e)))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, limit: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``n_words`` and ``passages`` per row of ``docs``.

    A null id is in the held-out fold's complement; null, empty and blank texts get the score of a text without
    any word above 0; texts of any length are read whole; repeated rows are each returned; an empty table gives an empty result. Without labels of both
    kinds all scores are the smoothed share of toxic labels (0.5 without any).
    """
    model = fit(docs, labels, limit)
    scored = score(docs.select("doc_id", "text"), model)
    held = F.coalesce(id_crc() % 3 == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_words", "passages")
