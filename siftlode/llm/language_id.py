"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its words and of the byte 2- to 4-grams within them, all hashed into a fixed
number of rows. Embeddings and the softmax are trained together by stochastic gradient descent on a bounded sample.
A part of the sample is left out of it and sets the temperature of the scores, and the score below which a prediction
counts as rejected. At most 64 languages are learned, the most frequent ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlode.llm import textvec as tv
from siftlode.llm.labels import id_crc

#: Documents that the model is fitted on at most, shared evenly by the languages; languages; hashed rows; width of an embedding.
SAMPLE, LANGUAGES, ROWS, WIDTH = 3_000, 64, 1 << 16, 16
GRAMS = (2, 3, 4)
EPOCHS, RATE = 6, 0.4
#: Share of wrong predictions among those that are not rejected, on the part of the sample left out.
WRONG = 0.01
UNKNOWN = "und"

#: Bytes of words: ASCII letters and all of other scripts.
_LETTER = tv.table([*range(65, 91), *range(97, 123), *range(128, 256)])
_U = np.uint64


def _subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, row) of all subwords; a word is taken with a blank on either side."""
    texts = len(offsets) - 1
    # each text between blanks of its own
    text = np.full(len(data) + 2 * texts, 32, np.uint8)
    own = np.repeat(np.arange(texts), np.diff(offsets))
    letter = _LETTER[data]
    text[(np.arange(len(data)) + 2 * own + 1)[letter]] = tv.LOWER[data[letter]]
    bounds = offsets + 2 * np.arange(texts + 1)
    inside = text != 32
    starts, ends = tv.spans(text, bounds, _LETTER)
    owner, rows = [tv.owners(bounds, starts)], [tv.hashes(text, starts, ends)]
    wide = text.astype(_U)
    value = wide.copy()
    whole = np.ones(len(text), bool)
    for n in range(2, max(GRAMS) + 1):
        if len(text) < n:
            break
        # blanks stand at the ends of a subword only
        whole = whole[: len(text) - n + 1] & (inside[n - 2 : len(text) - 1] if n > 2 else True)
        value = value[: len(text) - n + 1] | wide[n - 1 :] << _U(8 * (n - 1))
        if n in GRAMS:
            at = np.flatnonzero(whole if n > 2 else inside[:-1] | inside[1:])
            owner.append(tv.owners(bounds, at))
            rows.append(tv.mix(value[at] | _U(n) << _U(40)))
    owner, rows = np.concatenate(owner), (np.concatenate(rows) & _U(ROWS - 1)).astype(np.int64)
    by = np.argsort(owner, kind="stable")
    return owner[by], rows[by]


def _sums(table: np.ndarray, owner: np.ndarray, rows: np.ndarray, texts: int) -> np.ndarray:
    """Per text the mean of the table's rows; zeros without any."""
    out = np.zeros((texts, table.shape[1]))
    if len(rows):
        first, number = tv.counts_by_text(owner, texts)
        there = np.flatnonzero(number)
        out[there] = np.add.reduceat(table[rows], first[there], axis=0) / number[there, None]
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


@dataclass(frozen=True)
class Languages:
    names: list[str]
    table: np.ndarray  # (ROWS, names): embeddings times the softmax's weights, as both are linear
    bias: np.ndarray
    temperature: float
    reject: float  # predictions that score less are rejected

    def probabilities(self, owner, rows, texts: int) -> np.ndarray:
        return _softmax((_sums(self.table, owner, rows, texts) + self.bias) / self.temperature)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Of a grid, the temperature with the least negative log-likelihood of the labels, each smoothed by one count so that a part without mistakes gives no certainty."""
    grid, smooth, others = np.geomspace(0.2, 20, 81), 1 / (len(y) + 2), max(1, logits.shape[1] - 1)
    target = np.full(logits.shape, smooth / others)
    target[np.arange(len(y)), y] = 1 - smooth
    loss = [-(target * np.log(_softmax(logits / t) + 1e-300)).sum(1).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def rejection(score: np.ndarray, right: np.ndarray, wrong: float = WRONG) -> float:
    """The least score such that of the predictions from it on at most a share of ``wrong`` is wrong; above all where there is none."""
    by = np.argsort(-score, kind="stable")
    share = np.cumsum(~right[by]) / np.arange(1, len(by) + 1)
    # equal scores stand or fall together
    last = np.concatenate([score[by][1:] != score[by][:-1], [True]]) if len(by) else np.empty(0, bool)
    fits = np.flatnonzero((share <= wrong) & last)
    return float(score[by][fits[-1]]) if len(fits) else float(np.nextafter(1, 2))


def fit(texts: list[tuple[np.ndarray, np.ndarray]], labels: list[str]) -> Languages:
    """The model of texts, given as (rows, their shares of the mean), in an order that runs agree on. Every fifth text is left out for calibration."""
    names = sorted(set(labels))
    y = np.array([names.index(x) for x in labels], int)
    rng = np.random.default_rng(13)
    e, w, bias = rng.normal(0, 1 / WIDTH, (ROWS, WIDTH)), np.zeros((WIDTH, max(1, len(names)))), np.zeros(max(1, len(names)))
    if len(names) < 2:
        return Languages(names or [UNKNOWN], np.zeros((ROWS, 1)), bias, 1.0, 0.0)
    left_out = np.arange(len(y)) % 5 == 4
    learned = np.flatnonzero(~left_out)
    # the first gradient needs weights that differ
    w += rng.normal(0, 1 / WIDTH, w.shape)
    steps, done = EPOCHS * len(learned), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(learned):
            rows, share = texts[i]
            rate = RATE * (1 - done / steps)
            mean = share @ e[rows]
            error = _softmax(mean @ w + bias)
            error[y[i]] -= 1
            pull = w @ error
            w -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            # the share of each row in the mean, scaled up so that rare rows move
            e[rows] -= rate * np.minimum(share * len(rows), 4)[:, None] * pull
            done += 1
    table = e @ w
    held = np.flatnonzero(left_out)
    logits = np.array([texts[i][1] @ table[texts[i][0]] for i in held]).reshape(len(held), -1) + bias
    t = temperature(logits, y[held]) if len(held) else 1.0
    p = _softmax(logits / t)
    return Languages(names, table.astype(np.float32), bias, t, rejection(p.max(1), p.argmax(1) == y[held]) if len(held) else 0.0)


def train(docs: DataFrame, folds: int = 4, held: int = 2, limit: int = SAMPLE) -> Languages:
    """A model from at most ``limit`` documents with a language and a letter outside the held-out fold; their subwords, as counts by row, go to the driver."""
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (id_crc() % folds != held))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return fit([], [])
    # by the hash of their ids, about twice as many as a language's share, of which the first are taken
    share = max(1, limit // len(counts))
    rate = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], min(1.0, 2 * share / r["count"]))))
    drawn = F.xxhash64("doc_id", F.lit(13))
    some = known.filter((F.pmod(drawn, F.lit(1 << 20)) / float(1 << 20)) < rate[F.col("lang")])
    chosen = some.select("doc_id", "lang", drawn.alias("drawn")).distinct()
    least = chosen.groupBy("lang").agg(F.sort_array(F.collect_list("drawn")).alias("d")).select("lang", F.get("d", F.lit(share)).alias("bound"))
    texts = some.join(F.broadcast(least), "lang").filter(F.col("bound").isNull() | (drawn < F.col("bound"))).select("doc_id", "lang", F.lower("text").alias("text"))

    def run(batches):
        for b in batches:
            lo = 0
            for start, end, data, offsets in tv.chunks(b.column(2)):
                owner, rows = _subwords(data, offsets)
                found, times = np.unique(owner * ROWS + rows, return_counts=True)
                number = np.bincount(found // ROWS, minlength=end - start)
                lists = [tv.list_array(x, number, pa.int32()) for x in (found % ROWS, times)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, end - start), b.column(1).slice(lo, end - start), *lists], ["doc_id", "lang", "rows", "times"])
                lo = end

    got = texts.mapInArrow(run, "doc_id long, lang string, rows array<int>, times array<int>").toArrow()
    by = sorted(zip(*(got.column(i).to_pylist() for i in (0, 1)), range(len(got)), strict=True), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    columns = [got.column(i).combine_chunks() for i in (2, 3)]

    def text(i):
        rows, times = (np.asarray(c[i].values) for c in columns)
        return rows, times / times.sum()

    # ids of one language do not follow one another in the sample
    order = np.random.default_rng(4).permutation(len(by))
    return fit([text(by[k][2]) for k in order], [by[k][1] for k in order])


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``rejected`` per row of ``docs``.

    ``score`` is the calibrated probability of the language. Texts that are null or have no letter are ``und`` with score 0, and rejected, as are predictions below the model's
    bound; those keep their language, for the caller to drop. Rows that repeat are each returned, other columns are ignored, an empty table gives an empty result. Whole
    texts count, a mebibyte or a longer text at a time, with some 150 bytes of memory a byte of it.
    """

    def run(batches):
        for b in batches:
            spoken = b.column(2).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in tv.chunks(b.column(1)):
                p = model.probabilities(*_subwords(data, offsets), hi - lo)
                there, best = spoken[lo:hi], p.argmax(1)
                score = np.where(there, p.max(1), 0)
                names = [model.names[k] if ok else UNKNOWN for k, ok in zip(best, there, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(names, pa.string()), pa.array(score), pa.array(~there | (score < model.reject))], ["doc_id", "lang_pred", "score", "rejected"])

    spoken = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("spoken")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"), spoken).mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def languages(docs: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``rejected`` per row, by a model of the rows whose id's crc32 modulo 4 is not 2; a null id is not held out, and not learned from."""
    held = F.coalesce(id_crc() % 4 == 2, F.lit(False))
    return identify(docs, train(docs, limit=limit)).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
