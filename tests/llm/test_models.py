import math
import random

import numpy as np

from siftlode.llm import quality_gam as qg
from siftlode.llm import toxicity as tx


def best_segments(values):
    """All maximal scoring segments by their definition: the best one, then left and right of it."""
    best = max(((sum(values[i:j]), -i, -j) for i in range(len(values)) for j in range(i + 1, len(values) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i, j = -best[1], -best[2]
    return [*best_segments(values[:i]), round(best[0], 6), *best_segments(values[j:])]


def test_segments_match_their_definition():
    rng = random.Random(8)
    for _ in range(300):
        # no two sums are equal
        scores = [rng.choice([-0.61, -1.3, 1.3, 2.9, 0.7]) + rng.random() / 100 for _ in range(rng.randint(0, 14))]
        got = [(round(s, 6), a) for s, a, _ in tx.segments(np.array(scores, float))]
        assert [s for s, _ in got] == best_segments(scores)
        assert all(np.isclose(sum(scores[a : b + 1]), s) for s, a, b in tx.segments(np.array(scores, float)))


def test_every_word_has_its_log_odds(spark):
    rows = [(1, "bad day"), (1, "bad word here"), (0, "good day"), (0, "good word"), (0, "good good here")] * 40
    counts = tx.word_counts(spark.createDataFrame(rows, "label int, text string"))
    got = {r.word: r.score for r in tx.log_odds(counts, 80, 120).collect()}
    h = {w: int(tx.tv.hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)])).view(np.int64)[0]) for w in ("bad", "good", "day", "word", "here")}
    for word, toxic, clean in (("bad", 80, 0), ("good", 0, 120), ("day", 40, 40), ("word", 40, 40), ("here", 40, 40)):
        t, c = toxic + 2 * 0.4, clean + 2 * 0.6
        odds = math.log(t / 80.8) - math.log(c / 121.2)
        error = 2 * math.sqrt(1 / t + 1 / c)
        if abs(odds) > error:
            assert abs(got[h[word]] - (math.copysign(abs(odds) - error, odds) - tx.LOSS)) < 1e-9
        else:
            assert h[word] not in got
    assert got[h["bad"]] > 0 > got[h["good"]]


def rows_with(spark, odd, n=600, seed=1):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(common) for _ in range(rng.randint(5, 120))]
        bad = rng.random() < 0.3
        docs.append((i, odd(words, rng) if bad else " ".join(words), "x"))
        labels.append((i, int(not bad), int(bad)))
    docs += [(n, None, "x"), (n + 1, "", "x"), (n + 2, "w1 w2 " * 40_000, "x"), (None, "w1 w2", "x"), (0, docs[0][1], "x")]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def accuracy(got, labels, column):
    truth = {r.doc_id: r[column] for r in labels.collect() if r[column] is not None}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50
    return np.mean([r.predicted == truth[r.doc_id] for r in held])


def test_toxicity(spark):
    def insult(words, rng):
        for _ in range(rng.randint(2, 4)):
            words.insert(rng.randrange(len(words)), rng.choice(["Nitwit", "dolt,", "OAF!", "cretin"]))
        return " ".join(words)

    docs, labels = rows_with(spark, insult)
    got = tx.toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert accuracy(got, labels, "toxic") > 0.97
    assert all(r.passages == [] or r.score > 0.5 for r in got)
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        for p in r.passages:
            assert text[r.doc_id].encode()[p.first_byte : p.end_byte].lower().decode() == p.text


def test_quality(spark):
    def junk(words, rng):
        return rng.choice([" ".join(words).upper() + "!!!", " ".join([words[0]] * 80), " | ".join(words), "*** ".join(words)])

    docs, labels = rows_with(spark, junk)
    got = qg.quality(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert accuracy(got, labels, "quality") > 0.95


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in tx.toxicity(docs, labels).collect()} == {0.5}
    assert {r.score for r in qg.quality(docs, labels).collect()} == {0.5}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tx.toxicity(empty, labels).count() == qg.quality(empty, labels).count() == 0


def test_gam_scores_are_sums_of_its_tables():
    """Fit and scores of a tiny table against plain loops over bins."""
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 5, 200), rng.random(200), rng.integers(0, 2, 200)]).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 2] == 1)).astype(float)
    model = qg.fit(x, y)
    got = model.score(x)
    for row, p in zip(x, got, strict=True):
        total = model.base
        for f, cuts in enumerate(model.cuts):
            total += model.tables[f][sum(c <= row[f] for c in cuts)]
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            a, b = (sum(c <= row[k] for c in model.pair_cuts[k]) for k in (i, j))
            total += table[a * qg.PAIR_BINS + b]
        assert abs(p - 1 / (1 + math.exp(-total))) < 1e-9
    # an interaction that no single feature shows
    assert ((got > 0.5) == (y == 1)).mean() > 0.97


def brute_leaves(g, h, depth):
    """Leaf values of the best tree over ordered bins, one cut after another."""
    gain = lambda a, b: a * a / (b + qg.LEAF)
    best, cut = gain(sum(g), sum(h)) + 1e-9, None
    for i in range(1, len(g) if depth else 0):
        got = gain(sum(g[:i]), sum(h[:i])) + gain(sum(g[i:]), sum(h[i:]))
        if got > best:
            best, cut = got, i
    if cut is None:
        return [sum(g) / (sum(h) + qg.LEAF)] * len(g)
    return brute_leaves(g[:cut], h[:cut], depth - 1) + brute_leaves(g[cut:], h[cut:], depth - 1)


def test_trees_match_brute_force():
    rng = np.random.default_rng(9)
    for _ in range(100):
        n = int(rng.integers(1, 12))
        g, h = rng.normal(size=n), rng.random(n)
        assert np.allclose(qg._split(g, h, 2), brute_leaves(g.tolist(), h.tolist(), 2))


def test_columns_with_clashing_names(spark):
    docs, labels = rows_with(spark, lambda words, rng: " ".join([*words, "dolt oaf"]), 200)
    got = tx.score(docs.withColumnRenamed("score", "__text"), tx.fit(docs, labels))
    assert got.columns == ["doc_id", "text", "__text", "score", "n_words", "passages"] and {r["__text"] for r in got.collect()} == {"x"}
