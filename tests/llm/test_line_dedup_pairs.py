"""Candidates of keys: packed keys come back whole, copies make few pairs, and pairs that are left out cannot link."""

import random

import numpy as np
from pyspark.sql import functions as F

from siftlode.llm import line_dedup as ld
from test_line_dedup import edited, similar


def lines_of(rng, number):
    vocabulary = [rng.randrange(1, 1 << 32) for _ in range(3000)]
    lines = []
    for _ in range(number):
        line = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]
        lines += [line, edited(rng, line, rng.randint(1, max(1, len(line) // 5)), vocabulary)]
    return lines


def test_no_similar_pair_is_left_out():
    rng = random.Random(5)
    lines = lines_of(rng, 400)
    numbers = np.array([len(x) for x in lines])
    words = np.array([w for x in lines for w in x], np.uint32)
    line, key, place = ld.placed_keys(words, numbers, ld.Guess.of(words, numbers, 1))
    order = np.lexsort((line, key))
    line, key, place = line[order], key[order], place[order]
    bits = ld._bits(ld._sketches(words, numbers))
    found = {(int(line[x]), int(line[y])) for xs, ys in ld._pairs(key, line, numbers[line], place, 0.8, bits[line]) for x, y in zip(xs, ys, strict=True)}
    linked = {(i, i + 1) for i in range(0, len(lines), 2) if lines[i] != lines[i + 1] and similar(lines[i], lines[i + 1])}
    assert len(linked) > 300 and linked <= found
    # strangers that share a run are known by length, place or sketch
    assert len(found) < 2 * len(linked)


def test_copies_make_as_many_pairs_as_lines(spark, monkeypatch):
    """The pairs of a group of like lines were as many as its size squared."""
    rng, seen = random.Random(6), []
    base = [f"w{rng.randrange(10**9)}" for _ in range(40)]
    rows = [(i, " ".join(f"x{i}" if j == i % 40 else w for j, w in enumerate(base))) for i in range(200)]
    whole = ld.sifted
    monkeypatch.setattr(ld, "sifted", lambda pairs, s: (seen.append(pairs.count()), whole(pairs, s))[1])
    got = ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).filter(F.col("n_dropped") > 0).count()
    assert got == 199 and sum(seen) < 200 * 12
