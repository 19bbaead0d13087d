import random
import re
from collections import Counter, defaultdict

from siftlode.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def make(rng, counts):
    rows = []
    for source, n in counts.items():
        for _ in range(n):
            rows.append((len(rows), " ".join(["w"] * int(rng.lognormvariate(3.5, 1))), source))
    rows += [(None, "no id here", "a"), (3, rows[3][1], rows[3][2]), (9000, None, "a"), (9001, " \t\n", "b"), (9002, "", "empty")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int").repartition(3)


def test_targets_and_copies(spark):
    rng = random.Random(3)
    rows = make(rng, {"a": 700, "B": 30, "é": 60, "b": 90, "": 20, None: 40, "z": 2})
    got = mixing.mix(frame(spark, rows), block=50).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t, _ in rows}
    sizes = defaultdict(int)
    for k, _, s in rows:
        sizes[s] += size[k]
    want = brute_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - want[s]) <= max(0.01 * want[s], min(size[r[0]] for r in rows if r[2] == s and size[r[0]]) if want[s] else 0) for s in sizes)
    again = mixing.mix(frame(spark, rows[::-1]), block=50).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mixed_rows(spark):
    rows = make(random.Random(5), {"a": 50, "b": 5, "c": 9})
    df = frame(spark, rows)
    copies = Counter()
    for r in mixing.mix(df).collect():
        copies[r.doc_id, r.source] += r.copies
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == Counter({k: n for k, n in copies.items() if n})


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(empty).count() == mixing.mixed_documents(empty).count() == 0


def test_a_few_long_documents_outweigh_all_others(spark):
    """One offset, and yet the words come near the target: the long ones are rounded against each other."""
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([3, 5, 9]), "a") for i in range(400)] + [(1000 + i, "w " * n, "a") for i, n in enumerate((30_000, 9_000, 2_500, 700, 650))]
    rows += [(2000 + i, "w " * 40, "b") for i in range(900)] + [(3000, "w " * 5000, "c"), (3001, "w " * 3000, "c")]
    got = mixing.mix(frame(spark, rows)).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert abs(taken["a"] - target["a"]) < 0.01 * target["a"] and abs(taken["b"] - target["b"]) < 0.01 * target["b"]
    assert abs(taken["c"] - target["c"]) <= 3000


def test_columns_with_clashing_names(spark):
    rows = make(random.Random(5), {"a": 50, "b": 5})
    df = frame(spark, rows).withColumns({"__key": mixing.F.lit("mine"), "copies": mixing.F.lit("x"), "__NTH": mixing.F.lit(1)})
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns and {(r["__key"], r["copies"], r["__NTH"]) for r in got.collect()} == {("mine", "x", 1)}
