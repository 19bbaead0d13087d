import itertools
import random

from siftlode.llm.ngram_join import near_duplicates

SPACE = " \t\n\v\f\r"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    out, word = [], ""
    for ch in (text or "").translate(LOWER):
        if ch in SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += ch
    return out + [word] if word else out


def shingles(text, k=4):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(rows, num=85, den=100):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[root(i)] = min(low.get(root(i), key), key)
    return sorted(((k, len(sets[i]), low.get(root(i), k)) for i, (k, _) in enumerate(rows)), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, node string")
    return sorted((tuple(r) for r in near_duplicates(df).collect()), key=str)


def test_random_edits_match_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 12, 30, 60, 150, 400]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 30)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy = copy[: max(1, int(len(copy) * rng.uniform(0.8, 1)))]
            rows.append((len(rows), " ".join(copy).upper() if rng.random() < 0.2 else "\n".join(copy)))
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    long = " ".join(f"t{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "one two three four"), (7, long), (8, long + " end"), (8, "one two"), (None, "one two"), (None, None), (9, "Ä b c d"), (10, "ä b c d")]
    assert run(spark, rows) == brute(rows)


def test_chain_and_empty_table(spark):
    base = [f"c{i}" for i in range(100)]
    rows = [(i, " ".join(base[i * 2 : 60 + i * 2])) for i in range(20)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_rows_without_ids_link_others(spark):
    """A chain whose middle has no id is one component, named by the ids at its ends; a text of nothing but null ids has none."""
    base = [f"c{i}" for i in range(100)]
    text = lambda k: " ".join(base[k * 3 : 60 + k * 3])
    rows = [(5, text(0)), (None, text(1)), (7, text(2)), (None, "alone and without any number"), (None, "alone and without any number")]
    assert run(spark, rows) == brute(rows)
