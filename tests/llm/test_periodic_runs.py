import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq

from siftlode.llm import periodic_runs as pr
from siftlode.llm import registry


def stretches(t, least=12):
    """(start, length, period) by comparing each word with that a period on, for all periods; the smallest period of a stretch counts."""
    out, n = {}, len(t)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and t[j] == t[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least:
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((*k, q) for k, q in out.items())


def found(t, least=12):
    return list(zip(*(x.tolist() for x in pr.runs(np.array(t, np.int64), least)), strict=True))


def test_runs_match_their_definition():
    rng = random.Random(3)
    for _ in range(600):
        n, k = rng.randint(0, 60), rng.choice([1, 2, 2, 3, 5])
        t = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.4:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(3, 8)
            t = t[:a] + [t[a + (i - a) % p] for i in range(a, n)]
        for least in (2, 12):
            assert found(t, least) == stretches(t, least)


def test_powers_and_words_of_fibonacci():
    a, b = [0], [0, 1]
    while len(b) < 1000:
        a, b = b, b + a
    assert found(b) == stretches(b)
    assert found([0] * 100_000) == [(0, 100_000, 1)]
    assert found(list(range(30_000)) * 3) == [(0, 90_000, 30_000)]


def test_suffixes_and_prefixes():
    rng = random.Random(1)
    for _ in range(200):
        t = [rng.randrange(3) for _ in range(rng.randint(1, 40))]
        order, rank = pr.suffix_ranks(np.array(t))
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:]) and rank[order].tolist() == list(range(len(t)))
        common = lambda i, j: next((k for k in range(len(t)) if max(i, j) + k >= len(t) or t[i + k] != t[j + k]), 0)  # noqa: B023, E731
        want = [0, *(common(i, j) for i, j in zip(order, order[1:]))]
        assert pr.common_prefixes(np.array(t), order).tolist() == want


def by_hand(doc, text):
    """Query 12 in plain Python."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    got = stretches(words)
    gone = {i for s, m, q in got for i in range(s + q, s + m)}
    best = min(got, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc, len(got), *longest, sha("".join(f"{s},{m},{q}\n" for s, m, q in got)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def test_query_by_hand(spark):
    folder = "/root/testdata/sf0.001"
    docs = [r for r in pq.read_table(f"{folder}/documents.parquet").to_pylist() if len(r["text"] or "") < 9000]
    got = {r.doc_id: tuple(r[c] for c in pr.NAMES) for r in registry.queries()["op12_periodic_runs"](spark, folder).collect()}
    want = [by_hand(r["doc_id"], r["text"]) for r in docs]
    assert [got[r[0]] for r in want] == want and sum(r[1] > 0 for r in want) > 10


def test_edge_rows(spark):
    loop = "ab cd " * 9 + "ef"
    texts = [None, "", " \n", loop, loop, "x y " * 8, "é " * 20 + "é", "a b c d e f g h i j k l", "w " * 400_000, "😀\t".encode("utf-16", "surrogatepass").decode("utf-16") * 30]
    rows = [(i, t, "s", 1) for i, t in enumerate(texts)] + [(None, loop, "s", 1), (3, loop, "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Start string, n_runs int")
    got = sorted((tuple(r[c] for c in pr.NAMES) for r in pr.periodic_runs(df).collect()), key=str)
    plain = lambda doc, text: (doc, *by_hand(None, text)[1:])
    short = [(d, t) for d, t, _, _ in rows if len(t or "") < 10_000]
    want = [plain(*r) for r in short] + [(8, 1, 0, 400_000, 1, 400_000_000, hashlib.sha256(b"0,400000,1\n").hexdigest(), hashlib.sha256(b"w").hexdigest())]
    assert got == sorted(want, key=str)
    assert pr.periodic_runs(df.limit(0)).collect() == []
