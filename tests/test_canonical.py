"""Canonical JSON against plain Python, ids of changes, and orders."""

import hashlib
import json
import random

from pyspark.sql import functions as F

from siftlode.functions.canonical import canonical_json
from siftlode.operators import aggregates, changes, evidence, ordering

SCHEMA = "zeta string, Alpha struct<b: int, a: array<struct<y: string, x: double>>, C: map<string, array<string>>>, flag boolean, n long"


def plain(value):
    """JSON with keys in a locale's order at every depth."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{plain(v)}" for k, v in sorted(value.items(), key=lambda e: (e[0].lower(), e[0].swapcase()))) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(plain, value)) + "]"
    if isinstance(value, float):
        return NUMBERS[value]
    return json.dumps(value, ensure_ascii=False)


# numbers as scripts write them
NUMBERS = {1.0: "1", -0.5: "-0.5", 0.1: "0.1", 1e21: "1e+21", 1.5e22: "1.5e+22", 1e20: "100000000000000000000", 1e-6: "0.000001", 1.25e-7: "1.25e-7", 123456789.5: "123456789.5", 0.0005: "0.0005", 0.0: "0", -12345678.0: "-12345678"}
TEXTS = ["", "a\"b\\c", "tab\tline\nfeed\r\b\f", "\x01\x1f\x7f", "é–’ 😀", None, "null"]


def test_nested_rows(spark):
    rng = random.Random(4)
    some = rng.choice
    rows = []
    for _ in range(60):
        items = [{"y": some(TEXTS), "x": some([None, *NUMBERS])} for _ in range(rng.randint(0, 3))]
        inner = {"b": some([None, 3, -7]), "a": some([None, items]), "C": some([None, {some(["b", "B", "a", "zz"]): [some(TEXTS)], "A": []}])}
        rows.append({"zeta": some(TEXTS), "Alpha": some([None, inner]), "flag": some([None, True, False]), "n": some([None, 1 << 60])})
    df = spark.createDataFrame([(r["zeta"], r["Alpha"], r["flag"], r["n"]) for r in rows], SCHEMA).coalesce(1)
    got = [r.j for r in df.select(canonical_json(F.struct(*df.columns), df.schema).alias("j")).collect()]
    assert got == [plain(r) for r in rows]


def test_change_ids_hash_all_that_they_say(spark):
    fields = "sourceId string, url string, statusCode int, rawHash string, textHash string, error string"
    before = spark.createDataFrame([("s", "u1", 200, "r", "t", None), ("s", "u2", 200, "r", "t", None), ("s", "gone", 200, "r", "t", None)], fields)
    after = spark.createDataFrame([("s", "u1", 200, "r2", "t2", None), ("s", "u2", 500, "r", "t2", None), ("s", "new", None, "r", "t", "time \"out\"")], fields)
    got = {(r.url, r.change_type): r for r in changes.described_pages(before, after, "2027-01-02T03:04:05.000Z").collect()}
    assert set(got) == {("u1", "content-changed"), ("u2", "error"), ("new", "new-source"), ("new", "error")}
    assert got["u2", "error"].message == "Page crawl failed for u2: HTTP 500." and got["new", "error"].message == "Page crawl failed for new: time \"out\"."
    r = got["u1", "content-changed"]
    side = lambda raw, text: {"sourceId": "s", "url": "u1", "statusCode": 200, "rawHash": raw, "textHash": text, "error": None}
    told = {"sourceId": "s", "url": "u1", "detectedAt": "2027-01-02T03:04:05.000Z", "changeType": "content-changed", "severity": "review", "before": side("r", "t"), "after": side("r2", "t2"), "message": "Cleaned page text changed for u1."}
    assert r.change_id == "change-" + hashlib.sha256(plain(told).encode()).hexdigest()[:16]
    # told twice, a change is one; the gravest come first
    both = changes.all_changes(changes.described_pages(before, after, "x").union(changes.described_pages(before, after, "x")), changes.described_pages(before, before, "x"))
    assert [r.severity for r in both.collect()] == ["review"] * 3 + ["info"]
    assert [r.change_type for r in both.collect()] == ["content-changed", "error", "error", "new-source"]


def test_locale_order(spark):
    names = ["Zug", "Äpfel", "apfel", "Apfel", "äpfel", "Zürich", "Zurich", "Ärzte", "Arzt", "10", "9", "Spital-Ost", "Spital Ost", "Éclair", "eclair", None]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int")
    want = [None, "10", "9", "apfel", "Apfel", "äpfel", "Äpfel", "Arzt", "Ärzte", "eclair", "Éclair", "Spital Ost", "Spital-Ost", "Zug", "Zurich", "Zürich"]
    assert [r.name for r in df.orderBy(ordering.locale("name")).collect()] == want
    placed = ordering.places(df.union(df), ["name"], ["i"]).orderBy("place").collect()
    assert [r.place for r in placed] == list(range(1, 33)) and [r.name for r in placed][::2] == want


def test_medians_from_counts(spark):
    import statistics

    rng = random.Random(1)
    rows = [(k, rng.choice([None, *range(-3, 9)])) for k in range(30) for _ in range(rng.randint(0, 9))] + [(99, 7)] * 4000 + [(99, 1)] * 3999
    counted = spark.createDataFrame(rows, "k int, v int").groupBy("k", "v").agg(F.count("*").alias("n"))
    out = counted.groupBy("k").agg(F.collect_list(F.struct(F.col("v").alias("value"), "n")).alias("pairs")).select("k", aggregates.counted_median(F.col("pairs")).alias("m"))
    values = lambda k: [v for key, v in rows if key == k and v is not None]
    assert {r.k: r.m for r in out.collect()} == {k: statistics.median(values(k)) if values(k) else None for k in {r[0] for r in rows}}


def test_one_hot_place(spark):
    rows = [(f"r{i}", "p", "s", "historical-observed", i % 7, "low") for i in range(3001)] + [("r0", "q", "s", "explicit-source", 3, "low"), ("r1", "q", "t", "explicit-source", 5, "high")]
    df = spark.createDataFrame(rows, "record_id string, place string, source_id string, kind string, months int, confidence string")
    out = evidence.summaries(df)
    assert "percentile" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r.place: r for r in out.collect()}
    assert (got["p"].median_months, got["p"].observed, got["p"].least, got["p"].most) == (3, 3001, 0, 6)
    assert (got["q"].apply_min, got["q"].confidence, got["q"].observed, got["q"].median_months) == (3, "medium", 0, None)
