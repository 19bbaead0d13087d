"""Evidence over runs, the nested registry, and documents of sources."""

from pyspark.sql import functions as F

from siftlode.operators import crawl, evidence, registry
from siftlode.streaming import observations

RECORD = "id string, source_id string, institution string, department string, department_normalized string, role_type string, explicit_months int, available_from string, booked_until string, confidence string, checked string"


def run_of(spark, day, months="2027-03"):
    rows = [("r1", "s", "Haus", "Chirurgie", "surgery", "PJ", None, months, None, "high", day), ("r2", "s", "Haus", "Radiologie", None, "PJ", 6, None, None, "low", day)]
    return evidence.evidence(evidence.with_lead_times(spark.createDataFrame(rows, RECORD).withColumn("checked", F.to_timestamp("checked"))))


def test_three_runs_make_three_observations(spark, tmp_path):
    table, distinct, checkpoint = (str(tmp_path / n) for n in ("observations", "distinct", "checkpoint"))
    sizes = []
    for run, day in (("1", "2026-07-01"), ("2", "2026-08-01"), ("2", "2026-08-01"), ("3", "2026-09-01"), ("4", "2026-09-01")):
        # a build that is repeated, under its own name or another, adds nothing
        observations.append(run_of(spark, day), table, run)
        observations.collect(spark, table, distinct, checkpoint)
        sizes.append(spark.read.schema(observations.SCHEMA).parquet(distinct).count())
    assert sizes == [2, 4, 4, 6, 6]
    got = {r.place.rsplit("|", 2)[1]: r for r in observations.summarised(spark, distinct).collect()}
    surgery = got["surgery"]
    assert (surgery.observed, surgery.basis, surgery.confidence, surgery.median_months, surgery.apply_min, surgery.apply_max) == (3, "historical-observed", "medium", 7, 6, 8)
    assert str(surgery.first_seen)[:10] == "2026-07-01" and surgery.warnings == []
    assert (got["radiologie"].basis, got["radiologie"].evidence, got["radiologie"].confidence) == ("explicit-source", 3, "medium")


def test_ids_are_forgotten_after_the_delay(spark, tmp_path):
    table, distinct, checkpoint = (str(tmp_path / n) for n in ("observations", "distinct", "checkpoint"))
    for run, day in (("1", "2026-07-01"), ("2", "2026-07-02"), ("3", "2026-07-01")):
        observations.append(run_of(spark, day), table, run)
        observations.collect(spark, table, distinct, checkpoint, "30 days")
    assert spark.read.schema(observations.SCHEMA).parquet(distinct).count() == 4


URLS = "array<struct<url: string, page_type: string, parser: string, fetch_mode: string>>"
ENTRY = f"position int, id string, institution string, canton string, city string, language string, source_language string, region string, notes string, priority int, status string, urls {URLS}, path string"


def entry(position, id="haus-a", urls=(), **changed):
    good = {"institution": "Haus", "canton": "BE", "city": "Bern", "language": "de", "source_language": None, "region": None, "notes": "seen", "priority": 3, "status": "verified"} | changed
    return (position, id, *good.values(), None if urls is None else list(urls), "mine")


def test_registry_paths(spark):
    page = lambda url, **c: {"url": url, "page_type": "list", "parser": "generic", "fetch_mode": "html"} | c
    rows = [
        entry(0, urls=[page("https://a.example/1"), page("https://a.example/1")]), entry(1, urls=[page("https://b.example", fetch_mode=None), page("https://a.example/1", parser="")]), entry(2, "Haus B", [page("b.example")], priority=6, canton=None),
        entry(3, None, None, notes=" ", status="gone"), entry(4, None, [page("https://c.example")]), entry(5, "haus-c", [page(None), page(None)]),
    ]
    got = {(r.entry, r.url, r.path, r.message) for r in registry.violations(spark.createDataFrame(rows, ENTRY)).collect()}
    assert got == {
        (1, 2, "0.urls.1.url", 'Duplicate source URL "https://a.example/1" also appears at entry 1, URL 1.'), (2, None, "1.id", 'Duplicate source id "haus-a" also appears at entry 1.'),
        (2, 1, "1.urls.0.fetch_mode", "fetch mode is known"), (2, 2, "1.urls.1.parser", "parser is required"), (2, 2, "1.urls.1.url", 'Duplicate source URL "https://a.example/1" also appears at entry 1, URL 1.'),
        (3, None, "2.id", "id must use lowercase kebab-case"), (3, None, "2.priority", "priority is a whole number of 1 to 5"), (3, None, "2.canton", "canton is known"), (3, 1, "2.urls.0.url", "url is an address"),
        (4, None, "3.id", "id is required"), (4, None, "3.status", "status is known"), (4, None, "3.urls", "urls must contain at least one URL"), (5, None, "4.id", "id is required"),
        (6, 1, "5.urls.0.url", "url is an address"), (6, 2, "5.urls.1.url", "url is an address"),
    }
    assert registry.violations(spark.createDataFrame([], ENTRY)).collect() == []


def test_a_busy_source_has_parts(spark):
    sources = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    records = spark.range(250).selectExpr("if(id % 10 = 0, 'b', 'a') as source_id", "concat('r', lpad(id, 4, '0')) as id", "'Haus' as institution", "cast(null as string) as department", "'PJ' as role_type")
    changes = spark.createDataFrame([("a", "change-2", "error", "review"), ("a", "change-1", "new-source", "info"), ("a", "change-3", "content-changed", "review")], "source_id string, change_id string, change_type string, severity string")
    rows = crawl.source_documents(sources, records, changes, part=100).collect()
    parts = {(r.id, r.part): r for r in rows}
    assert set(parts) == {("a", 0), ("a", 1), ("a", 2), ("b", 0), ("b", 1), ("b", 2), ("c", 0)} and all(len(r.records) <= 100 for r in rows)
    told = [x.id for k in range(3) for x in parts["a", k].records]
    assert told == sorted(told) and len(told) == 225 and [c.change_id for c in parts["a", 0].changes] == ["change-3", "change-2", "change-1"]
    assert parts["c", 0].records == [] and parts["c", 0].changes == []
