"""Files at the edges, names of institutions, text helpers, and rules whose cases the tables lack."""

import json

import pytest
from pyspark.sql import functions as F

from siftlode.functions import lexicon as lex
from siftlode.functions import placement as pl
from siftlode.functions import text
from siftlode.operators import crawl, evidence, matching, quality
from siftlode.sources import json_files


def test_json_scans(spark, tmp_path):
    for name, body in {"b.snapshot.json": {"sourceId": "s", "url": "u", "statusCode": 404}, "a.snapshot.json": {"sourceId": "s", "url": "v", "error": "", "statusCode": 200, "extractedLinks": [{"text": "t", "href": "h"}]}, "report.json": {}}.items():
        (tmp_path / name).write_text(json.dumps(body, indent=1))
    got = json_files.snapshots(spark, str(tmp_path)).withColumn("failed", json_files.failed()).orderBy("file").collect()
    assert [(r.file, r.url, r.failed) for r in got] == [("a.snapshot.json", "v", False), ("b.snapshot.json", "u", True)] and got[0].extractedLinks[0].href == "h"
    assert json_files.summary(json_files.snapshots(spark, str(tmp_path))).columns == ["sourceId", "url", "statusCode", "rawHash", "textHash", "error"]
    (tmp_path / "rows.json").write_text(json.dumps([{"id": "1"}, {"id": "2"}]))
    assert json_files.array(spark, str(tmp_path / "rows.json"), "id string").count() == 2
    assert json_files.array_or_empty(spark, str(tmp_path / "none.json"), "id string").count() == 0
    with pytest.raises(Exception, match="none.json"):
        json_files.array(spark, str(tmp_path / "none.json"), "id string").count()


def test_crawl_report_needs_its_numbers(spark, tmp_path):
    good = dict.fromkeys(json_files.REPORT, 3)
    for name, body in {"good": good, "negative": good | {"urlCount": -1}, "missing": {k: v for k, v in good.items() if k != "skippedCount"}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(body))
    assert tuple(json_files.crawl_report(spark, str(tmp_path / "good.json")).first()) == (3,) * 6
    for bad in ("negative", "missing"):
        with pytest.raises(Exception, match="0 or more"):
            json_files.crawl_report(spark, str(tmp_path / f"{bad}.json")).collect()


def test_csv(spark):
    df = spark.createDataFrame([("a\"b", None, ["x", "y"], 3)], "a string, b string, c array<string>, d int")
    assert json_files.csv_lines(df, ("a", "b", "c", "d")).first().line == '"a""b",,"x; y","3"' and len(json_files.EXPORT) == 19


def test_institution_names(spark):
    names = ["Universitätsspital Zürich", "University Hospital Zürich", "Hôpitaux Universitaires de Genève", "Spital & Klinik Ütli", "  Inselspital  Bern"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(pl.institution_name(F.col("n")).alias("k")).withColumn("a", pl.institution_alias(F.col("k")))
    assert [tuple(r) for r in df.collect()] == [
        ("universitaetsspital zuerich", "usz"), ("universitat hospital zuerich", "universitat hospital zuerich"), ("hospital universitaires de geneve", "hospital universitaires de geneve"),
        ("hospital and hospital uetli", "hospital and hospital uetli"), ("inselspital bern", "inselgruppe"),
    ]


def test_matching_tiers(spark):
    known = spark.createDataFrame([("Universitätsspital Zürich", 3), ("Kantonsspital Aarau Baden Chur", 0), ("Klinik Rot Blau", 1), ("Klinik Rot Blau Gelb", 1), ("Spital Einzel", 2)], "institution string, records int").withColumn("key", pl.institution_name(F.col("institution")))
    rows = [(1, "Universitätsspital Zürich", ""), (2, "USZ", None), (3, "Aarau Baden Chur Haus", ""), (4, "Klinik Rot Blau Gelb Haus", ""), (5, "Klinik Rot Blau", ""), (6, "Einzel", ""), (7, "Nirgends", ""), (8, "USZ", "Out of scope here"), (9, "", "")]
    got = matching.match(spark.createDataFrame(rows, "id int, name string, notes string"), known)
    assert {r.id: (r.status, r.tier) for r in got.collect()} == {
        1: ("covered", "exact"), 2: ("covered", "alias"), 3: ("likely-covered", "fuzzy"), 4: ("ambiguous", "ambiguous"), 5: ("covered", "exact"), 6: ("covered", "fuzzy"), 7: ("missing", "none"),
        8: ("excluded", "excluded"), 9: ("missing", "none"),
    }
    assert {r.institution for r in matching.unmatched(known, got).collect()} == set()


def test_text_helpers(spark):
    row = spark.range(1).select(
        text.without_private_lines(F.lit("a\r\nPRIVATE b\nmy Email\nc")).alias("kept"), text.escape_html(F.lit("<a & \"b\">")).alias("escaped"), text.title_case(F.lit("hand-und_fuss")).alias("title"),
        text.emails(F.lit("A@b.ch, x@y.avif z@q.org).")).alias("emails"), text.fold(F.lit("Čéñ\u0301ß")).alias("fold"), text.slug(F.lit("--Ä b" * 20), 10).alias("slug"),
    ).first()
    assert tuple(row) == ("a\nc", "&lt;a &amp; &quot;b&quot;&gt;", "Hand Und Fuss", ["a@b.ch", "z@q.org"], "cenß", "a-b-a-b-a")


def test_departments_have_labels():
    assert set(lex.DEPARTMENTS) == set(lex.DEPARTMENT_LABELS) == set(lex.DEPARTMENT_KEYS)


def test_slices(spark):
    df = spark.createDataFrame([(1, "Kopf Aaa Bbb", [6, 10])], "id int, t string, s array<int>")
    assert [(r.start, r.slice) for r in crawl.slices("t", "s", df, "id").orderBy("start").collect()] == [(6, "Aaa"), (10, "Bbb")]


def test_summary_of_other_evidence(spark):
    rows = [("a", 1, "student-reported", 5, "low"), ("b", 2, "hospital-confirmed", 30, "high"), ("b", 3, "explicit-source", 4, "low"), ("c", 4, "historical-observed", 3, "low"), ("c", 5, "historical-observed", 4, "low"), ("c", 6, "historical-observed", 9, "low"), ("c", 7, "historical-observed", 9, "low"), ("d", 8, "estimated", 2, "low")]
    df = spark.createDataFrame(rows, "place string, record_id int, kind string, months int, confidence string").withColumn("source_id", F.lit("s"))
    got = {r.place: r for r in evidence.summaries(df).collect()}
    assert {k: (r.basis, r.confidence, r.apply_min, r.apply_max, r.median_months) for k, r in got.items()} == {
        "a": ("student-reported", "low", None, None, None), "b": ("hospital-confirmed", "high", 30, 30, None), "c": ("historical-observed", "medium", 3, 9, 7), "d": ("estimated", "low", None, None, None),
    }
    assert got["b"].warnings == ["Lead time is greater than 24 months and needs manual review."] and got["b"].label == "Hospital confirmed: apply 30 months ahead."


def test_other_constraints(spark):
    broken = lambda df, rules: [sorted(r.x) for r in df.select(quality.broken(rules).alias("x")).collect()]
    change = spark.createDataFrame([("availability-changed", None, "x"), ("availability-changed", "x", "y"), ("record-added", None, None)], "change_type string, before string, after string")
    assert broken(change, quality.change_constraints()) == [["an availability change has both sides"], [], []]
    assert broken(spark.createDataFrame([(5, 3), (3, 5), (None, 1)], "apply_min int, apply_max int"), quality.summary_constraints()) == [["recommended months are in order"], [], []]
    report = spark.createDataFrame([("2027-05", "2026-05", 12), ("2027-05", "2026-05", 11), ("2027-5", "2026-05", None)], "start_month string, apply_month string, months_ahead int")
    assert [len(x) for x in broken(report, quality.report_constraints())] == [0, 1, 2]
    assert broken(spark.createDataFrame([(404,), (99,), (None,)], "status_code int"), quality.snapshot_constraints()) == [[], ["status code is one"], []]
    with pytest.raises(ValueError):
        quality.gate(None, None, None, None, None, failure_rate=2)


def test_gate_messages(spark):
    """No records at all, and no previous run."""
    fields = ", ".join(f"{c} string" for c in ("id", "source_id", "status", "available_from", "booked_until", "method", "review_status", "confidence"))
    crawl_row = spark.createDataFrame([(0, 0)], "urls long, failures long")
    row = quality.gate(spark.createDataFrame([], fields), spark.createDataFrame([("s",)], "id string"), crawl_row, None, F.current_timestamp()).first()
    assert (row.placements, row.previous, row.drop_rate, row.crawl_failure_rate, row.passed) == (0, None, None, 0.0, False)
    assert row.errors == "No placement records were generated." and row.warnings == "1 registered sources produced no placement records."
    rows = spark.createDataFrame([("p", "s", "available", None, None, "site-parser", "auto-published", "high")] * 1, fields)
    good = quality.gate(rows, spark.createDataFrame([("s",)], "id string"), crawl_row, rows, F.current_timestamp()).first()
    assert good.passed and good.drop_rate == 0.0 and good.warnings == ""
    half = quality.gate(rows, spark.createDataFrame([("s",)], "id string"), spark.createDataFrame([(4, 1)], "urls long, failures long"), rows.union(rows), F.current_timestamp()).first()
    assert half.errors.split("\n") == ["Crawl failure rate 25.0% exceeds the configured 15.0% limit.", "Placement count dropped 50.0% from 2 to 1, above the configured 25.0% limit."]
