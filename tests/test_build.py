"""Snapshot files to records, and words from one reading."""

import json

from pyspark.sql import functions as F

from siftlode.functions import lexicon as lex
from siftlode.functions import placement as pl
from siftlode.functions.text import fold
from siftlode.operators import build, keywords
from siftlode.sources import json_files

UPPER = {"title": "Famulatur Chirurgie | Haus", "visibleText": "Famulatur in der Chirurgie ab Juni 2027."}
FILES = {
    "b.snapshot.json": {**UPPER, "sourceId": "s1", "url": "https://h.example/a", "visibleText": "Famulatur in der Chirurgie ausgebucht bis Ende 2027."},
    "a.snapshot.json": {**UPPER, "sourceId": "s1", "url": "https://h.example/a", "extractedEmails": ["logo@x.png", "mail@h.example"]},
    "c.snapshot.json": {**UPPER, "sourceId": "s2", "url": "https://h.example/b", "statusCode": 404},
    "d.snapshot.json": {**UPPER, "sourceId": "s3", "url": "https://h.example/c", "error": "timeout", "statusCode": None},
    "e.snapshot.json": {"sourceId": "s4", "url": "https://www.ksw.ch/x", "title": None, "visibleText": "Wahlstudienjahr an der Augenklinik ab Juni 2027. Klinik für Innere Medizin: Bewerbung offen."},
    "f.snapshot.json": {"sourceId": "spital-uster-chirurgie-unterassistenten-pdf", "url": "https://h.example/pdf", "title": None, "visibleText": "Unterassistenz ohne Fach."},
    "g.txt": {"sourceId": "s9"},
}


def test_snapshots_to_placements(spark, tmp_path):
    for name, content in FILES.items():
        (tmp_path / name).write_text(json.dumps({"fetchedAt": "2026-07-07T08:00:00Z", "statusCode": 200, "extractedLinks": [], "extractedEmails": [], "error": None, **content}, indent=1))
    read = json_files.snapshots(spark, str(tmp_path))
    urls = spark.createDataFrame([("s1", "https://h.example/other", "generic", "de", "de-CH"), ("s4", "https://www.ksw.ch/x", "generic", "mixed", "mixed"), ("s4", "https://www.ksw.ch/y", None, "fr", "fr-CH")], "source_id string, url string, expected_parser string, source_language string, region string")
    sources = spark.createDataFrame([("s1", "Spital Eins", "hospital", "BE", "Bern"), ("s4", "Haus Vier", "university", "GE", "Genf")], "id string, institution string, institution_type string, canton string, city string")
    out = build.placements(read, urls, sources)
    got = {(r.source_id, r.department_normalized): r for r in out.collect()}
    assert set(got) == {("s1", "surgery"), ("s4", "ophthalmology"), ("s4", "internal-medicine"), ("spital-uster-chirurgie-unterassistenten-pdf", None)}
    first = got["s1", "surgery"]
    # two files give one id: the first file by name is the one that counts; addresses of images are no addresses
    assert (first.file, first.available_from, first.email, first.institution, first.canton, first.city) == ("a.snapshot.json", "2027-06", "mail@h.example", "Spital Eins", "BE", "Bern")
    # the source's one address stands in for one that is not listed
    assert (first.record_source_language, first.record_region, first.review_status) == ("de", "de-CH", "needs-human-review")
    eyes = got["s4", "ophthalmology"]
    assert (eyes.parser, eyes.record_source_language, eyes.record_region, eyes.canton, eyes.city, eyes.institution) == ("ksw", "mixed", "mixed", "ZH", "Winterthur", "Haus Vier")
    official = got["spital-uster-chirurgie-unterassistenten-pdf", None]
    assert official.snippet == build.SNIPPETS[official.source_id] and (official.confidence, official.review_status, official.record_region) == ("low", "needs-human-review", "unknown")
    assert [r.source_id for r in out.orderBy(*build.order()).collect()] == ["s4", "s4", "s1", "spital-uster-chirurgie-unterassistenten-pdf"]
    failed = {r.sourceId: r.error for r in build.failed_pages(read).collect()}
    assert failed == {"s2": "HTTP 404", "s3": "timeout"}
    assert build.placements(read.limit(0), urls, sources).collect() == []


def test_words_of_one_reading_equal_those_of_many(spark):
    texts = [None, "", "Famulatur in der Chirurgie, Bewerbung.", "neurochirurgie", "Notfallmedizinisch", "étudiant en médecine, stage", "PJ_x", "xPJ", "urgences Urgences!", "Médecine d'urgence et Médecine d’urgence", "available from immediately", "fully booked ä.innere medizin"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, text string, roles string").drop("roles")
    got = keywords.matched(df, "text").withColumn("folded", fold(F.coalesce("text", F.lit(""))))
    words = lambda table: F.coalesce(*(F.when(F.col("language") == n, pl.counted(F.col("folded"), dict.fromkeys(table[n]))) for n in lex.LANGUAGES))
    rows = got.select("*", pl.folded_language(F.col("folded")).alias("l"), words(lex.ROLES).alias("r"), words(lex.APPLICATIONS).alias("a")).collect()
    assert len(rows) == len(texts) and all((x.language, x.roles, x.applications) == (x.l, x.r, x.a) for x in rows)
    named = {x.text: x.departments for x in rows}
    assert named["Famulatur in der Chirurgie, Bewerbung."] == ["surgery"] and named["neurochirurgie"] == [] and named["Notfallmedizinisch"] == []
    assert named["urgences Urgences!"] == ["emergency-medicine"] and named["fully booked ä.innere medizin"] == ["internal-medicine"]
