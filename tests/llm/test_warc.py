import base64
import gzip
import hashlib
from pathlib import Path

from siftlode.llm import warc
from siftlode.llm.workspace import Workspace


def sha(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def expected(rows):
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == raw and p is not None]
        revisit = bool(same) and page_id != min(same)
        out.append((page_id, len(raw), sha(raw), "revisit" if revisit else "response", min(same) if revisit else None))
    return sorted(out, key=str)


ROWS = [(5, "http://a/é x\r\ny", "<p>one</p>"), (3, "http://b", "<p>one</p>"), (3, "http://b", "<p>one</p>"), (9, None, None), (10, "", ""), (7, "http://c", "é" * 500_000), (None, "http://n", "<p>one</p>"), (None, "http://n", "alone")]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, 1) for r in ROWS], "page_id long, url string, html string, length int").repartition(3)
    assert sorted((tuple(r) for r in warc.archived(pages).collect()), key=str) == expected(ROWS)
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archives_and_selection(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i % 40} " * 50) for i in range(200)], "page_id long, url string, html string").repartition(4)
    ws = Workspace(spark, "test")
    index = warc.write_archives(pages, ws)
    got = {r.page_id: r for r in warc.read_archives(index.filter("page_id % 7 = 0"), f"{ws.root}/archives", with_payload=True).collect()}
    assert sorted(got) == list(range(0, 200, 7))
    assert all(r.payload is None if i >= 40 else r.payload.decode() == f"page {i} " * 50 for i, r in got.items())
    files = list(Path(f"{ws.root}/archives".removeprefix("file:")).glob("*.warc.gz"))
    assert sum(gzip.decompress(f.read_bytes()).count(b"WARC/1.1\r\n") for f in files) == 200
