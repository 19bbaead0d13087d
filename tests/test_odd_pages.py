"""Pages that the smallest tables lack: equal addresses, other entities, no titles; the rows are those of the SQL."""

import shutil

import duckdb

from siftlode.plans import catalogue, domain, runs
from tests.test_catalogue import FOLDER, plain


def both(spark, tmp_path, module, name, pages, *tables):
    """Rows of a query and of its SQL over these pages."""
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    for t in tables:
        shutil.copy(f"{FOLDER}/{t}.parquet", tmp_path)
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    for t in tables:
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet')")
    theirs = con.execute(module.oracle_sql()[name])
    names = [c[0] for c in theirs.description]
    ours = module.queries()[name](spark, str(tmp_path)).select(*names)
    return [sorted((tuple(map(plain, r)) for r in rows), key=str) for rows in (ours.collect(), theirs.fetchall())]


def test_changes_of_pages_with_one_address(spark, tmp_path):
    # 10 is new beside 3, which has its source and address; 7 and 21 are two pages of one address, of which one changes
    pages = [(3, "u", "a"), (10, "u", "b"), (7, "v", "a"), (21, "v", "a"), (14, "v", "c"), (11, "w", "a"), (4, "w", "b"), (32, "w", "a")]
    got, want = both(spark, tmp_path, runs, "all_changes", pages, "orders")
    assert got == want and any(r[2] == "u" for r in want)


ENTITIES = [
    (1, "a", '<html><head><title>A &quot;b&quot; &amp;lt; c &eacute; d</title></head><body>x &quot; &amp; y &uuml; &copy z &amp</body></html>'), (2, "b", "<p>no title &AMP; &#65; &#39;</p>"), (3, "c", None),
    (4, "d", "<head><title> R&D &amp cut</title></head><body>&nbsp;AT&T &lt;b&gt; <a href=\"/s?a=1&copy=2\">one</a> <a href=\"/s?a=1&amp;copy=3\">two</a></body>"), (5, "e", ""),
]


def test_titles(spark, tmp_path):
    got, want = both(spark, tmp_path, catalogue, "html_title", ENTITIES)
    assert got == want


def test_contents(spark, tmp_path):
    got, want = both(spark, tmp_path, domain, "page_content", ENTITIES)
    assert got == want


def test_outcomes_read_pages_once(spark):
    # the records of a page are made once, for their numbers and their departments alike
    rows = runs.queries()["page_outcomes"](spark, FOLDER)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode") == 1
