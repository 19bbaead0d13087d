from pyspark.sql import functions as F

from siftlode.functions import html

LONG = "wort " * 300
PAGE = f"""<html><head><title> A &amp; B&nbsp; <!-- x --></title><style>p {{}}</style></head><body>
<header>Kopf</header><nav><a href="/nav">Nav</a></nav><div class="Breadcrumb">Start</div><div id="cookie-banner">Kekse {LONG}</div>
<div class="navigation">{LONG}<a href="/lang">lang</a></div><div class="main-menu"><main><p>Text &uuml;ber <b>alles</b></p>
<a href="sub/page#teil">Seite</a> <a href='/nav?x=1'> Zwei </a><a href="sub/page">noch einmal</a><a href="mailto:x@y.z">Mail</a><a href="/leer"> </a><a href="https://other.example">Dort</a></main></div>
<p hidden>weg</p><p aria-hidden="true">weg</p><p style="Display: none">weg</p><p style="color:red; visibility:hidden">weg</p><div role="banner">weg</div><ul><li>eins<li>zwei</ul>
<table><caption>Plätze</caption><tr><th>Fach</th><th> </th></tr><tr><td>Chirurgie<td>3</tr><tr><td></td></tr></table><table></table><script>var weg</script></body></html>"""


def test_page(spark):
    df = spark.createDataFrame([(1, PAGE, "https://h.example/dir/a"), (2, "", "https://h.example"), (3, None, None), (4, "nur <b>Text", "x")], "id int, html string, url string")
    got = {r.id: r.p for r in df.select("id", html.page(F.col("html"), F.col("url")).alias("p")).collect()}
    p = got[1]
    assert p.title == "A & B"
    assert "weg" not in p.text and "Kopf" not in p.text and "Start" not in p.text and "Kekse" not in p.text and "Text über alles" in p.text and p.text.count("wort") == 300
    assert [(x.text, x.href) for x in p.links] == [("lang", "https://h.example/lang"), ("Seite", "https://h.example/dir/sub/page"), ("Zwei", "https://h.example/nav?x=1"), ("Dort", "https://other.example/")]
    assert [(t.caption, t.headers, t.rows) for t in p.tables] == [("Plätze", ["Fach"], [["Chirurgie", "3"]])]
    assert (got[2].title, got[2].text, got[2].links, got[2].tables) == (None, "", [], []) and got[3].text is None and got[4].text == "nur Text"
