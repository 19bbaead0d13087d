"""Pages as people see them: title, visible text, links and tables of HTML without hidden parts and page furniture.

Which elements go depends on what they hold and stand in, so that a small tree is made of each page, in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that are never shown or are no content, and the marks of page furniture.
GONE = {"script", "style", "noscript", "template", "nav", "footer", "header", "aside"}
CONTENT = {"main", "article"}
CONSENT = ("cookie", "consent", "tracking")
FURNITURE = ("breadcrumb", "main-menu", "navigation", "navbar", "site-menu")
HIDING = ("display:none", "display: none", "visibility:hidden", "visibility: hidden")
#: Characters of furniture at most; longer parts are taken for content.
SMALL = 1_200
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Elements that an opening one of the same kind ends.
_SELF_ENDING = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
TYPE = "struct<title: string, text: string, links: array<struct<text: string, href: string>>, tables: array<struct<caption: string, headers: array<string>, rows: array<array<string>>>>>"


def squeezed(text: str) -> str:
    return re.sub(r"\s+", " ", text.replace("\xa0", " ")).strip()


class Node:
    __slots__ = ("attrs", "parts", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.parts = tag, attrs, []

    def all(self) -> Iterator[Node]:
        """The element and those in it, in order."""
        waiting = [self]
        while waiting:
            node = waiting.pop()
            yield node
            waiting.extend(p for p in reversed(node.parts) if isinstance(p, Node))

    def text(self) -> str:
        out, waiting = [], [self]
        while waiting:
            x = waiting.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                waiting.extend(reversed(x.parts))
        return squeezed("".join(out))

    def find(self, *tags: str) -> list[Node]:
        return [n for n in self.all() if n is not self and n.tag in tags]


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        ends = _SELF_ENDING.get(tag, ())
        while self.open[-1].tag in ends:
            self.open.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].parts.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].parts.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].parts.append(data)


def tree(html: str) -> Node:
    parser = _Tree()
    parser.feed(html)
    parser.close()
    return parser.root


def _hidden(node: Node) -> bool:
    a = node.attrs
    style = a.get("style", "").lower()
    return node.tag in GONE or "hidden" in a or a.get("aria-hidden") == "true" or a.get("role") in ("navigation", "banner") or any(h in style for h in HIDING)


def _furniture(node: Node) -> bool:
    if node.tag in CONTENT or node.tag in ("html", "body") or node.find(*CONTENT):
        return False
    mark = " ".join(v for k in ("id", "class", "role", "aria-label") if (v := node.attrs.get(k))).lower()
    return any(m in mark for m in CONSENT) or any(m in mark for m in FURNITURE) and len(node.text()) <= SMALL


def clean(root: Node) -> Node:
    """The tree without what is not shown, then without furniture; content and what holds it always stays."""
    for gone in (_hidden, _furniture):
        for node in root.all():
            node.parts = [p for p in node.parts if isinstance(p, str) or not gone(p)]
    return root


def links(root: Node, base: str) -> list[dict]:
    """Links with text, as whole http addresses without fragments, the first of equal ones."""
    out: dict[str, str] = {}
    for a in root.find("a"):
        href, text = a.attrs.get("href", "").strip(), a.text()
        if not href or not text:
            continue
        try:
            whole = urldefrag(urljoin(base, href)).url
            parts = urlsplit(whole)
        except ValueError:
            continue
        if parts.scheme in ("http", "https") and parts.netloc:
            out.setdefault(whole if parts.path else f"{whole}/", text)
    return [{"text": t, "href": h} for h, t in out.items()]


def tables(root: Node) -> list[dict]:
    """Captions, headers of the first row, and rows of cells, blanks left out; tables without any of these are none."""
    out = []
    for table in root.find("table"):
        some = lambda nodes: [t for n in nodes if (t := n.text())]
        rows = table.find("tr")
        caption = some(table.find("caption")[:1])
        headers = some(rows[0].find("th")) if rows else []
        cells = [c for r in rows if (c := some(r.find("td")))]
        if caption or headers or cells:
            out.append({"caption": caption[0] if caption else None, "headers": headers, "rows": cells})
    return out


def read(html: str | None, url: str | None, loose: re.Pattern | None = None) -> dict | None:
    if html is None:
        return None
    root = tree(loose.sub("&amp;", html) if loose else html)
    title = next((n.text() for n in root.all() if n.tag == "title"), "") or None
    root = clean(root)
    body = next((n for n in root.all() if n.tag == "body"), root)
    skipped = [n for n in body.parts if isinstance(n, Node) and n.tag in ("head", "title")]
    body.parts = [p for p in body.parts if p not in skipped]
    return {"title": title, "text": body.text(), "links": links(root, url or ""), "tables": tables(root)}


def page(html: Column, url: Column, entities: Sequence[str] | None = None) -> Column:
    """``(title, text, links, tables)`` of each page; null for a null page.

    Entities are read as browsers read them; where ``entities`` are given, by name and without signs, those alone, and any other stays as it is written.
    """
    loose = None if entities is None else re.compile(f"&(?!(?:{'|'.join(entities)});)")

    @F.pandas_udf(TYPE)
    def run(pages: pd.Series, urls: pd.Series) -> pd.DataFrame:
        rows = [read(h, u, loose) or {"title": None, "text": None, "links": None, "tables": None} for h, u in zip(pages, urls, strict=True)]
        return pd.DataFrame(rows, columns=["title", "text", "links", "tables"])

    return run(html, url)
