"""Functions that Spark has no expression for: Arrow-batched, never row by row across the boundary."""

from __future__ import annotations

import hashlib
import html
import html.entities
import re
import unicodedata
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def html_unescape(c: Column, closed: bool = False) -> Column:
    """Character references decoded; with closed only those that end in a semicolon, so a cut &amp stays."""
    reference = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")

    def one(x: str) -> str:
        return reference.sub(lambda m: html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html.entities.html5 else m[0], x)

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(one if closed else html.unescape, na_action="ignore")

    return run(c)


def normalized(c: Column) -> Column:
    """NFKC, soft hyphens dropped, white space to single blanks, casefolded; null is ''."""

    def one(x: str | None) -> str:
        return " ".join(unicodedata.normalize("NFKC", x or "").replace("\u00ad", "").split()).casefold()

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(one)

    return run(c)


#: Opens a document's bytes: gives for each page (html, width, height, gray samples), or raises.
Backend = Callable[[bytes], Iterator[tuple[str, int, int, bytes]]]


def document_pages(backend: Backend):
    """Content to struct<pages, opened_pages, html, render_sha256, error>.

    A document that can't be read gives its error and no page after the failing one.
    """

    @F.pandas_udf("struct<opened_pages:int, html:array<string>, render_sha256:string, error:string>")
    def run(content: pd.Series) -> pd.DataFrame:
        rows = []
        for data in content:
            pages, render, error = [], hashlib.sha256(), ""
            try:
                for text, width, height, samples in backend(data):
                    render.update(b"%dx%d:" % (width, height) + samples)
                    pages.append(text)
            except Exception as e:  # a bad copy must not stop the others
                error = f"{type(e).__name__}: {e}"
            rows.append((len(pages), pages, "" if error else render.hexdigest(), error))
        return pd.DataFrame(rows, columns=["opened_pages", "html", "render_sha256", "error"])

    return run


class _Cards(HTMLParser):
    """The divisions of one class, with their text and links, and the values of inputs."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self, css_class: str):
        super().__init__(convert_charrefs=True)
        self.css_class, self.depth, self.cards, self.inputs = css_class, 0, [], {}
        self.link: list | None = None
        self.text: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag == "input" and a.get("name") is not None:
            self.inputs.setdefault(a["name"], a.get("value"))
        if self.depth and tag not in self.VOID:
            self.depth += 1
        elif tag == "div" and self.css_class in (a.get("class") or "").split():
            self.depth = 1
            self.cards.append(([], []))
        if self.depth and tag == "a" and a.get("href") is not None:
            self.link = [a["href"], []]
            self.cards[-1][1].append(self.link)

    def handle_endtag(self, tag: str) -> None:
        if self.depth and tag not in self.VOID:
            self.depth -= 1
        if tag == "a" or not self.depth:
            self.link = None

    def handle_data(self, data: str) -> None:
        data = data.strip()
        if not data:
            return
        self.text.append(data)
        if self.depth:
            self.cards[-1][0].append(data)
            if self.link:
                self.link[1].append(data)


LISTING = "struct<text:string, inputs:map<string,string>, cards:array<struct<registration:string, detail_url:string, pdf_url:string, title:string, doc_id:string>>>"


def parse_listing(base_url: str, pdf_base_url: str, host_pattern: str, css_class: str):
    """A listing page to its text, inputs and cards.

    A card's link is the first whose address matches host_pattern; its document id is the last part of that link's
    path, its registration number the first one in its text (else the link's text, else "unknown").
    """
    host, number = re.compile(host_pattern), re.compile(r"\b\d{4}U\d{6}\b", re.IGNORECASE)

    def card(texts: list[str], links: list) -> tuple | None:
        found = next((x for x in links if host.search(x[0])), None)
        if found is None:
            return None
        url = urljoin(base_url, found[0])
        doc_id = urlparse(url).path.rstrip("/").rpartition("/")[2]
        text = " ".join(texts)
        reg = number.search(text)
        return (reg.group(0) if reg else "".join(found[1])) or "unknown", url, urljoin(pdf_base_url, doc_id), text[:200], doc_id

    @F.pandas_udf(LISTING)
    def run(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            p = _Cards(css_class)
            p.feed(page or "")
            p.close()
            names = ("registration", "detail_url", "pdf_url", "title", "doc_id")
            cards = [dict(zip(names, c, strict=True)) for c in (card(*x) for x in p.cards) if c and c[4]]
            rows.append((" ".join(p.text), p.inputs, cards))
        return pd.DataFrame(rows, columns=["text", "inputs", "cards"])

    return run
