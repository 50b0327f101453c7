"""Main text of web pages by consensus of their hosts.

A page is read once into blocks of text and containers (`parsed`). Menus, headers, footers, sidebars, notices, adverts,
forms, comments and hidden elements go by element, role, or the words of their classes and ids. A container scores the characters of its blocks
less three times those inside links; a page's choice is its article elements if they hold a good part of the score, else
the container that is reached from the top by going down while one kind of child holds nearly all and nothing but it has
paragraphs. Kinds are generalised paths: block elements with their classes, digits as "#", no ids and no positions.

In Spark, the pages of a host vote on paths: votes are summed where they lie, then by host and path, and the leading
`most` paths of a host that `share` of its voting pages chose win. Then every page is read again and its text taken from all
containers of the first winning path that scores at least `least` of its own choice, else from its own choice, so a
page of another layout than its host's keeps its text.

Winning paths travel as 64-bit hashes, at most `most` for each host; up to `HOSTS` hosts are broadcast, beyond that
`store.looked_up` broadcasts the hot ones and joins the others by hash. No host's pages meet in a task.

White space is that of Unicode; `br` is white space inside a block; cells, list items and headings are blocks. An unclosed comment, script, style
or tag takes the rest of the page, as in browsers. Nulls: a null html is empty, a page without text gives "", a null
or odd url belongs to host "". Repeated rows are alike; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import arrow_limits, documents, looked_up, written
from .words import column, release

HOSTS = 1 << 16

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dd dt figcaption td th caption summary address".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_CONTAINER = frozenset("body article main section div td center dd details fieldset form".split())
_BLOCK = _PARAGRAPH | _CONTAINER | frozenset("aside dialog dl figure footer header hgroup hr html legend menu nav ol option search table tbody tfoot thead tr ul".split())
_KEEPS_P = frozenset("td th tr tbody thead tfoot caption option dd dt li html body legend".split())  # don't end a paragraph by themselves
_ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "option": ("option",)}
_TABLE = frozenset("table thead tbody tfoot tr td th caption".split())

_GONE = frozenset("nav aside footer noscript template object svg canvas audio video button select datalist dialog menu search".split())
_ROLES = frozenset("navigation contentinfo complementary search dialog alertdialog alert menu menubar toolbar tooltip form".split())
_COMMENTS = frozenset("comment comments commentlist reply replies respond disqus".split())
_ANYWHERE = frozenset("advert adverts advertisement advertisements advertising adsense sponsored cookie cookies consent gdpr sidebar navbar breadcrumb breadcrumbs newsletter".split())
_WORDS = frozenset(
    """
    ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox adunit adspace leaderboard sponsor sponsored sponsors promo promos promotion promoted banner
    nav navbar navigation menu menus submenu breadcrumb breadcrumbs topbar toolbar pager pagination skip toc
    footer colophon copyright sidebar sidebars aside rail widget widgets related recommended recommendations trending popular
    cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay disclaimer paywall
    form forms newsletter subscribe subscription signup signin login register search searchbox
    share sharing social follow hidden
    """.split()
)
_MODIFIES = frozenset("has with no without not is".split())
_HEADS = frozenset("header masthead".split())

_TAG = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_SIMPLE = re.compile(r"\s*/?>")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)?(\s*=\s*)?")
_UNQUOTED = re.compile(r"[^\s>]*")
_CASES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NONE: dict[str, str] = {}


@dataclass(frozen=True)
class Consensus:
    share: float = 0.1
    most: int = 10
    least: float = 0.4


def attributes(html: str, at: int, last: dict[str, int]) -> tuple[dict[str, str], int]:
    """The attributes from `at` on and where their tag ends; `last` tells each quote's last place, so no search is in vain twice."""
    out: dict[str, str] = {}
    n = len(html)
    while at < n:
        m = _ATTRIBUTE.match(html, at)
        at = m.end()
        if at < n and m[2]:
            mark = html[at]
            end = html.find(mark, at + 1) if mark in last and at < last[mark] else -1
            if end >= 0:
                value, at = html[at + 1 : end], end + 1
            else:
                u = _UNQUOTED.match(html, at)
                value, at = u[0], u.end()
        else:
            value = ""
        if m[1]:
            out.setdefault(m[1].lower(), value)
        if at < n and html[at] == ">":
            return out, at + 1
    return out, n


def tags(html: str) -> Iterator[tuple[str, str, object]]:
    """Text, tags and the ends of tags in order: ("text", text, None), ("open", name, attributes), ("close", name, None)."""
    at, n = 0, len(html)
    last = {mark: html.rfind(mark) for mark in "\"'"}
    while at < n:
        found = _TAG.search(html, at)
        lt = found.start() if found else n
        if lt > at:
            yield "text", html[at:lt], None
        if not found:
            return
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 2)
            at = n if end < 0 else end + 3
            continue
        closing = html[lt + 1] == "/"
        name = _NAME.match(html, lt + 1 + closing)
        if not name:  # a declaration, an instruction or no tag
            end = html.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        tag, at = name[0].lower(), name.end()
        simple = _SIMPLE.match(html, at)
        attrs, at = (_NONE, simple.end()) if simple else attributes(html, at, last)
        if closing:
            yield "close", tag, None
        else:
            yield "open", tag, attrs
            if tag in _RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
                gt = html.find(">", end.end()) if end else -1
                at = n if gt < 0 else gt + 1
                yield "close", tag, None


def named(attrs: dict[str, str]) -> str:
    """What classes and id say of an element: "comments", "header", "gone" or ""."""
    out = ""
    for name in (attrs.get("class", "") + " " + attrs.get("id", "")).split():
        words = [w.lower() for w in _CASES.findall(name)]
        if not words or words[0] in _MODIFIES:
            continue
        ends = {words[0], words[-1], "".join(words)}
        if not _COMMENTS.isdisjoint(words):
            return "comments"
        if ends & _WORDS or not _ANYWHERE.isdisjoint(words):
            out = "gone"
        elif ends & _HEADS:
            out = out or "header"
    return out


def hidden(attrs: dict[str, str]) -> bool:
    style = attrs.get("style", "").replace(" ", "").lower()
    return "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style


KEPT, DROPPED, TITLES = range(3)  # TITLES: of a header inside an article only headings stay
TITLE, MAIN, NEVER = 1, 2, 3  # an h1; an article or main element


@dataclass
class Page:
    """Elements (parents before children) and pieces of text, each with its element and its block."""

    tag: list[str] = field(default_factory=lambda: ["body"])
    parent: list[int] = field(default_factory=lambda: [-1])
    path: list[int] = field(default_factory=lambda: [0])
    part: list[str] = field(default_factory=lambda: [""])
    rule: list[int] = field(default_factory=lambda: [KEPT])
    unless: list[int] = field(default_factory=lambda: [NEVER])  # what inside the element takes its rule away
    holds: list[int] = field(default_factory=lambda: [MAIN])
    pieces: list[tuple[int, str, bool]] = field(default_factory=list)  # element, text, inside a link
    blocks: list[tuple[int, int, int]] = field(default_factory=list)  # owner, first piece, end of its pieces

    def add(self, tag: str, parent: int, block: bool, attrs: dict[str, str], in_article: bool) -> int:
        rule, unless = KEPT, NEVER
        role = attrs.get("role", "").lower()
        name = named(attrs) if attrs else ""
        if tag in _GONE or role in _ROLES or name == "comments" or hidden(attrs):
            rule = DROPPED
        elif tag == "header" or role == "banner" or (name == "header" and block):
            rule, unless = (TITLES, NEVER) if in_article else (DROPPED, MAIN)
        elif tag == "form" or (name == "gone" and tag not in ("article", "main", "body", "html")):
            rule, unless = DROPPED, TITLE
        kind = ""
        if block and tag not in ("html", "body"):
            classes = sorted({re.sub(r"\d+", "#", c) for c in attrs.get("class", "").split() if ">" not in c})
            kind = ".".join([tag, *classes])
        self.tag.append(tag)
        self.parent.append(parent)
        self.part.append(kind)
        self.path.append(xxhash.xxh64_intdigest(kind, self.path[parent]) if kind else self.path[parent])
        self.rule.append(rule)
        self.unless.append(unless)
        self.holds.append(0)
        return len(self.tag) - 1

    def mark(self, at: int, what: int) -> None:
        """at's ancestors hold a title or main element; each is marked once for either."""
        at = self.parent[at]
        while at >= 0 and self.holds[at] < what:
            self.holds[at] = what
            at = self.parent[at]

    def path_of(self, at: int) -> str:
        parts = []
        while at >= 0:
            if self.part[at]:
                parts.append(self.part[at])
            at = self.parent[at]
        return ">".join(reversed(parts)) or "body"


def parsed(html: str) -> Page:
    """The page's elements and blocks. Missing end tags of paragraphs, items and cells are supplied, stray ones ignored."""
    page = Page()
    stack: list[tuple[str, int, bool]] = [("body", 0, True)]  # tag, element, block
    open_at: dict[str, list[int]] = {}
    blocks = [0]  # places of block elements on the stack
    counts = {"a": 0, "article": 0, "main": 0}
    begun = 0

    def flush(owner: int) -> None:
        nonlocal begun
        if len(page.pieces) > begun:
            page.blocks.append((owner, begun, len(page.pieces)))
            begun = len(page.pieces)

    def pop_to(place: int) -> None:
        """Close everything from that place of the stack on."""
        while len(stack) > place:
            tag, at, block = stack.pop()
            if block:
                flush(at)
                blocks.pop()
            open_at[tag].pop()
            if tag in counts:
                counts[tag] -= 1

    for what, tag, attrs in tags(html):
        if what == "text":
            page.pieces.append((stack[-1][1], unescape(tag) if "&" in tag else tag, counts["a"] > 0))
        elif what == "open":
            block = tag in _BLOCK
            if tag == "br":
                page.pieces.append((stack[-1][1], " ", False))
            if block:
                ended = _ENDS.get(tag, ())
                if stack[blocks[-1]][0] == "p" and (tag not in _KEEPS_P or stack[blocks[-2]][0] in ended):
                    pop_to(blocks[-1])
                while stack[blocks[-1]][0] in ended:
                    pop_to(blocks[-1])
                flush(stack[blocks[-1]][1])
            if tag in _VOID:
                continue
            at = stack[-1][1]
            if block or attrs or tag in _GONE:
                at = page.add(tag, at, block, attrs, counts["article"] + counts["main"] > 0)
                if tag in ("article", "main", "h1") and page.rule[at] != DROPPED:
                    page.mark(at, TITLE if tag == "h1" else MAIN)
            open_at.setdefault(tag, []).append(len(stack))
            if block:
                blocks.append(len(stack))
            if tag in counts:
                counts[tag] += 1
            stack.append((tag, at, block))
        elif places := open_at.get(tag):
            place = places[-1]
            cell = max((open_at[t][-1] for t in ("td", "th", "caption") if open_at.get(t)), default=0)
            if tag in _TABLE or place > cell:
                if tag in _BLOCK or place > blocks[-1]:
                    pop_to(place)
                elif tag == "a":  # a link that was closed inside a block that it doesn't hold
                    places.pop()
                    counts["a"] -= 1
                    stack[place] = ("", *stack[place][1:])
                    open_at.setdefault("", []).append(place)
        elif tag in _BLOCK:
            flush(stack[blocks[-1]][1])
    pop_to(1)
    flush(0)
    return page


@dataclass
class Scores:
    kept: list[bool]  # by piece
    total: list[int]  # by element, of all blocks in it
    own: list[bool]  # by element: paragraphs lie right in it, not in containers inside it
    holder: list[int]  # by element: the container that it is or lies in


def scored(page: Page) -> Scores:
    n = len(page.tag)
    rule = [KEPT] * n
    holder = [0] * n  # the nearest container
    for i in range(1, n):
        above, own = rule[page.parent[i]], page.rule[i]
        if page.holds[i] >= page.unless[i]:
            own = KEPT
        if above == DROPPED or own == DROPPED:
            rule[i] = DROPPED
        elif above == TITLES:
            rule[i] = KEPT if page.tag[i] in _HEADING else TITLES
        else:
            rule[i] = own
        holder[i] = i if page.tag[i] in _CONTAINER else holder[page.parent[i]]
    kept = [rule[e] == KEPT for e, _, _ in page.pieces]
    total, direct = [0] * n, [False] * n
    for owner, a, b in page.blocks:
        size = linked = 0
        for k in range(a, b):
            if kept[k]:
                _, text, link = page.pieces[k]
                long = len(text) if not text.isspace() else 0
                size += long
                linked += long * link
        if size:
            paragraph = page.tag[owner] in _PARAGRAPH
            if paragraph or size >= 80 or linked:
                total[owner] += max(size - 3 * linked, -size)
                direct[holder[owner]] |= size > 3 * linked
    for i in range(n - 1, 0, -1):
        total[page.parent[i]] += total[i]
    return Scores(kept, total, direct, holder)


def choice(page: Page, s: Scores) -> list[int]:
    """The page's own containers of main text, all of one path."""

    def best(among: list[int]) -> tuple[int, list[int]]:
        kinds: dict[int, list[int]] = {}
        for i in among:
            if s.total[i] > 0:
                kinds.setdefault(page.path[i], []).append(i)
        sums = [(sum(s.total[i] for i in g), g) for g in kinds.values()]
        return max(sums, key=lambda x: (x[0], -x[1][0]), default=(0, []))

    for tag, part in (("article", 0.4), ("main", 0.4)):
        score, group = best([i for i, t in enumerate(page.tag) if t == tag])
        if group and score >= part * s.total[0]:
            if tag == "article" or len(group) > 1:
                return group
            at = group[0]
            break
    else:
        at = 0
    inside: dict[int, list[int]] = {}
    for i in range(1, len(page.tag)):
        if page.tag[i] in _CONTAINER and s.total[i] > 0:
            inside.setdefault(s.holder[page.parent[i]], []).append(i)
    while not s.own[at]:
        score, group = best(inside.get(at, []))
        if not group or score < 0.8 * s.total[at]:
            break
        if len(group) > 1:
            return group
        at = group[0]
    return [at]


def text_of(page: Page, s: Scores, containers: list[int]) -> str:
    """The kept blocks in the containers, one a line. Outside articles, lists and containers made of links go as menus."""
    chosen, inside, menu = set(containers), [False] * len(page.tag), [False] * len(page.tag)
    for i, tag in enumerate(page.tag):
        up = page.parent[i]
        inside[i] = i in chosen or (up >= 0 and inside[up])
        in_menu = up >= 0 and i not in chosen and (menu[up] or (s.total[i] < 0 and tag in ("ul", "ol", "dl", "div", "section", "table")))
        menu[i] = in_menu and page.tag[containers[0]] != "article"
    lines = []
    for owner, a, b in page.blocks:
        if inside[owner] and not menu[owner]:
            line = " ".join("".join(page.pieces[k][1] for k in range(a, b) if s.kept[k]).split())
            if line:
                lines.append(line)
    return "\n".join(lines)


def vote(html: str) -> tuple[int, str, int]:
    """(hash, path, score) of the page's own choice; score 0 is no vote."""
    page = parsed(html)
    s = scored(page)
    at = choice(page, s)
    return page.path[at[0]], page.path_of(at[0]), max(sum(s.total[i] for i in at), 0)


def extracted(html: str, winning: list[int], c: Consensus = Consensus()) -> str:
    page = parsed(html)
    s = scored(page)
    own = choice(page, s)
    least = max(c.least * sum(s.total[i] for i in own), 1)
    for path in winning:
        found = [i for i, t in enumerate(page.tag) if page.path[i] == path and (t in _CONTAINER and page.part[i] or i == 0)]
        if found and sum(s.total[i] for i in found) >= least:
            return text_of(page, s, found)
    return text_of(page, s, own)


def host(url: Column) -> Column:
    """The host of a url in lower case, without user and port."""
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def _strings(batch: pa.RecordBatch, name: str) -> Iterator[str]:
    for x in column(batch, name):
        yield x.as_py() or ""


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def votes(pages: DataFrame) -> DataFrame:
    """host, path, hash, pages and score: how many pages of a host chose a path. hash 0 and path "" where a page has no choice."""
    arrow_limits(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(_signed(h), p, n) if n else (0, "", 0) for h, p, n in map(vote, _strings(b, "html"))]
            yield pa.RecordBatch.from_arrays([column(b, "host").cast(pa.string()), *(pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int64())))], ["host", "hash", "path", "score"])
            release()

    chosen = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, hash long, path string, score long")
    return chosen.groupBy("host", "hash").agg(F.min("path").alias("path"), F.count("*").alias("pages"), F.sum("score").alias("score"))


def winning_paths(voted: DataFrame, c: Consensus = Consensus()) -> DataFrame:
    """host, pages, winning (hashes, the first first) and paths of each host. voted is written, see votes."""
    all_pages = voted.groupBy("host").agg(F.sum("pages").alias("pages"), F.sum(F.when(F.col("score") > 0, F.col("pages")).otherwise(0)).alias("voting"))
    order = Window.partitionBy("host").orderBy(F.col("pages").desc(), F.col("score").desc(), "path", "hash")
    first = voted.filter("score > 0").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= c.most)
    first = first.join(all_pages.select("host", "voting"), "host").filter(F.col("pages") >= c.share * F.col("voting"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "hash", "path")))
    best = first.groupBy("host").agg(ordered.alias("w"))  # c.most of a host at most
    return all_pages.join(best, "host", "left").select("host", "pages", F.coalesce(F.transform("w", lambda x: x["hash"]), F.array().cast("array<long>")).alias("winning"), F.transform("w", lambda x: x["path"]).alias("paths"))


def main_texts(pages: DataFrame, winning: DataFrame, c: Consensus = Consensus()) -> DataFrame:
    """page_id, url, text and n_chars of each row. winning is written, see winning_paths."""
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    table = winning.select("host", "pages", "winning")
    rows = rows.join(F.broadcast(table), "host") if winning.count() <= HOSTS else looked_up(rows, table, ["host"], "pages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extracted(h, [x & (1 << 64) - 1 for x in w], c) for h, w in zip(_strings(b, "html"), column(b, "winning").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([column(b, "page_id").cast(pa.int64()), column(b, "url").cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])
            release()

    return rows.select("page_id", "url", "html", "winning").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op13_consensus_main_text(spark, sf_dir: str) -> DataFrame:
    pages = documents(spark, sf_dir, "pages")
    return main_texts(pages, written(winning_paths(written(votes(pages), "votes")), "winning"))
