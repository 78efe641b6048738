"""Captured pages: a small tolerant tree for what regular expressions can't tell, and cascades of selectors."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from forgelake.functions.text import first_match, strip

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Element:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Element | str] = []

    def walk(self) -> Iterator[Element]:
        for c in self.children:
            if isinstance(c, Element):
                yield c
                yield from c.walk()

    def strings(self, raw: bool = False) -> Iterator[str]:
        for c in self.children:
            if isinstance(c, str):
                if raw or self.tag not in ("script", "style", "template"):
                    yield c
            else:
                yield from c.strings(raw)

    def text(self, strip_each: bool = False, sep: str = "") -> str:
        parts = (s.strip() if strip_each else s for s in self.strings())
        return sep.join(p for p in parts if p)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(e)
        if tag not in _VOID:
            self.at = e

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        e = self.at
        while e is not None and e.tag != tag:
            e = e.parent
        if e is not None and e.parent is not None:
            self.at = e.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str) -> Element:
    """Unclosed tags reach to the end of their parents; comments are dropped; script and style stay raw text."""
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


_STEP = re.compile(r"^(?P<tag>[\w-]+|\*)?(?P<rest>(?:\.[\w-]+|#[\w-]+|\[[^\]]+\])*)$")
_COND = re.compile(r"\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>[*^$]?=)['\"]?(?P<val>[^'\"\]]*)['\"]?)?\]")


def _fits(e: Element, step: str) -> bool:
    m = _STEP.match(step)
    if not m:
        raise ValueError(f"unknown selector {step!r}")
    if m["tag"] not in (None, "*", e.tag):
        return False
    for c in _COND.finditer(m["rest"]):
        if c["cls"]:
            ok = c["cls"] in e.attrs.get("class", "").split()
        elif c["id"]:
            ok = e.attrs.get("id") == c["id"]
        else:
            v = e.attrs.get(c["attr"])
            want = c["val"]
            ok = v is not None and (c["op"] is None or {"=": v == want, "*=": want in v, "^=": v.startswith(want), "$=": v.endswith(want)}[c["op"]])
        if not ok:
            return False
    return True


def select(root: Element, selector: str) -> list[Element]:
    """Elements fitting tag, .class, #id, [attr], [attr=v], [attr*=v], ^=, $= and descent, in document order."""
    steps = re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", selector)
    out = []
    for e in root.walk():
        if not _fits(e, steps[-1]):
            continue
        rest, up = list(steps[:-1]), e.parent
        while rest and up is not None:
            if up.tag and _fits(up, rest[-1]):
                rest.pop()
            up = up.parent
        if not rest:
            out.append(e)
    return out


def first_of(root: Element, selectors: list[str], attr: str | None = None, default: str | None = "") -> str | None:
    """The first selector with a value wins: its stripped text, or an attribute."""
    for s in selectors:
        for e in select(root, s):
            v = (e.attrs.get(attr) or "").strip() if attr else e.text().strip()
            if v:
                return v
    return default


def html_text(html: Column, strip_each: bool = True) -> Column:
    """The text nodes of a page, joined without separator; script and style left out; null stays null."""
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else tree(p).text(strip_each) for p in pages], dtype=object)

    return run(html)


# Where a page of a request, an issue or a listing keeps its fields, by priority.
PR_TITLE = ["h1.gh-header-title", "span.js-issue-title"]
ISSUE_TITLE = ['h1[class*="PageHeader_Title"]', 'h1[class*="prc-PageHeader-Title"]', 'h1[class*="HeaderViewer"]', "h1.gh-header-title .js-issue-title", "h1 .js-issue-title", ".gh-header-title", "h1.gh-header-title", ".js-issue-title"]
STATES = [".State--merged", ".State--closed", ".State--open", "[data-hovercard-type=pull_request] .State", ".gh-header-meta .State"]
ISSUE_STATES = [".State--open", ".State--closed", ".State--merged", "[data-hovercard-type='issue'] .State", ".gh-header-meta .State"]
AUTHORS = [".timeline-comment-header .author", ".timeline-comment .author", "[data-hovercard-type=user]", ".author"]
TIMES = [".timeline-comment-header relative-time", "relative-time[datetime]", "time[datetime]"]
BODIES = [".comment-body", ".timeline-comment-body", ".edit-comment-hide"]
LABELS = ["a.IssueLabel"]
ISSUE_LABELS = [".js-issue-labels .IssueLabel", ".sidebar-labels .IssueLabel", ".labels .label"]
COMMENT_BLOCKS = [".timeline-comment", ".js-timeline-item"]
ISSUE_COMMENT_BLOCKS = [".timeline-comment", ".js-timeline-item", "[data-testid*='comment']", "[class*='timeline']", "[class*='comment']"]
ISSUE_BODIES = ['[data-testid="issue-body"]', ".markdown-body", '[class*="IssueBody"]', '[class*="issue-body"]', ".comment-body"]
LISTING = ["div[data-testid='issue-row'] a[href*='/pull/']", ".js-issue-row a[href*='/pull/']", ".js-navigation-item a[href*='/pull/']", "a[data-hovercard-type='pull_request']", "a.Link--primary[href*='/pull/']", "a.v-align-middle[href*='/pull/']", ".Box-row a[href*='/pull/']", ".issue-title-link[href*='/pull/']", "h3 a[href*='/pull/']", "h4 a[href*='/pull/']", "a[href*='/pull/']"]


def _state(root: Element, issue: bool) -> str:
    word = first_of(root, ISSUE_STATES if issue else STATES).lower()
    order = ("open", "closed") if issue else ("merged", "closed", "open")
    return next((w for w in order if w in word), "open")


def _comments(root: Element, lowest: int, most: int, issue: bool = False) -> list[dict]:
    out, seen_blocks, seen_text = [], set(), set()
    for s in ISSUE_COMMENT_BLOCKS if issue else COMMENT_BLOCKS:
        for e in select(root, s):
            if id(e) in seen_blocks or any(id(x) in seen_blocks for x in e.walk()):
                continue
            seen_blocks.add(id(e))
            body = first_of(e, BODIES)
            if len(body) < lowest or body in seen_text:
                continue
            seen_text.add(body)
            when = first_of(e, ["relative-time[datetime]", "time[datetime]"], "datetime", None)
            out.append({"author": first_of(e, [".author"], default="unknown"), "timestamp": when, "content": body if len(body) <= most else body[:most] + "..."})
    return sorted(out, key=lambda c: c["timestamp"] or "")


_COMMENT = "array<struct<author:string,timestamp:string,content:string>>"
PAGE_FIELDS = f"title string, state string, author string, created_at string, tags array<string>, comments {_COMMENT}, body string, text string"


def page_fields(html: Column, issue: bool = False, comment_min: int = 5, comment_max: int = 2000) -> Column:
    """One struct with the fields of a page of a request (or of an issue), each by its cascade.

    created_at is null where the page has no time (nothing is filled in with
    the clock). Comments are kept once by text and sorted by their written
    times. Null pages give null fields.
    """
    kinds = ", ".join(f"{n.split()[0]}:{n.split(' ', 1)[1]}" for n in re.split(r", (?=\w+ \w)", PAGE_FIELDS))

    @F.pandas_udf(f"struct<{kinds.replace(', ', ',')}>")
    def run(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for p in pages:
            if p is None:
                rows.append(dict.fromkeys([f.split()[0] for f in re.split(r", (?=\w+ \w)", PAGE_FIELDS)]))
                continue
            root = tree(p)
            title = first_of(root, ISSUE_TITLE if issue else PR_TITLE)
            if issue and not title:
                title = next((t for e in select(root, "h1") if "sr-only" not in e.attrs.get("class", "").split() and len(t := e.text().strip()) > 5), "")
            if issue:
                title = title.partition("#")[0].strip()
            tags = [t for s in (ISSUE_LABELS if issue else LABELS) for e in select(root, s) if (t := e.text().strip())]
            rows.append({
                "title": title, "state": _state(root, issue), "author": first_of(root, AUTHORS, default="unknown"), "created_at": first_of(root, TIMES, "datetime", None),
                "tags": list(dict.fromkeys(tags)) if issue else tags, "comments": _comments(root, comment_min, comment_max, issue), "body": first_of(root, ISSUE_BODIES), "text": root.text(),
            })
        return pd.DataFrame(rows)

    return run(html)


@udtf(returnType="pos: int, rank: int, href: string")
class HtmlLinks:
    """html_links(html): the request links of a listing page, by selector priority and place, once per element and link."""

    def eval(self, html: str):
        if html is None:
            return
        root, seen, n = tree(html), set(), 0
        for rank, s in enumerate(LISTING):
            for e in select(root, s):
                href = e.attrs.get("href")
                if href and href not in seen:
                    seen.add(href)
                    yield n, rank, href
                    n += 1


def title_of(html: Column) -> Column:
    """First heading, else the title tag, else empty: a cascade in regular expressions."""
    inner = lambda tag: strip(F.regexp_replace(F.regexp_replace(first_match(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), r"<[^>]*>", ""), r"\s+", " "))
    none = lambda c: F.when(c != "", c)
    return F.coalesce(none(inner("h1")), none(inner("title")), F.lit(""))


def hrefs(html: Column) -> Column:
    """The targets of all anchors, in order, repeated ones too."""
    return F.regexp_extract_all(html, F.lit(r'(?i)<a\b[^>]*\bhref="([^"]*)"'), F.lit(1))


def tags_of(html: Column) -> Column:
    """The distinct tag names of a page, in order."""
    return F.array_distinct(F.regexp_extract_all(F.lower(html), F.lit(r"<([a-z][a-z0-9]*)"), F.lit(1)))


def anchor_texts(html: Column, href: str) -> Column:
    """The texts of the anchors whose link holds `href` (a regular expression), in order."""
    found = F.regexp_extract_all(html, F.lit(rf'(?is)<a\b[^>]*\bhref="[^"]*{href}[^"]*"[^>]*>(.*?)</a>'), F.lit(1))
    return F.transform(found, lambda x: strip(F.regexp_replace(F.regexp_replace(x, r"<[^>]*>", " "), r"\s+", " ")))


def link_count(html: Column, href: str) -> Column:
    """How many anchors lead to links that hold `href` (a regular expression)."""
    return F.size(anchor_texts(html, href))


def state_counts(html: Column, href: str = "/(?:issues|pulls)") -> Column:
    """struct<open,closed>: the counts a listing page shows, or null.

    By priority: anchors whose text or link says the state, then the number
    next to the word anywhere in the page's text, then the first number of any
    such anchor, as open.
    """
    from forgelake.functions.text import compact_count

    texts = anchor_texts(html, href)
    number = r"(\d[\d,.]*[km]?)"
    page = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " "), r"<[^>]*>", " ")

    def of(word: str) -> Column:
        said = F.get(F.filter(texts, lambda t: t.rlike(rf"(?i)\b{word}\b") & t.rlike(r"\d")), F.lit(0))
        linked = F.get(F.filter(anchor_texts(html, rf"{href}[^\"]*is%3A{word}"), lambda t: t.rlike(r"\d")), F.lit(0))
        near = F.coalesce(first_match(page, rf"(?i)\b{word}\s*\({number}\)"), first_match(page, rf"(?i){number}\s*{word}\b"), first_match(page, rf"(?i)\b{word}\s*{number}"))
        return compact_count(F.coalesce(said, linked, near))

    first = compact_count(F.get(F.filter(texts, lambda t: t.rlike(r"\d")), F.lit(0)))
    return F.struct(F.coalesce(of("open"), first).alias("open"), of("closed").alias("closed"))


def commit_details(html: Column) -> Column:
    """struct<sha,message,author,date> of a commit's page; null where a field is missing."""
    sha = F.coalesce(first_match(html, r"/commit/([a-f0-9]{40})"), first_match(html, r"\b([a-f0-9]{40})\b"))
    message = strip(F.regexp_replace(first_match(html, r'(?is)class="[^"]*commit-title[^"]*"[^>]*>(.*?)</'), r"<[^>]*>", ""))
    author = strip(F.regexp_replace(first_match(html, r'(?is)class="[^"]*(?:commit-author|author)[^"]*"[^>]*>(.*?)</'), r"<[^>]*>", ""))
    return F.struct(sha.alias("sha"), F.when(message != "", message).alias("message"), F.when(author != "", author).alias("author"), first_match(html, r'(?i)<(?:relative-time|time)\b[^>]*\bdatetime="([^"]+)"').alias("date"))
