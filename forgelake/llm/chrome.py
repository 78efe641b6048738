"""Page text mixed with main content, told apart by tag-path ratios.

Every text is cut into nodes with a root-to-leaf path. Text that still has tags
is parsed and its paths are those of the tags. Text whose tags were lost when
it was captured has paths restored from its layout: where a node stands (at the
head, at the tail, between) and how (in a run of short nodes, beside one, as a
paragraph, in a list, in code). Over all texts, the length and the punctuation
of each path's nodes are added up; each path gets the ratio of text per node, of
punctuation per node and their spreads, smoothed with its parent path, fused into
one score, and the paths below the threshold that parts the scores best are page
text.

Where a capture lost the layout, too, the nodes are found by what they say: texts
that stand on page paths again and again, and hardly anywhere else, are items of
pages. No phrase is given: menus, notices and footers are learned from all texts
of the table (`learned`). A text holds page text if items enough stand in a row at
one of its edges, or as a block of their own.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.errors import LayoutError
from forgelake.session import written

#: Texts that an item must stand in on page paths, the share of all its nodes that these must be, words of a title's item.
ITEM_TEXTS, ITEM_SHARE, TITLE_WORDS = 3, 0.5, 5

#: Chance that two nodes of an item stand beside the same item; nodes of a title's item from which it needs no other beside it.
COMPANY, SURE = 0.02, 10

#: Items that a table may have; they describe layouts, not data. Counters of a task are passed on when they hold so many keys.
MAX_ITEMS, FLUSH = 200_000, 200_000

#: Longest node that may be an item, and longest short one, in characters and words.
LONGEST, SHORT, SHORT_WORDS = 120, 48, 8

_STRONG = r"[ \t]*[·|›—•‹»][ \t]*|[ \t]{2,}"
_NODE_CUT = re.compile(rf"(?:{_STRONG}|[ \t]*\r?\n[ \t]*)+")
#: The same cuts where there is no carriage return (a run of separators that isn't one blank), and what any of them holds; both are cheap to look for.
_PLAIN_CUT = re.compile(r"[ \t\n·|›—•‹»](?:(?<![ \t])|[ \t\n·|›—•‹»])[ \t\n·|›—•‹»]*")
_STRONG_MARK = re.compile(r"[·|›—•‹»]")
_TITLE_CUT = re.compile(rf"(?:{_STRONG}|[ \t]+[-/][ \t]+|[ \t]*\n[ \t]*)+")
_SEP = re.compile(r"(?:[ \t]*[·|›—•‹»][ \t]*|[ \t]+[-/][ \t]+|[ \t]+|[ \t]*\r?\n\s*)*")
_NUMBER = re.compile(r"\(?0\)?(?![a-z.])")
_BETWEEN = re.compile(r"[^\s.!?`]{1,40}(?:[ ][^\s.!?`]{1,20}){0,2}?(?=[ \t·|›—•‹»\r\n])")
_NODES_BETWEEN = re.compile(rf"[^\n.!?`]{{1,60}}?(?:(?:{_STRONG}|[ \t]*\n[ \t]*)[^\n.!?`]{{1,60}}?){{0,3}}?(?={_STRONG}|[ \t]*\n)")
_WORDS_BETWEEN = re.compile(r"[^\n.!?`]{1,110}?(?=[ ])")
_NUMBERS = re.compile(r"\d\d*(?:[.,:]\d+)*")  # a digit in front, which is quicker to look for than a run
_COUNT = re.compile(r"[ \t]*\(?0\)?$")
_LIST = re.compile(r"(?:[-*+]|\d+[.)])\s|>")


def item_text(node: str, title: bool = False) -> str:
    """A node as an item: digits are one 0; a count behind it is left out, but not in titles, where it is a number of something."""
    t = _NUMBERS.sub("0", node.strip(" \t\r\n·|›—•‹»"))
    return t if title or t[-1:] not in ("0", ")") else _COUNT.sub("", t) or t


def _one_node(text: str) -> bool:
    """Whether a text, no title, has nothing that `_NODE_CUT` cuts at."""
    return not ("\n" in text or "  " in text or "\t" in text or ("|" in text if text.isascii() else _STRONG_MARK.search(text)))


def _kind(t: str) -> str:
    if _LIST.match(t):
        return "li"
    return "short" if len(t) <= SHORT and len(t.split()) <= SHORT_WORDS and t[-1] not in ".!?:;,`" and "`" not in t else "p"


def layout(text: str, title: bool = False) -> list[tuple[int, int, str]]:
    """start, end and path of the nodes of a text without tags, by its lines, separators and neighbours alone."""
    if not title and _one_node(text):
        kind = "pre" if "```" in text else _kind(text) if text.strip() else None
        return [(0, len(text), "whole/lone" if kind == "short" else f"main/{kind}")] if kind else []
    cuts, at, spans = (_TITLE_CUT if title else _NODE_CUT if "\r" in text else _PLAIN_CUT), 0, []
    for m in cuts.finditer(text):
        spans.append((at, m.start()))
        at = m.end()
    spans = [(s, e) for s, e in [*spans, (at, len(text))] if text[s:e].strip()]
    if title:
        main = max(range(len(spans)), key=lambda i: spans[i][1] - spans[i][0], default=0)
        return [(s, e, "title/main" if i == main else "title/edge") for i, (s, e) in enumerate(spans)]
    kinds, fenced = [], False
    for s, e in spans:
        t = text[s:e]
        if "```" in t:
            fenced = not fenced if t.count("```") % 2 else fenced
            kinds.append("pre")
        elif fenced:
            kinds.append("pre")
        else:
            kinds.append(_kind(t))
    out, i, last = [], 0, len(spans) - 1
    while i <= last:
        j = i
        while j < last and kinds[j + 1] == kinds[i] == "short":
            j += 1
        if kinds[i] == "short":
            where = "whole" if i == 0 and j == last else "head" if i == 0 else "tail" if j == last else "within"
            how = "run" if j - i >= 2 else "pair" if j > i else "lone"
            out += [(*spans[k], f"{where}/{how}") for k in range(i, j + 1)]
        else:
            out.append((*spans[i], f"main/{kinds[i]}"))
        i = j + 1
    # A sentence between a run and an edge, or on the inner side of an edge's run, with other text left; of two beside one run, the shorter.
    paragraphs = [k for k in range(last + 1) if kinds[k] != "short"]
    if len(paragraphs) > 1:
        marked = []
        for k, inner, edge in ((paragraphs[0], 1, "head"), (paragraphs[-1], -1, "tail")):
            outer = 0 <= k - inner <= last and kinds[k - inner] == "short"
            inside = k in (0, last) and 0 <= k + inner <= last and kinds[k + inner] == "short"
            if kinds[k] == "p" and (outer or inside) and spans[k][1] - spans[k][0] <= LONGEST:
                marked.append((k, inner, edge, inside))
        if len(marked) == 2 and len(paragraphs) == 2 and marked[0][3] and marked[1][3]:
            marked = [min(marked, key=lambda m: spans[m[0]][1] - spans[m[0]][0])]
        for k, inner, edge, inside in marked:
            out[k] = (*spans[k], f"{edge}/beside")
            j = k + inner
            while inside and 0 <= j <= last and kinds[j] == "short":
                out[j] = (*spans[j], f"{edge}/{out[j][2].partition('/')[2]}")
                j += inner
    return out


class Grammar:
    """Finds the page text of texts by learned items (item -> weight): those at their edges, and blocks within."""

    def __init__(self, items: dict[str, int], title: bool = False):
        import ahocorasick

        self.title, self.items = title, items
        self.words = ahocorasick.Automaton()
        for item in items:
            self.words.add_word(item, item)
        if items:
            self.words.make_automaton()

    def __reduce__(self):
        return Grammar, (self.items, self.title)

    def _found(self, text: str) -> tuple[dict[int, int], dict[int, int]]:
        """start -> end of the longest item there that no word goes on before or behind; the same of those that only another item runs into."""
        every: dict[int, list[int]] = {}
        for last, item in self.words.iter(text):
            every.setdefault(last - len(item) + 1, []).append(last + 1)
        free: dict[int, int] = {}
        glued: dict[int, int] = {}
        for start, ends in every.items():
            before, first = text[start - 1:start], text[start]
            alone = not (before.isalnum() and first.isalnum() and not (first.isupper() and not before.isupper())) and before not in ("/", "_", "`", "@", "#")
            for end in sorted(ends, reverse=True):
                behind = text[end:end + 1]
                ends_well = behind not in ("/", "_") and (not (behind.isalnum() and text[end - 1].isalnum()) or behind == "0" or (behind.isupper() and not self.title))
                if ends_well or (end in every and not self.title):
                    (free if alone else glued)[start] = end
                    break
        return free, glued

    def _gap(self, text: str, at: int, numbers: bool = True) -> int:
        """Behind the separators, and the bare numbers, that start at `at`."""
        while True:
            start = _SEP.match(text, at).end()
            m = _NUMBER.match(text, start) if numbers else None
            if not m:
                return start
            at = m.end()

    def _next(self, text: str, at: int, found: dict[int, int]) -> int | None:
        """Where the next item starts, with nothing but separators and numbers before it."""
        return next((p for n in (False, True) if (p := self._gap(text, at, n)) in found), None)

    def _run(self, text: str, at: int, found: dict[int, int], glued: dict[int, int], fill: bool = True) -> tuple[int, float, list[tuple[int, int]]]:
        """From `at` on, as many items as follow each other: where they end, their weight, and their places.

        fill: what stands between two items belongs to them, as a name in a list
        of links does: some nodes of their own, or some words, more of them
        where both items have several words themselves.
        """
        nodes: list[tuple[int, int]] = []
        weight, size = 0.0, len(text)
        while True:
            start = at if not nodes or at in glued else self._next(text, at, found)
            if start is None or (start not in found and not (nodes and start in glued)):
                between = None
                begin = self._gap(text, at)
                if nodes and fill and begin < size:
                    long = " " in text[nodes[-1][0]:nodes[-1][1]]
                    for pattern in (_BETWEEN, _NODES_BETWEEN, _WORDS_BETWEEN)[:3 if long else 2]:
                        for m in [pattern.match(text, begin)] if pattern is not _WORDS_BETWEEN else []:
                            if m and (p := self._next(text, m.end(), found)) is not None:
                                between = m.span()
                        if between is None and pattern is not _BETWEEN:  # the nearest item that the words between reach
                            for p in sorted(q for q in found if begin < q <= begin + (112 if pattern is _WORDS_BETWEEN else 250)):
                                gap = text[begin:p]
                                ok = re.fullmatch(_WORDS_BETWEEN.pattern + " " if pattern is _WORDS_BETWEEN else rf"(?:{_NODES_BETWEEN.pattern})(?:{_STRONG}|[ \t]*\n[ \t]*)", gap)
                                if ok and (pattern is not _WORDS_BETWEEN or " " in text[p:found[p]]):
                                    between = (begin, p - len(gap) + len(gap.rstrip(" \t\n·|›—•‹»")))
                                    break
                        if between:
                            break
                if between is None:
                    break
                nodes.append(between)
                at = between[1]
                continue
            end = found.get(start) or glued[start]
            weight += self.items[text[start:end]]
            count = re.compile(r"[ \t]*\(?0\)?(?=$|[\s·|›—•‹»]|[^\W\d_a-z])").match(text, end)
            end = count.end() if count and not self.title else end
            nodes.append((start, end))
            at = end
        if nodes:
            last = self._gap(text, at)
            at = last if last == size else at
            if text[at:at + 1] == " " and text[at + 1:at + 2].islower():  # the last one begins a sentence
                s, e = nodes.pop()
                if not nodes:
                    return s, 0.0, []
                weight -= self.items.get(text[s:e], 0)
                at = nodes[-1][1]
        return at, weight, [(nodes[0][0], at)] if nodes else []

    def parts(self, original: str) -> list[tuple[int, int, str]]:
        """start, end and path of the nodes of page text, in order: at the start, at the end, and blocks within."""
        if not self.items:
            return []
        text = _NUMBERS.sub("0", original)
        found, glued = self._found(text)
        # No run reaches a weight of 2 where all items together don't; in titles, where they stand adds to it.
        if not found or (not self.title and sum(self.items[text[s:e]] for places in (found, glued) for s, e in places.items()) < 2):
            return []
        shifts: list[tuple[int, int]] = []
        lost = 0
        for m in _NUMBERS.finditer(original):
            shifts.append((m.start() + 1 - lost, lost := lost + m.end() - m.start() - 1))
        size = len(text.rstrip())
        first = len(text) - len(text.lstrip(" \t\r\n·|›—•‹»"))
        end, head_weight, head = self._run(text, first, found, glued) if first in found else (first, 0.0, [])
        if head and end >= size:
            end, head_weight, head = self._run(text, first, found, glued, fill=False)
        if self.title and head and text[end:end + 1].isalnum():
            end, head_weight, head = first, 0.0, []
        if self.title and head and re.match(r"[ \t]*(?:[·|›—][ \t]|[-/][ \t])|\n|[ \t]{2,}", text[end:]):
            head_weight += 1
        tail: list[tuple[int, int]] = []
        tail_weight, known = 0.0, sorted(found)
        for p in known:
            if p < end or (p == end and not head and p > first):
                continue
            stop, weight, nodes = self._run(text, p, found, glued)
            if self.title and nodes and stop < size and (m := re.compile(rf"(?:{_STRONG}|[ \t]+[-/][ \t]+|[ \t]*\n[ \t]*)[^\s]{{1,60}}\s*$").match(text, stop)):
                stop, nodes = size, [*nodes, (stop, m.end())]
            if stop < size or not nodes:
                continue
            before = text[:p]
            if self.title and (before[-1:] == "0" or re.search(r"(?:[·|›—]|\s[-/]|\n|[ \t]{2})[ \t]*$", before) or weight + head_weight >= 2):
                weight += 1
            if weight >= 2 and before.strip():
                tail, tail_weight = nodes, weight
                break
        if head_weight < 2 and not (self.title and tail and head_weight + tail_weight >= 2):
            head, end = [], first
        if head and not tail and end >= size:
            return []  # nothing else is there: what its author wrote
        high = tail[0][0] if tail else len(text)
        middle: list[tuple[int, int]] = []
        if not self.title:
            at = end
            for p in known:
                if p < max(at, 1) or p >= high or not re.search(r"(?:\n|[ \t]{2}|[.!?`…)]\s)[ \t]*$", text[max(0, p - 8):p]):
                    continue
                stop, weight, nodes = self._run(text, p, found, glued)
                alone = stop >= high or text[stop:stop + 1] in ("\r", "\n")
                if weight >= (2 if alone else 3) and stop < size and (alone or text[stop:].lstrip()[:1].isupper()):
                    middle += nodes
                    at = stop
        if self.title and head and (m := re.match(r"[ \t]+[-/](?=[ \t])", text[end:])):
            head = [(head[0][0], end + m.end())]
        back_to = lambda p: re.search(r"(?:[·|›—•‹»][ \t]*)*$", text[:p]).start()
        middle, tail = ([(back_to(s), e) for s, e in nodes] for nodes in (middle, tail))
        starts = [a for a, _ in shifts]
        back = lambda x: x + (shifts[i - 1][1] if (i := bisect_right(starts, x)) else 0)
        return [(back(s), back(e), f"page/{where}") for where, nodes in (("head", head), ("within", middle), ("tail", tail)) for s, e in nodes]


class _Tags(HTMLParser):
    """Text nodes of tagged text with their root-to-leaf paths; unclosed and void tags are tolerated."""

    VOID = {"br", "img", "hr", "meta", "link", "input", "wbr", "source", "col", "area", "base", "embed", "track"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.nodes: list[tuple[str, str]] = []

    def handle_starttag(self, tag, attrs):
        if tag not in self.VOID:
            self.open.append(tag + ("." + name.split()[0] if (name := dict(attrs).get("class") or "").split() else ""))

    def handle_endtag(self, tag):
        if any(x.partition(".")[0] == tag for x in self.open):
            while self.open.pop().partition(".")[0] != tag:
                pass

    def handle_data(self, data):
        if data.strip() and not {"script", "style"} & set(self.open[-1:]):
            self.nodes.append(("/".join(self.open) or "text", data))


_TAGGED = re.compile(r"</?(?:html|body|div|nav|ul|li|p|a|footer|header|span|td|article|section)\b[^<>]*>", re.I)


def nodes_of(text: str, title: bool = False) -> list[tuple[str, str]]:
    """path and text of each node, in order; whole texts are cut, whatever their length."""
    if len(_TAGGED.findall(text)) >= 2:
        parser = _Tags()
        parser.feed(text)
        parser.close()
        return [(f"tags/{p}", t) for p, t in parser.nodes]
    return [(p, text[s:e]) for s, e, p in layout(text, title)]


_PUNCT = ".,;:!?…、。`()\"'"


def _marks(node: str) -> int:
    """How many characters of a node are punctuation."""
    return sum(map(node.count, _PUNCT))


def item_of(path: str, node: str, title: bool) -> str | None:
    return item_text(node, title) if len(node) <= LONGEST and not path.startswith("tags/") and path not in ("main/li", "main/pre") else None


def with_neighbours(nodes: list[tuple[str, str]], title: bool) -> list[tuple[tuple[str, str], str | None]]:
    """Each node with an item of its part of a page, null if it stands alone: the next one, and for the first and the last one each other."""
    part = [p.partition("/")[0] if p not in ("main/p", "main/li", "main/pre", "title/main") and not p.startswith("tags/") else None for p, _ in nodes]
    if len(nodes) == 1:
        return [(nodes[0], None)]
    out, i = [], 0
    while i < len(nodes):
        j = i
        while part[i] and j + 1 < len(nodes) and part[j + 1] == part[i]:
            j += 1
        for k in range(i, j + 1):
            other = j if k == i else i if k == j else k + 1
            out.append((nodes[k], item_text(nodes[other][1], title) if j > i else None))
        i = j + 1
    return out


def node_counts(texts: DataFrame, text: str, is_title: str) -> DataFrame:
    """path, title, item, beside, nodes, chars, chars2, marks, marks2: sums and sums of squares of length and punctuation over the nodes of all texts, for each path, item and item beside it.

    item is null for nodes too long for one, and for those of tagged texts;
    beside is another node of the same part of a page (`with_neighbours`). Sums are combined per task.
    """
    schema = "path string, title boolean, item string, beside string, nodes bigint, chars double, chars2 double, marks double, marks2 double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, list[float]] = {}

        def flush() -> pd.DataFrame:
            rows = [(*k, *v) for k, v in sums.items()]
            sums.clear()
            return pd.DataFrame(rows, columns=["path", "title", "item", "beside", "nodes", "chars", "chars2", "marks", "marks2"])

        for batch in batches:
            for t, title in zip(batch["t"], batch["title"]):
                if not t:
                    continue
                for (path, node), beside in with_neighbours(nodes_of(t, bool(title)), bool(title)):
                    item = item_of(path, node, bool(title))
                    n, marks = len(node), _marks(node)
                    s = sums.get((path, title, item, beside))
                    if s is None:
                        s = sums[path, title, item, beside] = [0, 0.0, 0.0, 0.0, 0.0]
                    s[0] += 1
                    s[1] += n
                    s[2] += n * n
                    s[3] += marks
                    s[4] += marks * marks
            if len(sums) > FLUSH:
                yield flush()
        yield flush()

    rows = texts.select(F.col(text).alias("t"), F.coalesce(F.col(is_title), F.lit(False)).alias("title")).mapInPandas(run, schema)
    return rows.groupBy("path", "title", "item", "beside").agg(*[F.sum(c).alias(c) for c in ("nodes", "chars", "chars2", "marks", "marks2")])


def path_statistics(counts: DataFrame) -> DataFrame:
    """path, nodes, chars, chars2, marks, marks2 over all items of node_counts."""
    return counts.groupBy("path").agg(*[F.sum(c).alias(c) for c in ("nodes", "chars", "chars2", "marks", "marks2")])


def learned(counts: DataFrame, paths: set[str]) -> tuple[Grammar, Grammar]:
    """The grammars of texts and of titles, from node_counts.

    An item stands on page paths in ITEM_TEXTS nodes, ITEM_SHARE of all there are
    of it. In texts it must keep company, too: the chance that two of its nodes
    stand beside the same item is COMPANY at least, as in menus, and unlike in
    signatures, where each stands beside another name. An item of several words
    shows page text alone (weight 2), a single word only beside others (1); in
    titles, a number, or SURE nodes nearly all on page paths, do as well. More
    than MAX_ITEMS are an error.
    """
    on = F.col("path").isin(*paths) if paths else F.lit(False)
    known = counts.where("item is not null").withColumn("on", F.when(on, F.col("nodes")).otherwise(0))
    near = known.groupBy("title", "item", "beside").agg(F.sum("on").alias("page"), F.sum("nodes").alias("n"))
    near = written(near, "beside")

    def kept(pairs: DataFrame) -> DataFrame:
        both, every = F.when(F.col("held"), F.col("page")).otherwise(0), F.when(F.col("beside").isNotNull(), F.col("page")).otherwise(0)
        seen = pairs.groupBy("title", "item").agg(F.sum("page").alias("page"), F.sum("n").alias("n"), F.sum(both * (both - 1)).alias("same"), F.sum(every).alias("pairs"))
        company = (F.col("pairs") > 1) & (F.col("same") >= COMPANY * F.col("pairs") * (F.col("pairs") - 1))
        return seen.where((F.col("page") >= ITEM_TEXTS) & (F.col("page") >= ITEM_SHARE * F.col("n")) & F.col("item").rlike(r"\p{L}|©") & (F.col("title") | company))

    # Once more with the company of items alone: the names in signatures stand beside lines that keep none themselves.
    first = kept(near.withColumn("held", F.col("beside").isNotNull())).select(F.col("title").alias("__t"), F.col("item").alias("__i"))
    again = near.join(first, (F.col("title") == F.col("__t")) & (F.col("beside") == F.col("__i")), "left").withColumn("held", F.col("__i").isNotNull()).drop("__t", "__i")
    rows = kept(again).limit(MAX_ITEMS + 1).collect()
    if len(rows) > MAX_ITEMS:
        raise LayoutError(f"more than {MAX_ITEMS} items of pages")
    items: tuple[dict[str, int], dict[str, int]] = ({}, {})
    for r in rows:
        if not r["title"] or len(r["item"].split()) <= TITLE_WORDS:
            items[r["title"]][r["item"]] = weight_of(r["item"], r["title"], r["page"], r["n"])
    return Grammar(items[False]), Grammar(items[True], True)


def weight_of(item: str, title: bool, page: int, n: int) -> int:
    words = len(item.split())
    return 2 if words > 2 or "©" in item or (title and ((words > 1 and ("0" in item or page >= 0.9 * n)) or (page >= SURE and page >= 0.9 * n))) else 1


def scores(stats: list[tuple]) -> dict[str, float]:
    """The fused, smoothed log score of each path, from rows of path_statistics."""
    by: dict[str, list[float]] = {}
    above = lambda p: p.rpartition("/")[0]
    for path, *sums in stats:
        for level in {path, above(path)}:
            s = by.setdefault(level, [0.0] * 5)
            for i, x in enumerate(sums):
                s[i] += x

    def fused(s: list[float]) -> float:
        n, chars, chars2, marks, marks2 = s
        spread = lambda a, b: math.sqrt(max(0.0, b / n - (a / n) ** 2))
        return math.log((chars / n + 1) * (marks / n + 0.05) * (spread(chars, chars2) + 1) * (spread(marks, marks2) + 0.05))

    own = lambda p: 0.5 if p.startswith("tags/") else 0.3
    return {path: own(path) * fused(by[path]) + (1 - own(path)) * fused(by[above(path)]) for path, *_ in stats}


def page_paths(stats: DataFrame, max_paths: int = 100_000) -> set[str]:
    """The paths below the threshold, the one that sets the means of the scores below and above it furthest apart (their variance between the two is the greatest).

    Tagged paths, those of titles and restored ones are parted each on their own. A text that is
    nothing but short nodes is what its author wrote, so paths below `whole`
    have no part in it. Paths describe layouts, so they are few; more than
    max_paths are an error.
    """
    rows = stats.limit(max_paths + 1).collect()
    if len(rows) > max_paths:
        raise LayoutError(f"more than {max_paths} paths")
    by = scores([tuple(r) for r in rows])
    out: set[str] = set()
    for kind in ("tags", "title", ""):
        order = sorted((p for p in by if kind == (k if (k := p.partition("/")[0]) in ("tags", "title") else "") and k != "whole"), key=by.get)
        def apart(i: int) -> float:
            low, high = [by[p] for p in order[:i]], [by[p] for p in order[i:]]
            return len(low) * len(high) * (sum(high) / len(high) - sum(low) / len(low)) ** 2

        if len(order) > 1:
            out |= set(order[:max(range(1, len(order)), key=apart)])
    return out


def without(text: str, page: list[tuple[int, int, str]]) -> str:
    """The text without the given nodes and what parted them from the rest; unchanged if there are none."""
    if not page:
        return text
    kept, at = [], 0
    for start, end, _ in [*page, (len(text), len(text), "")]:
        kept.append(text[at:start].strip(" \t\r\n·|›—-"))
        at = end
    return "\n".join(x for x in kept if x)


def _page_nodes(t: str, title: bool, paths: set[str], grammars: tuple[Grammar, Grammar]) -> list[tuple[int, int, str]] | list[str] | None:
    if len(_TAGGED.findall(t)) >= 2:
        return [x for p, x in nodes_of(t) if p in paths]
    return grammars[bool(title)].parts(t)


def holds_page_text(column: Column, title: Column, paths: set[str], grammars: tuple[Grammar, Grammar]) -> Column:
    """boolean: whether a text has a node on a page path; false for null and empty texts."""
    @F.pandas_udf("boolean")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, titles in batches:
            yield pd.Series([bool(t) and bool(_page_nodes(t, k, paths, grammars)) for t, k in zip(texts, titles)], dtype=bool)

    return run(column, title)


def main_text(column: Column, title: Column, paths: set[str], grammars: tuple[Grammar, Grammar]) -> Column:
    """string: the content nodes of each text; texts without page text come back unchanged, null stays null."""
    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        def clean(t, k):
            if not t:
                return t
            page = _page_nodes(t, k, paths, grammars)
            if not page:
                return t
            if isinstance(page[0], str):
                return "\n".join(x.strip() for p, x in nodes_of(t) if p not in paths)
            return without(t, page)

        for texts, titles in batches:
            yield pd.Series([clean(t, k) for t, k in zip(texts, titles)], dtype=object)

    return run(column, title)


def fitted(texts: DataFrame, text: str, is_title: str) -> tuple[set[str], tuple[Grammar, Grammar]]:
    """The page paths of a table and its grammars: one pass over the texts, its counts written to the shared folder."""
    counts = written(node_counts(texts, text, is_title), "nodes")
    paths = page_paths(path_statistics(counts))
    return paths, learned(counts, paths)
