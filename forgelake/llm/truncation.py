"""Text cut off by field limits or in transfer.

Two kinds of evidence. A cut text is contained in the beginning of its copy,
however little of it was kept, so min-hash bands are taken over openings: the
first 1, 2, 4, 8, ... shingles of five words of every text. A text meets the
texts that open like it at one of its own largest openings, is aligned with them,
and was cut if its alignment ends early, inside a sentence. Texts without such a
copy are scored by the terminality of their closing words: how often, in the
whole corpus, sentences that open like this end without a full stop, and how
often this word ends a sentence; marks of a cut and the limit of the field a
text came through (many different texts of one length, and none longer) come
after.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, islice, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.chrome import Grammar, fitted, without
from forgelake.operators.lookup import sized
from forgelake.session import written

#: Words of a shingle; bands of an opening, rows of a band, the similarity a pair must reach.
SHINGLE, BANDS, ROWS, SIMILAR = 5, 3, 2, 0.8

#: A text is looked up by so many of its largest openings, but by those of fewer than 2 ** DISTINCT shingles only if it has none above: they are shared by many texts, and a changed word in so few shingles leaves hardly one alike.
OPENINGS, DISTINCT = 3, 3

#: Buckets that at most so many open texts look into are paired text by text, the others by how the texts go on; words an alignment may look ahead.
HOT, AHEAD = 0, 24

#: Remainders in the sketch of closing words: SPARE for each of them, and no fewer or more than these; a fuller sketch only spares less.
SPARE, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 27

#: Openings and words seen less often say nothing; shares from which they say that a sentence is unfinished.
SEEN, CLOSED_SHARE, TERMINAL_SHARE, RARE = 20, 0.9, 0.02, 0.05

#: A closing is whole if it has this share of the units that begin with it, and is in LIMIT_TEXTS texts (one text in several sources counts in each, its copies in one source once); closing lines are counted up to this length.
WHOLE_SHARE, LINE = 0.5, 80

#: A field limit: so many different texts of exactly one length, so many times what the lengths below have.
LIMIT_TEXTS, LIMIT_TIMES = 3, 8

#: Marks that are put behind a cut text; the first ones leave no doubt.
_SURE_MARK = re.compile(r"(?:\((?:cut|truncated|more|continued)\)|\[(?:more|cut|truncated|continued|\.{3}|…)\])\s*$")
MARK = re.compile(r"\s*(?:\((?:cut|truncated|more|continued)\)|\[(?:more|cut|truncated|continued|\.{3}|…)\]|(?<![.…])(?:\.{3}|…))\s*$")
_BREAK = re.compile(r"[.!?…\r\n)](?:(?<=[\r\n])[\r\n]*|(?<=[.!?…])\s+|(?<=\))\s+(?=[^\W\d_a-z]))")  # its first character is quicker to look for than its kinds
_CODE = re.compile(r"```|`[^`\n]*`")
_URL, _MAIL = re.compile(r"\S*://\S+"), re.compile(r"\S+@\S+")
_NUMBER = re.compile(r"\b[a-f]{0,39}[0-9][0-9a-f]*\b|[0-9]+")
_DIGITS = str.maketrans("", "", "0123456789")
_LONG_NUMBER = re.compile("[0-9a-f]" * 7 + "[0-9a-f]*")
_EDGE = re.compile(r"^[^\w~]+|[^\w~]+$")

#: Counters of a task are passed on when they hold so many keys, so many in a batch. Texts, and their characters, that a task works on at once; different words, and units, that it keeps; characters of texts whose units it keeps.
FLUSH, TEXTS, CHARACTERS, KNOWN, UNITS = 100_000, 2_000, 1 << 21, 1 << 16, 1 << 24


def _number(m: re.Match) -> str:
    return "~h" if 7 <= len(m[0]) <= 40 else m[0].translate(_DIGITS)


def _long_number(m: re.Match) -> str:
    """What `_NUMBER` makes of a run of hexadecimal digits, as far as more than its digits go."""
    if any(c.isalnum() or c == "_" for c in (m.string[max(0, m.start() - 1):m.start()], m.string[m.end():m.end() + 1])):
        return re.sub("[0-9]+", _number, m[0])
    return _NUMBER.sub(_number, m[0])


def _normal(text: str) -> str:
    if "`" in text:
        text = _CODE.sub(lambda m: m[0] if m[0] == "```" else "~c", text)
    if "://" in text:
        text = _URL.sub("~u", text)
    if "@" in text:
        text = _MAIL.sub("~m", text)
    # `_NUMBER.sub(_number, text)`, but only runs that are long enough for an id are looked at one by one.
    if not any(map(text.__contains__, "0123456789")):
        return text
    text = _LONG_NUMBER.sub(_long_number, text)
    for digit in "0123456789":
        if digit in text:
            text = text.replace(digit, "")
    return text


def without_mark(text: str) -> str:
    """The text without white space at its end and without the mark of a cut."""
    text = text.rstrip()
    if text[-1:] not in ".…)]":
        return text
    return text[:-24] + MARK.sub("", text[-24:])


def _units(text: str) -> list[str]:
    out, at = [], 0
    for m in _BREAK.finditer(text):
        out.append(text[at:m.start() + 1])
        at = m.end()
    out.append(text[at:])
    return [u for x in out if (u := x.strip().lower())]


def _full(unit: str) -> bool:
    """Whether a unit ends in a full stop."""
    return unit[-1] in ".!?" or (unit[-1] in "\"')]»”" and unit[-2:-1] in (".", "!", "?"))


def closing(text: str) -> tuple[list[str], bool, bool, bool]:
    """The normalised units (lines and sentences) of a text and flags: marked, in code, open code span.

    Normalised: lower case, code, ids and links replaced, digits dropped, and
    the mark of a cut taken off.
    """
    bare = without_mark(text)
    units = _units(_normal(bare))
    tick = bool(units) and "`" in units[-1] and "```" not in units[-1]
    return units, bool(text.rstrip()[-1:] in (")", "]") and _SURE_MARK.search(text[-40:])), bare.count("```") % 2 == 1, tick


def _word_id(word: str) -> int:
    return zlib.crc32(word.encode()) * 0x9E3779B97F4A7C15 & (1 << 64) - 1


class Words(dict):
    """The hash of each word; it keeps KNOWN of them."""

    def __missing__(self, word: str) -> int:
        h = _word_id(word)
        if len(self) < KNOWN:
            self[word] = h
        return h

    def ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Forms(dict):
    """Places of words in a table of their hash, their first character and whether they may go on; it is emptied when it holds KNOWN words."""

    def __init__(self):
        self.hashes, self.firsts, self.goes = array("Q"), array("Q"), array("B")

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self.hashes)
        self.hashes.append(_word_id(word)), self.firsts.append(ord(word[0])), self.goes.append(_goes_on(word))
        return at

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hash, first character and going on of each word."""
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        out = np.array(self.hashes)[at], np.array(self.firsts)[at], np.array(self.goes)[at].astype(bool)
        if len(self) > KNOWN:
            self.clear(), self.__init__()
        return out


def _rolled(ids: np.ndarray) -> np.ndarray:
    """The hash of the shingle that starts at each word, the last few left out."""
    out = np.zeros(max(0, len(ids) - SHINGLE + 1), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SHINGLE):
            out = out * np.uint64(0x100000001B3) + ids[i:len(out) + i]
        return out ^ (out >> np.uint64(29))


def _bands(batch: list[str | None], known: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which texts have SHINGLE words; the BANDS hashes of each of their openings, from the shortest on (text, level, band), how many openings each has, and which of them it is looked up by.

    The last shingle may hold a word that was cut, so the largest opening
    without it is among those that are looked up.
    """
    rng = np.random.default_rng(11)
    a = rng.integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 1 << 62, BANDS * ROWS, dtype=np.uint64)
    every, has, sizes = [], [], []
    for i, text in enumerate(batch):
        words = text.split() if text else []
        if len(words) >= SHINGLE:
            every += words
            has.append(i), sizes.append(len(words))
    if not has:
        return np.zeros(0, int), np.zeros((0, 0, BANDS), np.int64), np.zeros(0, int), np.zeros((0, 0), bool)
    rolled = _rolled(known.ids(every))
    sizes = np.array(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    shingles = sizes - SHINGLE + 1
    levels = np.frexp(shingles)[1].astype(int)
    bands = np.zeros((len(has), levels.max(), BANDS), dtype=np.uint64)
    at = [np.flatnonzero(levels > level) for level in range(levels.max())]
    # From the minimum of the first half of the opening and the second half of it.
    cuts = [np.stack([starts[x] + (0 if level == 0 else 1 << (level - 1)), starts[x] + (1 << level)], axis=1).reshape(-1) for level, x in enumerate(at)]
    before = [None, *[np.searchsorted(x, y) for x, y in pairwise(at)]]
    with np.errstate(over="ignore"):
        for k in range(BANDS * ROWS):
            h, band, least = np.append(rolled * a[k] + b[k], np.uint64((1 << 64) - 1)), k // ROWS, None
            for level, x in enumerate(at):
                more = np.minimum.reduceat(h, cuts[level])[::2]
                least = more if level == 0 else np.minimum(least[before[level]], more)
                bands[x, level, band] = (bands[x, level, band] ^ least) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(level * BANDS + band + 1)
    level = np.arange(levels.max())
    own = (level == (np.frexp(np.maximum(1, shingles - 1))[1] - 1)[:, None]) | ((level >= np.maximum(DISTINCT, levels - OPENINGS)[:, None]) & (level < levels[:, None]))
    return np.array(has), bands.view(np.int64), levels, own


def _minima(batch: list[str | None], known: dict[str, int]) -> list[tuple[list[int], list[int]] | None]:
    """The bands of each text, and after them those that it is looked up by (`_bands`); null for texts with fewer than SHINGLE words."""
    out: list[tuple[list[int], list[int]] | None] = [None] * len(batch)
    for i, row, n, own in zip(*_bands(batch, Words(known))):
        out[i] = row[:n].reshape(-1).tolist(), row[own].reshape(-1).tolist()
    return out


def _lists(size: int, at: np.ndarray, bands: np.ndarray, chosen: np.ndarray) -> pa.Array:
    """The chosen bands (text, level) of the texts `at` as one list each, and null for the others of `size` texts."""
    counts, none = np.zeros(size, dtype=np.int32), np.ones(size, dtype=bool)
    counts[at], none[at] = chosen.sum(axis=1) * BANDS, False
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[chosen].reshape(-1)), mask=pa.array(none))


def _stored(texts: DataFrame, text: str, *more: str) -> DataFrame:
    """more, n (length), h (hash), t of the texts that aren't blank; n and h together stand for a text."""
    return texts.where(F.col(text).rlike(r"\S")).select(*more, F.length(text).alias("n"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in batches of at most TEXTS and, but for a single text, CHARACTERS (bytes) of t."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("t")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHARACTERS, side="right"))
            to = min(max(to, at + 1), at + TEXTS, batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def prepared(texts: DataFrame, text: str, source: str, grammar: Grammar) -> DataFrame:
    """One pass over the different texts that aren't blank (copies count once); two kinds of rows.

    kind `text`: n (length), h (hash), t, parts (starts and ends of page text), bands (of the main text;
    page text around it is no end; as the bytes of their numbers) and, where the closing isn't a full stop,
    own (the bands that it is looked up by), closers, cuts and before (`_closers`), unit, open1, open2, last; alone if its main text is one short unit and it is in LIMIT_TEXTS sources; marked and code for marks and open code.
    Other kinds are counts, combined per task: k, cnt, ended of openings (`1`,
    `2`: words), `last` words, `unit`s without a full stop (ended: texts times sources), `word`s, and
    `begin`s, the first LINE + 1 characters of units of three words or more.
    """
    schema = "kind string, n int, h bigint, t string, parts array<int>, bands binary, own array<bigint>, closers array<bigint>, cuts array<string>, before array<bigint>, unit string, open1 string, open2 string, last string, alone boolean, marked boolean, code boolean, k string, cnt bigint, ended bigint"
    types = {"string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    fields = [x.split(" ") for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(size: int, **columns) -> pa.RecordBatch:
            arrays = []
            for name, t in fields:
                x = columns.get(name)
                arrays.append(x if isinstance(x, pa.Array) else pa.nulls(size, types[t]) if x is None else pa.array(x, types[t]))
            return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])

        known, kept = Words(), 0
        units_of: Counter = Counter()
        more_sources: Counter = Counter()
        counts: dict[tuple[str, str], list[int]] = {}
        words: Counter = Counter()
        begins: Counter = Counter()

        def add(what: str, k: str, n: int, e: int) -> None:
            c = counts.get((what, k))
            if c is None:
                c = counts[what, k] = [0, 0]
            c[0] += n
            c[1] += e

        def count() -> None:
            """What the units kept so far say, each different one read once."""
            for u, n in units_of.items():
                said, f = u.split(), _full(u)
                for w in said:
                    words[w] += n
                last = said[-1] if said[-1].isalnum() else _EDGE.sub("", said[-1])
                add("1", said[0], n, n * f)
                if len(said) > 1:
                    add("2", f"{said[0]} {said[1]}", n, n * f)
                if len(said) > 2:
                    begins[" ".join(said)[:LINE + 1]] += n
                if last:
                    add("last", last, n, n * f)
                if not f and len(u) <= LINE:
                    add("unit", u, n, n + more_sources[u])
            units_of.clear(), more_sources.clear()

        def flush() -> Iterator[pa.RecordBatch]:
            clean: Counter = Counter()
            for w, c in words.items():
                clean[_EDGE.sub("", w)] += c
            rows = chain(((w, k, *c) for (w, k), c in counts.items()), (("word", w, c, 0) for w, c in clean.items() if w), (("begin", u, c, 0) for u, c in begins.items()))
            while some := list(islice(rows, 5 * TEXTS)):
                yield table(len(some), **{name: [r[i] for r in some] for i, name in enumerate(("kind", "k", "cnt", "ended"))})
            counts.clear(), words.clear(), begins.clear()

        for batch in _pieces(batches):
            originals = batch.column("t").to_pylist()
            parts = [grammar.parts(t) for t in originals]
            clean = [without(t, x) for t, x in zip(originals, parts)]
            ends: dict[str, list] = {c: [] for c in ("unit", "open1", "open2", "last", "alone", "marked", "code")}
            for c, sources in zip(clean, batch.column("sources").to_pylist()):
                units, marked, in_code, tick = closing(c)
                units_of.update(units)
                if sources > 1:
                    for u in units:
                        more_sources[u] += sources - 1
                if units and not _full(units[-1]):
                    said = units[-1].split()
                    closes = units[-1], said[0], " ".join(said[:2]) if len(said) > 1 else None, _EDGE.sub("", said[-1])
                else:
                    closes = (None,) * 4
                for name, v in zip(("unit", "open1", "open2", "last"), closes):
                    ends[name].append(v)
                ends["alone"].append(len(units) == 1 and len(units[0]) <= LINE and sources >= LIMIT_TEXTS)
                ends["marked"].append(marked)
                ends["code"].append(in_code or tick)
            has, bands, levels, own = _bands(clean, known)
            closers: list[tuple[list, list, list]] = [([], [], [])] * len(clean)
            ended = [i for i in has.tolist() if ends["unit"][i]]
            for i, x in zip(ended, _closers([clean[i] for i in ended], known)):
                closers[i] = x
            named = {c: [x[i] or None for x in closers] for i, c in enumerate(("closers", "cuts", "before"))}
            open_ = np.array([bool(closers[i][0]) for i in has.tolist()], dtype=bool)
            packed: list[bytes | None] = [None] * len(clean)
            for i, row, n in zip(has.tolist(), bands, levels.tolist()):
                packed[i] = row[:n].tobytes()
            yield table(len(clean), kind=["text"] * len(clean), **{c: batch.column(c) for c in ("n", "h", "t")}, parts=[[at for s, e, _ in x for at in (s, e)] or None for x in parts], bands=packed, own=_lists(len(clean), has[open_], bands[open_], own[open_]), **named, **ends)
            kept += sum(map(len, clean))
            if len(units_of) > KNOWN or kept > UNITS:
                count()
                kept = 0
            if len(counts) + len(words) + len(begins) > FLUSH:
                yield from flush()
        count()
        if counts or words:
            yield from flush()

    stored = _stored(texts, text, F.coalesce(source, F.lit("")).alias("source"))
    return stored.groupBy("n", "h").agg(F.first("t").alias("t"), F.size(F.collect_set("source")).alias("sources")).mapInArrow(run, schema)


def _aligned(a: list[str], b: list[str]) -> tuple[int, int, int]:
    """Words that match, and where in a and b the last match ends, of a walk along both from their beginning.

    Where they part, the walk goes on at the nearest two words in a row that
    both have within AHEAD words (one where a ends); it stops where there are
    none or too few words are left for SIMILAR. Linear in the length of a.
    """
    alike = min(len(a) - 1, len(b))
    i = j = same = end_a = end_b = alike if alike > 0 and a[:alike] == b[:alike] else 0
    allowed = (1 - SIMILAR) * max(0, len(a) - 1) + 1
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            i, j, same = i + 1, j + 1, same + 1
            end_a, end_b = i, j
            continue
        if i - same > allowed:
            break
        near: dict[tuple[str, str], int] = {}
        for y, two in enumerate(pairwise(b[j:j + AHEAD + 2])):
            near.setdefault(two, y)
        best, step = 2 * AHEAD, None
        for x, two in enumerate(pairwise(a[i:i + AHEAD + 2])):
            if x >= best:
                break
            if (y := near.get(two)) is not None and x + y < best:
                best, step = x + y, (x, y)
        if step is None:
            break
        i, j = i + step[0], j + step[1]
    return same, end_a, end_b


def _spaced(text: str) -> list[str]:
    return list(filter(None, (text.replace("\n", " \n ") if "\n" in text else text).split(" ")))


class _Spaced(dict):
    """The words of the texts of a batch, each cut once."""

    def __missing__(self, text: str) -> list[str]:
        out = self[text] = _spaced(text)
        return out


def ends_early(short: str, long: str) -> bool:
    """Whether `short` aligns with the beginning of `long` and stops inside a sentence of it."""
    return _early(_spaced(short.rstrip()), long, lambda: _spaced(long))


def _early(a: list[str], long: str, words: Callable[[], list[str]]) -> bool:
    """`ends_early` of the words of a text, and of a longer one, whose words are only asked for if they matter."""
    if len(a) < SHINGLE or ("\n" not in a[-3:] and f"{a[-3]} {a[-2]}" not in long and f"{a[-2]} {a[-1]}" not in long):
        return False  # no alignment can reach the end: the last whole word, and the one beside it, would have to match
    b = words()
    if len(b) < len(a):
        return False
    same, end_a, end_b = _aligned(a, b)
    if same < SIMILAR * (len(a) - 1) or end_b >= len(b) or end_a < len(a) - 1:
        return False
    if end_a == len(a) - 1:  # the last word was cut, too
        cut, whole = a[end_a], b[end_b]
        return len(whole) > len(cut) and whole.startswith(cut) and _broken(cut) and _broken(whole[len(cut)])
    return a[-1][-1] not in ".!?…:`)" and _goes_on(b[end_b])


def _mixed(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = (a * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        out = (out ^ (out >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
        return out ^ (out >> np.uint64(31))


def _powers(size: int) -> np.ndarray:
    """The factors of the words of a text, by their place, in the hash of all words up to one."""
    global _POWERS
    if len(_POWERS) < size:
        with np.errstate(over="ignore"):
            _POWERS = np.multiply.accumulate(np.full(max(size, 2 * len(_POWERS)), 0x5851F42D4C957F2D, dtype=np.uint64))
    return _POWERS[:size]


_POWERS = np.zeros(0, dtype=np.uint64)


def _goes_on(word: str) -> bool:
    """Whether a word may stand behind the cut of a sentence (between two words)."""
    return word[0].islower() or word[0] in "`#(" or word[0].isdigit()


def _broken(word: str) -> bool:
    return word[-1].isalpha() or word[-1] == "_"


def _along(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each of several texts of so many words begins, the place of each word in its text, and sums up to each word, the difference of two of which is a hash of the words between."""
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(ids)) - np.repeat(starts, sizes)
    with np.errstate(over="ignore"):
        return starts, place, np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * _powers(sizes.max())[place], dtype=np.uint64)])


def _closers(texts: list[str], known: Words) -> list[tuple[list[int], list[str | None], list[int]]]:
    """How a longer text must go on for `ends_early` to hold of a text: hashes of two words and what follows them, the beginning of the word that follows (null: any that goes on), and hashes of all words up to there.

    An alignment ends in two words in a row that both texts have: the last two,
    if the cut was between words, or the two before, if it was in the last word.
    """
    out: list[tuple[list, list, list]] = []
    words, lasts, sizes, at = [], [], [], []
    for i, text in enumerate(texts):
        said = _spaced(without_mark(text).rstrip())
        out.append(([], [], []))
        if len(said) >= SHINGLE:
            words += said
            lasts.append(said[-1]), sizes.append(len(said)), at.append(i)
    if not at:
        return out
    ids, sizes = known.ids(words), np.array(sizes)
    starts, _, sums = _along(ids, sizes)
    ends = starts + sizes
    with np.errstate(over="ignore"):
        before, before_last = ((sums[x] - sums[starts]).view(np.int64).tolist() for x in (ends, ends - 1))
    between = _mixed(_mixed(ids[ends - 2], ids[ends - 1]), np.uint64(0)).view(np.int64).tolist()
    within = _mixed(_mixed(ids[ends - 3], ids[ends - 2]), np.array([ord(w[0]) for w in lasts], dtype=np.uint64)).view(np.int64).tolist()
    for j, (i, last) in enumerate(zip(at, lasts)):
        for holds, *how in ((last[-1] not in ".!?…:`)", between[j], None, before[j]), (_broken(last), within[j], last, before_last[j])):
            if holds:
                for x, v in zip(out[i], how):
                    x.append(v)
    return out


class Sketch:
    """Which remainders any of the hashes has, as a bitmap; a second remainder is that of its upper bits."""

    def __init__(self, bitmap: np.ndarray):
        self.bitmap, self.mask = bitmap, 8 * len(bitmap) - 1

    def has(self, hashes: np.ndarray) -> np.ndarray:
        first, second = hashes & self.mask, hashes >> 27 & self.mask
        out = (self.bitmap[first >> 3] >> (first & 7).astype(np.uint8) & 1).astype(bool)
        return out & (self.bitmap[second >> 3] >> (second & 7).astype(np.uint8) & 1).astype(bool)


def _sketch(hashes: DataFrame, size: int) -> Sketch:
    """The sketch of the column x, of `size` rows. Combined in the JVM, each part of the bitmap by one task; at most MOST_BITS reach the driver, for any number of hashes."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (SPARE * size).bit_length()))
    at = F.pmod("x", F.lit(bits)) + 1
    hashes = hashes.select(F.explode(F.array("x", F.shiftright("x", 27))).alias("x"))
    rows = hashes.select(F.bitmap_bucket_number(at).cast("int").alias("b"), F.bitmap_bit_position(at).cast("int").alias("at")).repartition("b").groupBy("b").agg(F.bitmap_construct_agg(F.col("at").cast("bigint")).alias("bits"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows.collect():
        out[(r.b - 1) * 4096:r.b * 4096] = np.frombuffer(bytes(r.bits), dtype=np.uint8)
    return Sketch(out)


def _unpacked(bands: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bands of all texts of a batch, and the row of each."""
    packed = bands.to_pylist()
    return np.frombuffer(b"".join(packed), np.int64), np.repeat(np.arange(len(packed)), [len(x) // 8 for x in packed])


def _looked_into(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n, h, k: each band a row."""
    for batch in batches:
        ks, of = _unpacked(batch.column("bands"))
        yield pa.RecordBatch.from_arrays([batch.column("n").take(pa.array(of)), batch.column("h").take(pa.array(of)), pa.array(ks)], ["n", "h", "k"])


def _goings_on(batches: Iterator[pa.RecordBatch], sketch: Sketch) -> Iterator[pa.RecordBatch]:
    """x, n, h, next, before: where a text t goes on behind two words that may close an open text of one of its buckets (x: both, as one hash).

    sketch: those of the buckets that are looked into, of the closers, and of both as one hash.
    """
    forms = Forms()
    for batch in _pieces(batches):
        ks, of = _unpacked(batch.column("bands"))
        held = np.flatnonzero(sketch.has(ks))
        ks, of = ks[held], of[held]
        words, rows, sizes = [], [], []
        looked = np.unique(of)
        for i, t, parts in zip(looked.tolist(), *(batch.column(c).take(pa.array(looked)).to_pylist() for c in ("t", "parts"))):
            said = _spaced(without_mark(_without(t, parts)))
            if len(said) >= SHINGLE:
                words += said
                rows.append(i), sizes.append(len(said))
        if not rows:
            continue
        ids, firsts, goes = forms.of(words)
        sizes = np.array(sizes)
        starts, place, sums = _along(ids, sizes)
        first = np.flatnonzero(place < np.repeat(sizes, sizes) - 2)  # of two words that a third one follows
        grams = _mixed(ids[first], ids[first + 1])
        between = np.flatnonzero(goes[first + 2])
        keys = np.concatenate([_mixed(grams[between], np.uint64(0)), _mixed(grams, firsts[first + 2])]).view(np.int64)
        met = np.flatnonzero(sketch.has(keys))
        keys, at, cut = keys[met], first[np.concatenate([between, np.arange(len(first))])[met]], met >= len(between)
        text = np.repeat(np.arange(len(rows)), sizes)[at]
        low, high = (np.searchsorted(of, np.array(rows), side=side) for side in ("left", "right"))
        for piece in range(0, len(keys), KNOWN):
            some = slice(piece, piece + KNOWN)
            n = (high - low)[text[some]]
            which = np.repeat(np.arange(len(n)), n)
            k = ks[low[text[some]][which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)]
            x = keys[some][which] ^ k
            found = np.flatnonzero(sketch.has(x))
            which = which[found] + piece
            kept = pa.array(np.array(rows)[text[which]], pa.int64())
            with np.errstate(over="ignore"):
                before = (sums[at[which] + 2] - sums[starts[text[which]]]).view(np.int64)
            following = [words[i] if c else None for i, c in zip((at[which] + 2).tolist(), cut[which].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(x[found], pa.int64()), batch.column("n").take(kept), batch.column("h").take(kept), pa.array(following, pa.string()), pa.array(before, pa.int64())], ["x", "n", "h", "next", "before"])


def _without(text: str, parts: list[int] | None) -> str:
    return without(text, [(s, e, "") for s, e in zip(parts[::2], parts[1::2])] if parts else [])


def candidates(ready: DataFrame) -> DataFrame:
    """n1, h1, n2, h2: open texts and longer ones of the same bucket that go on, somewhere, as `ends_early` demands.

    A bucket is an opening's band. Every text without a full stop at its end is
    looked up by its OPENINGS largest openings; every longer text of those
    buckets tells what follows its words, as far as the sketch doesn't rule out
    that it follows an open text's closing words. No pair that `ends_early`
    holds for is left out, however many look into a bucket. Of the texts that
    are word for word alike up to there, and that go on with the same word, one is
    enough, as `ends_early` reads no further in them.
    """
    opened = written(ready.where("own is not null").select("n", "h", "own", "closers", "cuts", "before"), "open")
    own = opened.select("n", "h", F.explode("own").alias("k"), F.arrays_zip("closers", "cuts", "before").alias("c"))
    if HOT:
        looked = own.groupBy("k").agg((F.count(F.lit(1)) > HOT).alias("hot"))
        own = own.join(looked, "k")
    xs = F.flatten(F.transform("own", lambda k: F.transform("closers", lambda c: c.bitwiseXOR(k))))
    hashes = opened.select(F.explode(F.concat("own", "closers", xs)).alias("x"))
    sketch = _sketch(hashes, opened.agg(F.sum(F.size("own") + F.size("closers") + F.size("own") * F.size("closers"))).first()[0] or 0)
    ends = (own.where("hot") if HOT else own).select("n", "h", "k", F.explode("c").alias("c"))
    ends = ends.select(F.col("n").alias("n1"), F.col("h").alias("h1"), F.col("c.closers").bitwiseXOR(F.col("k")).alias("x"), F.col("c.cuts").alias("cut"), F.col("c.before").alias("before1"))
    longer = ready.where("bands is not null").select("n", "h", "t", "parts", "bands")
    on = longer.mapInArrow(lambda batches: _goings_on(batches, sketch), "x bigint, n int, h bigint, next string, before bigint")
    # What is joined to, of which a task holds a key's rows, are the open texts: fewer than those that go on.
    met = on.join(ends, "x").where((F.col("n1") < F.col("n")) & (F.col("cut").isNull() | (F.col("next").startswith(F.col("cut")) & (F.length("next") > F.length("cut")))))
    # All pairs that are alike word for word have one verdict (by next word); the others each have their own.
    alike = F.col("before") == F.col("before1")
    each = met.groupBy("n1", "h1", F.when(alike, F.coalesce("next", F.lit(""))).alias("next"), F.when(~alike, F.struct("n", "h")).alias("other")).agg(F.max(F.struct("n", "h")).alias("x"))
    pairs = each.select("n1", "h1", F.col("x.n").alias("n2"), F.col("x.h").alias("h2"))
    if HOT:
        few = own.where("not hot").select("k", F.col("n").alias("n1"), F.col("h").alias("h1"))
        rows = longer.select("n", "h", "bands").mapInArrow(_looked_into, "n int, h bigint, k bigint")
        pairs = pairs.unionByName(few.join(rows, "k").where("n1 < n").select("n1", "h1", F.col("n").alias("n2"), F.col("h").alias("h2")))
    return pairs.distinct()


def cut_copies(ready: DataFrame, texts: DataFrame, text: str, grammar: Grammar | None = None) -> DataFrame:
    """n, h of the texts that are a copy, cut short, of another text of the table. ready: the text rows of `prepared`.

    A closing that is the whole of a text in LIMIT_TEXTS sources is whole there,
    as sources don't cut a text at the same word by chance: texts that close so
    are no cut copies, though others begin like them (`reason`s of the closing
    hold all the same). Each pair of `candidates` is aligned; texts are fetched for pairs only.
    Texts shorter than a shingle have no pairs. Only ready is read any more: it
    holds the texts and the places of page text.
    """
    said = sized(ready.where("alone and unit is not null").select("unit").distinct().withColumn("said", F.lit(True)))
    judged = ready.join(said, "unit", "left").withColumn("own", F.when(F.col("said").isNull(), F.col("own")))
    pairs = written(candidates(judged), "pairs")
    wanted = pairs.select(F.explode(F.array(*[F.struct(F.col(f"n{i}").alias("n"), F.col(f"h{i}").alias("h")) for i in (1, 2)])).alias("x")).select("x.*").distinct()
    wanted = sized(written(wanted, "wanted"))

    @F.pandas_udf("string")
    def main(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for ts, parts in batches:
            yield pd.Series([without_mark(_without(t, None if p is None else list(p))) for t, p in zip(ts, parts)], dtype=object)

    @F.pandas_udf("boolean")
    def early(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for short, long in batches:
            words = _Spaced()
            yield pd.Series([_early(words[s.rstrip()], x, lambda: words[x]) for s, x in zip(short, long)], dtype=bool)  # noqa: B023

    held = written(ready.select("n", "h", "t", "parts").join(wanted, ["n", "h"]).select("n", "h", main("t", "parts").alias("t")), "paired")
    shorts, longs = (held.select(F.col("n").alias(f"n{i}"), F.col("h").alias(f"h{i}"), F.col("t").alias(f"t{i}")) for i in (1, 2))
    return pairs.join(shorts, ["n1", "h1"]).join(longs, ["n2", "h2"]).where(early(F.col("t1"), F.col("t2"))).select(F.col("n1").alias("n"), F.col("h1").alias("h")).distinct()


def field_limits(rows: DataFrame) -> DataFrame:
    """source, n: lengths at which a source's different texts pile up, with nothing beyond but marks of a cut."""
    at = rows.select("source", "n", "h").distinct().groupBy("source", "n").agg(F.count(F.lit(1)).alias("c"))
    below = F.expr("coalesce(sum(c) over (partition by source order by n range between 50 preceding and 1 preceding), 0)")
    beyond = F.expr("coalesce(sum(c) over (partition by source order by n range between 17 following and unbounded following), 0)")
    seen = at.withColumns({"below": below, "beyond": beyond})
    return seen.where((F.col("c") >= LIMIT_TEXTS) & (F.col("c") > LIMIT_TIMES * F.col("below") / 50) & (F.col("beyond") <= 0.05 * F.col("c")) & (F.col("n") >= 100)).select("source", "n")


def _prefixes(df: DataFrame, k: str, least: int, most: int) -> DataFrame:
    """p, longest_n: the proper prefixes (of at least `least` characters) of frequent keys, with the count of the most frequent key behind each."""
    frequent = df.where((F.col("n") >= SEEN) & (F.length(k) <= most) & (F.length(k) > least))
    each = frequent.select(F.explode(F.transform(F.sequence(F.lit(least), F.length(k) - 1), lambda i: F.substring(F.col(k), F.lit(1), i))).alias("p"), "n")
    return each.groupBy("p").agg(F.max("n").alias("longest_n"))


def _beginning(stats: DataFrame, begins: DataFrame, units: DataFrame) -> DataFrame:
    """unit, nb: how many units of all texts begin with it, itself and those with a full stop included.

    units: unit, open2 of closings of at most LINE characters. Those of one or
    two words are met by the counts of openings, longer ones by `begin` rows of
    the same two words.
    """
    parts = F.split("unit", r"\s+")
    units = units.select("unit", "open2", F.array_join(parts, " ").alias("u"), F.size(parts).alias("words"))
    one = stats.where("kind = '1'").select("n", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length("k"), F.lit(LINE))), lambda i: F.substring(F.col("k"), F.lit(1), i))).alias("u"))
    out = one.join(sized(units.where("words = 1").select("unit", "u")), "u").select("unit", "n")
    longer = lambda rows, key, words, n, of: rows.select("k", F.col(n).alias("n"), F.substring_index("k", " ", of).alias(key)).join(sized(words), key).where(F.col("k").startswith(F.col("u"))).select("unit", "n")
    out = out.unionByName(longer(stats.where("kind = '2'"), "w", units.where("words = 2").select("unit", "u", F.substring_index("u", " ", 1).alias("w")), "n", 1))
    out = out.unionByName(longer(begins, "open2", units.where("words > 2").select("unit", "u", "open2"), "cnt", 2))
    return out.groupBy("unit").agg(F.sum("n").alias("nb"))


def truncated(texts: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """key, reason of the texts that lost their end.

    reason, the first that holds: `copy` (its alignment with a near-copy ends
    early); by the terminality of the closing, `opening` (a sentence of a kind
    that ends in a full stop doesn't), `fragment` (the last word is only the
    beginning of a common one), `word` (the last word hardly ever ends a
    sentence) or `line` (the closing line is the beginning of a common one);
    `code` (an open code span), `mark` or `limit`. Null, empty and blank texts are no cases; repeated rows are
    judged alike. Rows are joined to statistics by small keys (openings,
    words), never to each other.
    """
    grammar = fitted(texts.withColumn("__title", F.lit(False)), text, "__title")[1][0]
    rows = _stored(texts, text, F.col(key).alias("id"), F.col(source).alias("source")).drop("t")
    rows = written(rows, "rows")
    every_row = written(prepared(texts, text, source, grammar), "prepared")
    ready = every_row.where("kind = 'text'")
    stats = written(every_row.where("kind not in ('text', 'begin')").groupBy("kind", "k").agg(F.sum("cnt").alias("n"), F.sum("ended").alias("ended")), "closings")
    of = lambda kind, **names: stats.where(F.col("kind") == kind).select(*[F.col(c).alias(a) for a, c in names.items()])
    at_limit = rows.select("id", "source", "n").join(sized(field_limits(rows)), ["source", "n"], "left_semi").select("id", F.lit("limit").alias("reason"))
    sure = ready.where("marked or code").select("n", "h", F.when(F.col("marked"), "mark").otherwise("code").alias("reason"))
    # One row per distinct closing; what is said of it holds for all texts that close so.
    kinds = ready.where("unit is not null").select("unit", "open1", "open2", "last").distinct()
    words = of("word", w="k", n="n")
    kinds = kinds.join(of("1", open1="k", n1="n", e1="ended"), "open1", "left").join(of("2", open2="k", n2="n", e2="ended"), "open2", "left")
    kinds = kinds.join(of("last", last="k", ends="n"), "last", "left").join(words.select(F.col("w").alias("last"), F.col("n").alias("nw")), "last", "left")
    kinds = kinds.join(_prefixes(words, "w", 1, 40).select(F.col("p").alias("last"), F.col("longest_n").alias("nlw")), "last", "left")
    lines = of("unit", unit="k", n="n", ended="ended")
    kinds = kinds.join(lines.select("unit", F.col("n").alias("nu"), F.col("ended").alias("su")), "unit", "left").join(_prefixes(lines, "unit", 1, LINE).select(F.col("p").alias("unit"), F.col("longest_n").alias("nlu")), "unit", "left")
    begun = written(kinds.where(F.col("su") >= LIMIT_TEXTS).select("unit", "open2").distinct(), "begun")
    kinds = kinds.join(_beginning(stats, every_row.where("kind = 'begin'"), begun), "unit", "left")
    c = lambda name: F.coalesce(F.col(name), F.lit(0))
    two = (c("n2") >= SEEN) & (c("e2") >= CLOSED_SHARE * c("n2"))
    # An opening that is the whole unit, and of which hardly any sentence of those that begin so ends there, is a cut one itself.
    stub = (F.col("unit") == F.col("open2")) & (c("nu") < RARE * c("nb"))
    single = ((c("n2") < SEEN) | stub) & (c("n1") >= SEEN) & (c("e1") >= CLOSED_SHARE * c("n1"))
    plain = F.col("last").rlike(r"^[\p{L}'’]+(?:-[\p{L}'’]+)*$")
    cut_word = plain & (c("nw") < RARE * c("nlw"))
    dangling = plain & ~F.col("unit").rlike(r"[)\]]$") & (c("nw") >= SEEN) & (c("ends") < TERMINAL_SHARE * c("nw"))
    whole = (c("su") >= LIMIT_TEXTS) & (c("nu") >= c("nlu")) & (c("nu") >= WHOLE_SHARE * c("nb"))
    cut_line = c("nu") < RARE * c("nlu")
    reason = F.when(two | single, "opening").when(cut_word, "fragment").when(whole, None).when(dangling, "word").when(cut_line, "line")
    judged = ready.where("unit is not null").select("n", "h", "unit").join(kinds.withColumn("reason", reason).where("reason is not null").select("unit", "reason"), "unit").select("n", "h", "reason")
    copies = cut_copies(ready, texts, text).withColumn("reason", F.lit("copy"))
    order = F.array(*[F.lit(x) for x in ("copy", "opening", "fragment", "word", "line", "code", "mark", "limit")])
    first = F.min(F.array_position(order, F.col("reason"))).alias("r")
    by_text = written(sure.unionByName(judged).unionByName(copies).groupBy("n", "h").agg(first), "cut")
    every = at_limit.groupBy("id").agg(first).unionByName(rows.join(sized(by_text), ["n", "h"]).select("id", "r"))
    return every.groupBy("id").agg(F.min("r").alias("r")).select(F.col("id").alias(key), F.element_at(order, F.col("r").cast("int")).alias("reason"))


def rates(texts: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """source, n_texts, n_truncated, share: how often each source cuts its texts (null source is a source)."""
    found = truncated(texts, key, text, source).select(F.col(key).alias("__k"), "reason")
    judged = texts.where(F.col(text).rlike(r"\S")).join(found, F.col(key) == F.col("__k"), "left")
    return judged.groupBy(source).agg(F.count(F.lit(1)).alias("n_texts"), F.count("reason").alias("n_truncated")).withColumn("share", F.col("n_truncated") / F.col("n_texts"))
