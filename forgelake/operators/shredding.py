"""Deeply nested records to flat tables: columnar shredding and reassembly.

Each record's leaf paths become columns of (repetition level, definition
level, value) entries. `[]` in a path stands for the items of an array. The
repetition level of an entry says at which array of its path it continues (0:
a new record); the definition level says how much of the path is there. Besides
the leaves, each array has an item column (its path ending in `[]`) with one
entry per item, so that items which are bare numbers or texts, and items of
mixed kinds, have their place too. Flat tables of any array are rebuilt from
the level sequences alone; parents are found by position. What an array holds can
be told from the shapes of its items, counted over all records (`shapes`), so
nothing depends on what its key is called.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.errors import LayoutError

#: Counts of an array's items: objects, numbers (also written as texts), texts of several words, other texts, the rest; objects with a number, with a text of several words, with an array or object.
COUNTS = ("objects", "numbers", "prose", "words", "others", "with_number", "with_prose", "with_below")
COLUMNS = "array<struct<path:string,entry_def:int,reps:array<int>,defs:array<int>,vals:array<string>>>"
SHAPES = f"array<struct<path:string,{','.join(f'{c}:bigint' for c in COUNTS)}>>"

#: Definition level from which on a value is kept as its JSON text.
DEEPEST = 200

#: Array paths that may be classified; they describe layouts, not data.
MAX_ARRAYS = 5000

_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null))')
_DIGITS = re.compile(r"#?\d+")


class _Text(str):
    """The JSON text of a value that lies too deep to be taken apart."""


def deep_loads(text: str, deepest: int = DEEPEST):
    """json.loads for text of any depth, without recursion: what is below `deepest` containers stays text (checked all the same)."""
    stack: list = []  # (container, key, start)
    at, state, out, size = 0, "value", None, len(text)
    while True:
        m = _TOKEN.match(text, at)
        if not m:
            if stack or state != "end" or text[at:].strip(" \t\n\r"):
                raise ValueError(f"no JSON at {at}")
            return out
        mark, string, scalar = m.groups()
        start, at = m.start(m.lastindex), m.end()
        if state == "end":
            raise ValueError(f"more than one value at {start}")
        done = False
        if state in ("value", "first item") and mark in ("{", "["):
            stack.append([{} if mark == "{" else [], None, start])
            state = "first key" if mark == "{" else "first item"
        elif state in ("value", "first item") and mark is None:
            value, done = json.loads(string or scalar), True
        elif state in ("key", "first key") and string is not None:
            stack[-1][1], state = json.loads(string), "colon"
        elif state == "colon" and mark == ":":
            state = "value"
        elif state == "after" and mark == ",":
            state = "key" if isinstance(stack[-1][0], dict) else "value"
        elif (mark == "]" and state in ("first item", "after") and isinstance(stack[-1][0], list)) or (mark == "}" and state in ("first key", "after") and isinstance(stack[-1][0], dict)):
            value, _, begin = stack.pop()
            done = True
            if len(stack) >= deepest:
                value = _Text(text[begin:at]) if len(stack) == deepest else None
        else:
            raise ValueError(f"unexpected {m[0]!r} at {start}")
        if done:
            if not stack:
                out, state = value, "end"
                continue
            holder, key, _ = stack[-1]
            if len(stack) <= deepest:
                if isinstance(holder, dict):
                    holder[key] = value
                else:
                    holder.append(value)
            state = "after"


class _Node:
    """A path of one record: keys below it, items below it, and its own column."""

    __slots__ = ("path", "rep", "definition", "keys", "item", "column", "leaf", "shape")

    def __init__(self, path: str, rep: int, definition: int):
        self.path, self.rep, self.definition = path, rep, definition
        self.keys: dict[str, _Node] = {}
        self.item: _Node | None = None
        self.column: tuple[list, list, list] | None = None
        self.leaf = False
        self.shape: list[int] | None = None

    def learn(self, value, wanted: Callable[[str], bool] | None) -> None:
        """wanted: of paths; None for arrays alone, with the shapes of their items."""
        if self.definition >= DEEPEST:
            self.leaf = True
        elif isinstance(value, dict):
            for k, x in value.items():
                if wanted is None and not isinstance(x, (dict, list)):
                    continue
                if (node := self.keys.get(k)) is None:
                    path = f"{self.path}.{k}" if self.path else k
                    if wanted and not wanted(path):
                        continue
                    node = self.keys[k] = _Node(path, self.rep, self.definition + 1)
                node.learn(x, wanted)
        elif isinstance(value, list):
            if self.item is None:
                self.item = _Node(self.path + "[]", self.rep + 1, self.definition + 2)
                self.item.leaf = True
                self.item.shape = [0] * len(COUNTS) if wanted is None else None
            shape = self.item.shape
            for x in value:
                if shape:
                    _count(shape, x)
                    if not isinstance(x, (dict, list)):
                        continue
                self.item.learn(x, wanted)
        else:
            self.leaf = True

    def open(self, columns: dict, shapes: list) -> None:
        if self.leaf:
            self.column = columns[self.path] = ([], [], [])
        if self.shape:
            shapes.append((self.path, self.shape))
        for node in self.keys.values():
            node.open(columns, shapes)
        if self.item:
            self.item.open(columns, shapes)

    def absent(self, r: int, d: int) -> None:
        if self.column:
            self.column[0].append(r), self.column[1].append(d), self.column[2].append(None)
        for node in self.keys.values():
            node.absent(r, d)
        if self.item:
            self.item.absent(r, d)

    def put(self, value, r: int) -> None:
        d = self.definition
        if self.column:
            whole = self.definition >= DEEPEST or not isinstance(value, (dict, list))
            scalar = str(value) if isinstance(value, str) else value if value is None else json.dumps(value) if whole else None
            self.column[0].append(r), self.column[1].append(d if value is not None else d - 1), self.column[2].append(scalar)
        is_dict, is_list = isinstance(value, dict), isinstance(value, list)
        for k, node in self.keys.items():
            if is_dict and value.get(k) is not None:
                node.put(value[k], r)
            else:
                node.absent(r, d if is_dict else d - 1)
        if self.item:
            if is_list and value:
                for i, x in enumerate(value):
                    if x is None:
                        self.item.absent(r if i == 0 else self.item.rep, d + 1)
                    else:
                        self.item.put(x, r if i == 0 else self.item.rep)
            else:
                self.item.absent(r, d if is_list else d - 1)


def _kind(x) -> str:
    if isinstance(x, str):
        return "numbers" if _DIGITS.fullmatch(x) else "prose" if " " in x.strip() else "words"
    return "numbers" if isinstance(x, (int, float)) and not isinstance(x, bool) else "others"


_AT = {c: i for i, c in enumerate(COUNTS)}


def _count(shape: list[int], item) -> None:
    if isinstance(item, dict):
        shape[0] += 1
        kinds = {_kind(x) if not isinstance(x, (dict, list)) else "below" for x in item.values()}
        shape[5] += "numbers" in kinds
        shape[6] += "prose" in kinds
        shape[7] += "below" in kinds
    elif item is not None:
        shape[_AT[_kind(item)]] += 1


def shred_record(record: dict, wanted: Callable[[str], bool] | None = lambda path: True) -> tuple[dict[str, tuple[int, list, list, list]], list[tuple[str, list[int]]]]:
    """path -> (definition level at which an entry is there, reps, defs, vals) of one record, and the shapes of its arrays if wanted is None."""
    root = _Node("", 0, 0)
    root.learn(record, wanted)
    columns: dict = {}
    shapes: list = []
    root.open(columns, shapes)
    root.put(record, 0)
    return {p: (2 * p.count("[]") + len([k for k in re.split(r"\.|\[\]", p) if k]), *c) for p, c in columns.items()}, shapes


def _nested(lengths: Sequence[int], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(lengths)], pa.int32()), values)


def shred(df: DataFrame, keep: Sequence[str], raw: str, only: str | None = None, arrays_only: bool = False) -> DataFrame:
    """keep..., columns, shapes: the shredded columns of each row whose `raw` is one complete JSON object.

    only: a regular expression; paths that don't match it (from their start)
    are pruned before anything is built of them. arrays_only: the item columns
    of all arrays and no other leaves; only then shapes is filled. Rows with
    null, blank or broken text, and JSON that is no object, are left out. Empty
    objects have an empty list of columns. What lies deeper than DEEPEST levels
    stays JSON text, at any depth. Names in keep must differ from `columns`
    and `shapes`.
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keep).schema) + f", columns {COLUMNS}, shapes {SHAPES}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if arrays_only else re.compile(only).match if only else lambda path: True
        for batch in batches:
            rows: list[int] = []
            per_row, n_shapes, paths, entry, lengths, reps, defs, vals, of, shapes = [], [], [], [], [], [], [], [], [], []
            for i, text in enumerate(batch.column("__raw").to_pylist()):
                try:
                    record = json.loads(text) if text else None
                except RecursionError:
                    try:
                        record = deep_loads(text)
                    except ValueError:
                        continue
                except ValueError:
                    continue
                if not isinstance(record, dict):
                    continue
                rows.append(i)
                columns, found = shred_record(record, wanted)
                per_row.append(len(columns)), n_shapes.append(len(found))
                for p, (e, r, d, v) in columns.items():
                    paths.append(p), entry.append(e), lengths.append(len(r))
                    reps += r
                    defs += d
                    vals += v
                for p, shape in found:
                    of.append(p), shapes.append(shape)
            kept = batch.take(pa.array(rows, pa.int64()))
            parts = [pa.array(paths, pa.string()), pa.array(entry, pa.int32()), *[_nested(lengths, pa.array(x, t)) for x, t in ((reps, pa.int32()), (defs, pa.int32()), (vals, pa.string()))]]
            counts = np.array(shapes, dtype=np.int64).reshape(-1, len(COUNTS))
            made = [_nested(per_row, pa.StructArray.from_arrays(parts, ["path", "entry_def", "reps", "defs", "vals"])), _nested(n_shapes, pa.StructArray.from_arrays([pa.array(of, pa.string()), *[pa.array(counts[:, c]) for c in range(len(COUNTS))]], ["path", *COUNTS]))]
            yield pa.RecordBatch.from_arrays([*[kept.column(k) for k in keep], *made], [*keep, "columns", "shapes"])

    return df.select(*keep, F.col(raw).alias("__raw")).mapInArrow(run, schema)


def array_shapes(shredded: DataFrame) -> dict[str, dict[str, int]]:
    """path -> COUNTS summed over all records, of a table shredded with arrays_only. More than MAX_ARRAYS paths are an error: keys that hold data."""
    rows = shredded.select(F.inline("shapes")).groupBy("path").agg(*[F.sum(c).alias(c) for c in COUNTS]).limit(MAX_ARRAYS + 1).collect()
    if len(rows) > MAX_ARRAYS:
        raise LayoutError(f"more than {MAX_ARRAYS} array paths")
    return {r.path: {c: r[c] for c in COUNTS} for r in rows}


def positions(reps: Sequence[int], depth: int) -> Iterator[tuple[int, ...]]:
    """The position at each of the first `depth` arrays, for each entry of a column."""
    at = [0] * depth
    for r in reps:
        if r == 0:
            at = [0] * depth
        elif r <= depth:
            at[r - 1] += 1
            at[r:] = [0] * (depth - r)
        yield tuple(at)


def _places(reps: np.ndarray, depth: int) -> np.ndarray:
    """`positions` of the entries of many records one after the other, at once: an array of (entries, depth)."""
    out, index = np.zeros((len(reps), depth), dtype=np.int64), np.arange(len(reps))
    for level in range(1, depth + 1):
        steps = np.cumsum(reps == level)
        out[:, level - 1] = steps - steps[np.maximum.accumulate(np.where(reps < level, index, 0))] if len(reps) else 0
    return out


def rebuild(shredded: DataFrame, keep: Sequence[str], tables: dict[str, str], fields: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Flat rows of the arrays named in tables: keep..., kind, pos (one per array of the path), item and fields.

    tables: kind -> regular expression that the array's path (with `[]` at the
    end) must match as a whole. One row per item that isn't null: its
    positions from the outermost array, `item` (its value if it is a scalar)
    and one column per field: the first of the leaves named for it that the
    item has. Columns of keep or fields called kind, pos or item are refused.
    All columns of a batch that share a path are read together.
    """
    fields = fields or {}
    if {"kind", "pos", "item"} & {*keep, *fields}:
        raise ValueError("kind, pos and item are names of the result")
    extra = "".join(f", `{f}` string" for f in fields)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shredded.select(*keep).schema) + f", kind string, pos array<bigint>, item string{extra}"
    leaves = {leaf for names in fields.values() for leaf in names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [(k, re.compile(p)) for k, p in tables.items()]
        kinds: dict[str, str | None] = {}
        for batch in batches:
            held = batch.column("columns")
            owner = np.repeat(np.arange(len(held)), pc.list_value_length(held).fill_null(0).to_numpy(zero_copy_only=False))
            every = held.flatten()
            coded = every.field("path").dictionary_encode()
            codes, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
            code_of = {p: i for i, p in enumerate(names)}

            def column(path: str) -> tuple[np.ndarray, np.ndarray, pa.StructArray]:
                """Rows, numbers of entries and the columns themselves of a path."""
                at = np.flatnonzero(codes == code_of[path])
                sub = every.take(pa.array(at))
                return owner[at], pc.list_value_length(sub.field("reps")).to_numpy(zero_copy_only=False), sub

            for path in names:
                if path.endswith("[]") and path not in kinds:
                    kinds[path] = next((k for k, p in patterns if p.fullmatch(path)), None)
                if not path.endswith("[]") or kinds[path] is None:
                    continue
                rows, sizes, sub = column(path)
                reps, defs = (sub.field(c).flatten().to_numpy(zero_copy_only=False) for c in ("reps", "defs"))
                there = np.flatnonzero(defs >= np.repeat(sub.field("entry_def").to_numpy(zero_copy_only=False), sizes))
                if not len(there):
                    continue
                places = _places(reps, path.count("[]"))[there]
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                values: dict[str, pa.Array] = {}
                for leaf in leaves:
                    if (full := f"{path}.{leaf}") not in code_of:
                        continue
                    own, lengths, leaf_columns = column(full)
                    source = np.full(len(reps), -1, dtype=np.int64)
                    flat_starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                    begin = starts[np.searchsorted(rows, own)]
                    for b, f, n in zip(begin, flat_starts, lengths):
                        source[b:b + n] = np.arange(f, f + n)
                    picked = source[there]
                    values[leaf] = leaf_columns.field("vals").flatten().take(pa.array(picked, mask=picked < 0))
                none = pa.nulls(len(there), pa.string())
                made = [pc.coalesce(*[values[x] for x in names_of if x in values], none) for names_of in fields.values()]
                kept = batch.take(pa.array(np.repeat(rows, sizes)[there]))
                pos = pa.ListArray.from_arrays(pa.array(np.arange(len(there) + 1) * places.shape[1], pa.int32()), pa.array(places.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*[kept.column(k) for k in keep], pa.array([kinds[path]] * len(there), pa.string()), pos, sub.field("vals").flatten().take(pa.array(there)), *made], [*keep, "kind", "pos", "item", *fields])

    return shredded.select(*keep, "columns").mapInArrow(run, schema)
