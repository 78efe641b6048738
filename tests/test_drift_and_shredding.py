import json

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from forgelake.operators import drift
from forgelake.operators.shredding import _places, array_shapes, deep_loads, positions, rebuild, shred, shred_record
from forgelake.plans.p5_nested import arrays_by_shape


def lines(spark, *records):
    return spark.createDataFrame([(f, r if isinstance(r, str) or r is None else json.dumps(r)) for f, r in records], "f bigint, raw string")


def files(spark, *ids):
    return spark.createDataFrame([(i, "s", t) for t, i in enumerate(ids)], "f bigint, series string, at bigint")


def found(spark, rows, records, order):
    stats = drift.path_stats(lines(spark, *records), "f", "raw", ["stats", "prs"])
    return rows(drift.changes(stats, files(spark, *order), "f", "series", "at"))


def test_changes(spark, rows):
    a = {"url": "u", "stars": 1, "stats": {"forks": 2, "watchers": 3}, "prs": [{"number": 1, "tags": []}, {"number": 2, "tags": ["x"]}], "gone": True}
    b = {"url": "u", "stargazers": 1, "stats": {"forks_count": 2, "watchers": "3"}, "prs": [{"number": 1, "tags": "x"}], "new": None}
    assert found(spark, rows, [(7, a), (3, b)], [7, 3]) == sorted([
        (3, "renamed", "stars", "stargazers"), (3, "renamed", "stats.forks", "stats.forks_count"), (3, "retyped", "stats.watchers", "stats.watchers"), (3, "retyped", "prs.tags", "prs.tags"), (3, "removed", "gone", ""), (3, "added", "", "new"),
    ], key=repr)


def test_no_change_from_nulls_and_broken_lines(spark, rows):
    records = [(1, {"a": None, "b": [], "c": 1}), (2, {"a": "x", "b": [1], "c": 2.5}), (2, "{bad"), (2, "null"), (2, ""), (2, None), (2, "[1]"), (9, "{bad")]
    assert found(spark, rows, records, [1, 9, 2]) == []
    assert found(spark, rows, [], [1, 2]) == []


def test_several_renames_in_one_object(spark, rows):
    a = {"commit_id": "x", "updated_at": "y", "n": 1}
    b = {"commitId": "x", "updatedAt": "y", "m": True}
    got = found(spark, rows, [(1, a), (2, b)], [1, 2])
    assert got == sorted([(2, "renamed", "commit_id", "commitId"), (2, "renamed", "updated_at", "updatedAt"), (2, "removed", "n", ""), (2, "added", "", "m")], key=repr)


def test_typed_table(spark):
    ls = lines(spark, (1, {"stars": 5, "f": 1}), (1, {"stars": 7}), (2, {"stargazers": "many"}), (2, {"stargazers": "8"}), (2, {"stargazers": None}))
    stats = drift.path_stats(ls, "f", "raw", [])
    ch = spark.createDataFrame([(2, "renamed", "stars", "stargazers")], "f bigint, change_kind string, old_path string, new_path string")
    plan = drift.layout_plan(stats, ch)
    assert [(c["path"], c["type"]) for c in plan] == [("f", "bigint"), ("stargazers", "bigint")] or [c["path"] for c in plan] == ["f", "stars"]
    got = drift.typed_table(ls, ["f"], "raw", plan)
    assert got.columns[0] == "f" and "f_" in got.columns  # the clashing key keeps its own column
    name = next(c for c in got.columns if c.startswith("sta"))
    assert sorted((r[name] or -1, tuple(r.failed_casts)) for r in got.collect()) == [(-1, ()), (-1, (name,)), (5, ()), (7, ()), (8, ())]


def test_no_lossy_read(spark):
    values = [1, 1.5, "1.5", "2", True, "abc", "true", None, 9007199254740993, 1e3, [], {"x": 1}, 3.0, " 4 ", 10**30]
    ls = lines(spark, *[(i, {"v": v}) for i, v in enumerate(values)])
    read = lambda t: {r.f: (r.v, bool(r.failed_casts)) for r in drift.typed_table(ls, ["f"], "raw", [{"path": "v", "aliases": ["v"], "type": t}]).collect()}
    failed = (None, True)
    assert list(read("bigint").values()) == [(1, False), failed, failed, (2, False), failed, failed, failed, (None, False), (9007199254740993, False), (1000, False), failed, failed, (3, False), (4, False), failed]
    assert list(read("double").values()) == [(1.0, False), (1.5, False), (1.5, False), (2.0, False), failed, failed, failed, (None, False), failed, (1000.0, False), failed, failed, (3.0, False), (4.0, False), (1e30, False)]
    assert [v for v in read("boolean").values() if v != failed] == [(True, False), (True, False), (None, False)]
    for number, want in ((2.5, "double"), (2, "bigint"), (2.0, "bigint"), (10**25, "double")):
        stats = drift.path_stats(lines(spark, (1, {"v": 1}), (1, {"v": number})), "f", "raw", [])
        assert drift.layout_plan(stats, spark.createDataFrame([], "change_kind string, old_path string, new_path string"))[0]["type"] == want


def test_pull_requests_in_one_layout(spark, tmp_path):
    from datetime import datetime

    from forgelake.plans.catalogue import QUERIES

    requests = [(1, [{"number": 1, "previous_commit_id": "a"}, {"number": "x", "previous_commit_id": None}]), (2, [{"number": 2, "previousCommitId": "b"}, 5]), (3, None)]
    raw = [(f * 10, f, 0, json.dumps({"url": "u", "stats": {"forks": 1}, "pull_requests": p})) for f, p in requests]
    spark.createDataFrame(raw, "line_id bigint, file_id bigint, line_no int, raw_line string").write.parquet(f"{tmp_path}/crawl_lines.parquet")
    spark.createDataFrame([(f, "s", datetime(2024, 1, f)) for f, _ in requests], "file_id bigint, series string, written_at timestamp").write.parquet(f"{tmp_path}/crawl_files.parquet")
    got = QUERIES["p2_pull_requests"](spark, str(tmp_path)).collect()
    name = next(c for c in got[0].asDict() if c.startswith("pull_requests__prev"))
    assert sorted((r.line_id, r.pr_pos, r.pull_requests__number, r[name], tuple(r.failed_casts)) for r in got) == [
        (10, 0, 1, "a", ()), (10, 1, None, None, ("pull_requests.number",)), (20, 0, 2, "b", ()), (20, 1, None, None, ("pull_requests",)),
    ]


def test_levels_of_a_known_record():
    r = {"a": [{"b": [1, 2]}, {}, {"b": []}, {"b": [None, 3], "c": "x"}]}
    c, _ = shred_record(r)
    assert c["a[].b[]"][1:] == ([0, 2, 1, 1, 1, 2], [6, 6, 3, 4, 5, 6], ["1", "2", None, None, None, "3"])
    assert c["a[].c"][1:] == ([0, 1, 1, 1], [3, 3, 3, 4], [None, None, None, "x"])
    assert list(positions(c["a[].b[]"][1], 2)) == [(0, 0), (0, 1), (1, 0), (2, 0), (3, 0), (3, 1)]


def walk(value, path, pos, out):
    if isinstance(value, dict):
        for k, v in value.items():
            walk(v, f"{path}.{k}" if path else k, pos, out)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            if v is not None:
                out.append((path + "[]", (*pos, i)))
                walk(v, path + "[]", (*pos, i), out)


leaf = st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.text("xy", max_size=2))
tree = st.recursive(leaf, lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(st.sampled_from("abc"), x, max_size=3)), max_leaves=12)


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.sampled_from("abc"), tree, max_size=3))
def test_positions_of_any_record(record):
    want: list = []
    walk(record, "", (), want)
    got = []
    for path, (entry, reps, defs, _) in shred_record(record)[0].items():
        if path.endswith("[]"):
            got += [(path, p) for p, d in zip(positions(reps, path.count("[]")), defs) if d >= entry]
    assert sorted(got) == sorted(want)


@settings(max_examples=200, deadline=None)
@given(st.recursive(leaf, lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(st.sampled_from("abc"), x, max_size=3)), max_leaves=20))
def test_parser_without_recursion(value):
    text = json.dumps(value)
    assert deep_loads(text) == value and deep_loads(f" \n{text} ") == value
    for broken in (text + "]", text + ",", "[" + text, text[:-1] + "}" if text.endswith("]") else text + "x", f"[{text},]", f'{{"a" {text}}}', f'{{"a": {text},}}'):
        with pytest.raises(ValueError):
            deep_loads(broken)


def test_any_depth(spark):
    deep = "[" * 60_000 + "]" * 60_000
    assert len(deep_loads(deep, 3)[0][0][0]) == len(deep) - 6
    df = spark.createDataFrame([(1, f'{{"prs": [{{"number": 1, "x": {deep}}}, 2]}}'), (2, f'{{"prs": {deep[:-1]}}}')], "line bigint, raw string")
    got = rebuild(shred(df, ["line"], "raw", arrays_only=True), ["line"], {"pr": r"prs\[\]"})
    assert sorted((r.line, r.pos[0], r.item) for r in got.collect()) == [(1, 0, None), (1, 1, "2")]


def test_places_of_many_records():
    r = [[0, 1, 2, 2, 1, 2], [0], [0, 2, 1], [0, 1, 1, 2]]
    want = [p for x in r for p in positions(x, 2)]
    assert [tuple(map(int, p)) for p in _places(np.array(sum(r, [])), 2)] == want
    assert _places(np.array([], dtype=int), 2).shape == (0, 2)


def test_arrays_by_shape_whatever_their_keys(spark, rows):
    record = {
        "url": "u", "langs": ["Go", "C++"], "changes": [{"sha": "ab12"}], "mrs": [
            {"number": 7, "title": "Fix it now", "labels": ["bug"], "notes": [{"by": "a", "said": "looks good to me"}, "please have a look"], "links": [3, {"iid": 4, "title": "a b", "replies": [{"text": "me too, really"}], "marks": ["x"]}]},
            {"number": 8, "title": "Other", "notes": None, "links": []},
        ],
    }
    df = spark.createDataFrame([(1, json.dumps(record)), (2, "{}"), (3, None), (4, "{bad")], "line bigint, raw string")
    shredded = shred(df, ["line"], "raw", arrays_only=True)
    arrays = arrays_by_shape(array_shapes(shredded))
    got = rows(rebuild(shredded, ["line"], arrays).select("kind", "pos"))
    assert got == sorted([("pull_request", [0]), ("pull_request", [1]), ("pr_comment", [0, 0]), ("pr_comment", [0, 1]), ("related_issue", [0, 0]), ("related_issue", [0, 1]), ("issue_comment", [0, 1, 0])], key=repr)
    assert arrays_by_shape({}) == {} and rebuild(shredded, ["line"], {}).count() == 0


def test_rebuild(spark, rows):
    data = [(1, '{"prs": [{"n": 1, "notes": ["a", {"t": "b"}]}, {"n": 2}], "x": {"deep": [1]}}'), (2, "{}"), (3, None), (4, "{bad"), (5, '{"prs": []}'), (1, '{"prs": [{"n": 1}]}'), (6, '{"prs": ' + "[" * 2000 + "]" * 2000 + "}")]
    df = spark.createDataFrame(data, "kind bigint, raw string").withColumnRenamed("kind", "line")
    got = rebuild(shred(df, ["line"], "raw", r"prs(?:\[\]\..*)?$"), ["line"], {"pr": r"prs\[\]", "note": r"prs\[\]\.notes\[\]"}, {"n": ["n"], "t": ["t"]})
    assert [r for r in rows(got) if r[0] != 6] == sorted([(1, "pr", [0], None, "1", None), (1, "pr", [1], None, "2", None), (1, "note", [0, 0], "a", None, None), (1, "note", [0, 1], None, None, "b"), (1, "pr", [0], None, "1", None)], key=repr)
