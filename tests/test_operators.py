import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from forgelake.operators import lookup, metrics, ordered, relational, state
from forgelake.operators.tree_aggregate import heavy_keys, rounds_of, tree_aggregate


def test_tree_aggregate(spark, rows):
    rng = random.Random(1)
    data = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 1, 2, 3])) for _ in range(5000)]
    df = spark.createDataFrame(data, "k string, v bigint").repartition(7)
    t = tree_aggregate(df, ["k"], {"n": ("count", F.lit(1)), "s": ("sum", F.col("v")), "hi": ("max", F.col("v")), "nn": ("count", F.col("v"))}, fan_in=3, chunk_rows=64)
    assert rows(t) == rows(df.groupBy("k").agg(F.count(F.lit(1)), F.sum("v"), F.max("v"), F.count("v")))
    assert tree_aggregate(df.limit(0), ["k"], {"n": ("count", F.lit(1))}).count() == 0
    assert rows(heavy_keys(t.select("k", "n"), ["k"], "n", 0.5).select("k")) == [("a",)]
    with pytest.raises(ValueError):
        tree_aggregate(df, ["k"], {}, fan_in=1)


@pytest.mark.parametrize("fan_in, chunk_rows", [(2, 4), (3, 16), (16, 8)])
def test_no_merge_reads_more_than_fan_in_states(spark, rows, fan_in, chunk_rows):
    # Two thirds of the rows have one key; there are more chunks than fan_in ** 2.
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 97).alias("k")).repartition(5)
    t = tree_aggregate(df, ["k"], {"n": ("count", F.lit(1))}, fan_in=fan_in, chunk_rows=chunk_rows, widest="w")
    assert rows(t.drop("w")) == rows(df.groupBy("k").count())
    assert 1 < t.agg(F.max("w")).first()[0] <= fan_in


def test_rounds_grow_with_the_logarithm():
    assert [rounds_of(n, 16) for n in (0, 1, 2, 16, 17, 256, 257, 4096, 1_000_000)] == [0, 0, 1, 1, 2, 2, 3, 3, 5]


def history(spark, n=600, keys=3):
    rng = random.Random(2)
    t0 = datetime(2024, 1, 1)
    data = [(i, f"k{min(int(rng.expovariate(1)), keys - 1)}", t0 + timedelta(hours=rng.randrange(24 * 20)), rng.random() < 0.4) for i in range(n)]
    return data, spark.createDataFrame(data, "id bigint, k string, t timestamp_ntz, bad boolean").withColumn("day", F.to_date("t"))


def test_ordered_against_lists(spark):
    data, df = history(spark)
    by = {}
    for r in sorted(data, key=lambda r: (r[2], r[0])):
        by.setdefault(r[1], []).append(r)
    nxt = {r.id: r.nx for r in ordered.next_values(df, ["k"], "day", ["t", "id"], "id", "nx").collect()}
    num = {r.id: r.rn for r in ordered.row_numbers(df, ["k"], "day", ["t", "id"], "rn").collect()}
    run = {r.id: r.n for r in ordered.run_lengths(df, ["k"], "day", ["t", "id"], "bad", "n").collect()}
    assert len(nxt) == len(num) == len(run) == len(data)
    for seq in by.values():
        n = 0
        for i, r in enumerate(seq):
            n = n + 1 if r[3] else 0
            assert nxt[r[0]] == (seq[i + 1][0] if i + 1 < len(seq) else None)
            assert num[r[0]] == i + 1
            assert run[r[0]] == n


def test_running_sums_cross_buckets(spark):
    rng = random.Random(3)
    data = [(rng.choice(["x", "y", None]), i, rng.randrange(5)) for i in range(300)]
    df = spark.createDataFrame(data, "k string, i int, v bigint").withColumn("b", (F.col("i") / 40).cast("int"))
    got = {r.i: r.s for r in ordered.running_sums(df, ["k"], "b", ["i"], "v", "s").collect()}
    assert got == {i: sum(v for kk, ii, v in data if kk == k and ii < i) for k, i, _ in data}


def test_top_first_latest(spark, rows):
    data, df = history(spark)
    top = rows(ordered.top_rows(df.select("k", "id"), ["k"], 4, [F.desc("id")]).select("k", "id", "rank"))
    want = []
    for k in {r[1] for r in data}:
        want += [(k, i, n + 1) for n, i in enumerate(sorted((r[0] for r in data if r[1] == k), reverse=True)[:4])]
    assert top == sorted(want, key=repr)
    assert rows(ordered.first_rows(df.select("k", "id"), ["k"], ["id"])) == sorted([(k, min(r[0] for r in data if r[1] == k)) for k in {r[1] for r in data}], key=repr)
    assert ordered.latest_rows(df.select("k", "id").limit(0), ["k"], ["id"]).count() == 0


def test_circuit_breaker(spark):
    data, df = history(spark, 3000)
    got = {r.k: r for r in state.circuit_breaker(df.withColumn("ok", ~F.col("bad")), "k", "t", "ok", "id", failures=3, seconds=7200).collect()}
    by = {}
    for r in sorted(data, key=lambda r: (r[2], r[0])):
        by.setdefault(r[1], []).append(r)
    for k, seq in by.items():
        st = (0, 0.0, 0, 0)
        for r in seq:
            st, _ = state.breaker_step(st, (r[2] - datetime(1970, 1, 1)).total_seconds(), not r[3], 3, 7200)
        assert (got[k].n_attempts, got[k].n_skipped, got[k].n_trips, got[k].n_failures, got[k].blocked_until) == (len(seq), st[2], st[3], st[0], st[1] or None)


def test_breaker_block_and_expiry():
    s = (0, 0.0, 0, 0)
    for t in range(10):
        s, let = state.breaker_step(s, 1000.0 + t, False, 10, 300)
        assert let
    assert s == (10, 1309.0, 0, 1)
    assert state.breaker_step(s, 1308.0, True, 10, 300) == ((10, 1309.0, 1, 1), False)
    assert state.breaker_step(s, 1309.0, False, 10, 300) == ((1, 0.0, 0, 1), True)


def test_joins(spark, rows):
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 3), ("x", 1)], "k string, v int")
    done = spark.createDataFrame([("x",), (None,)], "k string")
    anti, semi = relational.not_done(a, done, ["k"]), relational.already_done(a, done, ["k"])
    assert rows(anti) == [("y", 2), (None, 3)]
    assert rows(anti.unionByName(semi)) == rows(a)
    hit = relational.split_by_cache(a, spark.createDataFrame([("x", 9), ("x", 8)], "k string, w int"), ["k"], "w", -1)
    assert rows(hit.select("v", "w", "hit")) == [(1, 8, True), (1, 8, True), (2, -1, False), (3, -1, False)]
    tiers = relational.tiered_skips(a, "k", {"first": done, "second": a.select("k")})
    assert rows(tiers.select("v", "skip_reason")) == [(1, "first"), (1, "first"), (2, "second"), (3, None)]
    merged = relational.merge_new(spark.createDataFrame([("x", 1)], "k string, v int"), spark.createDataFrame([("x", 5), ("z", 7), ("z", 6)], "k string, v int"), ["k"], ["v"])
    assert rows(merged) == [("x", 1), ("z", 6)]
    nested = relational.nest(spark.createDataFrame([("x",), ("q",)], "k string"), spark.createDataFrame([("x", 2, "b"), ("x", 1, "a")], "k string, pos int, c string"), ["k"], ["pos"], ["c"], "cs")
    assert sorted((r.k, [x.c for x in r.cs]) for r in nested.collect()) == [("q", []), ("x", ["a", "b"])]
    short = spark.createDataFrame([("abcdef1",), ("abc",), ("fffffff",)], "s string")
    full = spark.createDataFrame([("abcdef12",), ("abcdef10",), ("zz",)], "f string")
    assert rows(relational.prefix_join(short, full, "s", "f")) == [("abc", None), ("abcdef1", "abcdef10"), ("fffffff", None)]


def test_numbers(spark):
    df = spark.createDataFrame([(449.5, 500), (450.0, 500), (0.0, 0)], "have double, target int")
    assert [r[0] for r in df.select(relational.still_needed(F.col("have"), F.col("target"))).collect()] == [1, 0, 0]
    r = df.select(relational.retry_limit(F.lit(10), F.lit(2)), relational.backoff(F.lit(10)), relational.next_batch(F.lit(12)), metrics.share(F.lit(1), F.lit(0)), metrics.coverage(F.lit(5), F.lit(0)), metrics.megabytes(F.lit(1_048_576))).first()
    assert tuple(r) == (200, 60.0, 1, 0.0, 500.0, 1.0)


def test_sized_lookup(spark):
    small = spark.range(5)
    assert "broadcast" in lookup.sized(small)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in lookup.sized(small, 3)._jdf.queryExecution().logical().toString().lower()
    assert lookup.held(small, 3) is small and lookup.held(small).count() == 5


def test_upsert_and_expiry(spark, rows):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, t int, v string")
    new = spark.createDataFrame([("a", 2, "z"), ("c", 1, "w")], "k string, t int, v string")
    assert rows(state.keyed_upsert(old, new, ["k"], ["t"], spark.createDataFrame([("b",)], "k string"))) == [("a", 2, "z"), ("c", 1, "w")]
    m = spark.createDataFrame([({"1": 100.0, "2": 900.0},)], "m map<string,double>")
    assert m.select(state.ttl_map(F.col("m"), F.lit(1000.0), 500)).first()[0] == {"2": 900.0}
    fresh = spark.createDataFrame([(True, "2024-12-10T00:00:00Z"), (True, "2024-11-01T00:00:00Z"), (False, "2024-12-31T00:00:00Z"), (True, "soon"), (None, None)], "ok boolean, t string")
    assert [r[0] for r in fresh.select(state.is_fresh(F.col("ok"), F.col("t"), F.lit("2025-01-01T00:00:00Z"), 30)).collect()] == [True, False, False, False, False]
