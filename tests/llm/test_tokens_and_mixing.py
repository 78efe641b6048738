import os
import random

import pytest
from pyspark.sql import functions as F

from forgelake.llm import mixing, tokenizer

VOCABULARY = f"{tokenizer.FOLDER}/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no public vocabularies")


@pytest.fixture(scope="module")
def both():
    import tiktoken

    tokens = tokenizer.read_ranks(VOCABULARY)
    return tokenizer.Codec(tokenizer.model_bytes(tokens)), tiktoken.Encoding("own", pat_str=tokenizer.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def test_ids_as_the_public_tokenizer(both):
    ours, theirs = both
    rng = random.Random(1)
    texts = ["", " ", "\n\n  x", "<|endoftext|>", "don't we'll 12,345", "名前 été ​﻿ 👍🏽", "a" * 5000, "\0\x7f", "It's 'S"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x3000), rng.randrange(0x1F300, 0x1F700), 9, 10, 13])) for _ in range(rng.randrange(80))) for _ in range(300)]
    for t in texts:
        assert ours.encode(t) == theirs.encode_ordinary(t)
        assert ours.decode(ours.encode(t)) == t
    assert ours.encode(None) == []


def test_columns(spark):
    df = spark.createDataFrame([(1, "Hello there"), (2, None), (3, ""), (3, ""), (4, "word " * 50_000)], "ids int, text string")
    got = sorted((r.key, list(r.ids)[:3], len(r.ids)) for r in tokenizer.encode_corpus(df.withColumnRenamed("ids", "key"), "key", "text").collect())
    assert [(k, n) for k, _, n in got] == [(1, 2), (2, 0), (3, 0), (3, 0), (4, 50_001)]
    back = df.select(tokenizer.token_texts(spark, tokenizer.token_ids(spark, F.col("text"))).alias("t"), "text").collect()
    assert all(r.t == (r.text or "") for r in back)
    assert df.select(tokenizer.token_count(spark, F.col("text")).alias("n")).agg(F.sum("n")).first()[0] == 50_003


def shares(spark, docs, targets, **kw):
    d = spark.createDataFrame(docs, "doc bigint, source string, n bigint")
    p = mixing.plan(d.groupBy("source").agg(F.sum("n").alias("available")), spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), kw.pop("total", None))
    return d, p, mixing.mixture(d, p, "doc", "source", "n", **kw)


def test_mixture(spark):
    rng = random.Random(2)
    docs = [(i, s, rng.randrange(1, 300)) for s, n in (("a", 300), ("b", 60), ("c", 8)) for i in range(n * (1 if s == "a" else 1))]
    docs = [(i, s, n) for i, (_, s, n) in enumerate(docs)]
    d, p, m = shares(spark, [*docs, (10_000, None, 50), (10_001, "zz", 70), (10_002, "a", 0), (10_003, "a", None)], [("a", 0.5, 2), ("b", 0.3, 3), ("c", 0.2, 4), ("none", 0.0, 1)], block=64)
    size = {s: sum(n for _, x, n in docs if x == s) for s in "abc"}
    rep = {r.source: r for r in mixing.report(m, p).collect()}
    assert rep["c"].planned == 4 * size["c"] and rep["none"].mixed == 0
    slots = m.groupBy("slot").agg(F.sum(F.col("to_token") - F.col("from_token")).alias("n"), F.count_distinct("source").alias("s")).collect()
    assert all(r.s == 1 and r.n <= 64 for r in slots) and sum(r.n == 64 for r in slots) >= len(slots) - 4
    for s, cap in (("a", 2), ("b", 3), ("c", 4)):
        assert rep[s].mixed <= cap * size[s]
        assert abs(rep[s].mixed - rep[s].planned) <= 64 * 8
    # No token of a text is used more often than its source allows, and pieces of a text follow each other.
    used = m.groupBy("source", "doc", "repeat").agg(F.sum(F.col("to_token") - F.col("from_token")).alias("n")).collect()
    whole = {i: n for i, _, n in docs}
    assert all(r.n <= whole[r.doc] and r.repeat < {"a": 2, "b": 3, "c": 4}[r.source] for r in used)
    # Every stretch has the shares, not only the whole.
    seq = {r.slot: r.source for r in m.select("slot", "source").distinct().collect()}
    order = [seq[k] for k in sorted(seq)]
    for at in range(0, len(order) - 100, 50):
        part = order[at:at + 100]
        assert abs(part.count("a") / 100 - rep["a"].planned / sum(r.planned for r in rep.values())) < 0.06


def test_nothing_to_mix(spark):
    for docs, targets in (([(1, "a", 5)], [("b", 1.0, 2)]), ([(1, "a", 5)], [("a", 1.0, 0)]), ([(1, None, None)], [("a", None, None)])):
        d, p, m = shares(spark, docs, targets, block=4)
        assert m.count() == 0 and mixing.report(m, p).count() == 1
