import random

import pytest
from pyspark.sql import functions as F

from forgelake.llm import truncation as T


def corpus():
    """Whole sentences of a few kinds, most of them with a full stop."""
    rng = random.Random(1)
    things = ["parser", "cursor", "header", "socket", "buffer", "record", "manifest", "payload"]
    out = []
    for i in range(900):
        a, b, c = (rng.choice(things) for _ in range(3))
        out.append(rng.choice([f"Either we drop the {a} early, or the {b} has to keep the {c} later.", f"My guess is that the {a} keeps the {b} and the {c} for too long.", "LGTM", f"- rename the {a}\n- drop the {b}", f"We will see about the {a}. Let me think about it..."]))
    return out


def found(spark, extra, base=None):
    base = corpus() if base is None else base
    rows = [(i, t, "html") for i, t in enumerate(base)] + [(10_000 + i, t, s) for i, (t, s) in enumerate(extra)]
    df = spark.createDataFrame(rows, "id bigint, text string, source string")
    return {r.id: r.reason for r in T.truncated(df, "id", "text", "source").collect()}


def test_kinds_of_cuts(spark):
    got = found(spark, [
        ("Either we drop the cursor early, or the parser has to", "x"), ("My guess is that the soc", "x"), ("My guess is that the parser keeps the...", "x"), ("All good here. My guess is that (cut)", "x"), ("It ends well. It really does. [more]", "x"), ("See `parser_of", "x"), ("Look:\n```\nraise Er", "x"),
        ("Let me think about it...", "x"), ("LGTM", "x"), ("- rename the parser", "x"), ("", "x"), (None, "x"), ("   ", "x"), ("A whole sentence.", "x"), ("```\ncode\n```", "x"),
    ])
    assert {k - 10_000 for k in got if k >= 10_000} == {0, 1, 2, 3, 4, 5, 6}
    assert not [k for k in got if k < 10_000]
    assert (got[10_003], got[10_004], got[10_005], got[10_000]) == ("opening", "mark", "code", "copy")  # the base holds its whole sentence


def test_limits(spark):
    rng = random.Random(2)
    texts = [("".join(rng.choice("abcdef ") for _ in range(rng.randrange(100, 900))) + ".", "short") for _ in range(400)]
    cut = [(t[:300] if len(t) > 300 else t, s) for t, s in texts]
    got = found(spark, cut, [])
    want = {10_000 + i for i, (t, _) in enumerate(texts) if len(t) > 300}
    assert want <= set(got) and all(len(cut[k - 10_000][0]) == 300 for k, r in got.items() if r == "limit")


def test_near_copies(spark):
    whole = "The stream joiner rewrites the page token once the disk of the runner is almost full and nobody ever notices it until the nightly build breaks"
    got = found(spark, [(whole, "a"), (whole[:-13], "b"), (whole[:-13], "b"), (whole + "\nThanks, Ann", "c")], [])
    assert got == {10_001: "copy", 10_002: "copy"}
    assert T.ends_early(whole[:-13], whole) and not T.ends_early(whole, whole + "\nmore") and not T.ends_early("one two", whole)


def test_bands_find_similar_texts():
    rng = random.Random(3)
    hits = 0
    for _ in range(200):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        a, b = T._minima([" ".join(words), " ".join(words[:54])], {})
        hits += bool(set(a[0]) & set(b[1]))
    assert hits >= 190
    assert T._minima(["one two three four", "", None], {}) == [None, None, None]
    same = T._minima(["a b c d e f", "x y z u v w q", "a b c d e f"], {})
    assert same[0] == same[2] and not set(same[0][0]) & set(same[1][0])


@pytest.mark.parametrize("kept", [0.3, 0.5, 0.7, 0.85, 0.95])
@pytest.mark.parametrize("edited", [False, True])
def test_cut_copies_are_found_however_little_was_kept(spark, kept, edited):
    """Recall of planted prefixes, also of copies in which a word was changed before the cut (in short ones, that leaves few shingles alike)."""
    rng = random.Random(int(kept * 100))
    rows, cuts = [], []
    for i in range(120):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(rng.randrange(80, 240))]
        whole = " ".join(words) + "."
        if edited:
            words[rng.randrange(6, 14)] = "otherwise"
        short = " ".join(words)[:int(len(whole) * kept)].rstrip()
        rows += [(2 * i, whole, "a"), (2 * i + 1, short, "b")]
        of = lambda t: {tuple(t.split()[j:j + 5]) for j in range(len(t.split()) - 4)}
        held = of(" ".join(short.split()[:-1]))
        if len(held & of(whole)) >= 0.8 * len(held):  # as alike as a copy has to be, as far as it goes
            cuts.append(2 * i + 1)
    df = spark.createDataFrame(rows, "id bigint, t string, source string")
    g = T.Grammar({})
    ready = T.prepared(df, "t", "source", g).where("kind = 'text'")
    found = df.join(T.cut_copies(ready, df, "t", g), (F.length("t") == F.col("n")) & (F.xxhash64("t") == F.col("h"))).select("id").collect()
    hits = {r.id for r in found}
    assert all(h % 2 for h in hits) and len(cuts) >= 40 and len(hits & set(cuts)) >= (0.85 if edited and kept < 0.5 else 0.9) * len(cuts)


def test_a_hot_opening_loses_no_copy(spark, monkeypatch):
    """Many texts that open alike: paired by how they go on, with the same result as pair by pair."""
    rng = random.Random(5)
    opening = "please have a look at the new loader before the next release because it"
    wholes = [f"{opening} {' '.join(rng.choice(['reads', 'drops', 'keeps', 'writes', 'sorts']) + ' ' + rng.choice(['rows', 'keys', 'files', 'pages']) for _ in range(12))} {i} times a day." for i in range(150)]
    cuts = [w[:rng.randrange(100, len(w) - 20)].rstrip() for w in wholes[:40]]
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(wholes + cuts)], "id bigint, t string, source string")
    g = T.Grammar({})
    ready = T.prepared(df, "t", "source", g).where("kind = 'text'").cache()
    got = []
    for hot in (10**6, 20):
        monkeypatch.setattr(T, "HOT", hot)
        got.append({(r.n, r.h) for r in T.cut_copies(ready, df, "t", g).collect()})
    assert got[0] == got[1] and len(got[0]) >= 36


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None), (2, "word " * 60_000 + "end.", None), (3, "LGTM", None)], "id bigint, text string, source string")
    assert {r.id for r in T.truncated(df, "id", "text", "source").collect()} == set()
    assert T.truncated(df.limit(0), "id", "text", "source").count() == 0
    r = {x.source: (x.n_texts, x.n_truncated) for x in T.rates(df, "id", "text", "source").collect()}
    assert r == {None: (2, 0)}


def test_copies_and_short_cuts_are_not_whole(spark):
    """A closing counts once per different text, and beside the sentences that begin with it."""
    base = corpus() + [f"Could you measure the {a} of {b} on {c}?" for c in ("arm", "disk", "tape", "bsd", "mac") for a in ("cost", "size", "load", "heat", "age") for b in ("it", "them", "this", "that", "those", "all")]
    cuts = [(f"A whole sentence about the {x}. Cou", "x") for x in ("parser", "cursor", "header", "socket")]
    got = found(spark, cuts + [("The end is near. My guess", "x")] * 30, base)
    assert {10_000, 10_001, 10_002, 10_003} <= set(got)
    assert got == {**found(spark, cuts + [("The end is near. My guess", "x")], base), **{k: got[k] for k in got if k > 10_004}}
    assert {10_004 + i for i in range(30)} <= set(got) and not [k for k in got if k < 10_000]


def test_a_longer_variant_in_every_bucket_hides_no_copy(spark):
    """The text that a cut one was cut from needn't be the longest of a bucket."""
    for seed in range(5000):
        rng = random.Random(seed)
        words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(60)]
        whole = " ".join(words)
        short, longer = whole[:-4], " ".join([*words[:-1], "zzz", "yyyyyyy", "xxxxxxx"])
        a, b, c = T._minima([short, whole, longer], {})
        both = set(a[1]) & set(b[0])
        if both and both <= set(c[0]):
            break
    assert T.ends_early(short, whole) and not T.ends_early(short, longer)
    assert found(spark, [(short, "a"), (whole, "b"), (longer, "c")], [])[10_000] == "copy"


@pytest.mark.parametrize("edited", [False, True])
def test_no_partner_of_a_hot_opening_is_left_out(spark, edited):
    """Texts that open, close and go on alike, neither the shortest nor the longest of which is the one that was cut; also with a word changed within the last ones."""
    opening = " ".join(f"open{i}" for i in range(20))
    begun = [f"{opening} {' '.join(f'mid{i}x{j}' for j in range(10))} the nightly build breaks again" for i in range(7)]
    wholes = [f"{x} until{' nobody' * (i + 1)} looks." for i, x in enumerate(begun)]
    cuts = [x.replace("build", "bild") if edited else x for x in begun]
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(wholes + cuts)], "id bigint, t string, source string")
    g = T.Grammar({})
    found = T.cut_copies(T.prepared(df, "t", "source", g).where("kind = 'text'"), df, "t", g)
    assert {r.id for r in df.join(found, (F.length("t") == F.col("n")) & (F.xxhash64("t") == F.col("h"))).collect()} == set(range(7, 14))


def test_what_several_sources_say_alone_is_whole(spark):
    """A short text without a full stop that others begin with is no cut copy where it stands by itself in several sources; in one source it is."""
    whole = "works for me on the old laptop"
    longer = [(f"{whole} {x}", "a") for x in ("`since` last week", "and on the new one, too")]
    found_in = lambda sources: found(spark, [*longer, *[(whole, s) for s in sources], (f"It was slow before.\n{whole}", "a"), ("It was slow before.\n" + longer[1][0], "b")], [])
    assert found_in("bc") == {10_002: "copy", 10_003: "copy", 10_004: "copy"}
    assert found_in("bcd") == {}


def test_a_task_holds_few_texts_at_once():
    """However many and long the texts of a batch are; none is lost and their order stays."""
    texts = ["x" * n for n in [10] * 5000 + [T.CHARACTERS // 3] * 8 + [3 * T.CHARACTERS, 0, 1]] + [None]
    batch = T.pa.RecordBatch.from_arrays([T.pa.array(range(len(texts))), T.pa.array(texts)], ["i", "t"])
    pieces = list(T._pieces([batch, batch.slice(0, 0), batch.slice(4990, 15)]))
    assert [i for p in pieces for i in p.column("i").to_pylist()] == [*range(len(texts)), *range(4990, 5005)]
    assert all(p.num_rows <= T.TEXTS and (p.num_rows == 1 or sum(len(t or "") for t in p.column("t").to_pylist()) <= T.CHARACTERS) for p in pieces)


def test_the_sketch_grows_with_what_it_holds(spark):
    df = spark.range(40_000).select(F.xxhash64("id").alias("x"))
    sketch = T._sketch(df, 40_000)
    held = T.np.array([r.x for r in df.collect()])
    assert sketch.has(held).all() and sketch.has(~held).mean() < 0.05
    assert 8 * len(sketch.bitmap) >= T.SPARE * 40_000 and T.MOST_BITS <= 8 * (16 << 20)


def test_texts_are_read_three_times(spark):
    """For page text, for their lengths and hashes, and to be prepared; pairs are read where they were prepared."""
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate([*corpus()[:300], "the loader keeps the last row of each page in", "the loader keeps the last row of each page in memory now."])], "id bigint, text string, source string")
    df.write.mode("overwrite").parquet(folder := spark.conf.get("spark.sql.warehouse.dir") + "/read")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.read.parquet(folder).mapInArrow(counted, "id bigint, text string, source string")
    assert T.truncated(rows, "id", "text", "source").where("reason = 'copy'").count() == 1
    assert 0 < read.value <= 3 * 302


def test_closers_of_many_texts_are_those_of_each():
    texts = ["one two three four fi", "too short", "a b c d e f, g (cut)", "it stops here: one two three.", "x " * 5000 + "end_", "one two three four fi"]
    known = T.Words()
    each = [T._closers([t], known)[0] for t in texts]
    assert T._closers(texts, known) == each and [len(c[0]) for c in each] == [2, 0, 2, 0, 2, 2] and each[0] == each[5]


def test_long_numbers_alone_are_read_as_all_numbers_are():
    rng = random.Random(6)
    for _ in range(5000):
        text = "".join(rng.choice(["a", "b1", "7", "1234567", "deadbee", "f" * 38, "g", "_", "é", " ", "-", "Z", "0" * 39]) for _ in range(rng.randrange(1, 12)))
        assert T._normal(text) == T._NUMBER.sub(T._number, text)
