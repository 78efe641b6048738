import json
import random
from datetime import datetime, timedelta


from forgelake import cli
from forgelake.config import EngineConfig, preset
from forgelake.operators.state import breaker_step, refine
from forgelake.plans import pipeline
from forgelake.sources import records, sinks
from forgelake.sources.listing import ListingSource
from forgelake.streaming.breaker import breaker_stream
from forgelake.streaming.resume import new_files, once_per_key, run_available


def put(path, *lines):
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines), encoding="utf-8")
    return str(path)


def test_inputs(spark, tmp_path):
    good = put(tmp_path / "a.json", json.dumps({"language": "Go", "repositories": [{"url": "u1", "stars": 5, "language": ["Go"]}, {"url": "u2", "stars": 1}]}, indent=1))
    bad = put(tmp_path / "b.json", "{bad")
    assert records.usable_paths([good, bad, str(tmp_path), str(tmp_path / "none")]) == [good, bad]
    repos = records.repositories(records.read_inputs(spark, [good, bad])).collect()
    assert [(r.pos, r.url, r.stars, r.language) for r in repos] == [(0, "u1", 5, ["Go"]), (1, "u2", 1, None)]


def test_outputs(spark, tmp_path):
    p = put(tmp_path / "o.jsonl", '{"url":"a","stars":1}', "", "{bad", '{"stars":2}', '{"url":"a","stars":3}')
    df = records.read_outputs(spark, p)
    assert sorted((r.url or "", r.usable) for r in df.collect()) == [("", False), ("", False), ("a", True), ("a", True)]
    assert [r.url for r in records.known_urls(spark, str(tmp_path)).collect()] == ["a"]
    assert records.was_crawled(spark, str(tmp_path), "a") and not records.was_crawled(spark, str(tmp_path), "b")


def test_caches_and_states(spark, tmp_path, rows):
    pulls = spark.createDataFrame([("https://x/a/b_c", 1), ("https://x/a/b_c", 2), ("https://x/a_b/c", 1)], "repo_url string, number bigint")
    sinks.write_pull_cache(pulls, str(tmp_path / "prs"))
    assert rows(records.cached_numbers(spark, str(tmp_path / "prs"), "https://x/a/b_c")) == [("https://x/a/b_c", 1), ("https://x/a/b_c", 2)]
    assert records.cached_pulls(spark, str(tmp_path / "prs")).count() == 3
    s = put(tmp_path / "s_state.json", {"repo_url": "r", "pr_commit_mapping": {"12": ["c1", "c2"]}})
    st = records.crawl_states(spark, s)
    assert (st.first().last_open_page, st.first().scraped_pr_numbers, st.first().discovery_complete) == (0, [], False)
    assert rows(records.pr_commits(st)) == [("r", 12, 0, "c1"), ("r", 12, 1, "c2")]
    f = put(tmp_path / "f.json", {"failed_issues": {"u": {"1": 1000.0, "2": 10.0}, "old": [7, 8]}, "failed_repositories": {"u": {"reason": "gone", "timestamp": 990.0}, "v": ["timeout", 980.0]}, "last_updated": 950.0})
    assert rows(records.failures(spark, f, 1000.0, 100).select("scope", "repo_url", "issue_number", "reason")) == sorted([("issue", "u", 1, None), ("issue", "old", 7, None), ("issue", "old", 8, None), ("repository", "u", None, "gone"), ("repository", "v", None, "timeout")], key=repr)
    sinks.save_state(pulls, str(tmp_path / "t"))
    kept = sinks.drop_keys(spark.read.parquet(str(tmp_path / "t")), spark.createDataFrame([(1,)], "number bigint"), ["number"])
    assert kept.count() == 1
    sinks.append_rows(pulls, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6
    sinks.write_records(pulls, str(tmp_path / "w"), append=False)
    assert spark.read.json(str(tmp_path / "w")).count() == 3
    assert sinks.output_name("go_list", 500) == "go_list_crawled_stars_500.jsonl"


def test_listing_source(spark, tmp_path):
    for n in range(5):
        put(tmp_path / f"x-y__open__{n}.html", f"page {n}")
    spark.dataSource.register(ListingSource)
    df = spark.read.format("listing").option("path", str(tmp_path)).option("pages", 2).load()
    assert sorted((r.page_no, r.html) for r in df.collect()) == [(n, f"page {n}") for n in range(5)] and df.rdd.getNumPartitions() == 3


def test_stream_resumes(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    schema = "id bigint, v string"
    for part in ([(1, "a"), (2, "b"), (1, "again")], [(2, "again"), (3, "c")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        run_available(once_per_key(new_files(spark, src, schema), ["id"]), out, cp)
    run_available(once_per_key(new_files(spark, src, schema), ["id"]), out, cp)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_breaker_stream_is_the_batch_fold(spark, tmp_path):
    rng, t0 = random.Random(5), datetime(2024, 1, 1)
    data = [(f"k{i % 2}", t0 + timedelta(seconds=40 * i), rng.random() < 0.5) for i in range(200)]
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for part in (data[:90], data[90:]):
        spark.createDataFrame(part, "k string, t timestamp, ok boolean").coalesce(1).write.mode("append").parquet(src)
        run_available(breaker_stream(new_files(spark, src, "k string, t timestamp, ok boolean"), "k", "t", "ok", 3, 300.0), out, cp)
    got = sorted((r.k, r.t, r.allowed) for r in spark.read.parquet(out).collect())
    want = []
    for k in ("k0", "k1"):
        s = (0, 0.0, 0, 0)
        for _, t, ok in (d for d in data if d[0] == k):
            s, let = breaker_step(s, (t - datetime(1970, 1, 1)).total_seconds(), ok, 3, 300.0)
            want.append((k, t, let))
    assert got == want


def test_refine_stops(spark):
    steps = []

    def step(df, attempt):
        steps.append(attempt)
        return df

    assert refine(spark.range(3), lambda d: False, step).count() == 3 and steps == [0, 1]
    assert refine(spark.range(3), lambda d: d.count() >= 5, lambda d, a: d.unionByName(spark.range(10 + a, 11 + a))).count() == 5


def listing_page(n):
    return "".join(f'<a href="/o/r/pull/{i}{"/files" if i % 2 else ""}">x</a>' for i in range(n)) + '<a href="/pulls?q=is%3Aopen">1,200 Open</a><a href="/pulls?q=is%3Aclosed">2.5k Closed</a>'


REPO = "https://forge.example/o/r"


def pages(spark):
    pr = lambda n, extra: f'<h1 class="gh-header-title">PR {n}</h1><span class="State State--closed">Closed</span>{extra}'
    data = [("pulls", None, listing_page(8)), ("pr", 7, pr(7, '<a href="/o/r/issues/3">i</a><p>fixes #4 and #7</p> merged commit ' + "a" * 40 + " into main")), ("pr", 6, pr(6, "")), ("issue", 3, '<h1 class="gh-header-title">Issue three #3</h1><script>{"comments": [{"body": "from the page", "author": {"login": "ann"}, "createdAt": "1"}]}</script>'),
            ("repo", None, '<a href="/o/r/graphs/contributors">Contributors 74</a><a href="/o/r/forks">1.5k forks</a><a href="/o/r/issues">Issues 12</a>')]
    return spark.createDataFrame([(k, REPO, None, 1, n, f"{REPO}/{k}/{n}", h) for k, n, h in data], "page_kind string, repo_url string, pr_state string, page_no int, item_no bigint, url string, html string")


def test_pull_flow(spark):
    p, config = pages(spark), EngineConfig(closed_limit=4)
    found = pipeline.discovered(p, config)
    assert sorted((r.number, r.url) for r in found.collect()) == [(n, f"{REPO}/pull/{n}") for n in (4, 5, 6, 7)]
    schema = "repo_url string, number bigint, title string, state string, author string, created_at string, updated_at string, tags array<string>, comments array<struct<author:string,timestamp:string,content:string>>, url string, related_numbers array<bigint>, commit_id string"
    cached = spark.createDataFrame([(REPO, 6, "cached", "open", "x", None, None, [], [], "u", [], "")], schema)
    got = {r.number: r for r in pipeline.fetched(found, cached, p, config).collect()}
    assert sorted(got) == [6, 7] and got[6].title == "cached"
    assert (got[7].title, got[7].state, got[7].related_numbers, got[7].commit_id) == ("PR 7", "closed", [3, 4], "a" * 40)
    i = pipeline.issue_records(p, config).first()
    assert (i.number, i.title, i.ok, [c.content for c in i.comments]) == (3, "Issue three", True, ["from the page"])
    s = pipeline.repository_statistics(p, spark.createDataFrame([(REPO, 5000)], "repo_url string, number bigint")).first()
    assert (s.contributors_count, s.forks_count, s.open_issues, s.closed_issues, s.open_pull_requests, s.closed_pull_requests, s.pr_counts_available) == (74, 1500, 12, 1288, 1200, 2500, True)


def test_previous_commits(spark):
    commits = spark.createDataFrame([("r", 0, "c3"), ("r", 1, "c2"), ("r", 2, "c1")], "repo_url string, pos int, sha string")
    pulls = spark.createDataFrame([("r", 1, "c2"), ("r", 2, "c1"), ("r", 3, "zz"), ("r", 4, None)], "repo_url string, number bigint, commit_id string")
    assert {r.number: r.previous_commit_id for r in pipeline.with_previous(pulls, commits).collect()} == {1: "c1", 2: "", 3: "", 4: ""}


def test_output_flow_and_cli(spark, tmp_path, capsys):
    inputs = put(tmp_path / "go.json", json.dumps({"repositories": [{"url": "a", "stars": 50, "language": ["Go"]}, {"url": "b", "stars": 60}, {"url": "c", "stars": 5}, {"url": "d", "stars": 70}]}))
    (tmp_path / "out").mkdir()
    put(tmp_path / "out" / "old.jsonl", {"url": "b", "stars": 60})
    stats = spark.createDataFrame([("a", 4, True), ("d", 0, True)], "url string, closed_pull_requests bigint, pr_counts_available boolean")
    stats.write.parquet(str(tmp_path / "t/stats.parquet"))
    spark.createDataFrame([("a", n, "closed") for n in range(4)], "repo_url string, number bigint, state string").write.parquet(str(tmp_path / "t/pulls.parquet"))
    spark.createDataFrame([("a", 0, "c1")], "repo_url string, pos int, sha string").write.parquet(str(tmp_path / "t/commits.parquet"))
    args = ["-i", inputs, "-s", "10", "-o", str(tmp_path / "out"), "--asof", "2025-01-01T00:00:00"]
    assert cli.main([*args, "--dry-run"]) == 0 and "n_more" in capsys.readouterr().out
    assert cli.main([*args, "--tables", str(tmp_path / "t")]) == 0
    got = {r.url: r for r in spark.read.json(str(tmp_path / "out/go_crawled_stars_10.jsonl")).collect()}
    assert sorted(got) == ["a", "d"]
    assert (got["a"].meets_requirement, got["a"].crawl_success, [p.number for p in got["a"].pull_requests], got["a"].commit_ids) == (True, True, [3, 2, 1, 0], ["c1"])
    assert (got["d"].meets_requirement, got["d"].error_message) == (False, "no closed requests")
    assert cli.main(["-i", str(tmp_path / "missing.json")]) == 1


def test_settings():
    assert preset("latest_2000", min_stars=5) == EngineConfig(closed_limit=2000, min_stars=5)
    a = cli.arguments(["-i", "x", "--max-closed-prs", "7", "--skip-commits"])
    assert (cli.settings(a).closed_limit, cli.settings(a).with_commits) == (7, False)


def test_commit_history(spark, rows):
    a, b, c = ("a" * 40, "b" * 40, "c" * 40)
    page = lambda n, *s: ("commits", REPO, None, n, None, "", "".join(f'<a href="/o/r/commit/{x}">x</a>' for x in s))
    p = spark.createDataFrame([page(1, a, b), page(2, b, c), page(3), page(4, "d" * 40)], "page_kind string, repo_url string, pr_state string, page_no int, item_no bigint, url string, html string")
    assert rows(pipeline.commit_history(p, EngineConfig())) == [(REPO, 0, a), (REPO, 1, b), (REPO, 2, c)]
    assert rows(pipeline.commit_history(p, EngineConfig(commit_limit=1))) == [(REPO, 0, a)]
