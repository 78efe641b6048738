import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forgelake.functions import html as H
from forgelake.functions import jsonx as J
from forgelake.functions import text as X


@pytest.fixture(scope="module")
def on(spark):
    """The value of an expression for one text."""
    def run(f, *values):
        df = spark.createDataFrame([values], ", ".join(f"c{i} {'bigint' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for i, v in enumerate(values)))
        return df.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("r")).first().r

    return run


@pytest.mark.parametrize("text, want", [
    ("fixes #123 in foo/bar", []), ("#1 #2 #3", [1, 2, 3]), ("#1, #2, #3", [1, 2, 3]), ("prefixes #6", [6]), ("see other/repo#9 and fixes #4", [4]), ("Closes issue #7. See #8, bug #9", [7, 9, 8]),
    ("fix #5 and resolves #5", [5]), ("", []), (None, None), ("#99999999999999999999", []), ("x" * 50_000 + " #3", [3]),
])
def test_issue_refs(on, text, want):
    assert on(X.issue_refs, text) == want


def test_body_title_length(on):
    noisy = "Descriptionalice opened on Jan 1, 2024Issue body actions It crashes when opened on Windows 11, then hangs. Description follows"
    assert on(X.clean_body, noisy) == "It crashes when . follows"
    assert on(X.shortened, "x" * 2000) == "x" * 2000
    assert on(X.shortened, "x" * 2001) == "x" * 2000 + "..."
    assert on(X.clean_title, "  Crash on start #12 ") == "Crash on start"
    assert on(X.strip, "\t a \n") == "a" and on(X.strip, None) is None


@pytest.mark.parametrize("text, want", [("74.8k", 74_800), ("32.3k", 32_300), ("1,234", 1234), ("1.2k", 1200), ("2M", 2_000_000), ("12 contributors", 12), ("none", None), (None, None), ("", None)])
def test_compact_count(on, text, want):
    assert on(X.compact_count, text) == want


def test_links(on):
    u = "https://forge.example/a/b/pull/12/files?w=1#top"
    assert on(X.without_suffix, u) == "https://forge.example/a/b/pull/12/files"
    assert (on(X.pull_number, u), on(X.strict_number, u), on(X.canonical_pull, u)) == (12, None, "https://forge.example/a/b/pull/12")
    assert (on(X.repo_prefix, u), on(X.owner_repo, u)) == ("https://forge.example/a/b", "a/b")
    repo = "https://forge.example/a/b"
    assert on(X.absolute, "/x/y", repo) == "https://forge.example/x/y"
    assert on(X.absolute, "pull/3", repo) == repo + "/pull/3"
    assert on(X.absolute, "http://other/z", repo) == "http://other/z"
    assert on(X.belongs_to, u, repo) and not on(X.belongs_to, "https://forge.example/a/bb/pull/1", repo)
    assert on(X.is_repo_url, repo) and not on(X.is_repo_url, u)


def test_words(on):
    assert [on(X.state_word, s) for s in ("Merged", "Closed", "Draft", None)] == ["merged", "closed", "open", "open"]
    assert [on(X.status_message, c) for c in (404, 403, 429, 503, 418)] == ["not found", "forbidden", "rate limited", "server error", "status 418"]
    assert on(X.is_rate_limit, "HTTP 429") and on(X.is_rate_limit, "Rate Limit hit") and not on(X.is_rate_limit, "timed out")
    assert [on(X.is_retryable, e) for e in ("HTTP 404", "HTTP 503", "timed out", None)] == [False, True, True, False]
    assert [on(X.duration, s) for s in (5.0, 90.0, 7200.0)] == ["5.00 s", "1.50 min", "2.00 h"]
    assert tuple(on(X.page_markers, "Rate limit. Please sign in")) == (True, False, True)


def test_commits(on):
    sha = "a" * 39 + "1"
    assert on(X.merge_sha, f"alice merged commit {sha} into main") == sha
    assert on(X.merge_sha, "merged 343ec48 into dev") == "343ec48"
    assert on(X.merge_sha, "nothing here") is None
    assert on(X.full_shas, f"{sha} {sha} {'b' * 40} {'c' * 41}") == [sha, "b" * 40]
    assert on(X.commit_links, f'<a href="/r/commit/{sha}">x</a><a href="/r/commit/{sha}">y</a>') == [sha]
    assert [on(X.is_sha, s) for s in ("abc1234", "ABC1234", "abc", "g" * 8)] == [True, True, False, False]
    assert on(X.merge_context, "into main") and on(X.says_merged, "Bob MERGED 2 commits into main")


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(text=st.text(st.sampled_from("fixes closes #12 3\n,./ab"), max_size=60))
def test_patterns_as_in_python(on, text):
    for p in X.ISSUE_PATTERNS:
        got = on(lambda c: F.regexp_extract_all(c, F.lit(p), F.lit(1)), text)  # noqa: B023
        assert got == [m[1] for m in re.finditer(p, text)]


PAGE = """<html><head><title>T</title><script>var s = "</p>";</script><style>x</style></head><body><!-- no -->
<h1 class="gh-header-title">Fix <b>crash</h1><span class="State State--merged">Merged</span>
<div class="timeline-comment"><div class="timeline-comment-header"><a class="author">ann</a><relative-time datetime="2024-02-02T00:00:00Z">x</relative-time></div><div class="comment-body">second comment text</div></div>
<div class="timeline-comment"><a class="author">bob</a><time datetime="2024-01-01T00:00:00Z"></time><div class="comment-body">first &amp; oldest</div></div>
<div class="timeline-comment"><div class="comment-body">second comment text</div></div><div class="timeline-comment"><div class="comment-body">abc</div></div>
<div class="js-issue-labels"><a class="IssueLabel">bug</a><a class="IssueLabel">bug</a></div><p>unclosed<br>line</body></html>"""


def test_page_fields(spark):
    r = spark.createDataFrame([(PAGE,), (None,), ("",), ("<<<>>>",)], "h string").select(H.page_fields(F.col("h")).alias("f")).collect()
    f = r[0].f
    assert (f.title, f.state, f.author, f.created_at, f.tags) == ("Fix crash", "merged", "ann", "2024-02-02T00:00:00Z", ["bug", "bug"])
    assert [(c.author, c.timestamp, c.content) for c in f.comments] == [("bob", "2024-01-01T00:00:00Z", "first & oldest"), ("ann", "2024-02-02T00:00:00Z", "second comment text")]
    assert r[1].f.title is None and (r[2].f.title, r[2].f.author, r[2].f.comments) == ("", "unknown", [])
    i = spark.createDataFrame([(PAGE,)], "h string").select(H.page_fields(F.col("h"), True).alias("f")).first().f
    assert i.tags == ["bug"] and i.state == "open"


ISSUE = """<h1 class="x-PageHeader_Title-1">Broken loader #12</h1><span class="State State--closed">Closed</span><div class="sidebar-labels"><a class="IssueLabel">a</a></div><div class="labels"><i class="label">b</i></div>
<div data-testid="issue-body">It is broken here.</div><div data-testid="x-comment-1"><a class="author">bo</a><div class="comment-body">we see it, too</div></div>"""


def test_issue_fields(spark):
    f = spark.createDataFrame([(ISSUE,)], "h string").select(H.page_fields(F.col("h"), True).alias("f")).first().f
    assert (f.title, f.state, f.tags, f.body, [(c.author, c.content) for c in f.comments]) == ("Broken loader", "closed", ["a", "b"], "It is broken here.", [("bo", "we see it, too")])


def test_tree_and_selectors():
    root = H.tree(PAGE)
    assert H.select(root, "div.timeline-comment a.author")[0].text() == "ann"
    assert [e.tag for e in H.select(root, "[datetime^='2024-01']")] == ["time"]
    assert "var s" not in root.text() and "second comment text" in root.text()
    with pytest.raises(ValueError):
        H.select(root, "a:hover")


def test_html_columns(spark, on):
    assert on(H.title_of, "<h1 class=x> A <i>b</i>\n c</h1><title>t</title>") == "A b c"
    assert on(H.title_of, "<title>t</title>") == "t" and on(H.title_of, "none") == ""
    assert on(H.hrefs, '<a class="x" href="/1">a</a><A HREF="/2">b</A><link href="/3">') == ["/1", "/2"]
    assert on(H.tags_of, "<Div><p><div><br></p>") == ["div", "p", "br"]
    assert on(lambda c: H.anchor_texts(c, "/forks"), '<a href="/x/forks"><b>1.2k</b> forks</a><a href="/y">z</a>') == ["1.2k forks"]
    assert on(H.html_text, "<p> a <b>b</b></p>") == "ab" and on(H.html_text, None) is None
    spark.udtf.register("html_links", H.HtmlLinks)
    page = '<a href="/r/pull/2">x</a><div class="js-issue-row"><a href="/r/pull/1">y</a></div><h3><a href="/r/pull/1">z</a></h3>'
    assert [(r.pos, r.href) for r in spark.sql("select * from html_links(:p)", {"p": page}).collect()] == [(0, "/r/pull/1"), (1, "/r/pull/2")]


def page_with(data):
    return f"<script>window.x = 1</script><script type='application/json'> {data} </script>"


def test_json_comments(on):
    edge = '{"node": {"__typename": "IssueComment", "body": "hello there", "author": {"login": "ann"}, "createdAt": "2"}}'
    other = '{"node": {"__typename": "LabeledEvent", "body": "not a comment"}}'
    layouts = [
        '{"payload": {"preloadedQueries": [{"a": 1}, {"result": {"data": {"repository": {"issue": {"frontTimelineItems": {"edges": [%s, %s]}}}}}}]}}' % (edge, other),
        '{"payload": {"preloaded_records": {"x": 1, "TimelineA": [{"body": "hello there", "author": "ann", "created_at": "2"}]}}}',
        '{"timeline": [{"comment": {"bodyText": "hello there", "author": {"name": "ann"}, "createdAt": "2"}}, {"body": "abc"}]}',
        '{"comments": [{"body": "hello there", "author": {"login": "ann"}, "createdAt": "2"}, {"body": "hello there"}]}',
    ]
    for data in layouts:
        assert [(c.author, c.timestamp, c.content) for c in on(J.page_comments, page_with(data))] == [("ann", "2", "hello there")], data
    both = '{"timeline": [{"body": "from timeline"}], "comments": [{"body": "from comments"}]}'
    assert [c.content for c in on(J.page_comments, page_with(both))] == ["from timeline"]
    post = '{"@type": "DiscussionForumPosting", "articleBody": "ab", "author": {"name": "zoe"}, "datePublished": "1"}'
    assert [(c.author, c.content) for c in on(J.page_comments, page_with(post))] == [("zoe", "ab")]
    assert on(J.page_comments, page_with("{broken")) == [] and on(J.page_comments, "no script") == [] and on(J.page_comments, None) is None


def test_counts_and_commits_of_pages(on):
    def counts(html):
        r = on(H.state_counts, html)
        return r.open, r.closed

    assert counts('<a href="/o/r/issues?q=is%3Aopen">1.2k Open</a><a href="/o/r/issues?q=is%3Aclosed"><b>3,400</b> Closed</a>') == (1200, 3400)
    assert counts('<a href="/o/r/issues?q=is%3Aopen">12</a><p>Closed (7)</p>') == (12, 7)
    assert counts('<a href="/o/r/issues">Issues 5</a>') == (5, None) and counts("nothing") == (None, None)
    assert on(lambda c: H.link_count(c, "/u/"), '<a href="/u/1">a</a><a href="/u/2">b</a><a href="/x">c</a>') == 2
    sha = "f" * 40
    d = on(H.commit_details, f'<p class="commit-title">Fix <b>it</b></p><a href="/r/commit/{sha}">x</a><a class="commit-author">ann</a><relative-time datetime="2024-01-01T00:00:00Z">')
    assert (d.sha, d.message, d.author, d.date) == (sha, "Fix it", "ann", "2024-01-01T00:00:00Z") and on(H.commit_details, "").sha is None
