import pytest
from pyspark.sql import functions as F

from forgelake.llm import chrome

NAV = [["Home", "Projects", "Issues", "Changes", "Boards"], ["Product", "Solutions", "Resources", "Company"], ["Home", "Groups", "lazyquery", "Tickets"], ["Skip to main content", "Code", "Tickets", "Merge queue", "Pipelines"], ["Docs", "Pricing", "Log in", "Sign up"], ["Home", "Groups", "calmdb", "Tickets"], ["Home", "Groups", "pinefold", "Tickets"]]
FOOT = [["Contact", "Security", "Status", "Manage cookies", "Privacy"], ["Aide", "Mentions légales", "Plan du site", "Back to top"], ["Copyright 2023 Codeharbor Ltd. All rights reserved.", "Plan du site", "Aide", "Confidentialité"], ["Already have an account? Log in", "Quote reply", "Follow"], ["Watchers", "18", "Linked work", "nothing linked", "Target release", "not set"], ["This conversation is locked for visitors.", "Report", "Copy link"], ["Please sign in to comment on this page.", "Print", "Share"], ["‹ Newer", "17", "18", "19", "Weiter", "Page rendered in 0.16 s"]]
NOTICE = [["We use cookies to measure traffic and show relevant tips.", "Preferences", "Got it"], ["We use cookies to measure traffic and show relevant tips.", "Accept all", "Reject"]]


def corpus():
    """Comments with the page around them, captured with its lines or separators, and comments without."""
    import random

    rng = random.Random(4)
    out = []
    for i in range(900):
        body = " ".join(f"The {rng.choice(['parser', 'cursor', 'loader'])} {rng.choice(['drops', 'keeps'])} row {i}, and nobody noticed it." for _ in range(rng.randrange(1, 4)))
        sep = rng.choice(["\n", " · ", " | ", "\n"])
        head = sep.join(rng.choice(NAV + NOTICE)) if rng.random() < 0.4 else ""
        tail = sep.join(rng.choice(FOOT)) if rng.random() < 0.4 else ""
        tail = f"Related threads{sep}{rng.choice('abcdef')}{i} skips request{sep}and batch {rng.choice('uvwxyz')}{i}{sep}Show all {i % 9}" if rng.random() < 0.05 else tail
        out.append("\n".join(x for x in (head, body, tail) if x))
    out += ["LGTM", "Thanks, merging.", "+1", "Closing as stale"] * 40 + [f"Kind regards\nAnn Example{i}\nMobile: {i}{i}" for i in range(60)]
    return [(t, False) for t in out]


def titles():
    extra = ["Log in", "Copy link", "Issue #1343", "Edit", "Subscribe", "Codeharbor", "Open menu", "Issues / Open", "Print view"]
    out = [(f"Fix the cursor of loader {i}", True) for i in range(200)] + [("Skip to content link has no focus style", True)] * 40
    return out + [(f"Bump the parser to {i}.{i % 7}{' - · |›—'[i % 4 + 1].join(['  '[:1]] * 2) if False else [' · ', ' | ', ' › '][i % 3]}{extra[i % len(extra)]}" if i % 9 not in (6, 7) else f"{extra[i % len(extra)]} · Bump the parser to {i}", True) for i in range(400)]


@pytest.fixture(scope="module")
def fit(spark):
    df = spark.createDataFrame(corpus() + titles(), "t string, k boolean")
    return chrome.fitted(df, "t", "k")


BODY = "Could you guard the null case, and maybe flush the header as well?\n\nThis change feels too broad."


@pytest.mark.parametrize("before, after", [
    ("Home · Groups · lazyquery · Tickets\n\n", "\n\n‹ Newer · 17 · 18 · 19 · Weiter · Page rendered in 0.16 s\n\nAide · Mentions légales · Back to top"), ("Skip to main content Code 95 Tickets Merge queue ", ""), ("", " Already have an account? Log in Quote reply Follow"),
    ("We use cookies to measure traffic and show relevant tips.PreferencesGot it\n", ""), ("", "\nWatchers28Linked worknothing linkedTarget releasenot set"), ("", "\nCopyright 2023 Codeharbor Ltd. All rights reserved.Plan du siteAideConfidentialité"),
    ("", "\nRelated threads\nevent bridge skips request\nconfig loader and batch\nShow all 5\nThis conversation is locked for visitors.\nReport"), ("", ""),
])
def test_page_text_comes_off(fit, before, after):
    page = fit[1][0].parts(before + BODY + after)
    assert bool(page) == bool(before or after)
    assert chrome.without(before + BODY + after, page) == BODY


@pytest.mark.parametrize("text", ["Our footer links Terms and Privacy twice, and the navigation menu hides the search box.", "The menu now shows Home, Docs, Pricing and Blog in that order.", "Skip links should come first, before the navigation.", "LGTM", "", "   ", "The cookie notice overlaps the sign in button.", "We set the Docs"])
def test_talk_about_pages_is_content(fit, text):
    assert fit[1][0].parts(text) == []


def test_block_within(fit):
    text = "first line.\nRelated threads\necho forge hides it\ndeep query\nShow all 8\nsecond line."
    assert chrome.without(text, fit[1][0].parts(text)) == "first line.\nsecond line."


@pytest.mark.parametrize("title, want", [("Cookie banner hides the label picker | Log in | Copy link | Issue #1343", "Cookie banner hides the label picker"), ("Skip to content link has no focus style", None), ("Skip to content link has no focus style › Edit", "Skip to content link has no focus style"), ("Remove old cursor from client/tiny_router.rb", None), ("Open menu - Fix the parser", "Fix the parser"), ("Issues / Open / docs: explain cursor", "docs: explain cursor"), ("Fix cursor #2028Log in — Subscribe", "Fix cursor #2028")])
def test_titles(fit, title, want):
    page = fit[1][1].parts(title)
    assert (chrome.without(title, page) if page else None) == want


def test_tagged_pages(spark):
    page = "<html><body><nav><ul>" + "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(12)) + "</ul></nav><article>" + "".join(f"<p>This is sentence {i}, and it says quite a lot; more than any menu does, doesn't it? {'Yes. ' * (i % 5)}</p>" for i in range(12)) + "</article><footer><a>Terms</a><a>Privacy</a></footer></body></html>"
    df = spark.createDataFrame([(1, page, False)], "id int, t string, k boolean")
    paths, grammars = chrome.fitted(df, "t", "k")
    assert any(p.endswith("a") for p in paths) and not any(p.endswith("article/p") for p in paths)
    clean = df.select(chrome.main_text(F.col("t"), F.col("k"), paths, grammars).alias("c")).first().c
    assert "Item 3" not in clean and "sentence 11" in clean


def test_columns(spark, fit):
    rows = [(1, "Docs | Pricing | Log in\n" + BODY, False), (2, None, False), (3, "", False), (4, "a. " * 50_000, False), (5, BODY, False), (5, BODY, False), (6, "Fix it · Subscribe", True)]
    df = spark.createDataFrame(rows, "id int, text string, is_title boolean")
    paths, grammars = fit
    got = sorted((r.id, r.f) for r in df.select("id", chrome.holds_page_text(F.col("text"), F.col("is_title"), paths, grammars).alias("f")).collect())
    assert got == [(1, True), (2, False), (3, False), (4, False), (5, False), (5, False), (6, True)]
    clean = {r.id: r.c for r in df.select("id", chrome.main_text(F.col("text"), F.col("is_title"), paths, grammars).alias("c")).collect()}
    assert (clean[1], clean[2], clean[3], clean[6]) == (BODY, None, "", "Fix it")
    paths, grammars = chrome.fitted(df.limit(0), "text", "is_title")
    assert (paths, grammars[0].items, grammars[1].items) == (set(), {}, {})


FRESH = [
    (["Home", "Forum", "Members", "Help"], []), (["We value your privacy and that of our partners.", "Manage choices", "Agree"], []), ([], ["Related articles", "Latest posts", "More from this author"]), ([], ["Tous droits réservés", "Politique", "Nous écrire"]),
]


def test_pages_of_other_sites_are_learned(spark):
    """Phrases that stand nowhere in this package: found where the layout is kept, and where it is lost."""
    bodies = [f"The tide came in at {i} that day, and the boats stayed out of the harbour until it was dark." for i in range(160)]
    rows = [(i, sep.join(head) + ("\n" if head else "") + b + ("\n" if tail else "") + sep.join(tail), bool(head or tail)) for i, b in enumerate(bodies) for head, tail in [FRESH[i // 2 % 4] if i % 2 else ([], [])] for sep in [["\n", " | ", " "][i % 3]]]
    df = spark.createDataFrame([(i, t, False, w) for i, t, w in rows], "id int, t string, k boolean, want boolean")
    got = df.withColumn("got", chrome.holds_page_text(F.col("t"), F.col("k"), *chrome.fitted(df, "t", "k"))).where("got != want").collect()
    assert got == []


def test_no_phrase_is_given():
    import inspect

    source = inspect.getsource(chrome).lower()
    assert not [w for w in ("cookie", "impressum", "privacy", "log in", "codeharbor", "home|", "rights reserved") if w in source]
