"""Scalar text and number operators, Column to Column, all inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The phrases that tie an issue number to a text, in order of precedence.
ISSUE_PATTERNS = [
    r"(?im)\b(?:fixes?|closes?|resolves?|addresses?)\s+(?:issue\s+)?#(\d++)(?!\s*in\s+[\w-]+/[\w-]+)",
    r"(?im)\b(?:fix|close|resolve|address)\s+(?:issue\s+)?#(\d++)(?!\s*in\s+[\w-]+/[\w-]+)",
    r"(?im)\b(?:issue|bug|problem)\s+#(\d++)(?!\s*in\s+[\w-]+/[\w-]+)",
    r"(?im)\b(?:see|related\s+to|duplicate\s+of|duplicates?)\s+(?:issue\s+)?#(\d++)(?!\s*in\s+[\w-]+/[\w-]+)",
    r"(?m)(?:^|(?<=\s))#(\d++)(?=\s|$|[^\w/])",
]
ELSEWHERE = r"(?i)[\w-]+/[\w-]+#\d+|#\d+\s+in\s+[\w-]+/[\w-]+"

# What a page puts around the text of an issue, in order of removal.
BODY_NOISE = [
    r"(?i)^Description[a-zA-Z0-9\s]*opened\s*on\s*[a-zA-Z0-9\s,]*Issue body actions",
    r"(?i)^[a-zA-Z0-9\s]*opened\s*on\s*[a-zA-Z0-9\s,]*Issue body actions",
    r"(?i)Issue body actions",
    r"(?i)Description\s*",
    r"(?i)opened\s*on\s*[a-zA-Z0-9\s,]*",
]

# How a page tells the commit a request was merged with, in order.
MERGE_PATTERNS = [
    r"(?i)merged commit ([a-f0-9]{7,40}) into",
    r"(?i)merged ([a-f0-9]{7,40}) into",
    r"(?i)merge commit ([a-f0-9]{7,40})",
    r"(?i)commit ([a-f0-9]{7,40}) was merged",
    r"(?i)merged pull request.*?([a-f0-9]{7,40})",
]


def strip(c: Column) -> Column:
    """Without any white space around (not only blanks)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def none_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """The first match of a group, or null."""
    return none_if_empty(F.regexp_extract(c, pattern, group))


def without_suffix(url: Column) -> Column:
    """A link without fragment and query."""
    return F.split_part(F.split_part(url, F.lit("#"), F.lit(1)), F.lit("?"), F.lit(1))


def pull_number(url: Column) -> Column:
    """The number of a request from its link, whatever follows it."""
    return first_match(without_suffix(url), r"/pull/(\d+)").try_cast("bigint")


def strict_number(url: Column) -> Column:
    """The number behind the last /pull/, null if anything else follows."""
    return F.when(F.contains(url, F.lit("/pull/")), F.substring_index(url, "/pull/", -1).try_cast("bigint"))


def canonical_pull(url: Column) -> Column:
    """The link of a request without what points below it."""
    return first_match(without_suffix(url), r"^(.*?/pull/\d+)")


def repo_prefix(url: Column) -> Column:
    """The first five parts of a link: its repository."""
    return F.substring_index(url, "/", 5)


def owner_repo(url: Column, host: str = r"[^/]+") -> Column:
    return first_match(url, rf"^https?://{host}/([^/]+/[^/#?]+)")


def absolute(href: Column, repo_url: Column) -> Column:
    """A link as written in a page of repo_url, made absolute."""
    host = F.regexp_extract(repo_url, r"^(https?://[^/]+)", 1)
    return F.when(href.startswith("/"), F.concat(host, href)).when(href.rlike("^https?://"), href).otherwise(F.concat(F.regexp_replace(repo_url, "/+$", ""), F.lit("/"), href))


def is_repo_url(url: Column, host: str = r"[^/]+") -> Column:
    return url.rlike(rf"^https://{host}/[^/]+/[^/]+/?$")


def belongs_to(url: Column, repo_url: Column) -> Column:
    """Whether a link leads to a request of the repository (a prefix decides)."""
    return url.startswith(F.concat(F.regexp_replace(repo_url, "/+$", ""), F.lit("/pull/"))) & url.rlike(r"/pull/\d+")


def is_sha(c: Column) -> Column:
    return c.rlike(r"(?i)^[a-f0-9]{7,40}$")


def full_shas(c: Column) -> Column:
    """The distinct 40-digit ids in a text, in order."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?i)\b([a-f0-9]{40})\b"), F.lit(1)))


def commit_links(html: Column) -> Column:
    """The distinct ids that commit links lead to, in order."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r"/commit/([a-f0-9]{40})"), F.lit(1)))


def issue_refs(c: Column) -> Column:
    """The issue numbers a text refers to: kept once, by precedence of the phrase, then by place.

    If the text names an issue of another repository anywhere, only the first
    three, unmistakable phrases count.
    """
    each = [F.regexp_extract_all(c, F.lit(p), F.lit(1)) for p in ISSUE_PATTERNS]
    picked = F.when(c.rlike(ELSEWHERE), F.flatten(F.array(*each[:3]))).otherwise(F.flatten(F.array(*each)))
    return F.array_distinct(F.transform(F.filter(picked, lambda x: x.try_cast("bigint").isNotNull()), lambda x: x.cast("bigint")))


def issue_link_refs(html: Column) -> Column:
    """The issue numbers that links lead to, once each, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(r"/issues/(\d{1,18})"), F.lit(1)), lambda x: x.cast("bigint")))


def valid_issue(n: Column, low: int = 1, high: int = 100_000) -> Column:
    return n.between(low, high)


def clean_title(c: Column) -> Column:
    """A title up to its first number sign."""
    return strip(F.split_part(c, F.lit("#"), F.lit(1)))


def clean_body(c: Column) -> Column:
    """A body without the page's words in and around it, white space collapsed."""
    for p in BODY_NOISE:
        c = F.regexp_replace(c, p, "")
    return strip(F.regexp_replace(c, r"\s+", " "))


def shortened(c: Column, most: int = 2000) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("..."))).otherwise(c)


def state_word(c: Column) -> Column:
    """merged, closed or open by the word the text holds; open if it holds none."""
    low = F.lower(c)
    return F.when(F.contains(low, F.lit("merged")), "merged").when(F.contains(low, F.lit("closed")), "closed").otherwise("open")


def issue_state_word(c: Column) -> Column:
    low = F.lower(c)
    return F.when(F.contains(low, F.lit("open")), "open").when(F.contains(low, F.lit("closed")), "closed").otherwise("open")


def merge_sha(text: Column) -> Column:
    """The commit id a text says a request was merged with, by the first phrase that has one."""
    return F.coalesce(*[first_match(text, p) for p in MERGE_PATTERNS])


def says_merged(text: Column) -> Column:
    return text.rlike(r"(?is)merged.*into.*(?:main|master)") | text.rlike(r"(?i)\bmerged\s+(?:commit|pull request)\b")


def merge_context(text: Column) -> Column:
    low = F.lower(text)
    return F.contains(low, F.lit("merged")) | F.contains(low, F.lit("merge")) | F.contains(low, F.lit("into main")) | F.contains(low, F.lit("into master"))


def status_message(code: Column) -> Column:
    """What an HTTP status means for a capture."""
    return F.when(code == 404, "not found").when(code == 403, "forbidden").when(code == 429, "rate limited").when(code >= 500, "server error").otherwise(F.concat(F.lit("status "), code.cast("string")))


def is_rate_limit(error: Column) -> Column:
    low = F.lower(error)
    return F.contains(low, F.lit("429")) | F.contains(low, F.lit("rate limit"))


def is_retryable(error: Column) -> Column:
    """Client errors are for good; other failures may pass."""
    code = first_match(error, r"\b([1-5]\d\d)\b").try_cast("int")
    return F.when(code.between(400, 499), False).otherwise(error.isNotNull())


def duration(seconds: Column) -> Column:
    two = lambda x, unit: F.format_string(f"%.2f {unit}", x)
    return F.when(seconds < 60, two(seconds, "s")).when(seconds < 3600, two(seconds / 60, "min")).otherwise(two(seconds / 3600, "h"))


def page_markers(html: Column) -> Column:
    """Which hints of an unusable page a text holds."""
    low = F.lower(html)
    has = lambda w: F.contains(low, F.lit(w))
    return F.struct(has("rate limit").alias("rate_limited"), (has("no results") | has("there aren")).alias("empty"), (has("sign in") | has("log in")).alias("login"))


def first_integer(c: Column) -> Column:
    return first_match(F.regexp_replace(c, r"[,\s]", ""), r"(\d+)").try_cast("bigint")


def compact_count(c: Column) -> Column:
    """74.8k, 1.2m and 1,234 as integers; decimals are exact, so 32.3k is 32300."""
    m = F.lower(F.regexp_replace(c, r"[,\s]", ""))
    number = first_match(m, r"(\d+(?:\.\d+)?)").try_cast("decimal(18,6)")
    times = F.when(m.rlike(r"\dk"), 1000).when(m.rlike(r"\dm"), 1_000_000).otherwise(1)
    return F.floor(number * times).cast("bigint")
