"""Record layouts of captured collaboration data, as DDL that readers take as it is."""

_COMMENTS = "array<struct<author:string,timestamp:string,content:string>>"
_ISSUE = f"number:bigint,title:string,state:string,author:string,created_at:string,updated_at:string,tags:array<string>,comments:{_COMMENTS},url:string"
_STATS = "contributors_count:bigint,forks_count:bigint,total_issues:bigint,open_issues:bigint,closed_issues:bigint,total_pull_requests:bigint,open_pull_requests:bigint,closed_pull_requests:bigint,pr_counts_available:boolean"
_PULL = f"number:bigint,title:string,state:string,author:string,created_at:string,updated_at:string,tags:array<string>,comments:{_COMMENTS},related_issues:array<struct<{_ISSUE}>>,url:string,commit_ids:array<string>,commit_id:string,previous_commit_id:string"


def ddl(fields: str) -> str:
    """Fields of a struct type as top-level columns."""
    out, depth = [], 0
    for part in fields.split(","):
        (out.append(part) if not depth else out.append(out.pop() + "," + part))
        depth += part.count("<") - part.count(">")
    return ", ".join(f"{n} {t}" for n, t in (p.split(":", 1) for p in out))


COMMENT = "author string, timestamp string, content string"
ISSUE = ddl(_ISSUE)
PULL_REQUEST = ddl(_PULL)
STATS = ddl(_STATS)
CRAWLED = f"url string, stars bigint, language array<string>, stats struct<{_STATS}>, pull_requests array<struct<{_PULL}>>, commit_ids array<string>, crawl_timestamp string, crawl_success boolean, error_message string"
INPUT = "language string, summary struct<total_repositories:bigint,total_stars:bigint,average_stars:double,top_repository:struct<url:string,stars:bigint>>, repositories array<struct<url:string,stars:bigint,language:array<string>>>"
CRAWL_STATE = "repo_url string, total_prs_expected bigint, discovered_pr_urls array<string>, scraped_pr_numbers array<bigint>, failed_pr_urls array<string>, last_open_page bigint, last_closed_page bigint, open_pages_complete boolean, closed_pages_complete boolean, discovery_complete boolean, scraping_complete boolean, open_prs_found bigint, closed_prs_found bigint, commit_ids array<string>, pr_commit_mapping map<string,array<string>>"
FAILURES = "failed_issues map<string,map<string,double>>, failed_repositories map<string,struct<reason:string,timestamp:double>>, failure_counts map<string,bigint>, blocked_until map<string,double>, last_updated double"
PAGE = "page_kind string, repo_url string, pr_state string, page_no int, item_no bigint, url string, html string"
