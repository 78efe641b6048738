"""Settings of a run, with named presets. Values are typed; nothing is read from the environment."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class EngineConfig:
    min_stars: int = 1000
    closed_limit: int = 500
    limit_by_repo: dict[str, int] = field(default_factory=dict)
    keep_open: bool = False
    keep_closed: bool = True
    commit_limit: int = 500
    with_commits: bool = True
    coverage: float = 0.9
    warn_below: float = 0.8
    rounds: int = 5
    empty_pages: int = 3
    issues_from_page: int = 10
    issues_per_pull: int = 5
    issue_numbers: tuple[int, int] = (1, 100_000)
    comment_min: int = 5
    comment_max: int = 2000
    body_min: int = 50
    breaker_failures: int = 10
    breaker_seconds: int = 300
    failure_ttl_seconds: int = 604_800
    fresh_days: int = 30
    purge_days: int = 60


PRESETS = {
    "latest_1000": EngineConfig(closed_limit=1000),
    "latest_2000": EngineConfig(closed_limit=2000),
    "latest_5000": EngineConfig(closed_limit=5000),
    "latest_10000": EngineConfig(closed_limit=10_000),
    "open_only": EngineConfig(keep_open=True, keep_closed=False),
    "recent_closed": EngineConfig(keep_open=False, keep_closed=True),
}


def preset(name: str, **changes) -> EngineConfig:
    """A preset with some values changed."""
    return replace(PRESETS[name], **changes)
