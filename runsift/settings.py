"""Settings record handed to the operators."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from runsift import fixed_values as fv


@dataclass(frozen=True)
class Settings:
    languages: tuple[str, ...] = fv.LANGUAGES
    min_builds: int = fv.MIN_BUILDS
    failure_limit: int = fv.FAILURE_LIMIT
    travis_builds: int = fv.TRAVIS_BUILDS
    search_sort: str = fv.SEARCH_SORT
    search_order: str = fv.SEARCH_ORDER
    search_per_page: int = fv.SEARCH_PER_PAGE
    search_pages: int = fv.SEARCH_PAGES
    min_stars: int = fv.MIN_STARS
    updated_since: str = fv.UPDATED_SINCE
    # Date segments as written: mappings with two ends, or pairs.
    search_segments: tuple[object, ...] = ()
    segment_start: str = ""
    segment_end: str = ""
    retry_count: int = fv.RETRY_COUNT
    retry_base_delay_seconds: float = fv.RETRY_BASE_DELAY_SECONDS
    sleep_on_429_seconds: int = fv.SLEEP_ON_429_SECONDS
    loop_sleep_seconds: int = fv.LOOP_SLEEP_SECONDS
    github_api_url: str = fv.GITHUB_API
    travis_api_url: str = fv.TRAVIS_API
    # A key that may hold a large share of all rows is cut into this many parts
    # before its rows meet in one task. On a cluster: about the shuffle partitions.
    hot_key_splits: int = 16

    def __post_init__(self) -> None:
        if self.min_builds < 1:
            raise ValueError("min_builds must be at least 1")
        if self.failure_limit < 1:
            raise ValueError("failure_limit must be at least 1")
        if isinstance(self.languages, str):
            raise ValueError("languages must be a list, not one string")
        if isinstance(self.search_segments, str) or any(isinstance(s, str) for s in self.search_segments):
            raise ValueError("a segment has two ends; one string is none")

    @classmethod
    def from_mapping(cls, raw: Mapping[str, object]) -> "Settings":
        """Settings from a loaded configuration file; unknown keys are dropped."""
        known = {f.name for f in fields(cls)}
        given = {k: v for k, v in raw.items() if k in known}
        if isinstance(given.get("languages"), list):
            given["languages"] = tuple(str(item) for item in given["languages"])
        if isinstance(given.get("search_segments"), list):
            given["search_segments"] = tuple(given["search_segments"])
        return cls(**given)

    @property
    def step_bound(self) -> int:
        """Steps that decide a repository.

        Undecided, a repository has at most ``min_builds - 1`` good logs and
        ``min_builds`` failure runs shorter than ``failure_limit``; one step
        more always stops it. One row is added for the marker of a first page
        without any run worth a request.
        """
        return self.min_builds * self.failure_limit + 1
