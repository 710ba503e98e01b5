"""The whole scan as one plan over landed tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift import fixed_values as fv
from runsift.functions.outcomes import github_code, travis_code
from runsift.operators.discover import (
    TRAVERSAL,
    cut_page_chains,
    drop_seen,
    drop_seen_pairs,
    first_seen,
    search_hits,
    split_rejects,
)
from runsift.operators.logs import with_outcomes
from runsift.operators.providers import detect_providers, fan_out
from runsift.operators.readiness import bound_steps, fold_jobs, fold_runs, job_steps, run_steps
from runsift.operators.results import repo_details, union_branches, upsert, with_details
from runsift.plans.materialise import materialise
from runsift.schemas import RESULT_KEY
from runsift.settings import Settings


@dataclass(frozen=True)
class Landed:
    """The landed tables one scan reads."""

    repo_pages: DataFrame
    ci_probes: DataFrame
    run_pages: DataFrame
    travis_build_pages: DataFrame
    responses: DataFrame
    travis_responses: DataFrame


def evaluate_github(slugs: DataFrame, run_pages: DataFrame, responses: DataFrame, settings: Settings) -> DataFrame:
    """Status of each slug that has landed run pages.

    Pages are reduced to steps at the scan, steps to those that can decide
    before they meet the responses.
    """
    steps = run_steps(run_pages).join(slugs, "slug", "left_semi")
    judged = with_outcomes(bound_steps(steps, settings), responses, github_code)
    return fold_runs(judged, settings, ("page", "pos"), bounded=True).withColumn("provider", F.lit(fv.GITHUB))


def evaluate_travis(slugs: DataFrame, build_pages: DataFrame, responses: DataFrame, settings: Settings) -> DataFrame:
    """Status of each slug that has a landed build list."""
    steps = job_steps(build_pages.join(slugs, "slug", "left_semi"), settings)
    judged = with_outcomes(steps, responses, travis_code)
    return fold_jobs(judged, settings).withColumn("provider", F.lit(fv.TRAVIS))


def found_repositories(repo_pages: DataFrame) -> DataFrame:
    """Repositories of the landed search pages, each once, with the segment of its first hit."""
    hits, _ = split_rejects(search_hits(cut_page_chains(repo_pages)))
    return first_seen(hits)


def rejected_hits(repo_pages: DataFrame) -> DataFrame:
    """Hits of the landed search pages that no scan can take up, for lack of a usable slug; to be written or counted."""
    return split_rejects(search_hits(cut_page_chains(repo_pages)))[1]


def open_pairs(
    landed: Landed, results: DataFrame, limit: int | None = None, per_provider: bool = False
) -> DataFrame:
    """(repository, provider) rows to evaluate in this pass.

    A repository with any processed result is left out; with ``per_provider``
    only its processed providers are. The limit counts repositories.
    """
    repos = found_repositories(landed.repo_pages)
    if not per_provider:
        repos = drop_seen(repos, results)
        if limit is not None:
            repos = repos.orderBy(*TRAVERSAL).limit(limit)
        return fan_out(repos, detect_providers(landed.ci_probes))
    pairs = drop_seen_pairs(fan_out(repos, detect_providers(landed.ci_probes)), results)
    if limit is None:
        return pairs
    taken = pairs.select("slug", *TRAVERSAL).distinct().orderBy(*TRAVERSAL).limit(limit)
    return pairs.join(taken.select("slug"), "slug", "left_semi")


def scan_updates(
    landed: Landed,
    results: DataFrame,
    settings: Settings,
    checked_at: Column,
    limit: int | None = None,
    per_provider: bool = False,
) -> DataFrame:
    """Result rows of one pass, as updates for the result table."""
    pairs = materialise(open_pairs(landed, results, limit, per_provider))
    provider = F.col("provider")
    github = pairs.filter(provider == fv.GITHUB).select("slug")
    travis = pairs.filter(provider == fv.TRAVIS).select("slug")
    evaluated = union_branches(
        evaluate_github(github, landed.run_pages, landed.responses, settings),
        evaluate_travis(travis, landed.travis_build_pages, landed.travis_responses, settings),
    )
    # A pair without landed lists: the request for its list failed.
    list_failed, failed_text = fv.GITHUB_REASONS["list_failed"]
    no_builds, no_builds_text = fv.TRAVIS_REASONS["list_empty"]
    skipped = provider == fv.NO_PROVIDER
    rows = with_details(repo_details(pairs, checked_at, "provider"), evaluated, RESULT_KEY).withColumns(
        {
            "status": F.when(skipped, fv.SKIPPED)
            .when(provider == fv.GITHUB, F.coalesce("status", F.lit(list_failed)))
            .otherwise(F.coalesce("status", F.lit(no_builds))),
            "message": F.when(skipped, fv.NO_PROVIDER_MESSAGE)
            .when(provider == fv.GITHUB, F.coalesce("message", F.lit(failed_text % "no page landed")))
            .otherwise(F.coalesce("message", F.lit(no_builds_text))),
            "builds_found": F.coalesce("builds_found", F.lit(0)),
        }
    )
    fields = [c for c in rows.columns if c not in RESULT_KEY]
    return rows.withColumns(
        {
            "set_fields": F.when(skipped, F.array(*[F.lit(c) for c in ("status", "checked_at", "message")])).otherwise(
                F.array(*[F.lit(c) for c in fields])
            ),
            "seq": F.lit(0),
        }
    )


def scan(
    landed: Landed,
    results: DataFrame,
    settings: Settings,
    checked_at: Column | None = None,
    limit: int | None = None,
    per_provider: bool = False,
) -> DataFrame:
    """The result table after one pass."""
    now = F.current_timestamp() if checked_at is None else checked_at
    return upsert(results, scan_updates(landed, results, settings, now, limit, per_provider), RESULT_KEY)
