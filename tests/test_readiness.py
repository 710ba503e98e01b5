"""Stop rules: chosen cases, random sequences against the step-by-step rule, and laws."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import sequential
from runsift import Settings
from runsift import fixed_values as fv
from runsift.functions.outcomes import github_code, travis_code
from runsift.operators import logs, readiness, results

SMALL = Settings(min_builds=3, failure_limit=4, hot_key_splits=3)
OUTCOMES = ["ok", "gone", "auth", "error"]


def folded(spark, cases, chosen, **kwargs):
    rows = [(name, i, o) for name, outcomes in cases.items() for i, o in enumerate(outcomes)]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "slug STRING, seq LONG, outcome STRING")
    return {r.slug: (r.status, r.builds_found, r.message) for r in readiness.fold_runs(frame, chosen, **kwargs).collect()}


def expected(outcomes, chosen, event=None):
    reason, found = sequential.fold_runs([(o, None) for o in outcomes], chosen.min_builds, chosen.failure_limit)
    status, message = fv.GITHUB_REASONS[reason]
    return status, found, message.replace("%s", str(chosen.failure_limit))


def test_chosen_runs(spark):
    chosen = Settings()
    cases = {
        "nine-ok-nine": ["error"] * 9 + ["ok"] + ["gone"] * 9,
        "tenth-gone": ["error"] * 9 + ["gone"] + ["ok"] * 40,
        "tenth-error": ["gone"] * 9 + ["error"] + ["ok"] * 40,
        "auth-after-nine": ["gone"] * 9 + ["auth"],
        "ready": ["ok"] * 30 + ["auth"],
        "one-short": ["ok"] * 29,
        "worst-case": (["gone"] * 9 + ["ok"]) * 29 + ["error"] * 9 + ["ok"],
        "worst-case-failing": (["gone"] * 9 + ["ok"]) * 29 + ["error"] * 10,
    }
    got = folded(spark, cases, chosen)
    assert got == {name: expected(outcomes, chosen) for name, outcomes in cases.items()}
    assert got["tenth-gone"] == ("logs_gone", 0, "Logs removed (404) consecutively 10 times, stop scanning.")
    assert got["tenth-error"][0] == "error" and got["ready"][:2] == ("ready", 30) and got["worst-case"][:2] == ("ready", 30)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(OUTCOMES + ["ok", "gone", "error"] * 3), min_size=1, max_size=60), min_size=50, max_size=200))
def test_runs_match_the_rule(spark, sequences):
    cases = {f"o/{i}": seq for i, seq in enumerate(sequences)}
    want = {name: expected(seq, SMALL) for name, seq in cases.items()}
    assert folded(spark, cases, SMALL) == want


def test_splitting_and_bounding_change_nothing(spark):
    rnd = random.Random(7)
    cases = {f"o/{i}": rnd.choices(OUTCOMES[:2] + OUTCOMES[3:], weights=[1, 2, 1], k=rnd.randint(1, 80)) for i in range(60)}
    plain = folded(spark, cases, Settings(min_builds=3, failure_limit=4, hot_key_splits=1))
    assert plain == folded(spark, cases, SMALL) == folded(spark, cases, Settings(min_builds=3, failure_limit=4, hot_key_splits=50))
    unbounded = folded(spark, cases, Settings(min_builds=3, failure_limit=4), bounded=True)
    assert plain == unbounded


PERSON, BOT = json.dumps({"login": "ann", "type": "User"}), json.dumps({"login": "x", "type": "Bot"})
RUN_PAGES = (
    "slug STRING, page INT, status INT, request_failed BOOLEAN, error STRING, "
    "runs ARRAY<STRUCT<id: LONG, logs_url: STRING, triggering_actor: STRING, actor: STRING>>"
)


def run(url, actor=PERSON):
    return (1, url, actor, None)


def page_results(spark, pages, answers, chosen):
    frame = spark.createDataFrame(pages, RUN_PAGES)
    responses = spark.createDataFrame(
        [(u, None, s, None, "{}") for u, s in answers], "url STRING, ts TIMESTAMP, status INT, location STRING, body STRING"
    )
    steps = readiness.bound_steps(readiness.run_steps(frame), chosen)
    judged = logs.with_outcomes(steps, responses, github_code)
    return {r.slug: (r.status, r.builds_found, r.message) for r in
            readiness.fold_runs(judged, chosen, readiness.RUN_ORDER, bounded=True).collect()}


def test_page_events(spark):
    ok, chosen = run("ok"), Settings(min_builds=3, failure_limit=4)
    pages = [
        ("empty1", 1, 200, False, None, []),
        ("null1", 1, 200, False, None, None),
        ("empty3", 1, 200, False, None, [ok]), ("empty3", 2, 200, False, None, [ok]), ("empty3", 3, 200, False, None, []),
        ("empty3", 4, 200, False, None, [ok]),
        ("404-1", 1, 404, False, None, None),
        ("404-2", 1, 200, False, None, [ok, ok]), ("404-2", 2, 404, None, None, None),
        ("500", 1, 500, False, None, None),
        ("failed", 1, 200, False, None, [ok]), ("failed", 2, None, True, "timed out", None),
        ("stops-before", 1, 200, False, None, [ok, ok, ok]), ("stops-before", 2, 500, False, None, None),
        ("over-the-border", 1, 200, False, None, [run("gone"), run("gone")]),
        ("over-the-border", 2, 200, False, None, [run("gone"), run("gone"), ok]),
        ("bots", 1, 200, False, None, [run("ok", BOT)] * 5), ("bots", 2, 200, False, None, [run("ok", BOT)] * 5),
        ("no-url", 1, 200, False, None, [run(""), run(None), ok]),
        ("not-landed", 1, 200, False, None, [run("lost")] * 4),
        ("last-run", 1, 200, False, None, [run("ok", BOT), ok, ok, ok]),
    ]
    got = page_results(spark, pages, [("ok", 200), ("gone", 404)], chosen)
    assert got == {
        "empty1": ("missing_actions", 0, "Actions disabled or no runs found."),
        "null1": ("missing_actions", 0, "Actions disabled or no runs found."),
        "empty3": ("insufficient", 2, "Not enough Actions runs with logs."),
        "404-1": ("missing_actions", 0, "Actions disabled or repo missing."),
        "404-2": ("missing_actions", 2, "Actions disabled or repo missing."),
        "500": ("error", 0, "Failed to list runs: 500"),
        "failed": ("error", 1, "Failed to list runs: timed out"),
        "stops-before": ("ready", 3, "Has enough downloadable GitHub Actions logs."),
        "over-the-border": ("logs_gone", 0, "Logs removed (404) consecutively 4 times, stop scanning."),
        "bots": ("insufficient", 0, "Not enough Actions runs with logs."),
        "no-url": ("insufficient", 1, "Not enough Actions runs with logs."),
        "not-landed": ("error", 0, "Too many consecutive errors 4, stop scanning."),
        "last-run": ("ready", 3, "Has enough downloadable GitHub Actions logs."),
    }


@pytest.mark.parametrize("seed", [3, 4])
def test_random_pages_match_the_rule(spark, seed):
    rnd, chosen = random.Random(seed), SMALL
    pages, want = [], {}
    answers = {"ok": 200, "gone": 404, "auth": 403, "error": 503}
    for i in range(150):
        steps, slug = [], f"o/{i}"
        for page in range(1, rnd.randint(2, 6)):
            kind = rnd.choice(["runs"] * 6 + ["404", "500", "failed", "empty"])
            if kind == "runs":
                runs = [(rnd.choice(OUTCOMES), rnd.random() < 0.7) for _ in range(rnd.randint(1, 8))]
                pages.append((slug, page, 200, False, None, [run(o, PERSON if human else BOT) for o, human in runs]))
                steps += [(o, "probe") for o, human in runs if human]
                continue
            event = {"404": "list_missing", "500": "list_refused", "failed": "list_failed"}.get(
                kind, "list_empty" if page == 1 else "list_end")
            pages.append((slug, page, {"404": 404, "500": 500, "empty": 200}.get(kind), kind == "failed", "lost", None))
            steps.append((None, event))
        reason, found = sequential.fold_runs(steps, chosen.min_builds, chosen.failure_limit)
        want[slug] = (fv.GITHUB_REASONS[reason][0], found)
    rnd.shuffle(pages)
    got = page_results(spark, pages, answers.items(), chosen)
    assert {slug: v[:2] for slug, v in got.items()} == want


BUILD_PAGES = (
    "slug STRING, status INT, builds ARRAY<STRUCT<id: LONG, started_at: TIMESTAMP, jobs: ARRAY<STRUCT<id: LONG>>>>"
)


def job_results(spark, pages, answers, chosen):
    frame = spark.createDataFrame(pages, BUILD_PAGES)
    responses = spark.createDataFrame(
        [(f"{chosen.travis_api_url}/job/{j}/log", None, s, None, None) for j, s in answers],
        "url STRING, ts TIMESTAMP, status INT, location STRING, body STRING",
    )
    judged = logs.with_outcomes(readiness.job_steps(frame, chosen), responses, travis_code)
    return {r.slug: (r.status, r.builds_found, r.message) for r in readiness.fold_jobs(judged, chosen).collect()}


def test_jobs(spark):
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)

    def build(n, *jobs):
        return n, start + timedelta(minutes=n), [(j,) for j in jobs]

    chosen = Settings(min_builds=2, travis_builds=3)
    answers = [(j, 200) for j in range(1, 10)] + [(j, 404) for j in range(10, 20)] + [(j, 500) for j in range(20, 30)] + [(30, 403)]
    pages = [
        ("empty", 200, []), ("null", 200, None), ("refused", 503, [build(1, 1, 2)]),
        ("errors-between", 200, [build(1, 1, 20), build(2, 21, 2)]),
        ("gone-first", 200, [build(2, 10), build(1, 1, 2)]),
        ("newest-first", 200, [build(1, 10), build(2, 1, 2)]),
        ("two-in-one", 200, [build(1, 1, 2, 10)]),
        ("denied", 200, [build(2, 1), build(1, 30)]),
        ("no-ids", 200, [build(1, None, 1), (2, start, None)]),
        ("only-newest", 200, [build(n, n) for n in range(4, 7)] + [build(3, 10)]),
        ("few", 200, [build(1, 1)]), ("paged", 200, [build(1, 10)]), ("paged", 200, [build(5, 1), build(6, 2)]),
    ]
    no_builds = ("missing_travis", 0, "No Travis builds listed.")
    ready, few = ("ready", 2, "Has enough downloadable Travis logs."), "Not enough Travis job logs."
    assert job_results(spark, pages, answers, chosen) == {
        "empty": no_builds, "null": no_builds, "refused": no_builds, "errors-between": ready,
        "gone-first": ("logs_gone", 0, "Logs removed (404), stop scanning."), "newest-first": ready, "two-in-one": ready,
        "denied": ("auth_failed", 1, "401/403 fetching Travis logs."), "no-ids": ("insufficient", 1, few),
        "only-newest": ready, "few": ("insufficient", 1, few), "paged": ready,
    }


def test_random_jobs_match_the_rule(spark):
    rnd, chosen = random.Random(5), Settings(min_builds=3)
    cases = {f"o/{i}": rnd.choices(["ok", "error", "gone", "auth"], weights=[6, 4, 1, 1], k=rnd.randint(1, 12)) for i in range(200)}
    rows = [(s, 1, i, True, o) for s, seq in cases.items() for i, o in enumerate(seq)]
    frame = spark.createDataFrame(rows, "slug STRING, build_rank INT, job_pos INT, listed BOOLEAN, outcome STRING")
    got = {r.slug: (r.status, r.builds_found) for r in readiness.fold_jobs(frame, chosen).collect()}
    want = {s: sequential.fold_jobs(seq, chosen.min_builds) for s, seq in cases.items()}
    assert got == {s: (fv.TRAVIS_REASONS[reason][0], n) for s, (reason, n) in want.items()}


def test_redirects(spark):
    answers = [
        ("a", 1, 302, "x", None), ("a", 0, 200, None, None), ("x", 1, 200, None, None), ("b", 1, 302, None, None),
        ("c", 1, 302, "", None), ("d", 1, 302, "y", None), ("y", 1, 500, None, None), ("e", 1, 302, "lost", None),
        ("f", 1, 404, "x", "{}"), ("g", 1, 302, "a", None),
    ]
    frame = spark.createDataFrame(answers, "url STRING, n LONG, status INT, location STRING, body STRING").select(
        "url", F.timestamp_seconds("n").alias("ts"), "status", "location", "body")
    requests = spark.createDataFrame([(u, u) for u in "abcdefgh"] + [("none", None)], "slug STRING, log_url STRING")
    got = {r.slug: r.outcome for r in logs.with_outcomes(requests, frame, github_code).collect()}
    assert got == {"a": "ok", "b": "error", "c": "error", "d": "error", "e": "error", "f": "gone", "g": "error", "h": "error", "none": None}


def test_page_progress(spark):
    steps = spark.createDataFrame(
        [("a", 1, "ok"), ("a", 1, "ok"), ("a", 2, "gone"), ("a", 3, "ok")], "slug STRING, page INT, outcome STRING")
    pages = spark.createDataFrame([("a", p, [1] * p) for p in (1, 2, 3, 4)] + [("b", 1, None)], "slug STRING, page INT, runs ARRAY<INT>")
    for slice_pages in (1, 2, 1000):
        got = {(r.slug, r.page): (r.runs, r.ok_before) for r in results.page_progress(steps, pages, slice_pages).collect()}
        assert got == {("a", 1): (1, 0), ("a", 2): (2, 2), ("a", 3): (3, 2), ("a", 4): (4, 3), ("b", 1): (0, 0)}
