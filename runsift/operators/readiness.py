"""From ordered log outcomes to one status per repository.

A scan of a repository stops at its first decisive step. Here all steps are rows
and the stop is found with running sums over one partitioning by slug:

* ``ok_cum``, good logs so far;
* ``bad_run``, failures since the last good log, that is failures so far minus
  failures at the last good log. Both come from one sort order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runsift import fixed_values as fv
from runsift.functions.actors import run_actor, worth_a_request
from runsift.functions.messages import message_for, status_for
from runsift.functions.text import travis_log_address
from runsift.operators.first_rows import first_hole, first_rows, newest_landings, newest_walk, thin_hot_keys
from runsift.settings import Settings

# Kinds of steps that end a list of runs, whatever comes after.
LIST_EVENTS = ("list_failed", "list_missing", "list_refused", "list_empty", "list_end")
RUN_ORDER = ("page", "pos")
JOB_ORDER = ("build_rank", "job_pos")


def run_steps(pages: DataFrame) -> DataFrame:
    """Landed run pages to steps: slug, page, pos, ``kind``, ``detail``, ``log_url``.

    A page that failed, was refused, is missing or empty gives one list event
    (with a ``kind`` and perhaps a ``detail``) in place of its runs. A run worth
    a request gives a probe; other runs give none, but the first run of the
    first page stays as an idle step so that no repository is lost.

    The newest walk through each list counts whole (:func:`newest_walk`). A page
    that never landed below a landed one (or a missing page 1) is a request that
    failed: a ``list_failed`` event at the first such hole, and pages after it
    are not read. A walk that ends on a page with runs ends the list there.
    """
    pages = newest_walk(pages, "slug")
    holes = first_hole(pages, "slug")
    pages = pages.join(holes, "slug", "left").filter(F.col("_hole").isNull() | (F.col("page") < F.col("_hole"))).drop("_hole")
    status, page, pos = F.col("status"), F.col("page"), F.col("pos")
    failed = F.coalesce(F.col("request_failed"), F.lit(False))
    listed = ~failed & F.coalesce(status == 200, F.lit(False))
    # A page without runs to look at keeps one row, with no position.
    rows = pages.select(
        "slug", "page", "status", "error", failed.alias("failed"),
        F.posexplode_outer(F.when(listed, F.col("runs"))).alias("pos", "run"),
    )
    worthy = worth_a_request(F.col("run.logs_url"), run_actor(F.col("run.triggering_actor"), F.col("run.actor")))
    first = (page == 1) & (pos == 0)
    kept = rows.filter(pos.isNull() | first | worthy)
    kind = (
        F.when(pos.isNull() & F.col("failed"), "list_failed")
        .when(pos.isNull() & (status == 404), "list_missing")
        .when(pos.isNull() & ~F.coalesce(status == 200, F.lit(False)), "list_refused")
        .when(pos.isNull() & (page == 1), "list_empty")
        .when(pos.isNull(), "list_end")
        .when(~first, "probe")
        .when(worthy, "probe")
        .otherwise("idle")
    )
    steps = kept.select(
        "slug", "page", F.coalesce(pos, F.lit(-1)).alias("pos"), kind.alias("kind"),
        F.when(pos.isNull(), F.when(F.col("failed"), F.col("error")).otherwise(status.cast("string"))).alias("detail"),
        F.when(~first | worthy, F.col("run.logs_url")).alias("log_url"),
    )
    missing = holes.select(
        "slug", F.col("_hole").alias("page"), F.lit(-1).alias("pos"), F.lit("list_failed").alias("kind"),
        F.concat(F.lit("page "), F.col("_hole").cast("string"), F.lit(" never landed")).alias("detail"),
        F.lit(None).cast("string").alias("log_url"),
    )
    return steps.unionByName(missing)


def can_decide(steps: DataFrame) -> Column:
    """Steps that take part in a decision: outcomes and list events, or probes whose outcome is still to come."""
    event = F.col("kind").isin(*LIST_EVENTS) if "kind" in steps.columns else F.lit(False)
    if "outcome" in steps.columns:
        known = F.col("outcome").isin(fv.LOG_OK, fv.LOG_GONE, fv.LOG_AUTH, fv.LOG_ERROR) | event
    else:
        known = (F.col("kind") == "probe") | event
    return F.coalesce(known, F.lit(False))


def bound_steps(steps: DataFrame, settings: Settings, order: Sequence[str] = RUN_ORDER) -> DataFrame:
    """Steps that can still decide: stands before the join to responses.

    Leaves at most ``step_bound * hot_key_splits`` steps per repository; the
    exact cut is made by :func:`fold_runs`. Steps that decide nothing come after
    all others, so they take no place from these, and keep a repository that has
    no others.
    """
    last = (~can_decide(steps)).cast("int")
    return thin_hot_keys(steps, ["slug"], [last, *order], settings.step_bound, settings.hot_key_splits, list(order))


def fold_runs(
    steps: DataFrame, settings: Settings, order: Sequence[str] = ("seq",), bounded: bool = False
) -> DataFrame:
    """One row per slug: ``status``, ``builds_found``, ``message``.

    ``steps`` holds slug, the order columns and ``outcome`` (ok, gone, auth,
    error, or null for a list event); optionally ``kind`` and ``detail`` of list
    events. Good logs set the failure run back; gone and error share it, and the
    step that fills it names the status. ``bounded`` says that
    :func:`bound_steps` has run before.
    """
    for name in ("kind", "detail"):
        if name not in steps.columns:
            steps = steps.withColumn(name, F.lit(None).cast("string"))
    steps = steps.select("slug", *order, "outcome", "kind", "detail")
    if not bounded:
        steps = bound_steps(steps, settings, order)

    # The exact cut, again with steps that decide nothing after all others.
    steps = first_rows(steps, ["slug"], [(~can_decide(steps)).cast("int"), *order], settings.step_bound)
    so_far = Window.partitionBy("slug").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outcome = F.col("outcome")
    is_ok = F.coalesce(outcome == fv.LOG_OK, F.lit(False))
    is_bad = F.coalesce(outcome.isin(fv.LOG_GONE, fv.LOG_ERROR), F.lit(False))
    running = steps.select(
        "*",
        F.sum(is_ok.cast("int")).over(so_far).alias("ok_cum"),
        F.sum(is_bad.cast("int")).over(so_far).alias("bad_cum"),
    )

    bad_at_last_ok = F.max(F.when(is_ok, F.col("bad_cum"))).over(so_far)
    counted = running.withColumn("bad_run", F.col("bad_cum") - F.coalesce(bad_at_last_ok, F.lit(0)))

    full_run = F.col("bad_run") >= settings.failure_limit
    reason = (
        F.when(F.col("kind").isin(*LIST_EVENTS), F.col("kind"))
        .when(outcome == fv.LOG_AUTH, "denied")
        .when(full_run & (outcome == fv.LOG_GONE), "gone_run")
        .when(full_run & (outcome == fv.LOG_ERROR), "error_run")
        .when(is_ok & (F.col("ok_cum") >= settings.min_builds), "enough")
    )
    detail = F.when(reason.isin("gone_run", "error_run"), F.col("bad_run").cast("string")).otherwise(F.col("detail"))
    stop = F.struct(*order, reason.alias("reason"), F.col("ok_cum").alias("found"), detail.alias("detail"))
    folded = counted.groupBy("slug").agg(
        F.min(F.when(reason.isNotNull(), stop)).alias("_stop"), F.max("ok_cum").alias("_found")
    )
    why = F.coalesce(F.col("_stop.reason"), F.lit("list_end"))
    return folded.select(
        "slug",
        status_for(why, fv.GITHUB_REASONS).alias("status"),
        F.coalesce(F.col("_stop.found"), F.col("_found")).cast("bigint").alias("builds_found"),
        message_for(why, fv.GITHUB_REASONS, F.col("_stop.detail")).alias("message"),
    )


def job_steps(build_pages: DataFrame, settings: Settings, api: str | None = None) -> DataFrame:
    """Jobs of the newest builds per slug: slug, ``build_rank``, ``job_pos``, ``log_url``.

    A page that was refused or lists no build leaves one row without a build. The newest walk through a list counts
    (:func:`newest_walk`, where ``page`` tells pages apart; else the newest landing), and a build that several pages
    list counts once.
    """
    newest = F.col("build.started_at").desc_nulls_last(), F.col("build.id").desc_nulls_last()
    pages = newest_walk(build_pages, "slug") if "page" in build_pages.columns else newest_landings(build_pages, "slug")
    landed = F.col("ts") if "ts" in pages.columns else F.lit(None).cast("timestamp")
    builds = pages.select(
        "slug",
        F.explode_outer(F.when(F.col("status") == 200, F.col("builds"))).alias("build"),
        landed.alias("_landed"),
    )
    # Builds without an id are told apart by what they hold.
    same = ["slug", F.col("build.id"), F.when(F.col("build.id").isNull(), F.col("build"))]
    builds = first_rows(builds, same, [F.col("_landed").desc_nulls_last(), F.col("build").desc()], 1).drop("_landed")
    order = [F.col("build").isNull(), *newest]
    in_time = Window.partitionBy("slug").orderBy(*order)
    builds = thin_hot_keys(builds, ["slug"], order, settings.travis_builds, settings.hot_key_splits, ["build"])
    ranked = builds.withColumn("build_rank", F.row_number().over(in_time)).filter(
        F.col("build_rank") <= settings.travis_builds
    )
    jobs = F.filter(F.col("build.jobs"), lambda job: job.id.isNotNull())
    return ranked.select(
        "slug", "build_rank", F.col("build").isNotNull().alias("listed"), F.posexplode_outer(jobs).alias("job_pos", "job")
    ).select(
        "slug",
        "build_rank",
        "listed",
        F.coalesce("job_pos", F.lit(-1)).alias("job_pos"),
        travis_log_address(api or settings.travis_api_url, F.col("job.id")).alias("log_url"),
    )


def fold_jobs(steps: DataFrame, settings: Settings) -> DataFrame:
    """One row per slug from job outcomes: the first gone or denied log, or enough good ones, decides.

    Failed requests do not count. The groups are bounded by the newest builds
    that :func:`job_steps` keeps.
    """
    so_far = Window.partitionBy("slug").orderBy(*JOB_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outcome = F.col("outcome")
    is_ok = F.coalesce(outcome == fv.LOG_OK, F.lit(False))
    counted = steps.withColumn("ok_cum", F.sum(is_ok.cast("int")).over(so_far))
    reason = (
        F.when(outcome == fv.LOG_GONE, "gone")
        .when(outcome == fv.LOG_AUTH, "denied")
        .when(is_ok & (F.col("ok_cum") >= settings.min_builds), "enough")
    )
    stop = F.struct(*JOB_ORDER, reason.alias("reason"), F.col("ok_cum").alias("found"))
    folded = counted.groupBy("slug").agg(
        F.min(F.when(reason.isNotNull(), stop)).alias("_stop"),
        F.max("ok_cum").alias("_found"),
        F.bool_or("listed").alias("_listed"),
    )
    why = F.when(~F.col("_listed"), "list_empty").otherwise(F.coalesce(F.col("_stop.reason"), F.lit("list_end")))
    return folded.select(
        "slug",
        status_for(why, fv.TRAVIS_REASONS).alias("status"),
        F.coalesce(F.col("_stop.found"), F.col("_found")).cast("bigint").alias("builds_found"),
        message_for(why, fv.TRAVIS_REASONS, F.lit(None).cast("string")).alias("message"),
    )
