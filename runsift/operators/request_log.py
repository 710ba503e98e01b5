"""Questions to a request log: not-modified bodies, dispositions, retry costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runsift.functions.requests import (
    backoff_total,
    github_disposition,
    is_spam_flag,
    quota_exhausted,
    retry_after_seconds,
    travis_disposition,
)
from runsift.functions.text import given, request_key
from runsift.operators.first_rows import first_rows
from runsift.settings import Settings


def fill_not_modified(log: DataFrame, slice_requests: int = 10_000) -> DataFrame:
    """Give each 304 the body of the newest earlier 200 with an ETag for the same request key.

    Adds ``served_status``, ``served_body`` and ``served_from``: ``own``,
    ``cache``, or ``open`` where nothing was cached. Only GET requests take part.

    Order is that of ``log_seq`` alone. A key's history is cut into slices of it, so that a key with a large share of
    all requests is spread over tasks: within a slice the last body is carried by
    a window, and into a slice comes the last body of the slices before it, of
    which there is one row per key and slice. Rows that neither fill nor need the
    cache are not shuffled.
    """
    log = log.withColumn("request_key", request_key(F.col("url"), F.col("params")))
    is_get = F.coalesce(F.col("method") == "GET", F.lit(False))
    not_modified = is_get & F.coalesce(F.col("status") == 304, F.lit(False))
    cacheable = is_get & F.coalesce(F.col("status") == 200, F.lit(False)) & given(F.col("etag")).isNotNull()

    own = log.filter(~not_modified).withColumns(
        {"served_status": F.col("status"), "served_body": F.col("body"), "served_from": F.lit("own")}
    )

    # A source brings its body only, a request to be filled brings its columns only.
    marks = log.filter(not_modified | cacheable).select(
        "request_key",
        F.floor(F.col("log_seq") / slice_requests).alias("_slice"),
        "log_seq",
        F.when(cacheable, F.struct("body")).alias("_source"),
        F.when(not_modified, F.struct(*log.columns)).alias("_open"),
    )
    in_slice = (
        Window.partitionBy("request_key", "_slice")
        .orderBy("log_seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    slices = marks.groupBy("request_key", "_slice").agg(
        F.max_by("_source", F.when(F.col("_source").isNotNull(), F.col("log_seq"))).alias("_last")
    )
    earlier = (
        Window.partitionBy("request_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = slices.select(
        "request_key", "_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_carried")
    ).filter(F.col("_carried").isNotNull())

    filled = (
        marks.withColumn("_near", F.last("_source", ignorenulls=True).over(in_slice))
        .filter(F.col("_open").isNotNull())
        .join(carried, ["request_key", "_slice"], "left")
        .select("_open.*", F.coalesce("_near", "_carried").alias("_hit"))
    )
    hit = F.col("_hit").isNotNull()
    filled = filled.withColumns(
        {
            "served_status": F.when(hit, F.lit(200)).otherwise(F.col("status")),
            "served_body": F.when(hit, F.col("_hit.body")).otherwise(F.col("body")),
            "served_from": F.when(hit, "cache").otherwise("open"),
        }
    )
    return own.unionByName(filled.select(*own.columns))


def counts_as_failure() -> Column:
    """Attempts that use up a retry: failed ones and 5xx answers."""
    return F.coalesce(F.col("failed"), F.lit(False)) | F.coalesce(F.col("status") >= 500, F.lit(False))


def with_retries_used(log: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``retries_used``: failures before each attempt of its request, counted up to ``retry_count``.

    More than that makes no difference to what follows, so only the first few
    failures of each request are kept and joined back.
    """
    failures = first_rows(
        log.filter(counts_as_failure()).select("request_id", "attempt"), ["request_id"], ["attempt"], settings.retry_count
    )
    early = failures.groupBy("request_id").agg(F.collect_list("attempt").alias("_failed_at"))
    before = F.size(F.filter("_failed_at", lambda at: at < F.col("attempt")))
    return (
        log.join(early, "request_id", "left")
        .withColumn("retries_used", F.coalesce(before, F.lit(0)))
        .drop("_failed_at")
    )


def with_dispositions(log: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``disposition`` and ``marks_exhausted`` to client requests.

    Needs ``cache`` (readable, unreadable, none); counts ``retries_used`` where the log does not tell it.
    Bodies are looked at before that count, so that they need not follow it through a shuffle.
    """
    flagged = log.withColumn("_spam", is_spam_flag(F.col("status"), F.col("body")))
    return _counted(flagged, settings).withColumns(
        {
            "disposition": github_disposition(
                F.col("method"),
                F.col("status"),
                F.col("remaining"),
                F.col("_spam"),
                F.col("cache"),
                F.coalesce(F.col("failed"), F.lit(False)),
                F.col("retries_used"),
                settings.retry_count,
            ),
            "marks_exhausted": quota_exhausted(F.col("status"), F.col("remaining")),
        }
    ).drop("_spam")


def _counted(log: DataFrame, settings: Settings) -> DataFrame:
    return log if "retries_used" in log.columns else with_retries_used(log, settings)


def with_travis_dispositions(log: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``disposition`` and, where a request waits for its quota, ``wait_seconds``."""
    return _counted(log, settings).withColumns(
        {
            "disposition": travis_disposition(
                F.col("status"), F.coalesce(F.col("failed"), F.lit(False)), F.col("retries_used"), settings.retry_count
            ),
            "wait_seconds": F.when(
                F.col("status") == 429, retry_after_seconds(F.col("retry_after"), settings.sleep_on_429_seconds)
            ),
        }
    )


def retry_costs(log: DataFrame, settings: Settings) -> DataFrame:
    """Per request: attempts, counted failures, planned back-off and whether it ran out of retries.

    Only 5xx answers and failed attempts count. The waits form a geometric
    series, so a count is all that has to be summed up.
    """
    totals = log.groupBy("request_id").agg(
        F.count("*").alias("attempts"), F.count_if(counts_as_failure()).alias("failures")
    )
    retries = F.least(F.col("failures"), F.lit(settings.retry_count))
    return totals.withColumns(
        {
            "planned_wait": backoff_total(retries, settings.retry_base_delay_seconds),
            "exhausted": F.col("failures") > settings.retry_count,
        }
    )
