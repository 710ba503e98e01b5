"""What one logged response leads to (P10, P11) and what waiting costs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runsift import fixed_values as fv


def backoff_seconds(attempt: Column, base: float) -> Column:
    """Wait before attempt ``attempt`` + 1, counted from 1; doubles each time."""
    return F.lit(float(base)) * F.pow(F.lit(2.0), attempt - 1)


def backoff_total(retries: Column, base: float) -> Column:
    """Sum of the first ``retries`` waits of :func:`backoff_seconds`."""
    return F.lit(float(base)) * (F.pow(F.lit(2.0), retries) - 1)


def retry_after_seconds(header: Column, default: float) -> Column:
    """A number waits at least one second; anything else waits the default."""
    seconds = header.try_cast("double")
    return F.when(seconds.isNull(), F.lit(float(default))).otherwise(F.greatest(seconds, F.lit(1.0)))


def quota_exhausted(status: Column, remaining: Column) -> Column:
    """The response marks its credential as used up."""
    return F.coalesce((status == 429) | ((status == 403) & (remaining == "0")), F.lit(False))


def is_spam_flag(status: Column, body: Column) -> Column:
    return F.coalesce((status > 400) & (status < 500) & F.lower(body).contains(fv.SPAM_TEXT), F.lit(False))


def github_disposition(
    method: Column,
    status: Column,
    remaining: Column,
    spam: Column,
    cache: Column,
    failed: Column,
    retries_used: Column,
    retry_count: int,
) -> Column:
    """What the client does next; the first match counts.

    ``cache`` is ``readable``, ``unreadable`` or ``none``, ``spam`` the outcome of
    :func:`is_spam_flag`. Status 429 marks the quota (:func:`quota_exhausted`)
    and still goes on to the spam test.
    """
    retries_left = retries_used < retry_count
    revalidated = (method == "GET") & (status == 304)
    return (
        F.when(failed & retries_left, "retry_failed")
        .when(failed, "give_up")
        .when(revalidated & (cache == "readable"), "serve_cached")
        .when(revalidated & (cache == "unreadable"), "retry_without_etag")
        .when(status == 401, "retry_credential_removed")
        .when((status == 403) & (remaining == "0"), "retry_quota_exhausted")
        .when(spam, "retry_credential_disabled")
        .when((status >= 500) & retries_left, "retry_server_error")
        .otherwise("return")
    )


def travis_disposition(status: Column, failed: Column, retries_used: Column, retry_count: int) -> Column:
    retries_left = retries_used < retry_count
    return (
        F.when(failed & retries_left, "retry_failed")
        .when(failed, "give_up")
        .when(status == 429, "wait_and_retry")
        .when((status >= 500) & (status < 600) & retries_left, "retry_server_error")
        .otherwise("return")
    )
