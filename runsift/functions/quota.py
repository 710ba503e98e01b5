"""Quota rows: who is enabled (P15), what is left (F12), and how a wait is shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runsift import fixed_values as fv


def is_enabled(disabled: Column) -> Column:
    """A missing flag counts as enabled."""
    return ~disabled.eqNullSafe(F.lit(True))


def effective_quota(remaining: Column, reset_time: Column, now: Column, stored: bool = True) -> Column:
    """Requests left at ``now``.

    Stored rows are full again once the reset has passed; rows held in memory
    only if they were used up before.
    """
    left = F.coalesce(remaining, F.lit(fv.FULL_QUOTA).cast("bigint"))
    passed = now > F.coalesce(reset_time, F.lit(0))
    full_again = passed if stored else passed & (left == 0)
    return F.when(full_again, F.lit(fv.FULL_QUOTA).cast("bigint")).otherwise(left)


def utc_text(at: Column) -> Column:
    """ISO text of a time in UTC, whatever the zone of the session."""
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def cool_down_label(until: Column, now: Column) -> Column:
    """``Ready`` without a wait, else the end of the wait; both arguments are timestamps."""
    return F.when(until.isNull() | (until <= now), "Ready").otherwise(utc_text(until))


def last_used_label(last_used: Column) -> Column:
    return F.when(last_used.isNull(), "Never").otherwise(utc_text(last_used))
