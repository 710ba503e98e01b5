"""Quota reports from a request log.

These plan capacity. They hand out nothing, and credentials appear as hashes only.
A credential may make a large share of all requests, so everything is summed up
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift import fixed_values as fv
from runsift.functions.quota import cool_down_label, effective_quota, is_enabled, last_used_label
from runsift.functions.requests import is_spam_flag, quota_exhausted
from runsift.functions.text import mask_secret
from runsift.operators.results import upsert

MINUTE = 60
KEYS = ["pool", "credential_hash"]


def _flags(log: DataFrame, travis_pool: str | None = None) -> DataFrame:
    status, failed = F.col("status"), F.coalesce(F.col("failed"), F.lit(False))
    # The Travis client neither removes nor disables; it looks at no header of a 429 or a server error.
    travis = F.lit(False) if travis_pool is None else F.coalesce(F.col("pool") == travis_pool, F.lit(False))
    unread = travis & F.coalesce((status == 429) | ((status >= 500) & (status < 600)), F.lit(False))
    exhausted = F.when(travis, F.coalesce(status == 429, F.lit(False))).otherwise(quota_exhausted(status, F.col("remaining")))
    removes = F.coalesce(status == 401, F.lit(False)) & ~travis
    # Exhausted by a 403 is retried at once, so its text is not looked at.
    spam = is_spam_flag(status, F.col("body")) & ~travis & ~removes & ~((status == 403) & exhausted)
    return log.select(
        *KEYS,
        "log_seq",
        "ts",
        F.when(~unread, F.col("remaining").try_cast("bigint")).alias("remaining"),
        F.when(~unread, F.floor(F.col("reset").try_cast("double"))).alias("reset"),
        exhausted.alias("exhausted"),
        removes.alias("removes"),
        spam.alias("spam"),
        (~failed & ~unread).alias("answered"),
    )


def _common(exhausted: Column) -> list[Column]:
    left = F.when(exhausted, F.lit(0)).otherwise(F.col("remaining"))
    return [
        F.max_by(left, F.when(left.isNotNull(), F.col("log_seq"))).cast("bigint").alias("remaining"),
        F.max(F.when(F.col("answered"), F.col("ts"))).alias("last_used"),
        F.bool_or("spam").alias("disabled"),
        F.bool_or("removes").alias("removed"),
    ]


def quota_state(log: DataFrame, travis_pool: str | None = None) -> DataFrame:
    """Stored mode: last known quota per pool and credential.

    A rate-limited answer leaves nothing and sets the reset a cool-off ahead.
    A null ``remaining`` or ``reset_time`` means that no answer has set it.
    Rows of ``travis_pool``, where it is named, follow the Travis client: a 429
    uses up the quota, server errors change nothing, nothing removes or disables.
    """
    exhausted = F.col("exhausted")
    reset = F.when(exhausted, F.col("ts") + fv.COOL_OFF_SECONDS).otherwise(F.col("reset"))
    return _flags(log, travis_pool).groupBy(*KEYS).agg(
        *_common(exhausted),
        F.max_by(reset, F.when(reset.isNotNull(), F.col("log_seq"))).alias("reset_time"),
    )


def quota_state_in_memory(log: DataFrame, travis_pool: str | None = None) -> DataFrame:
    """Memory mode: a rate-limited answer moves the reset only if the reset is past.

    Each such move depends on the move before it. What matters is the last reset
    header and the seconds with a rate-limited answer from there on; those are
    packed into one 60-bit mask per credential and minute, so what is folded in
    order grows with the minutes of the log and not with its rows.
    """
    flags = _flags(log, travis_pool)
    state = flags.groupBy(*KEYS).agg(
        *_common(F.col("exhausted")),
        F.max(F.when(F.col("reset").isNotNull(), F.col("log_seq"))).alias("_header_at"),
        F.max_by("reset", F.when(F.col("reset").isNotNull(), F.col("log_seq"))).alias("_header"),
    )
    limited = flags.filter("exhausted").select(*KEYS, "log_seq", "ts")
    after = limited.join(state.select(*KEYS, "_header_at"), KEYS).filter(
        F.col("_header_at").isNull() | (F.col("log_seq") >= F.col("_header_at"))
    )
    minutes = after.groupBy(*KEYS, F.floor(F.col("ts") / MINUTE).alias("minute")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(ts % {MINUTE} as int))")).alias("mask")
    )
    histories = minutes.groupBy(*KEYS).agg(
        F.array_sort(F.collect_list(F.struct("minute", "mask"))).alias("history")
    )
    reset = F.aggregate(
        F.col("history"), F.coalesce(F.col("_header"), F.lit(0).cast("bigint")), _next_reset
    )
    return (
        state.join(histories, KEYS, "left")
        .withColumn("reset_time", F.coalesce(reset, F.col("_header"), F.lit(0).cast("bigint")))
        .drop("_header_at", "_header", "history")
    )


def _next_reset(reset: Column, step: Column) -> Column:
    """Reset after one minute: a cool-off past its first marked second beyond ``reset``, if there is one."""
    base = step.minute * MINUTE
    offset = (reset - base).cast("bigint")
    # Shifting in two parts clears every second up to the reset.
    beyond = F.when(offset < 0, step.mask).when(offset >= MINUTE - 1, F.lit(0).cast("bigint")).otherwise(
        step.mask.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("bigint"), (offset + 1).cast("int")))
    )
    lowest = F.bit_count(beyond.bitwiseAND(-beyond) - 1)
    return F.when(beyond == 0, reset).otherwise((base + lowest + fv.COOL_OFF_SECONDS).cast("bigint"))


def merge_quota(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored quota rows with the fold of a later piece of the log laid over them."""
    newer = batch.select(*KEYS, *[F.col(c).alias(f"_{c}") for c in batch.columns if c not in KEYS])
    sticky = {
        c: F.coalesce(F.col(c), F.lit(False)) | F.coalesce(F.col(f"_{c}"), F.lit(False)) for c in ("disabled", "removed")
    }
    latest = {c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in ("remaining", "reset_time", "last_used")}
    merged = stored.join(newer, KEYS, "full_outer").withColumns({**sticky, **latest})
    return merged.select(*stored.columns)


def enable_credentials(state: DataFrame, added: DataFrame, now: Column, enable: bool = True) -> DataFrame:
    """Add credentials to their pool, or enable known ones again, whose quota stays.

    A removed credential is no longer known: added again, it starts afresh.
    """
    given = ["disabled", "removed", "added_at"]
    updates = added.select(
        *KEYS,
        F.lit(not enable).alias("disabled"),
        F.lit(False).alias("removed"),
        now.alias("added_at"),
        F.array(*[F.lit(c) for c in given]).alias("set_fields"),
        F.lit(0).alias("seq"),
    )
    known = is_enabled(F.col("removed"))
    still_removed = state.filter(~known).join(added.select(*KEYS).distinct(), KEYS, "left_anti")
    return upsert(state.filter(known), updates, KEYS).unionByName(still_removed)


def quota_pick(state: DataFrame, now: Column, stored: bool = True) -> DataFrame:
    """Per pool: enabled credentials, the one with most quota left, and the wait if there is none.

    Among equals the greatest hash is named.
    """
    enabled = is_enabled(F.col("disabled")) & is_enabled(F.col("removed"))
    left = effective_quota(F.col("remaining"), F.col("reset_time"), now, stored)
    rows = state.filter(F.col("pool").isNotNull()).select(
        "pool", "credential_hash", enabled.alias("_enabled"), left.alias("_left"),
        F.coalesce("reset_time", F.lit(0)).alias("_reset"),
    )
    usable = F.col("_enabled") & (F.col("_left") > 0)
    report = rows.groupBy("pool").agg(
        F.count_if("_enabled").alias("enabled"),
        F.max(F.when(usable, F.struct("_left", "credential_hash"))).alias("_best"),
        F.min(F.when(F.col("_enabled"), F.col("_reset"))).alias("soonest_reset"),
    )
    wait = F.col("soonest_reset") - now + 1
    return report.select(
        "pool",
        "enabled",
        F.col("_best.credential_hash").alias("best"),
        F.col("_best._left").alias("best_left"),
        "soonest_reset",
        F.when((F.col("enabled") > 0) & F.col("_best").isNull(), F.when(wait < 0, F.lit(1)).otherwise(wait))
        .cast("double")
        .alias("wait_seconds"),
        F.when(F.col("enabled") == 0, "none active")
        .when(F.col("_best").isNull(), "wait")
        .otherwise("available")
        .alias("state"),
    )


def quota_inventory(state: DataFrame, pool: str, now: Column) -> DataFrame:
    """Rows of one pool as they are listed: masked name, disabled flag, cool-down, last use."""
    return state.filter(F.col("pool") == pool).select(
        mask_secret(F.col("credential_hash")).alias("credential"),
        F.coalesce("disabled", F.lit(False)).alias("disabled"),
        cool_down_label(F.timestamp_seconds("reset_time"), F.timestamp_seconds(now)).alias("cool_down"),
        last_used_label(F.timestamp_seconds("last_used")).alias("last_used"),
    )
