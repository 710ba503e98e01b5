"""Outcome of each log request, following one redirect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.functions.outcomes import REDIRECT, log_outcome
from runsift.functions.text import given

# Starts a join key that no landed address can equal.
NO_ADDRESS = "\u0001"


def latest_responses(responses: DataFrame, code: Callable[[Column, Column], Column]) -> DataFrame:
    """The newest response per address, reduced to code, redirect target and status.

    The code is worked out at the scan; bodies are not shuffled.
    """
    slim = F.struct(
        F.col("ts"),
        F.col("status"),
        F.when(F.col("status") == 302, given(F.col("location"))).alias("location"),
        code(F.col("status"), F.col("body")).alias("code"),
    )
    newest = responses.groupBy("url").agg(F.max(slim).alias("r"))
    return newest.select("url", "r.code", "r.location", "r.status")


def with_outcomes(
    requests: DataFrame, responses: DataFrame, code: Callable[[Column, Column], Column], spread: str = "slug"
) -> DataFrame:
    """``requests`` (``log_url`` and any other columns) with ``outcome``; null where there is no address.

    Rows that need no lookup get a key of their own, so that they are spread over
    all tasks and do not meet as nulls in one.
    """
    latest = latest_responses(responses, code)
    url = F.coalesce(F.col("log_url"), F.concat(F.lit(NO_ADDRESS), F.col(spread)))
    first = requests.withColumn("_url", url).join(
        latest.select(F.col("url").alias("_url"), F.col("code").alias("_code"), F.col("location").alias("_location")),
        "_url",
        "left",
    )
    target = F.coalesce(
        F.when(F.col("_code") == REDIRECT, F.col("_location")), F.concat(F.lit(NO_ADDRESS), F.col("_url"))
    )
    followed = first.withColumn("_target", target).join(
        latest.select(F.col("url").alias("_target"), F.col("status").alias("_followed")), "_target", "left"
    )
    outcome = F.when(F.col("log_url").isNotNull(), log_outcome(F.col("_code"), F.col("_followed")))
    return followed.withColumn("outcome", outcome).drop("_url", "_target", "_code", "_location", "_followed")
