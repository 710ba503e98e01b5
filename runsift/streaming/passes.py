"""Repeated passes over newly landed files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from runsift.operators.quota import merge_quota, quota_state
from runsift.plans.scan import Landed, scan
from runsift.schemas import LANDED, RESULTS
from runsift.settings import Settings
from runsift.sources.results import read_results, write_results


def batch_writer(batch: DataFrame, batch_id: int) -> str:
    """Names a micro-batch: the stream, as its checkpoint knows it, and the batch number. A new checkpoint is a new stream."""
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{stream}-{batch_id}"


def run_passes(
    repo_pages: DataFrame,
    landed: Callable[[], Landed],
    results_base: str,
    checkpoint: str,
    settings: Settings,
    checked_at: Column | None = None,
    limit: int | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Scan each micro-batch of landed search pages and write a new version of the result table.

    ``landed`` reads the other landed tables; it is called in every pass, so that
    a pass sees what has landed since the one before.
    A pass reads the newest version and writes the next one, whoever wrote what is
    stored; a batch that is run again after a failure reads what it read before
    and replaces its own version. Repositories processed in an earlier pass are
    left out through the result table; duplicates within a pass are dropped
    afresh, and ``limit`` counts per pass.
    """

    def one_pass(batch: DataFrame, batch_id: int) -> None:
        writer = batch_writer(batch, batch_id)
        results = read_results(batch.sparkSession, results_base, RESULTS, not_by=writer)
        tables = replace(landed(), repo_pages=batch)
        write_results(scan(tables, results, settings, checked_at, limit), results_base, by=writer)

    return _start(repo_pages, one_pass, checkpoint, settings, once)


def run_quota_passes(
    request_log: DataFrame, state_base: str, checkpoint: str, settings: Settings, once: bool = False,
    travis_pool: str | None = None,
) -> StreamingQuery:
    """Lay the quota fold of each newly landed piece of the request log over the stored rows."""

    def one_pass(batch: DataFrame, batch_id: int) -> None:
        schema = LANDED["quota_state"]
        writer = batch_writer(batch, batch_id)
        stored = read_results(batch.sparkSession, state_base, schema, not_by=writer)
        write_results(merge_quota(stored, quota_state(batch, travis_pool)), state_base, by=writer)

    return _start(request_log, one_pass, checkpoint, settings, once)


def _start(stream: DataFrame, one_pass, checkpoint: str, settings: Settings, once: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(one_pass).option("checkpointLocation", checkpoint)
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{max(settings.loop_sleep_seconds, 1)} seconds").start()
