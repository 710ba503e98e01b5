"""Readiness kept up to date while log outcomes arrive.

State per repository: good logs, failures in a row, last step seen, and the
verdict once there is one. Within a micro-batch steps are taken in order; a step
at or before the last one seen is late, changes nothing and is put out as such,
for a batch run to settle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from runsift import fixed_values as fv
from runsift.operators.readiness import LIST_EVENTS
from runsift.settings import Settings

STATE = "ok LONG, bad LONG, seq LONG, status STRING"
OUTCOMES = (fv.LOG_OK, fv.LOG_GONE, fv.LOG_AUTH, fv.LOG_ERROR)
OUTPUT = "slug STRING, kind STRING, seq LONG, outcome STRING, status STRING, builds_found LONG"


class ReadinessProcessor(StatefulProcessor):
    def __init__(self, settings: Settings) -> None:
        self.min_builds = settings.min_builds
        self.failure_limit = settings.failure_limit
        self.step_bound = settings.step_bound

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("readiness", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ok, bad, last, status = self.state.get() if self.state.exists() else (0, 0, -1, None)
        newest = last
        # The earliest steps of the batch decide, as many as a stop can need.
        first = None
        for chunk in rows:
            late = chunk[chunk["seq"] <= last]
            if len(late):
                yield self._rows(key[0], "late", late["seq"], late["outcome"], status, ok)
            fresh = chunk.loc[chunk["seq"] > last, ["seq", "outcome", "kind"]]
            if len(fresh):
                newest = max(newest, int(fresh["seq"].max()))
                # Steps without a known outcome decide nothing and take no place.
                fresh = fresh[fresh["outcome"].isin(OUTCOMES) | fresh["kind"].isin(LIST_EVENTS)]
                if status is None and len(fresh):
                    so_far = fresh if first is None else pd.concat([first, fresh])
                    first = so_far.nsmallest(self.step_bound, "seq")
        if newest == last:
            return
        seq = newest
        if first is not None:
            for step, outcome, kind in first.itertuples(index=False):
                ok, bad, status = self._advance(ok, bad, outcome, kind)
                if status is not None:
                    seq = int(step)
                    break
        self.state.update((ok, bad, newest, status))
        yield self._rows(key[0], "status", [seq], [None], status or fv.INSUFFICIENT, ok)

    def _advance(self, ok: int, bad: int, outcome: str | None, kind: str | None) -> tuple[int, int, str | None]:
        if kind in LIST_EVENTS:
            return ok, bad, fv.GITHUB_REASONS[kind][0]
        if outcome == fv.LOG_OK:
            return ok + 1, 0, fv.READY if ok + 1 >= self.min_builds else None
        if outcome == fv.LOG_AUTH:
            return ok, bad, fv.AUTH_FAILED
        if outcome not in (fv.LOG_GONE, fv.LOG_ERROR):
            return ok, bad, None
        full = bad + 1 >= self.failure_limit
        named = fv.LOGS_GONE if outcome == fv.LOG_GONE else fv.ERROR
        return ok, bad + 1, named if full else None

    @staticmethod
    def _rows(slug, kind, seq, outcome, status, found) -> pd.DataFrame:
        return pd.DataFrame(
            {"slug": slug, "kind": kind, "seq": list(seq), "outcome": list(outcome), "status": status, "builds_found": found}
        )

    def close(self) -> None:
        pass


def readiness_stream(probes: DataFrame, settings: Settings) -> DataFrame:
    """Stream of ``slug``, ``seq``, ``outcome`` to status rows (newest per slug counts) and late rows.

    An optional ``kind`` tells list events, which close a repository as in a batch.
    Needs the RocksDB state store (:data:`STATE_STORE`). A status without a
    verdict reads ``insufficient``, as if the list ended here.
    """
    processor = ReadinessProcessor(settings)
    kind = F.col("kind") if "kind" in probes.columns else F.lit(None).cast("string").alias("kind")
    return (
        probes.select("slug", "seq", "outcome", kind)
        .groupBy("slug")
        .transformWithStateInPandas(
            statefulProcessor=processor, outputStructType=OUTPUT, outputMode="Update", timeMode="None"
        )
    )


STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)


def current_status(rows: DataFrame) -> DataFrame:
    """The newest status per slug from the rows the stream has put out."""
    return (
        rows.filter(F.col("kind") == "status")
        .groupBy("slug")
        .agg(F.max(F.struct("seq", "builds_found", "status")).alias("_newest"))
        .select("slug", "_newest.status", "_newest.builds_found")
    )
