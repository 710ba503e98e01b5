"""Streams against their batch forms, in any split of the input."""

import random
import time

from pyspark.sql import functions as F

from catalog import landed as L
from catalog.queries import FEW_BUILDS, landed_tables
from runsift import Settings
from runsift.operators import discover, quota, readiness
from runsift.plans.scan import found_repositories, scan
from runsift.schemas import LANDED, RESULTS
from runsift.sources.landing import read_landed_stream
from runsift.sources.results import read_results
from runsift.streaming import passes
from runsift.streaming import readiness as live

SF = "/root/testdata/sf0.001"
PROBE = "slug STRING, seq LONG, outcome STRING, kind STRING"
def checked():
    return F.lit("2024-02-01").cast("timestamp")


def run_readiness(spark, work, batches, chosen):
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, PROBE).coalesce(1).write.mode("append").parquet(f"{work}/landing")
        time.sleep(0.02)
    stream = spark.readStream.schema(PROBE).option("maxFilesPerTrigger", 1).parquet(f"{work}/landing")
    query = (
        live.readiness_stream(stream, chosen)
        .writeStream.outputMode("update")
        .foreachBatch(lambda rows, n: rows.write.mode("overwrite").parquet(f"{work}/out/batch={n}"))
        .option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{work}/out")


def test_readiness_stream_equals_batch_in_any_split(spark, tmp_path):
    rnd, chosen = random.Random(1), Settings(min_builds=3, failure_limit=4)
    cases = {f"o/{i}": rnd.choices(["ok", "gone", "error", "auth"], weights=[4, 3, 3, 1], k=rnd.randint(1, 30)) for i in range(40)}
    cuts = sorted(rnd.sample(range(1, 30), 3))
    batches = [[], [], [], []]
    for slug, seq in cases.items():
        for i, outcome in enumerate(seq):
            batches[sum(i >= c for c in cuts)].append((slug, i, outcome, None))
        if rnd.random() < 0.5:
            event = rnd.choice(["list_end", "list_failed", "list_missing", "list_refused"])
            batches[3].append((slug, 30, None, event))
            batches[3].append((slug, 31, "ok", None))
    for batch in batches:
        rnd.shuffle(batch)
    streamed = live.current_status(run_readiness(spark, str(tmp_path), [b for b in batches if b], chosen))
    whole = readiness.fold_runs(spark.createDataFrame(sum(batches, []), PROBE), chosen)
    assert whole.select("status").distinct().count() >= 5
    assert {tuple(r) for r in streamed.select("slug", "status", "builds_found").collect()} == {
        tuple(r) for r in whole.select("slug", "status", "builds_found").collect()}


def test_late_steps_change_nothing_and_are_put_out(spark, tmp_path):
    first = [("a", 5, "ok", None), ("a", 6, "ok", None)]
    batches = [first, [("a", 6, "auth", None), ("a", 2, "gone", None), ("a", 7, "ok", None)]]
    rows = run_readiness(spark, str(tmp_path), batches, Settings(min_builds=3)).collect()
    assert {(r.seq, r.outcome) for r in rows if r.kind == "late"} == {(6, "auth"), (2, "gone")}
    assert max((r.seq, r.status, r.builds_found) for r in rows if r.kind == "status") == (7, "ready", 3)


def test_passes_maintain_the_result_table(spark, tmp_path):
    work = str(tmp_path)
    tables = landed_tables(spark, SF, FEW_BUILDS)
    pages = tables.repo_pages.persist()
    first, second = pages.filter("page <= 1"), pages
    first.coalesce(1).write.parquet(f"{work}/landing")

    def one_run():
        stream = read_landed_stream(spark, "repo_pages", f"{work}/landing", files_per_batch=1, stamped=True)
        passes.run_passes(stream, lambda: tables, f"{work}/results", f"{work}/checkpoint", FEW_BUILDS, checked(), once=True).awaitTermination()
        return read_results(spark, f"{work}/results", RESULTS)

    empty = spark.createDataFrame([], RESULTS)
    want_first = {tuple(r) for r in scan(_with(tables, first), empty, FEW_BUILDS, checked()).collect()}
    after_first = one_run()
    assert {tuple(r) for r in after_first.collect()} == want_first and want_first
    assert discover.drop_seen(found_repositories(first), after_first).count() == 0
    # Nothing new has landed: no pass, the same table.
    assert {tuple(r) for r in one_run().collect()} == want_first

    second.coalesce(1).write.mode("append").parquet(f"{work}/landing")
    want_both = {tuple(r) for r in scan(_with(tables, second), spark.createDataFrame(list(want_first), RESULTS), FEW_BUILDS, checked()).collect()}
    after_second = {tuple(r) for r in one_run().collect()}
    assert after_second == want_both and want_first < want_both


def _with(tables, pages):
    from dataclasses import replace

    return replace(tables, repo_pages=pages)


def test_quota_passes_equal_the_whole_log(spark, tmp_path):
    work, log = str(tmp_path), L.request_log(spark, SF)
    for low, high in ((0, 300), (300, 650), (650, 10_000)):
        log.filter((F.col("log_seq") >= low) & (F.col("log_seq") < high)).coalesce(1).write.mode("append").parquet(f"{work}/landing")
        time.sleep(0.02)
    stream = read_landed_stream(spark, "request_log", f"{work}/landing", files_per_batch=1)
    passes.run_quota_passes(stream, f"{work}/state", f"{work}/checkpoint", Settings(), once=True).awaitTermination()
    shown = ["pool", "credential_hash", "remaining", "reset_time", "last_used", "disabled", "removed"]
    got = {tuple(r) for r in read_results(spark, f"{work}/state", LANDED["quota_state"]).select(*shown).collect()}
    assert got == {tuple(r) for r in quota.quota_state(log).select(*shown).collect()}
