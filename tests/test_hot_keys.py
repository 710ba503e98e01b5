"""One key holds a third of all rows or more: results stay whole, and plans cut it before and while it is shuffled."""

import random
import re

from pyspark.sql import functions as F

import sequential
from catalog import landed as L
from catalog.queries import QUERIES
from runsift import Settings
from runsift import fixed_values as fv
from runsift.operators import discover, quota, readiness, request_log

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def hot_probes(spark):
    """50,000 steps of one repository among 100,000."""
    base = spark.range(100_000)
    hot = F.col("id") % 2 == 0
    return base.select(
        F.when(hot, F.lit("hot/one")).otherwise(F.concat(F.lit("o/"), F.col("id") % 5000)).alias("slug"),
        F.col("id").alias("seq"),
        F.when(hot, F.when(F.col("id") % 20 == 18, "ok").otherwise("gone")).otherwise(
            F.when(F.col("id") % 7 == 0, "error").otherwise("ok")).alias("outcome"),
    )


def test_hot_repository(spark):
    chosen, frame = Settings(), hot_probes(spark)
    got = {r.slug: (r.status, r.builds_found) for r in readiness.fold_runs(frame, chosen).collect()}
    assert len(got) == 2501
    steps = {}
    for r in frame.filter("slug IN ('hot/one', 'o/1', 'o/77', 'o/4999')").orderBy("seq").collect():
        steps.setdefault(r.slug, []).append((r.outcome, None))
    for slug, outcomes in steps.items():
        reason, found = sequential.fold_runs(outcomes, 30, 10)
        assert got[slug] == (fv.GITHUB_REASONS[reason][0], found)
    assert got["hot/one"] == ("ready", 30)


def test_hot_repository_leaves_few_rows_for_one_task(spark):
    chosen, frame = Settings(hot_key_splits=8), hot_probes(spark)
    kept = readiness.bound_steps(frame, chosen, ("seq",)).filter("slug = 'hot/one'").count()
    assert kept <= chosen.step_bound * 8


def test_limits_stand_on_both_sides_of_the_shuffle(spark):
    told = plan(readiness.fold_runs(hot_probes(spark), Settings()))
    assert len(re.findall(r"WindowGroupLimit.*Partial", told)) == 2 and len(re.findall(r"WindowGroupLimit.*Final", told)) == 2
    assert told.count("Exchange hashpartitioning") == 2
    told = plan(readiness.fold_runs(hot_probes(spark), Settings(hot_key_splits=1)))
    assert told.count("Exchange hashpartitioning") == 1


def test_hot_slug_in_search_hits(spark):
    hits = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot/one").otherwise(F.concat(F.lit("o/"), F.col("id") % 1000)).alias("slug"),
        (F.col("id") % 7).alias("seg_idx"), (F.col("id") % 3).alias("lang_idx"), (F.col("id") % 11).alias("page"), F.col("id").alias("pos"))
    got = {r.slug: (r.seg_idx, r.lang_idx, r.page, r.pos) for r in discover.first_seen(hits).collect()}
    want = {}
    for r in hits.collect():
        place = (r.seg_idx, r.lang_idx, r.page, r.pos)
        want[r.slug] = min(want.get(r.slug, place), place)
    assert got == want
    assert "WindowGroupLimit" in plan(discover.first_seen(hits)) and "Partial" in plan(discover.first_seen(hits))


def test_hot_request_key(spark):
    rnd = random.Random(9)
    rows = [("hot" if rnd.random() < 0.5 else f"u{rnd.randint(0, 50)}", rnd.choice([200, 304, 304, 304])) for _ in range(20_000)]
    frame = spark.createDataFrame([(i, u, s) for i, (u, s) in enumerate(rows)], "log_seq LONG, url STRING, status INT").selectExpr(
        "log_seq", "log_seq AS ts", "'GET' AS method", "url", "cast(NULL AS string) AS params", "status", "'e' AS etag", "concat('b', log_seq) AS body")
    want = sequential.served_bodies([(u, s, True, f"b{i}") for i, (u, s) in enumerate(rows)])
    got = {r.log_seq: (r.served_status, r.served_body, r.served_from) for r in request_log.fill_not_modified(frame, 500).collect()}
    assert got == dict(enumerate(want))
    told = plan(request_log.fill_not_modified(frame, 500))
    assert "request_key" in told and "_slice" in re.findall(r"Exchange hashpartitioning\((.*?)\)", told)[0]


def test_hot_credential_is_summed_up_before_the_shuffle(spark):
    log = L.request_log(spark, SF)
    told = plan(quota.quota_state(log))
    assert "partial_max_by" in told and "SortAggregate" not in told and told.count("Exchange") == 1
    assert "collect_list(struct(minute" in plan(quota.quota_state_in_memory(log))


def test_filters_and_columns_reach_the_scan(spark):
    told = plan(QUERIES["readiness_gh"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in told
    told = plan(QUERIES["retry_cost"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint>" in told
    told = plan(QUERIES["entity_objects"](spark, SF))
    assert "user_id" in told and "event_type" not in told
