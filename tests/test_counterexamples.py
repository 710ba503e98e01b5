"""Cases that fixtures without repeated landings, odd settings and restarts do not hold."""

import datetime

from pyspark.sql import functions as F

from catalog import landed as L
from catalog.queries import FEW_BUILDS, landed_tables
from runsift import Settings
from runsift.operators import discover, readiness, request_log, results, worklist
from runsift.plans.scan import rejected_hits, scan
from runsift.schemas import LANDED, RESULT_KEY, RESULTS
from runsift.sources.landing import read_landed, read_landed_stream
from runsift.sources.results import _versions, read_results, write_results
from runsift.streaming import passes
from test_streaming import run_readiness

SF = "/root/testdata/sf0.001"


def status(rows):
    return {r.slug: (r.status, r.builds_found) for r in rows.collect()}


def test_steps_without_an_outcome_take_no_place(spark, tmp_path):
    rows = [("a", i, None, None) for i in range(600)] + [("a", 600 + i, "ok", None) for i in range(100)] + [("b", 0, "odd", None)]
    probes = spark.createDataFrame(rows, "slug STRING, seq LONG, outcome STRING, kind STRING")
    want = {"a": ("ready", 30), "b": ("insufficient", 0)}
    assert status(readiness.fold_runs(probes, Settings())) == want
    from runsift.streaming import readiness as live

    assert status(live.current_status(run_readiness(spark, str(tmp_path), [rows], Settings()))) == want


def test_upsert_keeps_new_fields(spark):
    current = spark.createDataFrame([("a", "x", 1)], "slug STRING, provider STRING, stars INT")
    updates = spark.createDataFrame([("a", "x", 2, "n", ["note"]), ("b", "x", 5, "m", ["stars", "note"])], "slug STRING, provider STRING, stars INT, note STRING, set_fields ARRAY<STRING>").withColumn("seq", F.lit(0))
    found = {r.slug: (r.stars, r.note) for r in results.upsert(current, updates, RESULT_KEY).collect()}
    assert found == {"a": (1, "n"), "b": (5, "m")}


def test_reversed_and_partial_segments(spark):
    written = ({"from": "2020-05-01", "to": "2020-01-01"}, ["2018-12", "2019-01"], ["2020-01-01", "2020-02-01"])
    segments = worklist.settings_segments(spark, Settings(search_segments=written))
    texts = [r.search for r in worklist.work_list(segments, ["A"], Settings(search_pages=1, min_stars=0)).orderBy("seg_idx").collect()]
    assert [t.split("created:")[1] for t in texts] == ["2020-05-01..2020-01-01", "2018-12..2019-01", "2020-01-01..2020-02-01"]
    repos = spark.createDataFrame([("o/r", datetime.datetime(2020, 1, 5))], "slug STRING, created_at TIMESTAMP")
    assert [r.seg_idx for r in worklist.match_segments(repos, segments).collect()] == [2]


def test_any_search_order(spark):
    rows = [("o/a", 0, 0, 5, 1), ("o/b", 0, 0, 1, 9)]
    repos = spark.createDataFrame(rows, "slug STRING, seg_idx INT, lang_idx INT, stargazers_count INT, forks_count INT")
    first = lambda sort: discover.search_pages(repos, Settings(search_sort=sort)).filter("rank = 1").first().slug
    assert [first(x) for x in ("stars", "forks", "best-match")] == ["o/a", "o/b", "o/a"]


def test_pages_that_were_never_listed_have_no_progress(spark):
    run = [(1, "u", None, None)]
    rows = [("a", 1, 200, False, run), ("a", 2, 404, False, run), ("a", 3, 200, False, run), ("b", 1, 200, False, []), ("b", 2, 200, False, run)]
    pages = spark.createDataFrame(rows, "slug STRING, page INT, status INT, request_failed BOOLEAN, runs ARRAY<STRUCT<id: BIGINT, logs_url: STRING, triggering_actor: STRING, actor: STRING>>")
    steps = spark.createDataFrame([("a", 1, "ok")], "slug STRING, page INT, outcome STRING")
    assert sorted((r.slug, r.page, r.runs, r.ok_before) for r in results.page_progress(steps, pages).collect()) == [("a", 1, 1, 0), ("b", 1, 0, 0)]


def test_rejects_are_a_table(spark):
    pages = L.repo_pages(spark, SF)
    whole = discover.search_hits(discover.cut_page_chains(pages))
    assert rejected_hits(pages).count() == whole.count() - discover.split_rejects(whole)[0].count() > 0


def test_stored_results_outlive_checkpoints_and_mixing(spark, tmp_path):
    work = str(tmp_path)
    tables = landed_tables(spark, SF, FEW_BUILDS)
    tables.repo_pages.coalesce(1).write.parquet(f"{work}/landing")
    stored = scan(tables, spark.createDataFrame([], RESULTS), FEW_BUILDS, F.lit("2024-02-01").cast("timestamp"))
    write_results(stored, f"{work}/results", version=7)
    before = {tuple(r) for r in read_results(spark, f"{work}/results", RESULTS).collect()}

    def one_run(checkpoint):
        stream = read_landed_stream(spark, "repo_pages", f"{work}/landing", stamped=True)
        later = F.lit("2025-01-01").cast("timestamp")
        passes.run_passes(stream, lambda: tables, f"{work}/results", f"{work}/{checkpoint}", FEW_BUILDS, later, once=True).awaitTermination()
        return {tuple(r) for r in read_results(spark, f"{work}/results", RESULTS).collect()}

    # All repositories of the batch are stored already, so nothing is scanned again, and the new version is the current one.
    assert one_run("one") == before
    assert [n for n, _, _ in _versions(spark, f"{work}/results")] == [7, 8]
    # A lost checkpoint is a new stream over the same stored rows.
    assert one_run("two") == before
    assert [n for n, _, _ in _versions(spark, f"{work}/results")] == [7, 8, 9]


def test_a_repeated_batch_replaces_its_own_version(spark, tmp_path):
    base, schema = str(tmp_path / "r"), "slug STRING"
    rows = lambda *names: spark.createDataFrame([(n,) for n in names], schema)
    write_results(rows("a"), base, version=3)
    write_results(rows("a", "b"), base, by="s-0")
    assert {r.slug for r in read_results(spark, base, schema, not_by="s-0").collect()} == {"a"}
    write_results(rows("a", "c"), base, by="s-0")
    assert {r.slug for r in read_results(spark, base, schema).collect()} == {"a", "c"}
    for n in range(15):
        write_results(rows("a", str(n)), base, by=f"s-{n + 1}", keep=4)
    assert [n for n, _, _ in _versions(spark, base)] == [16, 17, 18, 19]
    assert LANDED and {r.slug for r in read_results(spark, base, schema).collect()} == {"a", "14"}


def test_the_newest_landing_counts_once(spark):
    run = lambda i: (i, f"u{i}", '{"login": "a", "type": "User"}', None)
    fields = "slug STRING, page INT, status INT, request_failed BOOLEAN, error STRING, runs ARRAY<STRUCT<id: BIGINT, logs_url: STRING, triggering_actor: STRING, actor: STRING>>, ts TIMESTAMP"
    at = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
    runs = [run(1), run(2), run(3)]
    pages = spark.createDataFrame([("a", 1, 200, False, None, runs, at(1)), ("a", 1, 200, False, None, runs, at(2)), ("b", 1, 500, False, None, [], at(1)), ("b", 1, 200, False, None, runs, at(2))], fields)
    steps = readiness.run_steps(pages).withColumn("outcome", F.when(F.col("kind") == "probe", "ok"))
    assert status(readiness.fold_runs(steps, Settings(min_builds=5), ("page", "pos"))) == {"a": ("insufficient", 3), "b": ("insufficient", 3)}

    from runsift.operators.providers import detect_providers
    from runsift.sources import entities

    probes = spark.createDataFrame([("a", "travis_yml", 200, None, at(1)), ("a", "travis_yml", 404, None, at(2))], "slug STRING, probe STRING, status INT, total_count BIGINT, ts TIMESTAMP")
    assert detect_providers(probes).first().providers == []
    chain = spark.createDataFrame([(0, 0, 1, 422, False, at(1)), (0, 0, 1, 200, False, at(2)), (0, 0, 2, 200, False, at(1))], "seg_idx INT, lang_idx INT, page INT, status INT, request_failed BOOLEAN, ts TIMESTAMP")
    # Page 2 belongs to the older walk, which the newest page 1 replaces whole.
    assert sorted(r.page for r in discover.cut_page_chains(chain).collect()) == [1]
    listed = spark.createDataFrame([("pull_commits", "p", 1, 200, "[1]", at(1)), ("pull_commits", "p", 1, 200, "[1]", at(2))], "entity STRING, parent STRING, page INT, status INT, body STRING, ts TIMESTAMP")
    assert entities.entity_items(listed, "pull_commits").count() == 1


def test_cached_bodies_follow_the_log_order_whatever_the_clock_says(spark):
    rows = [(1, 9_000_000, 200, "e", "first"), (2, 5, 304, None, None)]
    log = spark.createDataFrame(rows, "log_seq BIGINT, ts BIGINT, status INT, etag STRING, body STRING").withColumns({"method": F.lit("GET"), "url": F.lit("u"), "params": F.lit(None).cast("string")})
    for size in (1, 10_000):
        filled = {r.log_seq: (r.served_from, r.served_body) for r in request_log.fill_not_modified(log, size).collect()}
        assert filled == {1: ("own", "first"), 2: ("cache", "first")}


def test_newest_landing_of_a_build_list_counts_once(spark, tmp_path):
    at = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
    schema = f"{LANDED['travis_build_pages']}, ts TIMESTAMP"
    build = lambda i, at_, *jobs: (i, at(at_), [(j,) for j in jobs])
    rows = [
        ("twice", 1, 200, [build(1, 1, 10), build(2, 2, 20)], at(1)),
        ("twice", 1, 200, [build(2, 2, 20), build(3, 3, 30)], at(2)),
        ("twice", 2, 200, [build(2, 2, 21), build(1, 1, 10)], at(1)),  # builds moved on to the next page meanwhile
        ("gone", 1, 200, [build(4, 4, 40)], at(1)),
        ("gone", 1, 404, None, at(2)),
    ]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lists")
    found = readiness.job_steps(read_landed(spark, "travis_build_pages", f"{tmp_path}/lists"), Settings(travis_builds=3), "h").collect()
    assert sorted((r.slug, r.build_rank, r.log_url) for r in found) == [
        ("gone", 1, None), ("twice", 1, "h/job/30/log"), ("twice", 2, "h/job/20/log"),
    ]  # page 2 landed in the older walk through the list, so its builds are not mixed into the newer one


def test_landing_times_are_read_where_the_files_hold_them(spark, tmp_path):
    at = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
    pages = [("a", 1, 500, False, None, [], at(1)), ("a", 1, 404, False, None, [], at(2))]
    spark.createDataFrame(pages, f"{LANDED['run_pages']}, ts TIMESTAMP").write.json(f"{tmp_path}/pages")
    steps = readiness.run_steps(read_landed(spark, "run_pages", f"{tmp_path}/pages", "json")).collect()
    assert [(r.slug, r.kind) for r in steps] == [("a", "list_missing")]
