"""One walk through a list at a time, and pages that never landed."""

import datetime

from pyspark.sql import functions as F

from runsift.operators import discover, readiness
from runsift.operators.first_rows import first_hole, newest_walk
from runsift.schemas import LANDED
from runsift.settings import Settings

at = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
run = lambda i: (i, f"u{i}", '{"login": "a", "type": "User"}', None)
RUNS = f"{LANDED['run_pages']}, ts TIMESTAMP"


def fold(spark, rows, min_builds=5):
    steps = readiness.run_steps(spark.createDataFrame(rows, RUNS)).withColumn("outcome", F.when(F.col("kind") == "probe", "ok"))
    return {r.slug: (r.status, r.builds_found, r.message) for r in readiness.fold_runs(steps, Settings(min_builds=min_builds), ("page", "pos")).collect()}


def test_a_shorter_list_landed_later_replaces_the_old_one_whole(spark):
    rows = [
        ("a", 1, 200, False, None, [run(1), run(2), run(3)], at(1)),
        ("a", 2, 200, False, None, [run(4), run(5), run(6)], at(1)),
        ("a", 1, 200, False, None, [run(7), run(8)], at(5)),
    ]
    assert fold(spark, rows)["a"][:2] == ("insufficient", 2)


def test_a_page_that_never_landed_is_a_failed_request(spark):
    rows = [
        ("gap", 1, 200, False, None, [run(1), run(2), run(3)], at(1)),
        ("gap", 3, 200, False, None, [run(4), run(5), run(6)], at(2)),
        ("late", 2, 200, False, None, [run(9)], at(1)),  # page 1 never landed
        ("full", 1, 200, False, None, [run(10), run(11)], at(1)),  # ends on a page with runs: the list ends there
    ]
    found = fold(spark, rows)
    assert found["gap"] == ("error", 3, "Failed to list runs: page 2 never landed")
    assert found["late"] == ("error", 0, "Failed to list runs: page 1 never landed")
    assert found["full"][:2] == ("insufficient", 2)


def test_a_walk_that_decides_before_the_hole_is_not_failed(spark):
    rows = [
        ("a", 1, 200, False, None, [run(i) for i in range(1, 6)], at(1)),
        ("a", 3, 200, False, None, [run(9)], at(1)),
    ]
    assert fold(spark, rows)["a"][:2] == ("ready", 5)


def test_equal_landing_times_choose_by_content_alike_at_any_partitioning(spark):
    rows = [("a", 1, 200, False, None, [run(1)], at(1)), ("a", 1, 500, False, None, [], at(1))]
    frame = spark.createDataFrame(rows, RUNS)
    chosen = {tuple(r) for r in newest_walk(frame, "slug").select("status").collect()}
    again = {tuple(r) for r in newest_walk(frame.repartition(7), "slug").select("status").collect()}
    assert len(chosen) == 1 and chosen == again


def test_first_hole(spark):
    rows = [("a", 1), ("a", 2), ("a", 4), ("a", 7), ("b", 2), ("c", 1), ("c", 2), ("d", 1), ("d", 1)]
    holes = {r.k: r._hole for r in first_hole(spark.createDataFrame(rows, "k STRING, page INT"), "k").collect()}
    assert holes == {"a": 3, "b": 1}


def test_search_chains_take_the_newest_walk_and_stop_at_a_hole(spark):
    schema = "seg_idx INT, lang_idx INT, page INT, status INT, request_failed BOOLEAN, ts TIMESTAMP"
    chains = spark.createDataFrame(
        [
            (0, 0, 1, 200, False, at(1)), (0, 0, 2, 200, False, at(1)), (0, 0, 1, 200, False, at(3)),  # re-landed: page 1 only
            (1, 0, 1, 200, False, at(1)), (1, 0, 3, 200, False, at(1)),  # page 2 never landed
            (2, 0, 1, 200, False, at(1)), (2, 0, 2, 200, False, at(2)),  # one walk, pages landed one after another
        ],
        schema,
    )
    kept = sorted((r.seg_idx, r.page) for r in discover.cut_page_chains(chains).collect())
    assert kept == [(0, 1), (1, 1), (2, 1), (2, 2)]
