"""The scan as a whole: options, laws and repeatability."""

from pyspark.sql import functions as F

from catalog import landed as L
from catalog.queries import FEW_BUILDS, landed_tables
from runsift.operators import discover, results
from runsift.plans.materialise import materialise
from runsift.plans.scan import found_repositories, open_pairs, scan, scan_updates
from runsift.schemas import RESULT_KEY, RESULTS

SF = "/root/testdata/sf0.001"
def checked():
    return F.lit("2024-02-01").cast("timestamp")


def test_a_second_scan_finds_nothing_new(spark):
    tables, prior = landed_tables(spark, SF, FEW_BUILDS), L.prior_results(spark, SF)
    once = materialise(scan(tables, prior, FEW_BUILDS, checked()))
    assert results.duplicate_keys(once, RESULT_KEY).count() == 0
    left = {r.slug for r in discover.drop_seen(found_repositories(tables.repo_pages), once).collect()}
    assert left == set()
    assert {tuple(r) for r in scan(tables, once, FEW_BUILDS, checked()).collect()} == {tuple(r) for r in once.collect()}


def test_limit_counts_repositories(spark):
    tables, prior = landed_tables(spark, SF, FEW_BUILDS), L.prior_results(spark, SF)
    unseen = discover.drop_seen(found_repositories(tables.repo_pages), prior).orderBy(*discover.TRAVERSAL).limit(7)
    updates = scan_updates(tables, prior, FEW_BUILDS, checked(), limit=7)
    assert {r.slug for r in updates.select("slug").collect()} == {r.slug for r in unseen.collect()}
    assert scan_updates(tables, prior, FEW_BUILDS, checked(), limit=0).count() == 0


def test_per_provider_takes_up_open_providers_of_seen_repositories(spark):
    tables, prior = landed_tables(spark, SF, FEW_BUILDS), L.prior_results(spark, SF)
    default = {(r.slug, r.provider) for r in open_pairs(tables, prior).collect()}
    wider = {(r.slug, r.provider) for r in open_pairs(tables, prior, per_provider=True).collect()}
    done = {(r.slug, r.provider) for r in prior.collect() if r.status != "retry"}
    everything = {(r.slug, r.provider) for r in open_pairs(tables, spark.createDataFrame([], RESULTS)).collect()}
    assert default < wider and wider == everything - done
    few = {r.slug for r in open_pairs(tables, prior, limit=3, per_provider=True).collect()}
    assert len(few) == 3


def test_lists_that_did_not_land(spark):
    tables = landed_tables(spark, SF, FEW_BUILDS)
    bare = type(tables)(**{**tables.__dict__, "run_pages": tables.run_pages.filter("false"), "travis_build_pages": tables.travis_build_pages.filter("false")})
    rows = scan(bare, spark.createDataFrame([], RESULTS), FEW_BUILDS, checked()).collect()
    seen = {(r.provider, r.status, r.builds_found, r.message) for r in rows}
    assert seen == {
        ("github_actions", "error", 0, "Failed to list runs: no page landed"),
        ("travis_ci", "missing_travis", 0, "No Travis builds listed."),
        ("unknown", "skipped", None, "No CI detected."),
    }
    assert all(r.stars is None and r.segment_from is None for r in rows if r.provider == "unknown")


def test_shared_rows_are_written_below_the_folder_of_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    kept = materialise(spark.range(3))
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2]
    assert folder.rstrip("/").split("/")[-1] in kept.inputFiles()[0]
