"""Upserts, request log, quota and entities against their step-by-step rules."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import sequential
from runsift import Settings
from runsift.operators import quota, request_log, results
from runsift.schemas import LANDED
from runsift.sources import entities
from runsift.sources.landing import read_landed
from runsift.sources.results import read_results, write_results

ROW = "slug STRING, provider STRING, status STRING, builds_found LONG, message STRING"
UPDATE = ROW + ", set_fields ARRAY<STRING>, seq LONG"
FIELDS = ["status", "builds_found", "message"]


def as_table(frame):
    return {(r.slug, r.provider): {f: r[f] for f in FIELDS} for r in frame.collect()}


def test_upsert_matches_updates_applied_in_order(spark):
    rnd = random.Random(11)
    old = [(f"o/{i}", "p", "old", i, f"m{i}") for i in range(20)]
    updates = []
    for seq in range(60):
        given = [f for f in FIELDS if rnd.random() < 0.5]
        updates.append((f"o/{rnd.randint(0, 30)}", "p", rnd.choice(["new", None]), rnd.choice([seq, None]), rnd.choice(["x", None]), given, seq))
    want = sequential.upsert(
        {(r[0], r[1]): dict(zip(FIELDS, r[2:])) for r in old},
        [((u[0], u[1]), u[5], dict(zip(FIELDS, u[2:5]))) for u in updates])
    want = {k: {f: row.get(f) for f in FIELDS} for k, row in want.items()}
    rnd.shuffle(updates)
    frame = spark.createDataFrame(updates, UPDATE)
    once = results.upsert(spark.createDataFrame(old, ROW), frame, ["slug", "provider"])
    assert as_table(once) == want
    assert as_table(results.upsert(once, frame, ["slug", "provider"])) == want
    assert results.duplicate_keys(once, ["slug", "provider"]).count() == 0
    twice = once.unionByName(once.filter("slug = 'o/1'"))
    assert [(r.slug, r.rows) for r in results.duplicate_keys(twice, ["slug", "provider"]).collect()] == [("o/1", 2)]


def test_details_and_unions(spark):
    repos = spark.createDataFrame([("a", None, "Java"), ("b", 3, None)], "slug STRING, stargazers_count LONG, language STRING").withColumns(
        {"pushed_at": F.lit(datetime(2024, 1, 1)), "segment_from": F.lit(None).cast("date"), "segment_to": F.lit(None).cast("date")})
    details = results.repo_details(repos, F.lit(datetime(2024, 2, 2)))
    assert {r.slug: (r.stars, r.languages_hint) for r in details.collect()} == {"a": (0, "Java"), "b": (3, None)}
    evaluated = spark.createDataFrame([("a", "ready", 99)], "slug STRING, status STRING, stars LONG")
    joined = {r.slug: (r.stars, r.status) for r in results.with_details(details, evaluated).collect()}
    assert joined == {"a": (99, "ready"), "b": (None, None)}
    both = results.union_branches(evaluated, spark.createDataFrame([("c", "m")], "slug STRING, message STRING"))
    assert {(r.slug, r.status, r.message) for r in both.collect()} == {("a", "ready", None), ("c", None, "m")}


def test_passes(spark):
    frame = spark.createDataFrame([(1,), (1,), (3,)], "pass_id LONG")
    assert [tuple(r) for r in results.processed_per_pass(frame).orderBy("pass_id").collect()] == [(1, 2, 2), (3, 1, 3)]


def test_result_versions(spark, tmp_path):
    base = str(tmp_path / "results")
    row = spark.createDataFrame([("a", "p", "ready", 1, "m")], ROW)
    assert read_results(spark, base, ROW).count() == 0
    write_results(row, base, 1)
    write_results(row.withColumn("status", F.lit("later")), base, 2)
    (tmp_path / "results" / "version=3").mkdir()
    assert read_results(spark, base, ROW).first().status == "later"
    assert read_results(spark, base, ROW, before=2).first().status == "ready"
    write_results(row.withColumn("status", F.lit("again")), base, 2)
    assert read_results(spark, base, ROW).first().status == "again"


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_landed_formats(spark, tmp_path, fmt):
    rows = [("a", "runs", 200, 3), ("b", "travis_yml", 404, None)]
    path = str(tmp_path / fmt)
    spark.createDataFrame(rows, LANDED["ci_probes"]).write.format(fmt).save(path)
    assert sorted(map(tuple, read_landed(spark, "ci_probes", path, fmt).collect())) == rows


def log_frame(spark, rows):
    """rows: dicts over the request log's columns."""
    names = [c.split()[0] for c in LANDED["request_log"].split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], LANDED["request_log"])


@pytest.mark.parametrize("slice_seconds", [1, 7, 10_000])
def test_not_modified_matches_a_cache_kept_in_order(spark, slice_seconds):
    rnd = random.Random(slice_seconds)
    rows, ts = [], 0
    for n in range(400):
        ts += rnd.randint(0, 3)
        rows.append({
            "log_seq": n, "ts": ts, "method": "GET" if rnd.random() < 0.9 else "POST", "url": f"u{rnd.choice([0, 0, 0, 1, 2])}",
            "params": rnd.choice([None, "{}"]), "status": rnd.choice([200, 304, 304, 404]), "etag": rnd.choice(["e", "", None]),
            "body": rnd.choice([f"b{n}", None]),
        })
    served, cache_input = {}, []
    for r in rows:
        if r["method"] == "GET":
            cache_input.append(r)
        else:
            served[r["log_seq"]] = (r["status"], r["body"], "own")
    told = sequential.served_bodies([((r["url"], r["params"]), r["status"], bool(r["etag"]), r["body"]) for r in cache_input])
    served.update({r["log_seq"]: s for r, s in zip(cache_input, told)})
    got = request_log.fill_not_modified(log_frame(spark, rows), slice_seconds).collect()
    assert {r.log_seq: (r.served_status, r.served_body, r.served_from) for r in got} == served


def test_retry_costs(spark):
    rows = [{"request_id": 1, "status": 200}]
    rows += [{"request_id": 2, "status": s} for s in (503, 503, 200)]
    rows += [{"request_id": 3, "status": 500}] * 4 + [{"request_id": 4, "failed": True}, {"request_id": 4, "status": 404}]
    got = {r.request_id: (r.attempts, r.failures, r.planned_wait, r.exhausted)
           for r in request_log.retry_costs(log_frame(spark, rows), Settings()).collect()}
    assert got == {1: (1, 0, 0.0, False), 2: (3, 2, 0.75, False), 3: (4, 4, 1.75, True), 4: (2, 1, 0.25, False)}


def test_retries_used(spark):
    statuses = [503, 200, None, 500, 503, 200]
    rows = [{"request_id": 1, "attempt": n + 1, "status": s, "failed": s is None} for n, s in enumerate(statuses)]
    rows += [{"request_id": 2, "attempt": 1, "status": 200}]
    got = {(r.request_id, r.attempt): r.retries_used for r in
           request_log.with_retries_used(log_frame(spark, rows), Settings(retry_count=2)).collect()}
    assert got == {(1, 1): 0, (1, 2): 1, (1, 3): 1, (1, 4): 2, (1, 5): 2, (1, 6): 2, (2, 1): 0}


def test_travis_pool_follows_the_travis_client(spark):
    base = {"pool": "travis", "remaining": "50", "reset": "900"}
    later = {"401": {"status": 401}, "403": {"status": 403, "remaining": "0"}, "spam": {"status": 422, "body": "flagged as Spammy"},
             "429": {"status": 429, "remaining": "7", "reset": "5000"}, "503": {"status": 503, "remaining": "7", "reset": "5000"},
             "lost": {"failed": True}}
    rows = [{**base, "log_seq": 1, "ts": 1000, "credential_hash": h, "status": 200} for h in later]
    rows += [{**base, **answer, "log_seq": 2, "ts": 1010, "credential_hash": h} for h, answer in later.items()]
    want = {"401": (50, 900, 1010), "403": (0, 900, 1010), "spam": (50, 900, 1010), "429": (0, 1070, 1000), "503": (50, 900, 1000), "lost": (50, 900, 1000)}
    for fold in (quota.quota_state, quota.quota_state_in_memory):
        got = fold(log_frame(spark, rows), travis_pool="travis").collect()
        assert {r.credential_hash: (r.remaining, r.reset_time, r.last_used) for r in got} == want
        assert not any(r.removed or r.disabled for r in got)


def test_quota_in_memory_moves_only_past_resets(spark):
    rows = [{"log_seq": i, "ts": t, "credential_hash": "h", "pool": "p", "status": 429} for i, t in enumerate((1000, 1030, 1061))]
    one = quota.quota_state_in_memory(log_frame(spark, rows[:2])).first()
    assert one.reset_time == 1060
    assert quota.quota_state_in_memory(log_frame(spark, rows)).first().reset_time == 1121
    assert quota.quota_state(log_frame(spark, rows)).first().reset_time == 1121


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quota_matches_a_fold_in_order(spark, seed):
    rnd = random.Random(seed)
    rows, events, ts = [], {}, 0
    for n in range(1500):
        ts += rnd.choice([0, 0, 1, 3, 20])
        c = f"h{rnd.choice([0, 0, 0, 1, 2, 3])}"
        limited = rnd.random() < 0.3
        header = ts + rnd.randint(-30, 90) if rnd.random() < {"h0": 0.0, "h1": 0.005, "h2": 0.2, "h3": 0.01}[c] else None
        rows.append({"log_seq": n, "ts": ts, "credential_hash": c, "pool": "p", "status": 429 if limited else 200,
                     "reset": None if header is None else str(header), "remaining": rnd.choice([None, "0", "17", "x"])})
        events.setdefault(c, []).append((ts, limited, header))
    frame = log_frame(spark, rows)
    for stored, fold in ((True, quota.quota_state), (False, quota.quota_state_in_memory)):
        got = {r.credential_hash: r.reset_time for r in fold(frame).collect()}
        assert got == {c: sequential.quota_reset(e, stored) for c, e in events.items()}


def test_quota_flags_and_merge(spark):
    rows = [
        {"log_seq": 1, "ts": 10, "credential_hash": "a", "pool": "p", "status": 200, "remaining": "5", "reset": "99"},
        {"log_seq": 2, "ts": 11, "credential_hash": "a", "pool": "p", "status": 403, "remaining": "0"},
        {"log_seq": 3, "ts": 12, "credential_hash": "b", "pool": "p", "status": 401, "body": "spammy"},
        {"log_seq": 4, "ts": 13, "credential_hash": "c", "pool": "p", "status": 404, "body": "SPAMMY", "remaining": "9"},
        {"log_seq": 5, "ts": 14, "credential_hash": "d", "pool": "p", "failed": True},
        {"log_seq": 6, "ts": 15, "credential_hash": "a", "pool": "p", "status": 200},
    ]
    shown = ["remaining", "reset_time", "last_used", "disabled", "removed"]
    whole = {r.credential_hash: tuple(r[c] for c in shown) for r in quota.quota_state(log_frame(spark, rows)).collect()}
    assert whole == {"a": (0, 71, 15, False, False), "b": (None, None, 12, False, True), "c": (9, None, 13, True, False),
                     "d": (None, None, None, False, False)}
    state = spark.createDataFrame([], LANDED["quota_state"])
    for piece in (rows[:2], rows[2:4], rows[4:]):
        state = quota.merge_quota(state, quota.quota_state(log_frame(spark, piece)))
    assert {r.credential_hash: tuple(r[c] for c in shown) for r in state.collect()} == whole


def test_quota_reports(spark):
    rows = [
        ("aaaaaaaaaa1", "open", False, False, 10, 500, 90, 1), ("aaaaaaaaaa2", "open", None, None, 20, 500, None, 1),
        ("aaaaaaaaaa3", "open", True, False, 4000, 500, 90, 1), ("aaaaaaaaaa4", "open", False, True, 4000, 500, 90, 1),
        ("b", "dry", False, False, 0, 150, 90, 1), ("c", "dry", False, False, 0, 400, 90, 1),
        ("d", "off", True, False, 10, 500, 90, 1),
    ]
    state = spark.createDataFrame(rows, LANDED["quota_state"])
    got = {r.pool: (r.enabled, r.best, r.best_left, r.wait_seconds, r.state) for r in quota.quota_pick(state, F.lit(100)).collect()}
    assert got == {"open": (2, "aaaaaaaaaa2", 20, None, "available"), "dry": (2, None, None, 51.0, "wait"), "off": (0, None, None, None, "none active")}
    listed = {(r.credential, r.disabled, r.cool_down, r.last_used) for r in quota.quota_inventory(state, "open", F.lit(100)).collect()}
    assert ("aaaa...aaa2", False, "1970-01-01T00:08:20Z", "Never") in listed and len(listed) == 4
    added = spark.createDataFrame([("d", "off"), ("new", "off"), ("aaaaaaaaaa4", "open")], "credential_hash STRING, pool STRING")
    enabled = {r.credential_hash: (r.disabled, r.removed, r.remaining, r.added_at) for r in
               quota.enable_credentials(state, added, F.lit(100).cast("bigint")).collect()}
    assert len(enabled) == 8 and enabled["d"] == (False, False, 10, 100) and enabled["new"] == (False, False, None, 100)
    assert enabled["aaaaaaaaaa4"] == (False, False, None, 100) and enabled["aaaaaaaaaa3"] == (True, False, 4000, 1)


PAGES = LANDED["api_pages"]


@pytest.mark.parametrize("entity", entities.OBJECT_ENTITIES)
def test_object_entities(spark, entity):
    pages = spark.createDataFrame(
        [(entity, "a", 1, 200, '{"k": 1}'), (entity, "b", 1, 404, '{"k": 2}'), (entity, "c", 1, 200, "[1]"), (entity, "d", 1, 200, "no"),
         ("other", "e", 1, 200, '{"k": 3}')], PAGES)
    strict = entities.entity_objects(pages, entity, schema="k LONG").collect()
    assert {r.parent: r.data and r.data.k for r in strict} == {"a": 1, "b": None, "c": None, "d": None}
    raw = entities.entity_objects(pages, entity, raw=True).collect()
    assert {r.parent: r.body for r in raw} == {"a": '{"k": 1}', "b": '{"k": 2}', "c": None, "d": None}


@pytest.mark.parametrize("entity", entities.PAGED_ENTITIES + entities.SINGLE_PAGE_ENTITIES)
def test_list_entities(spark, entity):
    pages = spark.createDataFrame(
        [(entity, "a", 2, 200, '[{"k": 3}]'), (entity, "a", 1, 200, '[{"k": 1}, {"k": 2}]'), (entity, "a", 3, 200, '{"k": 4}'),
         (entity, "a", 4, 404, '{"k": 5}'), (entity, "a", 5, 200, "[]"), (entity, "b", 1, 200, '{"k": 9}'), (entity, "c", 1, 200, "no")], PAGES)

    def shown(**kwargs):
        rows = entities.entity_items(pages, entity, schema="k LONG", **kwargs).collect()
        return [(r.parent, r.data.k) for r in sorted(rows, key=lambda r: (r.parent, r.page, r.pos))]

    if entity in entities.PAGED_ENTITIES:
        assert shown() == [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 9)]
        assert shown(raw=True) == [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("a", 5), ("b", 9)]
    else:
        assert shown() == [("a", 1), ("a", 2)]


def test_languages_graphql_and_names(spark):
    body = json.dumps({"C": 5, "Java": 70})
    pages = spark.createDataFrame(
        [("languages", "a", 1, 200, body), ("languages", "b", 1, 404, body), ("languages", "c", 1, 200, "[]"),
         ("graphql", "a", 1, 200, '{"errors":[1]}'), ("graphql", "b", 1, 502, "x")], PAGES)
    assert {tuple(r) for r in entities.languages(pages).collect()} == {("a", "C", 5), ("a", "Java", 70)}
    assert {tuple(r) for r in entities.graphql_results(pages).collect()} == {("a", '{"errors":[1]}', True), ("b", "{}", False)}
    with pytest.raises(ValueError):
        entities.entity_items(pages, "commit")
    with pytest.raises(ValueError):
        entities.entity_objects(pages, "commits")


def test_settings():
    raw = {"min_builds": 4, "languages": ["C", 3], "max_workers": 5, "another": "x"}
    assert Settings.from_mapping(raw) == Settings(min_builds=4, languages=("C", "3"))
    for bad in ({"min_builds": 0}, {"languages": "Java"}, {"search_segments": ["2018-12-01"]}):
        with pytest.raises(ValueError):
            Settings.from_mapping(bad)
