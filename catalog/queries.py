"""The registered queries: each runs library operators over the given tables, whole."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import duck
from catalog import landed as L
from runsift import Settings
from runsift.functions import text as T
from runsift.functions.actors import is_human, run_actor, worth_a_request
from runsift.functions.outcomes import github_code, travis_code
from runsift.functions.requests import backoff_seconds
from runsift.operators import discover, logs, providers, quota, readiness, request_log, results, worklist
from runsift.plans.scan import Landed, found_repositories, scan
from runsift.schemas import RESULT_KEY, RESULTS
from runsift.sources import entities
from runsift.sources.landing import read_landed_stream
from runsift.sources.results import read_results
from runsift.streaming import passes
from runsift.streaming import readiness as live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

FEW_BUILDS = Settings(min_builds=5)
TWO_RETRIES = Settings(retry_count=2)
RESULT_COLUMNS = ["slug", "status", "builds_found", "message"]


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = duck.query(sql)
        return run

    return keep


# ---------------------------------------------------------------- readiness
@register(duck.github_fold("probes", "seq", 30, has_kind=False))
def readiness_gh(spark: SparkSession, sf: str) -> DataFrame:
    return readiness.fold_runs(L.probes(spark, sf), Settings())


@register("SELECT * FROM github_status")
def readiness_gh_pages(spark: SparkSession, sf: str) -> DataFrame:
    steps = readiness.bound_steps(readiness.run_steps(L.run_pages(spark, sf)), FEW_BUILDS)
    judged = logs.with_outcomes(steps, L.responses(spark, sf), github_code)
    return readiness.fold_runs(judged, FEW_BUILDS, readiness.RUN_ORDER, bounded=True)


@register(duck.travis_fold(30))
def readiness_travis(spark: SparkSession, sf: str) -> DataFrame:
    settings = Settings()
    steps = readiness.job_steps(L.travis_build_pages(spark, sf), settings)
    judged = logs.with_outcomes(steps, L.travis_responses(spark, sf, settings.travis_api_url), travis_code)
    return readiness.fold_jobs(judged, settings)


# ---------------------------------------------------------------- log outcomes
@register("SELECT id, outcome FROM run_outcomes UNION ALL SELECT id, NULL FROM runs WHERE logs_url = ''")
def log_outcome_gh(spark: SparkSession, sf: str) -> DataFrame:
    requests = L.runs(spark, sf).select("id", F.nullif("logs_url", F.lit("")).alias("log_url"))
    return logs.with_outcomes(requests, L.responses(spark, sf), github_code, spread="id").select("id", "outcome")


@register("SELECT job, outcome FROM job_outcomes")
def log_outcome_travis(spark: SparkSession, sf: str) -> DataFrame:
    api = Settings().travis_api_url
    requests = L.table(spark, sf, "events").select(
        F.col("event_id").alias("job"), T.travis_log_address(api, F.col("event_id")).alias("log_url")
    )
    answers = L.travis_responses(spark, sf, api)
    return logs.with_outcomes(requests, answers, travis_code, spread="job").select("job", "outcome")


@register(
    f"""SELECT id, {duck.HUMAN.format('ta')} AS trigger_is_human, {duck.HUMAN.format('chosen')} AS actor_is_human,
    logs_url <> '' AND {duck.HUMAN.format('chosen')} AS worth_a_request FROM chosen_runs"""
)
def human_actor(spark: SparkSession, sf: str) -> DataFrame:
    chosen = run_actor(F.col("triggering_actor"), F.col("actor"))
    return L.runs(spark, sf).select(
        "id",
        is_human(F.col("triggering_actor")).alias("trigger_is_human"),
        is_human(chosen).alias("actor_is_human"),
        worth_a_request(F.col("logs_url"), chosen).alias("worth_a_request"),
    )


# ---------------------------------------------------------------- work list and search
@register(
    """SELECT o_orderpriority, o_orderstatus, CAST(i AS BIGINT) AS seg_idx,
    CAST(d + CAST(7 * i AS INTEGER) AS VARCHAR) AS segment_from,
    CAST(least(d + CAST(7 * i AS INTEGER) + 6, e) AS VARCHAR) AS segment_to
    FROM (SELECT *, unnest(range(0, (e - d) // 7 + 1)) AS i FROM (
      SELECT o_orderpriority, o_orderstatus, CAST(min(o_orderdate) AS DATE) AS d, CAST(max(o_orderdate) AS DATE) AS e
      FROM orders GROUP BY ALL))"""
)
def weekly_segments(spark: SparkSession, sf: str) -> DataFrame:
    return worklist.weekly_segments(L.date_ranges(spark, sf)).select(
        "o_orderpriority",
        "o_orderstatus",
        F.col("seg_idx").cast("bigint").alias("seg_idx"),
        F.col("segment_from").cast("string").alias("segment_from"),
        F.col("segment_to").cast("string").alias("segment_to"),
    )


@register(
    """SELECT CAST(i AS BIGINT) AS seg_idx, CAST(lang_idx AS BIGINT) AS lang_idx, lang, CAST(page AS BIGINT) AS page,
    'language:' || lang || ' created:' || (d + CAST(7 * i AS INTEGER)) || '..' ||
      least(d + CAST(7 * i AS INTEGER) + 6, e) || ' stars:>=50' AS search
    FROM (SELECT *, unnest(range(0, (e - d) // 7 + 1)) AS i FROM (
      SELECT CAST(min(o_orderdate) AS DATE) AS d, CAST(max(o_orderdate) AS DATE) AS e FROM orders))
    CROSS JOIN (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS lang_idx FROM (SELECT DISTINCT lang FROM documents))
    CROSS JOIN (SELECT unnest([1, 2, 3]) AS page)"""
)
def work_list(spark: SparkSession, sf: str) -> DataFrame:
    langs = L.table(spark, sf, "documents").agg(F.array_sort(F.collect_set("lang"))).scalar()
    segments = worklist.weekly_segments(L.order_span(spark, sf))
    return worklist.work_list(segments, langs, Settings(search_pages=3)).select(
        F.col("seg_idx").cast("bigint").alias("seg_idx"),
        F.col("lang_idx").cast("bigint").alias("lang_idx"),
        "lang",
        F.col("page").cast("bigint").alias("page"),
        "search",
    )


@register(
    """SELECT slug, CAST((created - first_day) // 7 AS BIGINT) AS seg_idx, CAST(lang_idx AS BIGINT) AS lang_idx, stars
    FROM repos CROSS JOIN span WHERE stars >= 50000"""
)
def segment_match(spark: SparkSession, sf: str) -> DataFrame:
    segments = worklist.weekly_segments(L.order_span(spark, sf))
    found = worklist.search_filter(L.repos(spark, sf), Settings(min_stars=50000), segments)
    return found.select(
        "slug",
        F.col("seg_idx").cast("bigint").alias("seg_idx"),
        F.col("lang_idx").cast("bigint").alias("lang_idx"),
        F.col("stargazers_count").alias("stars"),
    )


@register("SELECT slug, CAST(lang_idx AS BIGINT) AS lang_idx FROM repos WHERE created >= DATE '1998-01-01' AND stars >= 50 AND lang_idx < 2")
def updated_since(spark: SparkSession, sf: str) -> DataFrame:
    settings = Settings(updated_since="1998-01-01", languages=("Python", "Ruby"))
    found = worklist.search_filter(L.repos(spark, sf), settings)
    return found.select("slug", F.col("lang_idx").cast("bigint").alias("lang_idx"))


@register(
    """SELECT CAST(seg_idx AS BIGINT) AS seg_idx, CAST(lang_idx AS BIGINT) AS lang_idx, slug, CAST(n AS BIGINT) AS rank,
    CAST((n - 1) // 4 + 1 AS BIGINT) AS page, CAST((n - 1) % 4 AS BIGINT) AS pos
    FROM (SELECT *, row_number() OVER (PARTITION BY seg_idx, lang_idx ORDER BY stars DESC, slug) AS n
      FROM (SELECT *, (created - first_day) // 7 AS seg_idx FROM repos CROSS JOIN span WHERE stars >= 50))
    WHERE n <= 8"""
)
def search_topk(spark: SparkSession, sf: str) -> DataFrame:
    settings = Settings(search_per_page=4, search_pages=2)
    segments = worklist.weekly_segments(L.order_span(spark, sf))
    ranked = discover.search_pages(worklist.search_filter(L.repos(spark, sf), settings, segments), settings)
    return ranked.select(
        *[F.col(c).cast("bigint").alias(c) for c in ("seg_idx", "lang_idx", "rank", "page", "pos")], "slug"
    )


@register(
    """SELECT o_orderkey, trim(f) AS segment_from, trim(t) AS segment_to FROM (
      SELECT o_orderkey,
        CASE o_orderkey % 6 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
          WHEN 1 THEN ' ' || CAST(o_orderdate AS DATE) || ' ' WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
          WHEN 3 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) WHEN 4 THEN '' ELSE '  ' END AS f,
        CASE o_orderkey % 6 WHEN 3 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) + 6 AS VARCHAR) END AS t
      FROM orders) WHERE trim(f) <> '' AND trim(t) <> ''"""
)
def segment_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Segments written in each accepted form: three namings, a pair, a missing end and blank ends."""
    raw = L.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS ordinal",
        "cast(cast(o_orderdate AS date) AS string) AS f",
        "cast(date_add(cast(o_orderdate AS date), 6) AS string) AS t",
    ).selectExpr(
        "ordinal",
        """CASE ordinal % 6 WHEN 0 THEN map('from', f, 'to', t) WHEN 1 THEN map('start', concat(' ', f, ' '), 'end', t)
             WHEN 3 THEN map('from_', f) WHEN 4 THEN map('from', '', 'to_', t) WHEN 5 THEN map('from', '  ', 'to_', t)
           END AS fields""",
        "CASE WHEN ordinal % 6 = 2 THEN array(f, t) END AS pair",
    )
    return worklist.normalise_segments(raw).withColumnRenamed("ordinal", "o_orderkey")


# ---------------------------------------------------------------- taking up repositories
@register("SELECT CAST(seg_idx AS BIGINT) AS seg_idx, CAST(lang_idx AS BIGINT) AS lang_idx, CAST(page AS BIGINT) AS page, items FROM kept_pages")
def page_chain(spark: SparkSession, sf: str) -> DataFrame:
    return discover.cut_page_chains(L.repo_pages(spark, sf)).select(
        *[F.col(c).cast("bigint").alias(c) for c in ("seg_idx", "lang_idx", "page")],
        F.size("items").cast("bigint").alias("items"),
    )


PLACE = ["seg_idx", "lang_idx", "page", "pos"]
PLACE_SQL = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in PLACE)


def _placed(rows: DataFrame) -> DataFrame:
    return rows.select("slug", *[F.col(c).cast("bigint").alias(c) for c in PLACE])


@register(f"SELECT slug, {PLACE_SQL} FROM firsts")
def first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return _placed(found_repositories(L.repo_pages(spark, sf)))


@register(f"SELECT slug, {PLACE_SQL} FROM hits WHERE slug = ''")
def blank_slugs(spark: SparkSession, sf: str) -> DataFrame:
    hits = discover.search_hits(discover.cut_page_chains(L.repo_pages(spark, sf)))
    return _placed(discover.split_rejects(hits)[1])


UNSEEN_SQL = "NOT EXISTS (SELECT 1 FROM prior p WHERE p.slug = f.slug AND p.status IS DISTINCT FROM 'retry')"


@register(f"SELECT slug, {PLACE_SQL} FROM firsts f WHERE {UNSEEN_SQL} ORDER BY seg_idx, lang_idx, page, pos LIMIT 25")
def limit_unseen(spark: SparkSession, sf: str) -> DataFrame:
    found = found_repositories(L.repo_pages(spark, sf))
    return _placed(discover.limit_unseen(found, L.prior_results(spark, sf), 25))


@register(f"SELECT slug, {PLACE_SQL} FROM firsts f WHERE {UNSEEN_SQL}")
def unseen_repositories(spark: SparkSession, sf: str) -> DataFrame:
    found = found_repositories(L.repo_pages(spark, sf))
    return _placed(discover.limit_unseen(found, L.prior_results(spark, sf), None))


@register(
    """SELECT slug, provider FROM pairs q WHERE NOT EXISTS (SELECT 1 FROM prior p
    WHERE p.slug = q.slug AND p.provider = q.provider AND p.status IS DISTINCT FROM 'retry')"""
)
def unseen_pairs(spark: SparkSession, sf: str) -> DataFrame:
    found = providers.detect_providers(L.ci_probes(spark, sf))
    pairs = providers.fan_out(found.select("slug"), found)
    return discover.drop_seen_pairs(pairs, L.prior_results(spark, sf))


# ---------------------------------------------------------------- providers
@register(
    f"""SELECT slug, CASE WHEN github AND travis THEN '{duck.GITHUB},{duck.TRAVIS}' WHEN github THEN '{duck.GITHUB}'
    WHEN travis THEN '{duck.TRAVIS}' ELSE '' END AS providers FROM providers"""
)
def detect_providers(spark: SparkSession, sf: str) -> DataFrame:
    found = providers.detect_providers(L.ci_probes(spark, sf))
    return found.select("slug", F.array_join("providers", ",").alias("providers"))


@register(
    """SELECT slug, provider, CASE provider WHEN 'unknown' THEN 'No CI detected.' END AS message FROM pairs"""
)
def provider_fanout(spark: SparkSession, sf: str) -> DataFrame:
    found = providers.detect_providers(L.ci_probes(spark, sf))
    pairs = providers.fan_out(found.select("slug"), found)
    known = pairs.filter("provider <> 'unknown'")
    unknown = pairs.filter("provider = 'unknown'").withColumn("message", F.lit("No CI detected."))
    return results.union_branches(known, unknown)


# ---------------------------------------------------------------- results
CHECKED_AT = "timestamp_seconds(1706745600)"


@register(
    f"""SELECT f.slug, coalesce(f.stars, 0) AS stars, f.pushed_at, f.lang AS languages_hint,
    (1995 + seg_idx) || '-01-01' AS segment_from, (1995 + seg_idx) || '-12-31' AS segment_to,
    CAST(1706745600 AS BIGINT) AS checked_at, v.status, v.builds_found
    FROM firsts f LEFT JOIN ({duck.github_fold('probes', 'seq', 30, has_kind=False)}) v ON f.slug = v.slug"""
)
def repo_details(spark: SparkSession, sf: str) -> DataFrame:
    details = results.repo_details(found_repositories(L.repo_pages(spark, sf)), F.expr(CHECKED_AT))
    verdicts = readiness.fold_runs(L.probes(spark, sf), Settings()).drop("message")
    return _flat(results.with_details(details, verdicts))


def _flat(rows: DataFrame) -> DataFrame:
    """Times as epoch seconds and dates as text, so that engines agree on their values."""
    shown = []
    for name, kind in rows.dtypes:
        column = F.col(name)
        if kind == "timestamp":
            column = F.unix_seconds(column)
        elif kind == "date":
            column = column.cast("string")
        shown.append(column.alias(name))
    return rows.select(*shown)


@register(
    """SELECT coalesce(p.slug, u.slug) AS slug, coalesce(p.provider, u.provider) AS provider,
    CASE WHEN u.slug IS NOT NULL THEN u.status ELSE p.status END AS status, p.checked_at, p.stars, p.pushed_at,
    p.languages_hint, p.segment_from, p.segment_to,
    CASE WHEN u.any_builds THEN u.builds_found ELSE p.builds_found END AS builds_found,
    CASE WHEN u.any_message THEN u.message ELSE p.message END AS message
    FROM prior p FULL OUTER JOIN (
      SELECT slug, provider, last(status ORDER BY seq) AS status, bool_or(gives_builds) AS any_builds,
        bool_or(gives_message) AS any_message, last(builds_found ORDER BY seq) FILTER (gives_builds) AS builds_found,
        last(message ORDER BY seq) FILTER (gives_message) AS message
      FROM updates GROUP BY slug, provider) u ON p.slug = u.slug AND p.provider = u.provider"""
)
def upsert_results(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(results.upsert(L.prior_results(spark, sf), L.result_updates(spark, sf), RESULT_KEY))


@register("SELECT slug, provider, count(*) AS rows FROM updates GROUP BY slug, provider HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return results.duplicate_keys(L.result_updates(spark, sf), RESULT_KEY)


@register(
    """SELECT pass_id, processed, CAST(sum(processed) OVER (ORDER BY pass_id) AS BIGINT) AS total
    FROM (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS pass_id, count(*) AS processed FROM orders GROUP BY 1)"""
)
def pass_counts(spark: SparkSession, sf: str) -> DataFrame:
    """One pass per day of the order table."""
    handled = L.table(spark, sf, "orders").selectExpr("cast(cast(o_orderdate AS date) AS string) AS pass_id")
    return results.processed_per_pass(handled)


@register(
    """SELECT slug, page, runs, CAST(coalesce(sum(good) OVER (PARTITION BY slug ORDER BY page
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ok_before
    FROM (SELECT *, min(page) FILTER (page_rule IN (5, 17, 23, 31)) OVER (PARTITION BY slug) AS ends
    FROM (SELECT w.slug, w.page, page_rule, CASE WHEN page_rule = 31 THEN 0 ELSE count(*) END AS runs,
        count(*) FILTER (worthy AND outcome = 'ok' AND page_rule NOT IN (5, 17, 23, 31)) AS good
      FROM worthy_runs w LEFT JOIN run_outcomes o ON w.id = o.id GROUP BY w.slug, w.page, page_rule
      UNION ALL SELECT 'org' || (c_custkey % 15) || '/repo' || c_custkey, 1, 31, 0, 0 FROM idle_customers
        WHERE c_custkey % 3 = 1))
    WHERE ends IS NULL OR page < ends OR (page = ends AND page_rule = 31)"""
)
def page_progress(spark: SparkSession, sf: str) -> DataFrame:
    pages = L.run_pages(spark, sf)
    judged = logs.with_outcomes(readiness.run_steps(pages), L.responses(spark, sf), github_code)
    return results.page_progress(judged, pages).select(
        "slug", *[F.col(c).cast("bigint").alias(c) for c in ("page", "runs", "ok_before")]
    )


# ---------------------------------------------------------------- request log
@register(
    """SELECT log_seq, served_status, served_from, CASE served_from WHEN 'cache' THEN cached ELSE body END AS served_body
    FROM (SELECT *, CASE WHEN NOT stale THEN 'own' WHEN cached IS NULL THEN 'open' ELSE 'cache' END AS served_from,
        CAST(CASE WHEN stale AND cached IS NOT NULL THEN 200 ELSE status END AS BIGINT) AS served_status
      FROM (SELECT *, coalesce(method = 'GET' AND status = 304, false) AS stale,
          last_value(CASE WHEN method = 'GET' AND status = 200 AND has_etag THEN body END IGNORE NULLS)
            OVER (PARTITION BY md5(url || ':' || coalesce(params, 'null')) ORDER BY log_seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cached FROM log))"""
)
def not_modified(spark: SparkSession, sf: str) -> DataFrame:
    return request_log.fill_not_modified(L.request_log(spark, sf)).select(
        "log_seq", F.col("served_status").cast("bigint").alias("served_status"), "served_from", "served_body"
    )


@register(
    """SELECT log_seq, CASE WHEN failed THEN CASE WHEN retries_used < 2 THEN 'retry_failed' ELSE 'give_up' END
      WHEN method = 'GET' AND status = 304 AND log_seq % 4 < 2 THEN 'serve_cached'
      WHEN method = 'GET' AND status = 304 AND log_seq % 4 = 2 THEN 'retry_without_etag'
      WHEN removes THEN 'retry_credential_removed' WHEN status = 403 AND remaining = 0 THEN 'retry_quota_exhausted'
      WHEN spam THEN 'retry_credential_disabled' WHEN status >= 500 AND retries_used < 2 THEN 'retry_server_error'
      ELSE 'return' END AS disposition, exhausted AS marks_exhausted FROM log_flags"""
)
def disposition(spark: SparkSession, sf: str) -> DataFrame:
    log = L.request_log(spark, sf).withColumn(
        "cache", F.expr("CASE WHEN log_seq % 4 < 2 THEN 'readable' WHEN log_seq % 4 = 2 THEN 'unreadable' ELSE 'none' END")
    )
    return request_log.with_dispositions(log, TWO_RETRIES).select("log_seq", "disposition", "marks_exhausted")


@register(
    """SELECT log_seq, CASE WHEN failed THEN CASE WHEN retries_used < 2 THEN 'retry_failed' ELSE 'give_up' END
      WHEN status = 429 THEN 'wait_and_retry' WHEN status >= 500 AND retries_used < 2 THEN 'retry_server_error'
      ELSE 'return' END AS disposition,
    CASE WHEN status = 429 THEN CASE retry_after WHEN '0.2' THEN 1.0::DOUBLE WHEN '7' THEN 7.0::DOUBLE ELSE 300.0::DOUBLE END
      END AS wait_seconds FROM log_flags"""
)
def disposition_travis(spark: SparkSession, sf: str) -> DataFrame:
    return request_log.with_travis_dispositions(L.request_log(spark, sf), TWO_RETRIES).select("log_seq", "disposition", "wait_seconds")


@register(
    """SELECT request_id, attempts, failures, CASE least(failures, 2) WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 0.25::DOUBLE
      ELSE 0.75::DOUBLE END AS planned_wait, failures > 2 AS exhausted
    FROM (SELECT request_id, count(*) AS attempts, count(*) FILTER (failed OR status >= 500) AS failures
      FROM log GROUP BY request_id)"""
)
def retry_cost(spark: SparkSession, sf: str) -> DataFrame:
    return request_log.retry_costs(L.request_log(spark, sf), TWO_RETRIES)


@register(
    """SELECT log_seq, CASE attempt WHEN 1 THEN 0.25::DOUBLE WHEN 2 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS backoff,
    md5(url || ':' || coalesce(params, 'null')) AS request_key FROM log"""
)
def request_keys(spark: SparkSession, sf: str) -> DataFrame:
    return L.request_log(spark, sf).select(
        "log_seq",
        backoff_seconds(F.col("attempt"), Settings().retry_base_delay_seconds).alias("backoff"),
        T.request_key(F.col("url"), F.col("params")).alias("request_key"),
    )


# ---------------------------------------------------------------- quota
STATE_COLUMNS = ["pool", "credential_hash", "remaining", "reset_time", "last_used", "disabled", "removed"]
STATE_SQL = ", ".join(STATE_COLUMNS)


@register(f"SELECT {STATE_SQL} FROM stored_state")
def quota_state(spark: SparkSession, sf: str) -> DataFrame:
    return quota.quota_state(L.request_log(spark, sf)).select(*STATE_COLUMNS)


@register(f"SELECT {STATE_SQL} FROM memory_state")
def quota_state_memory(spark: SparkSession, sf: str) -> DataFrame:
    return quota.quota_state_in_memory(L.request_log(spark, sf)).select(*STATE_COLUMNS)


@register(
    """SELECT coalesce(s.credential_hash, a.credential_hash) AS credential_hash, coalesce(s.pool, a.pool) AS pool,
      CASE WHEN a.pool IS NOT NULL THEN false ELSE s.disabled END AS disabled,
      CASE WHEN a.pool IS NOT NULL THEN false ELSE s.removed END AS removed,
      CASE WHEN a.pool IS NULL OR NOT s.removed THEN s.remaining END AS remaining,
      CASE WHEN a.pool IS NULL OR NOT s.removed THEN s.reset_time END AS reset_time,
      CASE WHEN a.pool IS NULL OR NOT s.removed THEN s.last_used END AS last_used,
      CASE WHEN a.pool IS NOT NULL THEN CAST(77 AS BIGINT) END AS added_at
    FROM stored_state s FULL OUTER JOIN (
      SELECT DISTINCT md5(CAST(user_id % 12 + 4 AS VARCHAR)) AS credential_hash, 'github' AS pool FROM events
      WHERE event_type = 'signup') a ON s.credential_hash = a.credential_hash AND s.pool = a.pool"""
)
def quota_reenable(spark: SparkSession, sf: str) -> DataFrame:
    state = quota.quota_state(L.request_log(spark, sf)).withColumn("added_at", F.lit(None).cast("bigint"))
    added = (
        L.table(spark, sf, "events")
        .filter("event_type = 'signup'")
        .selectExpr("md5(cast(user_id % 12 + 4 AS string)) AS credential_hash", "'github' AS pool")
        .distinct()
    )
    return quota.enable_credentials(state, added, F.lit(77).cast("bigint"))


NOW_SQL = "(SELECT max(event_id) + 1 FROM events)"


def _pick_sql(state: str, left: str) -> str:
    return f"""
    SELECT '{state}' AS mode, pool, enabled, best, best_left, soonest_reset,
      CASE WHEN enabled > 0 AND best IS NULL THEN CASE WHEN soonest_reset - now + 1 < 0 THEN 1.0::DOUBLE
        ELSE CAST(soonest_reset - now + 1 AS DOUBLE) END END AS wait_seconds,
      CASE WHEN enabled = 0 THEN 'none active' WHEN best IS NULL THEN 'wait' ELSE 'available' END AS state
    FROM (SELECT pool, any_value(now) AS now, count(*) FILTER (live) AS enabled,
        min(reset_time) FILTER (live) AS soonest_reset,
        first(credential_hash ORDER BY quota DESC, credential_hash DESC) FILTER (live AND quota > 0) AS best,
        max(quota) FILTER (live AND quota > 0) AS best_left
      FROM (SELECT pool, credential_hash, coalesce(reset_time, 0) AS reset_time, {NOW_SQL} AS now,
          NOT disabled AND NOT removed AS live, CAST({left} AS BIGINT) AS quota FROM {state}) GROUP BY pool)"""


STORED_LEFT = f"CASE WHEN {NOW_SQL} > coalesce(reset_time, 0) THEN 5000 ELSE coalesce(remaining, 5000) END"
MEMORY_LEFT = f"CASE WHEN {NOW_SQL} > reset_time AND remaining = 0 THEN 5000 ELSE coalesce(remaining, 5000) END"


def _log_end(spark: SparkSession, sf: str):
    """The second after the last logged request."""
    return L.table(spark, sf, "events").agg(F.max("event_id") + 1).scalar()


@register(_pick_sql("stored_state", STORED_LEFT) + " UNION ALL " + _pick_sql("memory_state", MEMORY_LEFT))
def quota_pick(spark: SparkSession, sf: str) -> DataFrame:
    log, now = L.request_log(spark, sf), _log_end(spark, sf)
    stored = quota.quota_pick(quota.quota_state(log), now, stored=True)
    memory = quota.quota_pick(quota.quota_state_in_memory(log), now, stored=False)
    return stored.withColumn("mode", F.lit("stored_state")).unionByName(memory.withColumn("mode", F.lit("memory_state")))


@register(
    f"""SELECT left(credential_hash, 4) || '...' || right(credential_hash, 4) AS credential, disabled,
    CASE WHEN reset_time IS NULL OR reset_time <= {NOW_SQL} THEN 'Ready'
      ELSE strftime(make_timestamp(reset_time * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS cool_down,
    CASE WHEN last_used IS NULL THEN 'Never' ELSE strftime(make_timestamp(last_used * 1000000), '%Y-%m-%dT%H:%M:%SZ') END
      AS last_used FROM stored_state WHERE pool = 'github'"""
)
def quota_inventory(spark: SparkSession, sf: str) -> DataFrame:
    state = quota.quota_state(L.request_log(spark, sf))
    return quota.quota_inventory(state, "github", _log_end(spark, sf))


# ---------------------------------------------------------------- slugs and lists
@register(
    """SELECT slug, split_part(slug, '/', 1) AS owner, substr(slug, strpos(slug, '/') + 1) AS name,
    split_part(slug, '/', 1) || '%2F' || substr(slug, strpos(slug, '/') + 1) AS travis_slug,
    'https://api.github.com/repos/' || slug || '/actions/runs' AS runs_address,
    'https://api.github.com/repos/' || slug || '/contents/.travis.yml' AS file_address,
    'https://api.travis-ci.com/repo/' || split_part(slug, '/', 1) || '%2F' || substr(slug, strpos(slug, '/') + 1) || '/builds'
      AS builds_address FROM repos"""
)
def slug_parts(spark: SparkSession, sf: str) -> DataFrame:
    slug, settings = F.col("slug"), Settings()
    return L.repos(spark, sf).select(
        "slug",
        T.slug_owner(slug).alias("owner"),
        T.slug_name(slug).alias("name"),
        T.travis_slug(slug).alias("travis_slug"),
        T.runs_address(settings.github_api_url + "//", slug).alias("runs_address"),
        T.contents_address(settings.github_api_url, slug, F.lit("/.travis.yml")).alias("file_address"),
        T.travis_builds_address(settings.travis_api_url, slug).alias("builds_address"),
    )


@register(
    """SELECT user_id, CASE WHEN tags = '' THEN '' ELSE 'language:' || replace(tags, ',', ' OR language:') END AS clause,
    tags, mask FROM (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS tags,
      CASE WHEN length(any_value('user' || user_id * 1000)) > 8 THEN 'user...' || right(CAST(user_id * 1000 AS VARCHAR), 4)
        ELSE '...' END AS mask FROM events GROUP BY user_id)"""
)
def clean_strings(spark: SparkSession, sf: str) -> DataFrame:
    """Per user the event types as an untidy list, tidied up and made into a clause; and a masked name."""
    kinds = L.table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))
    untidy = kinds.withColumn("kinds", F.expr("flatten(transform(kinds, k -> array(concat(' ', k, '\\t'), '  ')))"))
    tidy = T.clean_strings(F.col("kinds"))
    return untidy.select(
        "user_id",
        T.language_clause(tidy).alias("clause"),
        F.array_join(tidy, ",").alias("tags"),
        T.mask_secret(F.concat(F.lit("user"), (F.col("user_id") * 1000).cast("string"))).alias("mask"),
    )


@register(
    """SELECT value, count(*) AS rows FROM (SELECT o_orderpriority AS value FROM orders UNION ALL
      SELECT c_mktsegment FROM customer) WHERE value NOT IN (SELECT upper(trim(c_mktsegment)) FROM customer
      WHERE c_mktsegment LIKE '%U%') GROUP BY value"""
)
def list_edits(spark: SparkSession, sf: str) -> DataFrame:
    """Two lists appended, then the values of a third one, tidied and made distinct, removed."""
    first = L.table(spark, sf, "orders").selectExpr("o_orderpriority AS value")
    second = L.table(spark, sf, "customer").selectExpr("c_mktsegment AS value")
    removed = second.filter("value LIKE '%U%'").selectExpr("concat(' ', value, ' ') AS value")
    kept = worklist.remove_listed(
        worklist.append_lists(first, second), worklist.clean_distinct(removed, "value"), "value"
    )
    return kept.groupBy("value").agg(F.count("*").alias("rows"))


# ---------------------------------------------------------------- API entities
LIST_ENTITIES = entities.PAGED_ENTITIES + entities.SINGLE_PAGE_ENTITIES


def _items_sql() -> str:
    names = ", ".join(f"'{n}'" for n in LIST_ENTITIES)
    return f"""
    SELECT entity, parent, page, event_id, CAST(pos AS BIGINT) AS pos,
      CAST(json_extract_string(item, '$.k') AS BIGINT) AS k
    FROM (SELECT *, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS pos FROM (
      SELECT *, CASE WHEN json_type(body) = 'ARRAY' THEN json_extract(body, '$[*]')
        WHEN entity = 'commits' THEN [] ELSE [CAST(body AS JSON)] END AS items
      FROM api WHERE status = 200 AND json_valid(body) AND entity IN ({names}) AND (entity <> 'commits' OR page = 1)))"""


@register(
    f"""SELECT entity, parent, CAST(page AS BIGINT) AS page, pos, k, count(*) AS rows FROM ({_items_sql()}) GROUP BY ALL"""
)
def entity_pages(spark: SparkSession, sf: str) -> DataFrame:
    items = entities.entity_items(L.api_pages(spark, sf), *LIST_ENTITIES, schema="k BIGINT")
    return (
        items.select(
            "entity", "parent", *[F.col(c).cast("bigint").alias(c) for c in ("page", "pos")], F.col("data.k").alias("k")
        )
        .groupBy("entity", "parent", "page", "pos", "k")
        .agg(F.count("*").alias("rows"))
    )


OBJECTS_SQL = f"""(SELECT *, coalesce(json_type(CASE WHEN json_valid(body) THEN body END) = 'OBJECT', false) AS is_object,
    CAST(json_extract_string(CASE WHEN json_valid(body) THEN body END, '$.k') AS BIGINT) AS k
  FROM api WHERE entity IN ({", ".join(f"'{n}'" for n in entities.OBJECT_ENTITIES)}))"""


@register(
    f"""SELECT entity, parent, k, CAST(sum(strict) AS BIGINT) AS strict_rows, CAST(sum(nulls) AS BIGINT) AS raw_nulls FROM (
      SELECT entity, parent, CASE WHEN status = 200 AND is_object THEN k END AS k, 1 AS strict, 0 AS nulls FROM {OBJECTS_SQL}
      UNION ALL
      SELECT entity, parent, CASE WHEN is_object THEN k END, 0, CASE WHEN is_object THEN 0 ELSE 1 END FROM {OBJECTS_SQL})
    GROUP BY ALL"""
)
def entity_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Objects of each kind by their ``k``, and how many bodies are no object at any status."""
    pages = L.api_pages(spark, sf)
    strict = entities.entity_objects(pages, *entities.OBJECT_ENTITIES, schema="k BIGINT")
    raw = entities.entity_objects(pages, *entities.OBJECT_ENTITIES, schema="k BIGINT", raw=True)
    shown = strict.select("entity", "parent", F.col("data.k").alias("k"), F.lit(1).alias("strict"), F.lit(0).alias("nulls"))
    nulls = raw.select("entity", "parent", F.col("data.k").alias("k"), F.lit(0).alias("strict"), F.col("body").isNull().cast("int").alias("nulls"))
    return (
        shown.unionByName(nulls)
        .groupBy("entity", "parent", "k")
        .agg(F.sum("strict").alias("strict_rows"), F.sum("nulls").alias("raw_nulls"))
    )


@register(
    """SELECT parent, language, CAST(sum(bytes) AS BIGINT) AS bytes FROM (
      SELECT a.parent, e.key AS language, TRY_CAST(e.value AS BIGINT) AS bytes FROM api a, json_each(a.body) e
      WHERE a.entity = 'languages' AND a.status = 200 AND json_valid(a.body) AND json_type(a.body) = 'OBJECT') GROUP BY ALL"""
)
def languages(spark: SparkSession, sf: str) -> DataFrame:
    found = entities.languages(L.api_pages(spark, sf))
    return found.groupBy("parent", "language").agg(F.sum("bytes").alias("bytes"))


@register(
    """SELECT parent, body, has_errors, count(*) AS rows FROM (
      SELECT parent, CASE WHEN status = 200 THEN body ELSE '{}' END AS body,
        status = 200 AND body LIKE '%"errors"%' AS has_errors FROM api WHERE entity = 'graphql') GROUP BY ALL"""
)
def graphql_results(spark: SparkSession, sf: str) -> DataFrame:
    found = entities.graphql_results(L.api_pages(spark, sf))
    return found.groupBy("parent", "body", "has_errors").agg(F.count("*").alias("rows"))


# ---------------------------------------------------------------- the whole scan
def landed_tables(spark: SparkSession, sf: str, settings: Settings) -> Landed:
    return Landed(
        repo_pages=L.repo_pages(spark, sf),
        ci_probes=L.ci_probes(spark, sf),
        run_pages=L.run_pages(spark, sf),
        travis_build_pages=L.travis_build_pages(spark, sf),
        responses=L.responses(spark, sf),
        travis_responses=L.travis_responses(spark, sf, settings.travis_api_url),
    )


@register(duck.scanned("prior"))
def whole_scan(spark: SparkSession, sf: str) -> DataFrame:
    tables = landed_tables(spark, sf, FEW_BUILDS)
    return _flat(scan(tables, L.prior_results(spark, sf), FEW_BUILDS, F.expr(CHECKED_AT)))


# ---------------------------------------------------------------- streams
def scratch(spark: SparkSession) -> str:
    """A new folder under the session's checkpoint folder; a local one only for a local session without any."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("streams on a cluster need spark.checkpoint.dir")
        base = Path(tempfile.mkdtemp(prefix="run-")).as_uri()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


@register(f"SELECT slug, status, builds_found FROM ({duck.github_fold('probes', 'seq', 30, has_kind=False)})")
def stream_readiness(spark: SparkSession, sf: str) -> DataFrame:
    """Log outcomes streamed through keyed state; the newest status per repository."""
    store, provider = live.STATE_STORE
    before = spark.conf.get(store)
    spark.conf.set(store, provider)
    work = scratch(spark)
    files = spark.readStream.schema(L.GIVEN["events"]).option("pathGlobFilter", "events.parquet")
    arriving = L.probes_of(files.parquet(sf))
    try:
        query = (
            live.readiness_stream(arriving, Settings())
            .writeStream.foreachBatch(lambda rows, n: rows.write.mode("overwrite").parquet(f"{work}/out/batch={n}"))
            .option("checkpointLocation", f"{work}/checkpoint")
            .outputMode("update")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(store, before)
    return live.current_status(spark.read.parquet(f"{work}/out"))


@register(duck.scanned("(SELECT * FROM prior WHERE false)"))
def stream_results(spark: SparkSession, sf: str) -> DataFrame:
    """Search pages land as files; a pass over them writes the first version of the result table."""
    work = scratch(spark)
    L.repo_pages(spark, sf).write.parquet(f"{work}/landing")
    pages = read_landed_stream(spark, "repo_pages", f"{work}/landing", stamped=True)
    query = passes.run_passes(
        pages, lambda: landed_tables(spark, sf, FEW_BUILDS), f"{work}/results", f"{work}/checkpoint", FEW_BUILDS,
        F.expr(CHECKED_AT), once=True,
    )
    query.awaitTermination()
    return _flat(read_results(spark, f"{work}/results", RESULTS))


@register(f"SELECT {STATE_SQL} FROM stored_state")
def stream_quota(spark: SparkSession, sf: str) -> DataFrame:
    """The request log lands as files and is folded into stored quota rows."""
    work = scratch(spark)
    schema = "quota_state"
    L.request_log(spark, sf).write.parquet(f"{work}/landing")
    log = read_landed_stream(spark, "request_log", f"{work}/landing")
    query = passes.run_quota_passes(log, f"{work}/state", f"{work}/checkpoint", Settings(), once=True)
    query.awaitTermination()
    return read_results(spark, f"{work}/state", passes.LANDED[schema]).select(*STATE_COLUMNS)
