"""Landed tables derived from the given tables, whole, with integer rules only.

``duck.py`` states the same rules for the check by another engine. A rule picks
a value for each row and never leaves rows out; lists are gathered per bounded
stretch of keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GITHUB = "github_actions"
TRAVIS = "travis_ci"


# Declared, so that reading a table needs no job to look at its files first.
GIVEN = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf}/{name}.parquet")


def slug(key: str) -> str:
    return f"concat('org', {key} % 15, '/repo', {key})"


# ---------------------------------------------------------------- log outcomes
def probes(spark: SparkSession, sf: str) -> DataFrame:
    return probes_of(table(spark, sf, "events"))


def probes_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        f"{slug('user_id')} AS slug",
        "event_id AS seq",
        """CASE user_id % 5
             WHEN 0 THEN 'ok'
             WHEN 1 THEN CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END
             WHEN 2 THEN CASE WHEN event_id % 29 = 0 THEN 'ok' ELSE 'gone' END
             WHEN 3 THEN CASE WHEN event_id % 31 = 0 THEN 'ok' WHEN event_id % 7 = 0 THEN 'gone' ELSE 'error' END
             ELSE CASE WHEN event_id % 23 = 0 THEN 'auth' WHEN event_id % 3 = 0 THEN 'ok' ELSE 'gone' END
           END AS outcome""",
    )


# ---------------------------------------------------------------- workflow runs
RUN_COLUMNS = [
    "event_id AS id",
    """CASE WHEN event_type = 'signup' THEN ''
            WHEN event_id % 41 = 40 THEN concat('lost/', event_id)
            ELSE concat('u/', event_id) END AS logs_url""",
    """CASE event_id % 9
         WHEN 0 THEN '{"login":"x[bot]","type":"User"}'
         WHEN 1 THEN '{}'
         WHEN 2 THEN '{"id":5}'
         WHEN 3 THEN '{"login":"talbot","type":"User"}'
         WHEN 4 THEN '{"login":"ann","type":"User"}'
         WHEN 5 THEN '{"login":"CI-Bot","type":""}'
         WHEN 6 THEN NULL
         WHEN 7 THEN '"x"'
         ELSE '{"login":"guild","type":"Organization"}' END AS triggering_actor""",
    """CASE event_id % 4
         WHEN 0 THEN '{"login":"bob","type":"User"}'
         WHEN 1 THEN '{"login":"bob","type":"Bot"}'
         WHEN 2 THEN NULL
         ELSE '{}' END AS actor""",
]


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "user_id", "cast(event_id div 1000 + 1 AS int) AS page", *RUN_COLUMNS
    )


def customers_without_events(spark: SparkSession, sf: str) -> DataFrame:
    """Customers that start no runs."""
    active = table(spark, sf, "events").selectExpr("user_id AS c_custkey").distinct()
    return table(spark, sf, "customer").select("c_custkey").join(active, "c_custkey", "left_anti")


def landings(twice: str = "true") -> list:
    """Columns for one or two landings of a row: the time of each, and whether a newer one follows."""
    both = "array(struct(timestamp_seconds(2) AS ts, false AS first), struct(timestamp_seconds(1) AS ts, true AS first))"
    return [F.expr(f"inline(CASE WHEN {twice} THEN {both} ELSE slice({both}, 1, 1) END)")]


def run_pages(spark: SparkSession, sf: str) -> DataFrame:
    listed = (
        runs(spark, sf)
        .groupBy("user_id", "page")
        .agg(F.array_sort(F.collect_list(F.struct("id", "logs_url", "triggering_actor", "actor"))).alias("runs"))
        .withColumn("_rule", F.expr("(user_id * 3 + page * 7) % 61"))
        .selectExpr(
            f"{slug('user_id')} AS slug",
            "page",
            "CASE _rule WHEN 5 THEN 404 WHEN 17 THEN 500 WHEN 23 THEN NULL ELSE 200 END AS status",
            "_rule = 23 AS request_failed",
            "CASE WHEN _rule = 23 THEN 'timed out' END AS error",
            "CASE WHEN _rule = 31 THEN slice(runs, 1, 0) ELSE runs END AS runs",
        )
    )
    rest = customers_without_events(spark, sf).selectExpr(
        f"{slug('c_custkey')} AS slug",
        "1 AS page",
        "CASE c_custkey % 3 WHEN 0 THEN 404 WHEN 1 THEN 200 ELSE 503 END AS status",
        "false AS request_failed",
        "cast(NULL AS string) AS error",
        "cast(array() AS array<struct<id: bigint, logs_url: string, triggering_actor: string, actor: string>>) AS runs",
    )
    # Some pages landed before, when they were refused or lists were shorter.
    return (
        listed.unionByName(rest)
        .select("*", *landings("page % 3 = 1"))
        .withColumns(
            {
                "status": F.expr("CASE WHEN first AND status = 200 THEN 500 WHEN first THEN 200 ELSE status END"),
                "runs": F.expr("CASE WHEN first THEN slice(runs, 1, 1) ELSE runs END"),
                "request_failed": F.expr("request_failed AND NOT first"),
            }
        )
        .drop("first")
    )


RESPONSE_BODY = """CASE event_id % 37
    WHEN 5 THEN '{"message":"Must have admin rights to Repository."}'
    WHEN 7 THEN '{"message":"Unsupported ''Accept'' header: text"}'
    WHEN 9 THEN '["ADMIN rights"]'
    WHEN 11 THEN 'not json'
    WHEN 13 THEN '{"message":"","note":"Admin Rights"}'
    ELSE props END AS body"""


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Per event: the newest answer of its log address, an older one, and the answer at the redirect target."""
    answers = F.expr(
        """array(
          named_struct('url', concat('u/', event_id), 'ts', event_id + 10,
            'status', CASE WHEN event_id % 2 = 0 THEN 302
                           ELSE CASE event_id % 19 WHEN 1 THEN 404 WHEN 3 THEN 403 WHEN 5 THEN 503 WHEN 7 THEN 410
                                     WHEN 9 THEN 401 WHEN 11 THEN 415 WHEN 13 THEN 429 ELSE 200 END END,
            'location', CASE WHEN event_id % 2 = 1 OR event_id % 26 = 0 THEN NULL
                             WHEN event_id % 34 = 0 THEN concat('lost/', event_id)
                             ELSE concat('b/', event_id) END),
          named_struct('url', concat('u/', event_id), 'ts', event_id, 'status', 500, 'location', NULL),
          named_struct('url', concat('b/', event_id), 'ts', event_id, 'status',
            CASE WHEN event_id % 14 = 0 THEN 500 ELSE 200 END, 'location', NULL))"""
    )
    return (
        table(spark, sf, "events")
        .select(F.explode(answers).alias("r"), F.expr(RESPONSE_BODY))
        .select("r.url", F.timestamp_seconds("r.ts").alias("ts"), "r.status", "r.location", "body")
    )


# ---------------------------------------------------------------- builds and jobs
def travis_build_pages(spark: SparkSession, sf: str) -> DataFrame:
    builds = (
        table(spark, sf, "events")
        .selectExpr("user_id", "event_id div 5000 AS stretch", "event_id div 50 AS build", "event_id")
        .groupBy("user_id", "stretch", "build")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("id")))).alias("jobs"))
        .groupBy("user_id", "stretch")
        .agg(
            F.collect_list(
                F.struct(F.col("build").alias("id"), F.timestamp_seconds(F.col("build") * 60).alias("started_at"), "jobs")
            ).alias("builds")
        )
        .selectExpr(f"{slug('user_id')} AS slug", "cast(stretch + 1 AS int) AS page", "200 AS status", "builds")
    )
    rest = customers_without_events(spark, sf).selectExpr(
        f"{slug('c_custkey')} AS slug",
        "1 AS page",
        "CASE WHEN c_custkey % 2 = 0 THEN 404 ELSE 200 END AS status",
        "cast(array() AS array<struct<id: bigint, started_at: timestamp, jobs: array<struct<id: bigint>>>>) AS builds",
    )
    # Some lists landed before, refused where they are not now, or with later starts and fewer jobs of the same builds.
    older = "transform(builds, b -> named_struct('id', b.id, 'started_at', b.started_at + interval 9 days, 'jobs', slice(b.jobs, 1, 1)))"
    return (
        builds.unionByName(rest)
        .select("*", *landings("page % 2 = 1"))
        .withColumns(
            {
                "status": F.expr("CASE WHEN first AND (status <> 200 OR length(slug) % 2 = 0) THEN 604 - status ELSE status END"),
                "builds": F.expr(f"CASE WHEN first THEN {older} ELSE builds END"),
            }
        )
        .drop("first")
    )


def travis_responses(spark: SparkSession, sf: str, api: str) -> DataFrame:
    answers = F.expr(
        f"""array(
          named_struct('url', concat('{api}/job/', event_id, '/log'), 'status',
            CASE WHEN user_id % 4 = 1 AND event_id % 53 = 0 THEN 404
                 WHEN user_id % 4 = 2 AND event_id % 47 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 401 ELSE 403 END
                 WHEN user_id % 4 = 3 AND event_id % 2 = 0 THEN CASE WHEN event_id % 6 = 0 THEN 415 ELSE 500 END
                 WHEN event_id % 10 = 0 THEN 302 ELSE 200 END,
            'location', CASE WHEN event_id % 10 = 0 THEN concat('tb/', event_id) END),
          named_struct('url', concat('tb/', event_id), 'status', CASE WHEN event_id % 40 = 0 THEN 503 ELSE 200 END,
            'location', NULL))"""
    )
    return (
        table(spark, sf, "events")
        .select(F.explode(answers).alias("r"), "event_id", "props")
        .select("r.url", F.timestamp_seconds("event_id").alias("ts"), "r.status", "r.location", F.col("props").alias("body"))
    )


# ---------------------------------------------------------------- search pages
def repo_pages(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "orders").selectExpr(
        "year(o_orderdate) - 1995 AS seg_idx",
        "make_date(year(o_orderdate), 1, 1) AS segment_from",
        "make_date(year(o_orderdate), 12, 31) AS segment_to",
        "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS lang_idx",
        "CASE o_orderstatus WHEN 'F' THEN 'Python' WHEN 'O' THEN 'Ruby' ELSE 'Java' END AS lang",
        "cast(o_orderkey div 500 + 1 AS int) AS page",
        "o_orderkey",
        f"CASE WHEN o_custkey % 97 = 0 THEN '' ELSE {slug('o_custkey')} END AS full_name",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN cast(floor(o_totalprice) AS bigint) END AS stargazers_count",
        "timestamp_seconds(unix_date(cast(o_orderdate AS date)) * 86400L) AS pushed_at",
    )
    entry = F.struct(
        "o_orderkey", "full_name", "stargazers_count", "pushed_at",
        F.col("pushed_at").alias("created_at"), F.col("lang").alias("language"),
    )
    pages = items.groupBy("seg_idx", "segment_from", "segment_to", "lang_idx", "lang", "page").agg(
        F.array_sort(F.collect_list(entry)).alias("listed")
    )
    rule = "(seg_idx + lang_idx) % 3 = 0 AND page % 17"
    return pages.selectExpr(
        "seg_idx", "segment_from", "segment_to", "lang_idx", "lang", "page",
        f"CASE WHEN {rule} = 9 THEN 422 WHEN {rule} = 11 THEN 500 WHEN {rule} = 13 THEN NULL ELSE 200 END AS status",
        f"{rule} = 13 AS request_failed",
        "transform(listed, x -> struct(x.full_name, x.stargazers_count, x.pushed_at, x.created_at, x.language)) AS items",
    ).select("*", *landings("page % 5 = 2")).withColumn("status", F.expr("CASE WHEN first THEN 422 ELSE status END")).drop("first")


def repos(spark: SparkSession, sf: str) -> DataFrame:
    """Single repositories to be searched: one per order."""
    return table(spark, sf, "orders").selectExpr(
        f"concat({slug('o_custkey')}, '/', o_orderkey) AS slug",
        "CASE o_orderstatus WHEN 'F' THEN 'Python' WHEN 'O' THEN 'Ruby' ELSE 'Java' END AS language",
        "cast(floor(o_totalprice) AS bigint) AS stargazers_count",
        "cast(o_orderdate AS timestamp) AS created_at",
        "cast(o_orderdate AS timestamp) AS pushed_at",
    )


def date_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """First and last order date per priority and status."""
    return (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority", "o_orderstatus")
        .agg(
            F.min("o_orderdate").cast("date").cast("string").alias("range_start"),
            F.max("o_orderdate").cast("date").cast("string").alias("range_end"),
        )
    )


def order_span(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").cast("string").alias("range_start"),
        F.max("o_orderdate").cast("date").cast("string").alias("range_end"),
    )


# ---------------------------------------------------------------- providers and results
def ci_probes(spark: SparkSession, sf: str) -> DataFrame:
    answers = F.expr(
        """array(
          named_struct('probe', 'runs',
            'status', CASE WHEN c_custkey % 5 = 3 THEN 404 ELSE 200 END,
            'total_count', CASE WHEN c_custkey % 5 = 4 THEN NULL ELSE c_custkey % 4 END),
          named_struct('probe', 'travis_yml',
            'status', CASE c_custkey % 7 WHEN 0 THEN 200 WHEN 1 THEN 200 WHEN 2 THEN 301 ELSE 404 END,
            'total_count', NULL))"""
    )
    return (
        table(spark, sf, "customer")
        .select(F.expr(f"{slug('c_custkey')} AS slug"), F.explode(answers).alias("p"))
        .select("slug", "p.probe", "p.status", "p.total_count", *landings())
        # An older answer said the opposite.
        .selectExpr(
            "slug", "probe", "CASE WHEN first THEN CASE status WHEN 200 THEN 404 ELSE 200 END ELSE status END AS status",
            "CASE WHEN first THEN 9L ELSE total_count END AS total_count", "ts",
        )
    )


def prior_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results of an earlier pass; one market segment was not scanned, one has two rows per repository."""
    rows = F.expr(
        f"""CASE c_mktsegment
              WHEN 'BUILDING' THEN array(struct('{GITHUB}' AS provider, 'ready' AS status))
              WHEN 'MACHINERY' THEN array(struct('{GITHUB}' AS provider, 'retry' AS status))
              WHEN 'AUTOMOBILE' THEN array(struct('{TRAVIS}' AS provider, cast(NULL AS string) AS status))
              WHEN 'HOUSEHOLD' THEN array(struct('{GITHUB}' AS provider, 'retry' AS status),
                                          struct('{TRAVIS}' AS provider, 'logs_gone' AS status))
              ELSE array() END"""
    )
    return (
        table(spark, sf, "customer")
        .select("c_custkey", F.explode(rows).alias("r"))
        .selectExpr(
            f"{slug('c_custkey')} AS slug", "r.provider", "r.status",
            "timestamp_seconds(c_custkey) AS checked_at", "c_custkey AS stars",
            "timestamp_seconds(c_custkey) AS pushed_at", "'C' AS languages_hint",
            "date'2018-12-01' AS segment_from", "date'2018-12-07' AS segment_to",
            "c_custkey % 30 AS builds_found", "concat('old ', c_custkey) AS message",
        )
    )


def result_updates(spark: SparkSession, sf: str) -> DataFrame:
    """One update per order: status always, message sometimes null, builds sometimes not given."""
    return table(spark, sf, "orders").selectExpr(
        f"{slug('o_custkey')} AS slug",
        f"CASE WHEN o_orderstatus = 'F' THEN '{TRAVIS}' ELSE '{GITHUB}' END AS provider",
        "CASE WHEN o_orderkey % 4 = 1 THEN 'insufficient' ELSE 'ready' END AS status",
        "CASE WHEN o_orderkey % 5 <> 0 THEN concat('new ', o_orderkey) END AS message",
        "o_orderkey % 31 AS builds_found",
        """CASE WHEN o_orderkey % 4 = 0 THEN array('status', 'message', 'builds_found')
                WHEN o_orderkey % 4 = 1 THEN array('status')
                ELSE array('status', 'message') END AS set_fields""",
        "o_orderkey AS seq",
    )


# ---------------------------------------------------------------- request log and API pages
def request_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id AS log_seq",
        "event_id div 3 AS request_id",
        "cast(event_id % 3 + 1 AS int) AS attempt",
        "event_id AS ts",
        "md5(cast(user_id % 8 AS string)) AS credential_hash",
        "CASE WHEN user_id % 8 < 6 THEN 'github' ELSE 'travis' END AS pool",
        "CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method",
        "concat('https://host/', user_id % 20) AS url",
        """CASE event_type WHEN 'click' THEN '{"page": 1}' WHEN 'error' THEN '{}' END AS params""",
        """CASE WHEN event_id % 71 = 9 THEN NULL
                WHEN event_id % 101 = 3 THEN 401
                WHEN event_id % 17 = 0 THEN 429
                WHEN event_id % 13 = 4 THEN 403
                WHEN (event_id div 3) % 23 = 5 THEN 503
                WHEN event_id % 29 = 6 THEN 422
                WHEN event_id % 43 = 7 THEN 400
                WHEN event_id % 3 = 1 THEN 304
                WHEN event_id % 11 = 0 THEN 404
                ELSE 200 END AS status""",
        "CASE WHEN event_id % 4 <> 0 THEN concat('e', event_id) END AS etag",
        """CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 26 = 4 THEN '0'
                ELSE cast(event_id % 90 AS string) END AS remaining""",
        "CASE WHEN user_id % 8 >= 4 AND event_id % 50 = 7 THEN cast(event_id + 20 AS string) END AS reset",
        """CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '0.2' WHEN 2 THEN 'Wed, 21 Oct' ELSE '7' END AS retry_after""",
        """CASE WHEN event_id % 2 = 0 AND (event_id % 29 = 6 OR event_id % 43 = 7 OR event_id % 85 = 0)
                THEN '{"message":"Account flagged as Spammy"}' ELSE props END AS body""",
        "event_id % 71 = 9 AS failed",
    )


ENTITIES = [
    "commit", "commits", "repository", "languages", "pull_request", "commit_comments", "pull_commits",
    "pull_comments", "issue_comments", "pull_reviews", "user", "graphql",
]


def api_pages(spark: SparkSession, sf: str) -> DataFrame:
    names = ", ".join(f"'{name}'" for name in ENTITIES)
    return table(spark, sf, "events").selectExpr(
        f"element_at(array({names}), cast(event_id % 12 + 1 AS int)) AS entity",
        f"{slug('user_id')} AS parent",
        "cast(event_id div 12 % 3 + 1 AS int) AS page",
        "event_id",
        "CASE WHEN event_id div 12 % 7 = 3 THEN 404 ELSE 200 END AS status",
        """CASE event_id div 12 % 5
             WHEN 0 THEN props
             WHEN 1 THEN concat('[', props, ',', props, ']')
             WHEN 2 THEN '[]'
             WHEN 3 THEN '{"errors": [1], "Python": 7}'
             ELSE 'not json' END AS body""",
    )
