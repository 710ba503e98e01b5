"""Schemas of the landed tables and of the results, as DDL.

Spark keeps no row order, so every table whose order matters carries an explicit
ordinal. Actors stay raw JSON: an empty object and an object without a login
have to be told apart.
"""

LANDED = {
    "segments": "seg_idx INT, segment_from DATE, segment_to DATE",
    "repo_pages": (
        "seg_idx INT, segment_from DATE, segment_to DATE, lang_idx INT, lang STRING, page INT, "
        "status INT, request_failed BOOLEAN, items ARRAY<STRUCT<full_name: STRING, "
        "stargazers_count: BIGINT, pushed_at: TIMESTAMP, created_at: TIMESTAMP, language: STRING>>"
    ),
    "ci_probes": "slug STRING, probe STRING, status INT, total_count BIGINT",
    "run_pages": (
        "slug STRING, page INT, status INT, request_failed BOOLEAN, error STRING, "
        "runs ARRAY<STRUCT<id: BIGINT, logs_url: STRING, triggering_actor: STRING, actor: STRING>>"
    ),
    "responses": "url STRING, ts TIMESTAMP, status INT, location STRING, body STRING",
    "travis_build_pages": (
        "slug STRING, page INT, status INT, "
        "builds ARRAY<STRUCT<id: BIGINT, started_at: TIMESTAMP, jobs: ARRAY<STRUCT<id: BIGINT>>>>"
    ),
    "request_log": (
        "log_seq BIGINT, request_id BIGINT, attempt INT, ts BIGINT, credential_hash STRING, pool STRING, "
        "method STRING, url STRING, params STRING, status INT, etag STRING, remaining STRING, "
        "reset STRING, retry_after STRING, body STRING, failed BOOLEAN"
    ),
    "quota_state": (
        "credential_hash STRING, pool STRING, disabled BOOLEAN, removed BOOLEAN, remaining BIGINT, "
        "reset_time BIGINT, last_used BIGINT, added_at BIGINT"
    ),
    "api_pages": "entity STRING, parent STRING, page INT, status INT, body STRING",
}

RESULTS = (
    "slug STRING, provider STRING, status STRING, checked_at TIMESTAMP, stars BIGINT, pushed_at TIMESTAMP, "
    "languages_hint STRING, segment_from DATE, segment_to DATE, builds_found BIGINT, message STRING"
)
RESULT_KEY = ("slug", "provider")
