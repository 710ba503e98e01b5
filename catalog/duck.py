"""The registered queries as SQL for another engine, over the same given tables.

Named pieces are common table expressions; ``query`` puts those a statement
needs in front of it.
"""

from __future__ import annotations

import re

GITHUB = "github_actions"
TRAVIS = "travis_ci"


def slug(key: str) -> str:
    return f"('org' || ({key} % 15) || '/repo' || {key})"


PIECES: dict[str, str] = {}

PIECES["probes"] = f"""
SELECT {slug('user_id')} AS slug, event_id AS seq,
  CASE WHEN user_id % 5 = 0 THEN 'ok'
       WHEN user_id % 5 = 1 AND event_type = 'error' THEN 'error'
       WHEN user_id % 5 = 1 THEN 'ok'
       WHEN user_id % 5 = 2 AND event_id % 29 = 0 THEN 'ok'
       WHEN user_id % 5 = 2 THEN 'gone'
       WHEN user_id % 5 = 3 AND event_id % 31 = 0 THEN 'ok'
       WHEN user_id % 5 = 3 AND event_id % 7 = 0 THEN 'gone'
       WHEN user_id % 5 = 3 THEN 'error'
       WHEN event_id % 23 = 0 THEN 'auth'
       WHEN event_id % 3 = 0 THEN 'ok'
       ELSE 'gone' END AS outcome
FROM events"""

# ---------------------------------------------------------------- runs and their logs
PIECES["runs"] = f"""
SELECT user_id, {slug('user_id')} AS slug, event_id // 1000 + 1 AS page, event_id AS id,
  CASE WHEN event_type = 'signup' THEN '' WHEN event_id % 41 = 40 THEN 'lost/' || event_id
       ELSE 'u/' || event_id END AS logs_url,
  CASE event_id % 9 WHEN 0 THEN '{{"login":"x[bot]","type":"User"}}' WHEN 1 THEN '{{}}' WHEN 2 THEN '{{"id":5}}'
    WHEN 3 THEN '{{"login":"talbot","type":"User"}}' WHEN 4 THEN '{{"login":"ann","type":"User"}}'
    WHEN 5 THEN '{{"login":"CI-Bot","type":""}}' WHEN 6 THEN NULL WHEN 7 THEN '"x"'
    ELSE '{{"login":"guild","type":"Organization"}}' END AS ta,
  CASE event_id % 4 WHEN 0 THEN '{{"login":"bob","type":"User"}}' WHEN 1 THEN '{{"login":"bob","type":"Bot"}}'
    WHEN 2 THEN NULL ELSE '{{}}' END AS actor
FROM events"""

PIECES["chosen_runs"] = """
SELECT *, CASE WHEN ta IS NULL OR ta = '{}' THEN actor ELSE ta END AS chosen FROM runs"""

HUMAN = """coalesce(json_type({0}) = 'OBJECT' AND len(json_keys({0})) > 0
  AND lower(coalesce({0} ->> 'type', '')) <> 'bot'
  AND lower(coalesce({0} ->> 'login', '')) NOT LIKE '%bot'
  AND lower(coalesce({0} ->> 'login', '')) NOT LIKE '%[bot]', false)"""

PIECES["worthy_runs"] = f"""
SELECT slug, user_id, page, id, logs_url, row_number() OVER (PARTITION BY user_id, page ORDER BY id) - 1 AS pos,
  logs_url <> '' AND {HUMAN.format('chosen')} AS worthy, (user_id * 3 + page * 7) % 61 AS page_rule
FROM chosen_runs"""

PIECES["responses"] = """
SELECT 'u/' || event_id AS url, event_id + 10 AS ts,
  CASE WHEN event_id % 2 = 0 THEN 302 WHEN event_id % 19 = 1 THEN 404 WHEN event_id % 19 = 3 THEN 403
       WHEN event_id % 19 = 5 THEN 503 WHEN event_id % 19 = 7 THEN 410 WHEN event_id % 19 = 9 THEN 401
       WHEN event_id % 19 = 11 THEN 415 WHEN event_id % 19 = 13 THEN 429 ELSE 200 END AS status,
  CASE WHEN event_id % 2 = 0 AND event_id % 26 <> 0
       THEN CASE WHEN event_id % 34 = 0 THEN 'lost/' ELSE 'b/' END || event_id END AS location,
  CASE event_id % 37 WHEN 5 THEN '{"message":"Must have admin rights to Repository."}'
       WHEN 7 THEN '{"message":"Unsupported ''Accept'' header: text"}' WHEN 9 THEN '["ADMIN rights"]'
       WHEN 11 THEN 'not json' WHEN 13 THEN '{"message":"","note":"Admin Rights"}' ELSE props END AS body
FROM events
UNION ALL SELECT 'u/' || event_id, event_id, 500, NULL, props FROM events
UNION ALL SELECT 'b/' || event_id, event_id, CASE WHEN event_id % 14 = 0 THEN 500 ELSE 200 END, NULL, props FROM events"""

PIECES["latest"] = """
SELECT url, status, location, CASE WHEN json_valid(body) AND json_type(body) = 'OBJECT'
  THEN coalesce(nullif(json_extract_string(body, '$.message'), ''), body) ELSE body END AS text
FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts DESC) AS rn FROM responses) WHERE rn = 1"""

PIECES["run_outcomes"] = """
SELECT r.id, r.logs_url,
  CASE WHEN a.url IS NULL THEN 'error'
       WHEN a.status = 302 AND b.status = 200 THEN 'ok'
       WHEN a.status = 302 THEN 'error'
       WHEN a.status = 200 THEN 'ok'
       WHEN a.text ILIKE '%unsupported ''accept'' header%' OR a.text ILIKE '%admin rights%' THEN 'auth'
       WHEN a.status = 404 THEN 'gone'
       WHEN a.status IN (401, 403, 415) THEN 'auth'
       ELSE 'error' END AS outcome
FROM runs r LEFT JOIN latest a ON r.logs_url = a.url LEFT JOIN latest b ON a.location = b.url
WHERE r.logs_url <> ''"""

PIECES["idle_customers"] = """
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)"""

PIECES["run_steps"] = f"""
SELECT w.slug, w.page, w.pos, o.outcome, NULL AS kind, NULL AS detail
FROM worthy_runs w JOIN run_outcomes o ON w.id = o.id WHERE w.worthy AND w.page_rule NOT IN (5, 17, 23, 31)
UNION ALL
SELECT DISTINCT slug, page, -1, NULL,
  CASE page_rule WHEN 5 THEN 'list_missing' WHEN 17 THEN 'list_refused' WHEN 23 THEN 'list_failed'
       ELSE CASE WHEN page = 1 THEN 'list_empty' ELSE 'list_end' END END,
  CASE page_rule WHEN 17 THEN '500' WHEN 23 THEN 'timed out' END
FROM worthy_runs WHERE page_rule IN (5, 17, 23, 31)
UNION ALL
SELECT {slug('c_custkey')}, 1, -1, NULL,
  CASE c_custkey % 3 WHEN 0 THEN 'list_missing' WHEN 1 THEN 'list_empty' ELSE 'list_refused' END,
  CASE c_custkey % 3 WHEN 2 THEN '503' END
FROM idle_customers
UNION ALL
SELECT DISTINCT slug, page, -1, NULL, NULL, NULL FROM worthy_runs WHERE page = 1 AND page_rule NOT IN (5, 17, 23, 31)"""


def github_fold(source: str, order: str, min_builds: int, has_kind: bool = True) -> str:
    kind = "kind, detail" if has_kind else "NULL AS kind, NULL AS detail"
    return f"""
SELECT slug,
  CASE reason WHEN 'list_failed' THEN 'error' WHEN 'list_refused' THEN 'error' WHEN 'list_missing' THEN 'missing_actions'
    WHEN 'list_empty' THEN 'missing_actions' WHEN 'denied' THEN 'auth_failed' WHEN 'gone_run' THEN 'logs_gone'
    WHEN 'error_run' THEN 'error' WHEN 'enough' THEN 'ready' ELSE 'insufficient' END AS status,
  CAST(ok_cum AS BIGINT) AS builds_found,
  CASE reason WHEN 'list_failed' THEN 'Failed to list runs: ' || detail
    WHEN 'list_refused' THEN 'Failed to list runs: ' || detail
    WHEN 'list_missing' THEN 'Actions disabled or repo missing.'
    WHEN 'list_empty' THEN 'Actions disabled or no runs found.' WHEN 'denied' THEN '401/403 fetching logs.'
    WHEN 'gone_run' THEN 'Logs removed (404) consecutively ' || bad_run || ' times, stop scanning.'
    WHEN 'error_run' THEN 'Too many consecutive errors ' || bad_run || ', stop scanning.'
    WHEN 'enough' THEN 'Has enough downloadable GitHub Actions logs.'
    ELSE 'Not enough Actions runs with logs.' END AS message
FROM (
  SELECT *, row_number() OVER (PARTITION BY slug ORDER BY (reason IS NULL), CASE WHEN reason IS NULL THEN -n ELSE n END) AS pick
  FROM (
    SELECT *, CASE WHEN kind IS NOT NULL THEN kind WHEN outcome = 'auth' THEN 'denied'
      WHEN bad_run >= 10 AND outcome = 'gone' THEN 'gone_run' WHEN bad_run >= 10 AND outcome = 'error' THEN 'error_run'
      WHEN outcome = 'ok' AND ok_cum >= {min_builds} THEN 'enough' END AS reason
    FROM (
      SELECT *, sum(CASE WHEN outcome IN ('gone', 'error') THEN 1 ELSE 0 END)
        OVER (PARTITION BY slug, ok_cum ORDER BY n) AS bad_run
      FROM (
        SELECT slug, outcome, {kind}, row_number() OVER (PARTITION BY slug ORDER BY {order}) AS n,
          sum(CASE WHEN outcome = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY slug ORDER BY {order}) AS ok_cum
        FROM {source}))))
WHERE pick = 1"""


PIECES["github_status"] = github_fold("run_steps", "page, pos, kind NULLS LAST", 5)

# ---------------------------------------------------------------- builds and jobs
PIECES["jobs"] = f"""
SELECT user_id, {slug('user_id')} AS slug, event_id // 50 AS build, event_id AS job,
  CASE WHEN user_id % 4 = 1 AND event_id % 53 = 0 THEN 404
       WHEN user_id % 4 = 2 AND event_id % 94 = 0 THEN 401
       WHEN user_id % 4 = 2 AND event_id % 47 = 0 THEN 403
       WHEN user_id % 4 = 3 AND event_id % 6 = 0 THEN 415
       WHEN user_id % 4 = 3 AND event_id % 2 = 0 THEN 500
       WHEN event_id % 10 = 0 THEN 302 ELSE 200 END AS status,
  CASE WHEN event_id % 40 = 0 THEN 503 ELSE 200 END AS target_status
FROM events"""

PIECES["job_outcomes"] = """
SELECT slug, build, job, CASE WHEN status = 200 OR (status = 302 AND target_status = 200) THEN 'ok'
  WHEN status = 404 THEN 'gone' WHEN status IN (401, 403) THEN 'auth' ELSE 'error' END AS outcome
FROM jobs"""


def travis_fold(min_builds: int) -> str:
    return f"""
SELECT slug,
  CASE reason WHEN 'gone' THEN 'logs_gone' WHEN 'denied' THEN 'auth_failed' WHEN 'enough' THEN 'ready'
    ELSE 'insufficient' END AS status,
  CAST(ok_cum AS BIGINT) AS builds_found,
  CASE reason WHEN 'gone' THEN 'Logs removed (404), stop scanning.' WHEN 'denied' THEN '401/403 fetching Travis logs.'
    WHEN 'enough' THEN 'Has enough downloadable Travis logs.' ELSE 'Not enough Travis job logs.' END AS message
FROM (
  SELECT *, row_number() OVER (PARTITION BY slug ORDER BY (reason IS NULL), CASE WHEN reason IS NULL THEN -n ELSE n END) AS pick
  FROM (
    SELECT *, CASE outcome WHEN 'gone' THEN 'gone' WHEN 'auth' THEN 'denied'
      WHEN 'ok' THEN CASE WHEN ok_cum >= {min_builds} THEN 'enough' END END AS reason
    FROM (
      SELECT slug, outcome, row_number() OVER w AS n,
        sum(CASE WHEN outcome = 'ok' THEN 1 ELSE 0 END) OVER w AS ok_cum
      FROM (SELECT *, dense_rank() OVER (PARTITION BY slug ORDER BY build DESC) AS build_rank FROM job_outcomes)
      WHERE build_rank <= 50
      WINDOW w AS (PARTITION BY slug ORDER BY build_rank, job ROWS UNBOUNDED PRECEDING))))
WHERE pick = 1
UNION ALL
SELECT {slug('c_custkey')}, 'missing_travis', CAST(0 AS BIGINT), 'No Travis builds listed.' FROM idle_customers"""


PIECES["travis_status"] = travis_fold(5)

# ---------------------------------------------------------------- search
PIECES["listed"] = f"""
SELECT year(o_orderdate) - 1995 AS seg_idx,
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS lang_idx,
  CASE o_orderstatus WHEN 'F' THEN 'Python' WHEN 'O' THEN 'Ruby' ELSE 'Java' END AS lang,
  o_orderkey // 500 + 1 AS page, o_orderkey,
  CASE WHEN o_custkey % 97 = 0 THEN '' ELSE {slug('o_custkey')} END AS slug,
  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(floor(o_totalprice) AS BIGINT) END AS stars,
  CAST(epoch(o_orderdate) AS BIGINT) AS pushed_at
FROM orders"""

PIECES["chain_pages"] = """
SELECT seg_idx, lang_idx, page, count(*) AS items, (seg_idx + lang_idx) % 3 = 0 AND page % 17 IN (9, 11, 13) AS bad
FROM listed GROUP BY ALL"""

PIECES["kept_pages"] = """
SELECT p.seg_idx, p.lang_idx, p.page, p.items FROM chain_pages p
WHERE NOT EXISTS (SELECT 1 FROM chain_pages b
  WHERE b.bad AND b.seg_idx = p.seg_idx AND b.lang_idx = p.lang_idx AND b.page <= p.page)"""

PIECES["hits"] = """
SELECT l.*, row_number() OVER (PARTITION BY l.seg_idx, l.lang_idx, l.page ORDER BY o_orderkey) - 1 AS pos
FROM listed l JOIN kept_pages k ON l.seg_idx = k.seg_idx AND l.lang_idx = k.lang_idx AND l.page = k.page"""

PIECES["firsts"] = """
SELECT * FROM hits WHERE slug <> ''
QUALIFY row_number() OVER (PARTITION BY slug ORDER BY seg_idx, lang_idx, page, pos) = 1"""

PIECES["repos"] = f"""
SELECT {slug('o_custkey')} || '/' || o_orderkey AS slug, CAST(floor(o_totalprice) AS BIGINT) AS stars,
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS lang_idx, CAST(o_orderdate AS DATE) AS created
FROM orders"""

PIECES["span"] = """
SELECT CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders"""

# ---------------------------------------------------------------- providers and results
PIECES["providers"] = f"""
SELECT {slug('c_custkey')} AS slug, c_custkey % 5 < 3 AND c_custkey % 4 > 0 AS github, c_custkey % 7 < 2 AS travis
FROM customer"""

PIECES["pairs"] = f"""
SELECT slug, '{GITHUB}' AS provider FROM providers WHERE github
UNION ALL SELECT slug, '{TRAVIS}' FROM providers WHERE travis
UNION ALL SELECT slug, 'unknown' FROM providers WHERE NOT github AND NOT travis"""

PIECES["prior"] = f"""
SELECT {slug('c_custkey')} AS slug, r.provider AS provider, r.status AS status, c_custkey AS checked_at,
  c_custkey AS stars, c_custkey AS pushed_at, 'C' AS languages_hint, '2018-12-01' AS segment_from,
  '2018-12-07' AS segment_to, c_custkey % 30 AS builds_found, 'old ' || c_custkey AS message
FROM customer JOIN (VALUES ('BUILDING', '{GITHUB}', 'ready'), ('MACHINERY', '{GITHUB}', 'retry'),
  ('AUTOMOBILE', '{TRAVIS}', NULL), ('HOUSEHOLD', '{GITHUB}', 'retry'), ('HOUSEHOLD', '{TRAVIS}', 'logs_gone'))
  AS r(segment, provider, status) ON c_mktsegment = r.segment"""

PIECES["updates"] = f"""
SELECT {slug('o_custkey')} AS slug, CASE WHEN o_orderstatus = 'F' THEN '{TRAVIS}' ELSE '{GITHUB}' END AS provider,
  CASE WHEN o_orderkey % 4 = 1 THEN 'insufficient' ELSE 'ready' END AS status,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'new ' || o_orderkey END AS message, o_orderkey % 31 AS builds_found,
  o_orderkey % 4 <> 1 AS gives_message, o_orderkey % 4 = 0 AS gives_builds, o_orderkey AS seq
FROM orders"""


def scanned(prior: str) -> str:
    """Result table after a pass, where ``prior`` is the table before it."""
    return f"""
SELECT coalesce(n.slug, p.slug) AS slug, coalesce(n.provider, p.provider) AS provider,
  CASE WHEN n.slug IS NULL THEN p.status ELSE n.status END AS status,
  CAST(CASE WHEN n.slug IS NULL THEN p.checked_at ELSE 1706745600 END AS BIGINT) AS checked_at,
  CAST(CASE WHEN n.whole THEN n.stars ELSE p.stars END AS BIGINT) AS stars,
  CAST(CASE WHEN n.whole THEN n.pushed_at ELSE p.pushed_at END AS BIGINT) AS pushed_at,
  CASE WHEN n.whole THEN n.lang ELSE p.languages_hint END AS languages_hint,
  CASE WHEN n.whole THEN n.segment_from ELSE p.segment_from END AS segment_from,
  CASE WHEN n.whole THEN n.segment_to ELSE p.segment_to END AS segment_to,
  CAST(CASE WHEN n.whole THEN n.builds_found ELSE p.builds_found END AS BIGINT) AS builds_found,
  CASE WHEN n.slug IS NULL THEN p.message ELSE n.message END AS message
FROM (
  SELECT f.slug, q.provider, q.provider <> 'unknown' AS whole, coalesce(f.stars, 0) AS stars, f.pushed_at, f.lang,
    (1995 + f.seg_idx) || '-01-01' AS segment_from, (1995 + f.seg_idx) || '-12-31' AS segment_to,
    CASE q.provider WHEN 'unknown' THEN 'skipped' WHEN '{GITHUB}' THEN coalesce(g.status, 'error')
      ELSE coalesce(t.status, 'missing_travis') END AS status,
    CASE q.provider WHEN 'unknown' THEN 'No CI detected.'
      WHEN '{GITHUB}' THEN coalesce(g.message, 'Failed to list runs: no page landed')
      ELSE coalesce(t.message, 'No Travis builds listed.') END AS message,
    CASE q.provider WHEN '{GITHUB}' THEN coalesce(g.builds_found, 0) ELSE coalesce(t.builds_found, 0) END AS builds_found
  FROM firsts f JOIN pairs q ON f.slug = q.slug
  LEFT JOIN github_status g ON q.slug = g.slug AND q.provider = '{GITHUB}'
  LEFT JOIN travis_status t ON q.slug = t.slug AND q.provider = '{TRAVIS}'
  WHERE NOT EXISTS (SELECT 1 FROM {prior} s WHERE s.slug = f.slug AND s.status IS DISTINCT FROM 'retry')) n
FULL OUTER JOIN {prior} p ON n.slug = p.slug AND n.provider = p.provider"""


# ---------------------------------------------------------------- request log
PIECES["log"] = """
SELECT event_id AS log_seq, event_id // 3 AS request_id, event_id % 3 + 1 AS attempt, event_id AS ts,
  md5(CAST(user_id % 8 AS VARCHAR)) AS credential_hash,
  CASE WHEN user_id % 8 < 6 THEN 'github' ELSE 'travis' END AS pool,
  CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
  'https://host/' || (user_id % 20) AS url,
  CASE event_type WHEN 'click' THEN '{"page": 1}' WHEN 'error' THEN '{}' END AS params,
  event_id % 71 = 9 AS failed,
  CASE WHEN event_id % 71 = 9 THEN NULL WHEN event_id % 101 = 3 THEN 401 WHEN event_id % 17 = 0 THEN 429
    WHEN event_id % 13 = 4 THEN 403 WHEN (event_id // 3) % 23 = 5 THEN 503 WHEN event_id % 29 = 6 THEN 422
    WHEN event_id % 43 = 7 THEN 400 WHEN event_id % 3 = 1 THEN 304 WHEN event_id % 11 = 0 THEN 404
    ELSE 200 END AS status,
  event_id % 4 <> 0 AS has_etag,
  CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 26 = 4 THEN 0 ELSE event_id % 90 END AS remaining,
  CASE WHEN user_id % 8 >= 4 AND event_id % 50 = 7 THEN event_id + 20 END AS reset,
  CASE event_id % 4 WHEN 1 THEN '0.2' WHEN 2 THEN 'Wed, 21 Oct' WHEN 3 THEN '7' END AS retry_after,
  CASE WHEN event_id % 2 = 0 AND (event_id % 29 = 6 OR event_id % 43 = 7 OR event_id % 85 = 0)
    THEN '{"message":"Account flagged as Spammy"}' ELSE props END AS body
FROM events"""

PIECES["log_flags"] = """
SELECT *, least(2, count(*) FILTER (failed OR status >= 500) OVER (PARTITION BY request_id ORDER BY attempt
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS retries_used,
  coalesce(status = 429 OR (status = 403 AND remaining = 0), false) AS exhausted,
  coalesce(status = 401, false) AS removes,
  coalesce(status > 400 AND status < 500 AND status <> 401 AND NOT (status = 403 AND remaining IS NOT DISTINCT FROM 0)
    AND body ILIKE '%spammy%', false) AS spam
FROM log"""

STORED_STATE = """
SELECT pool, credential_hash,
  CAST(arg_max(CASE WHEN exhausted THEN 0 ELSE remaining END, log_seq)
    FILTER (exhausted OR remaining IS NOT NULL) AS BIGINT) AS remaining,
  CAST(arg_max(CASE WHEN exhausted THEN ts + 60 ELSE reset END, log_seq)
    FILTER (exhausted OR reset IS NOT NULL) AS BIGINT) AS reset_time,
  max(ts) FILTER (NOT failed) AS last_used, bool_or(spam) AS disabled, bool_or(removes) AS removed
FROM log_flags GROUP BY pool, credential_hash"""
PIECES["stored_state"] = STORED_STATE

PIECES["numbered_log"] = """
SELECT *, row_number() OVER (PARTITION BY pool, credential_hash ORDER BY log_seq) AS n FROM log_flags"""

PIECES["memory_steps"] = """
SELECT pool, credential_hash, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS reset_time
FROM (SELECT DISTINCT pool, credential_hash FROM log)
UNION ALL
SELECT s.pool, s.credential_hash, l.n,
  CASE WHEN l.exhausted AND coalesce(l.reset, s.reset_time) < l.ts THEN l.ts + 60
       ELSE coalesce(l.reset, s.reset_time) END
FROM memory_steps s JOIN numbered_log l
  ON l.pool = s.pool AND l.credential_hash = s.credential_hash AND l.n = s.n + 1"""

PIECES["memory_state"] = """
SELECT t.pool, t.credential_hash, t.remaining, m.reset_time, t.last_used, t.disabled, t.removed
FROM stored_state t JOIN (
  SELECT pool, credential_hash, arg_max(reset_time, n) AS reset_time FROM memory_steps GROUP BY ALL) m
  ON t.pool = m.pool AND t.credential_hash = m.credential_hash"""

# ---------------------------------------------------------------- API pages
PIECES["api"] = f"""
SELECT event_id,
  ['commit', 'commits', 'repository', 'languages', 'pull_request', 'commit_comments', 'pull_commits',
   'pull_comments', 'issue_comments', 'pull_reviews', 'user', 'graphql'][event_id % 12 + 1] AS entity,
  {slug('user_id')} AS parent, event_id // 12 % 3 + 1 AS page,
  CASE WHEN event_id // 12 % 7 = 3 THEN 404 ELSE 200 END AS status,
  CASE event_id // 12 % 5 WHEN 0 THEN props WHEN 1 THEN '[' || props || ',' || props || ']' WHEN 2 THEN '[]'
    WHEN 3 THEN '{{"errors": [1], "Python": 7}}' ELSE 'not json' END AS body
FROM events"""


def query(body: str) -> str:
    """``body`` with the pieces it names, directly or through other pieces, as CTEs in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in PIECES:
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                needed.append(name)
                visit(PIECES[name])

    visit(body)
    ordered = [name for name in PIECES if name in needed]
    if not ordered:
        return body.strip()
    recursive = "RECURSIVE " if "memory_steps" in ordered else ""
    ctes = ",\n".join(f"{name} AS ({PIECES[name]})" for name in ordered)
    return f"WITH {recursive}{ctes}\n{body.strip()}"
