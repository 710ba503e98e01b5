"""Fixed values.

Everything here has to equal what the services send or what existing result
tables hold, so it is stated as plain text in one place and used from here only.
"""

# --- fixed values: providers and statuses of a result row -------------------
GITHUB = "github_actions"
TRAVIS = "travis_ci"
NO_PROVIDER = "unknown"

READY = "ready"
INSUFFICIENT = "insufficient"
LOGS_GONE = "logs_gone"
AUTH_FAILED = "auth_failed"
ERROR = "error"
MISSING_GITHUB = "missing_actions"
MISSING_TRAVIS = "missing_travis"
SKIPPED = "skipped"
RETRY = "retry"

# --- fixed values: outcome of one log request -------------------------------
LOG_OK = "ok"
LOG_GONE = "gone"
LOG_AUTH = "auth"
LOG_ERROR = "error"

# --- fixed values: status and message per reason ----------------------------
# %s takes the length of the failure run, the HTTP status or the error text.
GITHUB_REASONS = {
    "list_failed": (ERROR, "Failed to list runs: %s"),
    "list_missing": (MISSING_GITHUB, "Actions disabled or repo missing."),
    "list_refused": (ERROR, "Failed to list runs: %s"),
    "list_empty": (MISSING_GITHUB, "Actions disabled or no runs found."),
    "gone_run": (LOGS_GONE, "Logs removed (404) consecutively %s times, stop scanning."),
    "denied": (AUTH_FAILED, "401/403 fetching logs."),
    "error_run": (ERROR, "Too many consecutive errors %s, stop scanning."),
    "enough": (READY, "Has enough downloadable GitHub Actions logs."),
    "list_end": (INSUFFICIENT, "Not enough Actions runs with logs."),
}
TRAVIS_REASONS = {
    "list_empty": (MISSING_TRAVIS, "No Travis builds listed."),
    "gone": (LOGS_GONE, "Logs removed (404), stop scanning."),
    "denied": (AUTH_FAILED, "401/403 fetching Travis logs."),
    "enough": (READY, "Has enough downloadable Travis logs."),
    "list_end": (INSUFFICIENT, "Not enough Travis job logs."),
}
NO_PROVIDER_MESSAGE = "No CI detected."

# --- fixed values: texts looked for in responses (all case-free) -------------
ACCEPT_REFUSED_TEXT = "unsupported 'accept' header"
ADMIN_ONLY_TEXT = "admin rights"
SPAM_TEXT = "spammy"
BOT_TYPE = "bot"
BOT_LOGIN_ENDS = ("[bot]", "bot")

# --- fixed values: limits and defaults ---------------------------------------
LANGUAGES = ("Python", "Ruby", "Java")
MIN_BUILDS = 30
FAILURE_LIMIT = 10
TRAVIS_BUILDS = 50
SEARCH_SORT = "stars"
SEARCH_ORDER = "desc"
SEARCH_PER_PAGE = 50
SEARCH_PAGES = 1
MIN_STARS = 50
UPDATED_SINCE = "2025-11-01"
RETRY_COUNT = 3
RETRY_BASE_DELAY_SECONDS = 0.25
SLEEP_ON_429_SECONDS = 300
LOOP_SLEEP_SECONDS = 300
GITHUB_API = "https://api.github.com"
TRAVIS_API = "https://api.travis-ci.com"
FULL_QUOTA = 5000
COOL_OFF_SECONDS = 60
SEGMENT_DAYS = 7
