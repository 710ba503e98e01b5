"""Classification of responses.

A response is classified before it is joined to anything, so that only a short
code and the redirect target travel through shuffles and never the body.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runsift import fixed_values as fv
from runsift.functions.text import given

REDIRECT = "redirect"


def message_text(body: Column) -> Column:
    """The ``message`` of a JSON object, else the text as it is."""
    return F.coalesce(given(F.get_json_object(body, "$.message")), body)


def denied_by_message(body: Column) -> Column:
    """The message says that the Accept header or the rights of the caller do not do.

    Most bodies hold neither text anywhere, and only those that do, or that have
    an escape which may stand for a part of it, are parsed.
    """
    whole, message = F.lower(body), F.lower(message_text(body))
    worth_parsing = (
        whole.contains(fv.ADMIN_ONLY_TEXT) | whole.contains(fv.ACCEPT_REFUSED_TEXT) | body.contains("\\")
    )
    said = message.contains(fv.ADMIN_ONLY_TEXT) | message.contains(fv.ACCEPT_REFUSED_TEXT)
    return F.coalesce(worth_parsing & said, F.lit(False))


def github_code(status: Column, body: Column) -> Column:
    """Code of a first response to a workflow-run log request; the first match counts."""
    return (
        F.when(status == 302, REDIRECT)
        .when(status == 200, fv.LOG_OK)
        .when(denied_by_message(body), fv.LOG_AUTH)
        .when(status == 404, fv.LOG_GONE)
        .when(status.isin(401, 403, 415), fv.LOG_AUTH)
        .otherwise(fv.LOG_ERROR)
    )


def travis_code(status: Column, body: Column) -> Column:
    """Code of a first response to a job log request; message texts play no part."""
    return (
        F.when(status == 302, REDIRECT)
        .when(status == 200, fv.LOG_OK)
        .when(status == 404, fv.LOG_GONE)
        .when(status.isin(401, 403), fv.LOG_AUTH)
        .otherwise(fv.LOG_ERROR)
    )


def log_outcome(code: Column, followed_status: Column) -> Column:
    """Outcome of a log request. A null code means that no response landed."""
    return (
        F.when(code.isNull(), fv.LOG_ERROR)
        .when(code != REDIRECT, code)
        .when(followed_status == 200, fv.LOG_OK)
        .otherwise(fv.LOG_ERROR)
    )


def content_exists(status: Column) -> Column:
    return F.coalesce(status == 200, F.lit(False))


def has_runs(status: Column, total_count: Column) -> Column:
    return F.coalesce((status == 200) & (F.coalesce(total_count, F.lit(0)) > 0), F.lit(False))
