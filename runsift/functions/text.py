"""Scalar text functions: slugs, addresses, search strings, lists, masks and keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\r\n"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def given(text: Column) -> Column:
    """The text, or null where it is empty."""
    return F.nullif(text, F.lit(""))


# ---------------------------------------------------------------- slugs (F1, F2)
def is_slug(slug: Column) -> Column:
    """A slug needs a slash; anything else belongs to the rejects."""
    return F.coalesce(slug.contains("/"), F.lit(False))


def slug_owner(slug: Column) -> Column:
    return F.split(slug, "/", 2).getItem(0)


def slug_name(slug: Column) -> Column:
    """All that follows the first slash."""
    return F.when(is_slug(slug), F.split(slug, "/", 2).getItem(1))


def travis_slug(slug: Column) -> Column:
    return F.concat(slug_owner(slug), F.lit("%2F"), slug_name(slug))


# ---------------------------------------------------------------- addresses
def address(base: Column | str, *parts: Column | str) -> Column:
    """Base without trailing slashes, then the parts joined to it as they are."""
    as_col = [p if isinstance(p, Column) else F.lit(p) for p in (base, *parts)]
    return F.concat(F.rtrim(as_col[0], F.lit("/")), *as_col[1:])


def search_address(api: Column | str) -> Column:
    return address(api, "/search/repositories")


def runs_address(api: Column | str, slug: Column) -> Column:
    return address(api, "/repos/", slug, "/actions/runs")


def contents_address(api: Column | str, slug: Column, path: Column) -> Column:
    return address(api, "/repos/", slug, "/contents/", F.ltrim(path, F.lit("/")))


def travis_builds_address(api: Column | str, slug: Column) -> Column:
    return address(api, "/repo/", travis_slug(slug), "/builds")


def travis_log_address(api: Column | str, job_id: Column) -> Column:
    return address(api, "/job/", job_id.cast("string"), "/log")


# ---------------------------------------------------------------- search strings
def search_string(
    language: Column, segment_from: Column, segment_to: Column, updated_since: Column, min_stars: Column
) -> Column:
    """Search qualifiers parted by one blank; with both segment ends the update date plays no part."""
    return F.concat_ws(
        " ",
        F.when(given(language).isNotNull(), F.concat(F.lit("language:"), language)),
        F.when(
            segment_from.isNotNull() & segment_to.isNotNull(),
            F.concat(F.lit("created:"), segment_from.cast("string"), F.lit(".."), segment_to.cast("string")),
        ).when(given(updated_since).isNotNull(), F.concat(F.lit("pushed:>="), updated_since)),
        F.when(min_stars != 0, F.concat(F.lit("stars:>="), min_stars.cast("string"))),
    )


def language_clause(languages: Column) -> Column:
    return F.array_join(F.transform(languages, lambda x: F.concat(F.lit("language:"), x)), " OR ")


# ---------------------------------------------------------------- lists, masks, keys
def clean_strings(items: Column) -> Column:
    """Stripped items without the blank ones."""
    return F.filter(F.transform(items, strip), lambda x: x != "")


def mask_secret(secret: Column) -> Column:
    """First and last four characters; a text of eight or fewer is hidden whole."""
    return F.when(
        F.length(secret) > 8, F.concat(F.left(secret, F.lit(4)), F.lit("..."), F.right(secret, F.lit(4)))
    ).when(secret.isNotNull(), F.lit("..."))


def request_key(url: Column, params: Column) -> Column:
    """Key of a conditional request. ``params`` is landed as canonical JSON; none and ``{}`` differ."""
    return F.md5(F.concat(url, F.lit(":"), F.coalesce(params, F.lit("null"))))


def any_of(value: Column, choices: Sequence[object]) -> Column:
    """``isin`` that is false, not null, for a null value."""
    return F.coalesce(value.isin(list(choices)), F.lit(False))
