"""Typed reads of landed API bodies.

``api_pages`` holds one row per landed response: entity, parent, page, status,
body. Objects and lists are told apart by shape, and the caller's schema turns
bodies into columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.functions.entities import graphql_body, graphql_has_errors, object_or_null
from runsift.operators.first_rows import newest_landings, newest_walk

OBJECT_ENTITIES = ("commit", "repository", "pull_request", "user")
PAGED_ENTITIES = ("commit_comments", "pull_commits", "pull_comments", "issue_comments", "pull_reviews")
SINGLE_PAGE_ENTITIES = ("commits",)


def entity_objects(
    pages: DataFrame, *entities: str, schema: str | None = None, raw: bool = False
) -> DataFrame:
    """One row per landed object: entity, parent, ``body`` and, with a schema, ``data``; null where it is no object."""
    _check(entities, OBJECT_ENTITIES)
    rows = newest_landings(pages.filter(F.col("entity").isin(*entities)), "entity", "parent").select(
        "entity", "parent", object_or_null(F.col("status"), F.col("body"), raw).alias("body")
    )
    return rows if schema is None else rows.withColumn("data", F.from_json("body", schema))


def entity_items(
    pages: DataFrame, *entities: str, schema: str | None = None, raw: bool = False
) -> DataFrame:
    """One row per list element, placed by (page, pos): entity, parent, ``item`` and, with a schema, ``data``.

    Paged entities take all pages of the newest walk through the list (pages
    that never landed are passed over); a page that is no list is one element; a
    single-page entity takes page 1, and there anything but a list is empty.
    """
    _check(entities, PAGED_ENTITIES + SINGLE_PAGE_ENTITIES)
    paged = F.col("entity").isin(*PAGED_ENTITIES)
    kept = pages.filter(F.col("entity").isin(*entities) & (paged | (F.col("page") == 1)))
    kept = newest_walk(kept, "entity", "parent")
    if not raw:
        kept = kept.filter(F.col("status") == 200)
    rows = kept.select(
        "entity", "parent", "page", F.posexplode(list_items(F.col("body"), paged)).alias("pos", "item")
    )
    return rows if schema is None else rows.withColumn("data", F.from_json("item", schema))


def list_items(body: Column, paged: Column) -> Column:
    """Elements of a JSON list as texts; another JSON value is one element of a paged list, else none."""
    elements = F.from_json(body, "array<string>")
    return F.when(elements.isNotNull(), elements).when(
        paged & F.try_parse_json(body).isNotNull(), F.array(body)
    )


def _check(entities: Sequence[str], known: Sequence[str]) -> None:
    unknown = set(entities) - set(known)
    if unknown or not entities:
        raise ValueError(f"entities must be among {sorted(known)}, not {sorted(unknown)}")


def languages(pages: DataFrame) -> DataFrame:
    """Bytes of code per repository and language; null where the count is no whole number."""
    kept = pages.filter((F.col("entity") == "languages") & (F.col("status") == 200))
    return kept.select(
        "parent", F.explode(F.from_json("body", "map<string,string>")).alias("language", "_bytes")
    ).select("parent", "language", F.col("_bytes").try_cast("bigint").alias("bytes"))


def graphql_results(pages: DataFrame) -> DataFrame:
    """Landed GraphQL bodies, an empty object unless the status is 200, and whether they carry errors."""
    kept = pages.filter(F.col("entity") == "graphql")
    return kept.select(
        "parent",
        graphql_body(F.col("status"), F.col("body")).alias("body"),
        graphql_has_errors(F.col("status"), F.col("body")).alias("has_errors"),
    )
