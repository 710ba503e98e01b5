"""Which repositories of a search are taken up: S2, W1, W2, W3, J3, J4, A6, P16."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runsift import fixed_values as fv
from runsift.functions.text import is_slug
from runsift.operators.first_rows import first_hole, first_rows, newest_walk, thin_hot_keys
from runsift.settings import Settings

#: Fields that a search order may go by, the first that the rows have.
SORT_FIELDS = {
    "stars": ("stargazers_count",),
    "updated": ("updated_at", "pushed_at"),
    "forks": ("forks_count",),
    "help-wanted-issues": ("open_issues_count",),
}
TRAVERSAL = ["seg_idx", "lang_idx", "page", "pos"]


def bad_page(status: Column, request_failed: Column) -> Column:
    return F.coalesce(request_failed, F.lit(False)) | ~F.coalesce(status == 200, F.lit(False))


def cut_page_chains(pages: DataFrame) -> DataFrame:
    """Search pages before the first bad one of their (segment, language) chain.

    Only the first bad page number per chain is shuffled and joined back; the
    item arrays stay where they were read unless that table outgrows a broadcast.
    The newest walk through each chain counts whole, and a page that never landed
    before a landed one is bad as well.
    """
    pages = newest_walk(pages, "seg_idx", "lang_idx")
    bad = bad_page(F.col("status"), F.col("request_failed"))
    holes = first_hole(pages, "seg_idx", "lang_idx").withColumnRenamed("_hole", "page")
    first_bad = (
        pages.filter(bad).select("seg_idx", "lang_idx", "page").unionByName(holes)
        .groupBy("seg_idx", "lang_idx").agg(F.min("page").alias("_first_bad"))
    )
    return (
        pages.filter(~bad)
        .join(first_bad, ["seg_idx", "lang_idx"], "left")
        .filter(F.col("_first_bad").isNull() | (F.col("page") < F.col("_first_bad")))
        .drop("_first_bad")
    )


def search_hits(pages: DataFrame) -> DataFrame:
    """One row per item of each page, with its place in the traversal."""
    return pages.select(
        "seg_idx", "segment_from", "segment_to", "lang_idx", "page", F.posexplode("items").alias("pos", "item")
    ).select(
        F.col("item.full_name").alias("slug"),
        "seg_idx",
        "lang_idx",
        "page",
        "pos",
        "segment_from",
        "segment_to",
        F.col("item.stargazers_count").alias("stargazers_count"),
        F.col("item.pushed_at").alias("pushed_at"),
        F.col("item.language").alias("language"),
    )


def split_rejects(hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits with a usable slug, rejects). Blank slugs never meet in one group."""
    return hits.filter(is_slug(F.col("slug"))), hits.filter(~is_slug(F.col("slug")))


def first_seen(hits: DataFrame) -> DataFrame:
    """The first hit of each slug over all segments, languages and pages, with that hit's segment.

    Each map task keeps one row per slug before the shuffle.
    """
    return first_rows(hits, ["slug"], TRAVERSAL, 1)


def search_pages(repos: DataFrame, settings: Settings) -> DataFrame:
    """Ranked pages of a search: at most ``per_page * pages`` repositories per (segment, language).

    An order whose field the rows lack, such as best match, is the search
    engine's own: then the slug alone decides. There are few (segment, language) groups and each may be huge, so hot ones
    are thinned in parts first.
    """
    cap = settings.search_per_page * settings.search_pages
    field = next((c for c in SORT_FIELDS.get(settings.search_sort, (settings.search_sort,)) if c in repos.columns), None)
    by = [] if field is None else [F.col(field).asc_nulls_first() if settings.search_order == "asc" else F.col(field).desc_nulls_last()]
    keys, order = ["seg_idx", "lang_idx"], [*by, F.col("slug")]
    thin = thin_hot_keys(repos, keys, order, cap, settings.hot_key_splits, ["slug"])
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        thin.withColumn("rank", rank)
        .filter(F.col("rank") <= cap)
        .withColumn("page", F.ceil(F.col("rank") / settings.search_per_page).cast("int"))
        .withColumn("pos", ((F.col("rank") - 1) % settings.search_per_page).cast("int"))
    )


def is_processed(status: Column) -> Column:
    """Anything but a row set to be retried counts as processed, a missing status too."""
    return ~status.eqNullSafe(F.lit(fv.RETRY))


def drop_seen(repos: DataFrame, results: DataFrame) -> DataFrame:
    """Repositories without any processed result row, whichever its provider."""
    seen = results.filter(is_processed(F.col("status"))).select("slug").distinct()
    return repos.join(seen, "slug", "left_anti")


def drop_seen_pairs(pairs: DataFrame, results: DataFrame) -> DataFrame:
    """(slug, provider) pairs without a processed result row of their own."""
    seen = results.filter(is_processed(F.col("status"))).select("slug", "provider").distinct()
    return pairs.join(seen, ["slug", "provider"], "left_anti")


def limit_unseen(repos: DataFrame, results: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` unseen repositories in traversal order; all of them without a limit."""
    unseen = drop_seen(repos, results)
    return unseen if limit is None else unseen.orderBy(*TRAVERSAL).limit(limit)
