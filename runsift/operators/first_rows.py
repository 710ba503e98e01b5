"""First rows per key, safe for a key that holds a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows per key.

    The filter on the rank lets Spark cut each group to ``n`` rows before the
    shuffle as well as after it (``n`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``).
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def newest_landings(rows: DataFrame, *keys: str, landed: str = "ts") -> DataFrame:
    """The newest landing per key, by the column ``landed``; rows of a table without it have landed once.

    An answer that landed later takes the place of an older one, whatever either says.
    """
    if landed not in rows.columns:
        return rows
    return first_rows(rows, list(keys), [F.col(landed).desc_nulls_last()], 1)


def thin_hot_keys(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, splits: int, spread: Sequence[str]
) -> DataFrame:
    """Keep a superset of the first ``n`` rows per key: at most ``n * splits`` rows of each.

    Every key is cut into ``splits`` parts by a hash of the ``spread`` columns
    and each part keeps its own first ``n``. A row among the first ``n`` of its
    key is among the first ``n`` of its part, so an exact cut can follow. Keys
    with few rows pass unchanged.
    """
    if splits <= 1:
        return df
    part = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(splits))
    return first_rows(df.withColumn("_part", part), [*keys, "_part"], order, n).drop("_part")


def newest_walk(rows: DataFrame, *keys: str, page: str = "page", landed: str = "ts") -> DataFrame:
    """The newest landing of each list (``keys``) whole: its pages, and no page of an older walk through it.

    A walk through a list begins at its page 1. Pages landed at or after the newest page 1 of a list belong to the
    newest walk; older pages drop out, even where the newest walk did not reach them. A list without a landed page 1
    keeps all its pages. Within the walk, the newest landing of each page counts (``newest_landings``); equal times
    are told apart by the row's content, so that the choice does not depend on partitioning. Rows without ``landed``
    have landed once.

    Only the newest start per list is aggregated (partially, before the shuffle) and joined back, so a list with a
    large share of all pages costs no task of its own size.
    """
    if landed not in rows.columns:
        return rows
    starts = rows.filter(F.col(page) == 1).groupBy(*keys).agg(F.max(landed).alias("_start"))
    walk = rows.join(starts, list(keys), "left").filter(F.col("_start").isNull() | (F.col(landed) >= F.col("_start")))
    content = F.xxhash64(*[F.col(c) for c in rows.columns if c != landed])
    ranked = first_rows(walk.drop("_start"), [*keys, page], [F.col(landed).desc_nulls_last(), content.desc()], 1)
    return ranked


def first_hole(pages: DataFrame, *keys: str, page: str = "page") -> DataFrame:
    """(keys, ``_hole``) of each list with a hole: the smallest page number from 1 on that did not land while a later
    page did. A list whose page 1 never landed has its hole at 1; a list whose landed pages run 1, 2, ... has none."""
    landed = pages.select(*keys, page).filter(F.col(page) >= 1).distinct()
    ends = landed.groupBy(*keys).agg(F.min(page).alias("_low"), F.max(page).alias("_top"))
    after = landed.select(*keys, (F.col(page) + 1).alias(page))
    inner = (
        after.join(landed, [*keys, page], "left_anti")
        .join(ends, list(keys))
        .filter(F.col(page) < F.col("_top"))
        .select(*keys, F.col(page).alias("_hole"))
    )
    first = ends.filter(F.col("_low") > 1).select(*keys, F.lit(1).alias("_hole"))
    return inner.unionByName(first).groupBy(*keys).agg(F.min("_hole").alias("_hole"))
