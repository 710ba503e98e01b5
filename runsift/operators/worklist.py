"""What to search for: date segments, languages, pages, and lists of settings.

G1, G2, F4, F11, A9, X2, X3, J1, J2, P12.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runsift import fixed_values as fv
from runsift.functions.text import any_of, given, search_string, strip
from runsift.settings import Settings


def iso_date(value: Column) -> Column:
    """The date of a whole ISO date or time; null for anything else, shortened dates too."""
    text = strip(value.cast("string"))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}($|[T ])"), text.try_cast("date"))


def weekly_segments(ranges: DataFrame, start: str = "range_start", end: str = "range_end") -> DataFrame:
    """Seven-day segments over each range, both ends inclusive, the last one cut short.

    ``start`` and ``end`` are ISO texts or dates. A range with a bad date, or
    one that ends before it starts, gives no segment.
    """
    first, last = iso_date(F.col(start)), iso_date(F.col(end))
    ordered = ranges.filter(F.coalesce(first <= last, F.lit(False)))
    weeks = F.sequence(first, last, F.expr(f"INTERVAL {fv.SEGMENT_DAYS} DAYS"))
    return (
        ordered.select("*", F.posexplode(weeks).alias("seg_idx", "segment_from"))
        .withColumn("segment_to", F.least(F.date_add("segment_from", fv.SEGMENT_DAYS - 1), last))
    )


def normalise_segments(raw: DataFrame) -> DataFrame:
    """Segments as written in settings (``ordinal``, ``fields`` map, ``pair`` list) to two clean ends.

    Either end may go by several names, or the two come as a list; a segment
    without both ends is dropped.
    """
    fields, pair = F.col("fields"), F.col("pair")

    def end_of(names: Sequence[str], position: int) -> Column:
        named = F.coalesce(*[given(F.try_element_at(fields, F.lit(name))) for name in names])
        listed = F.when(F.size(pair) >= 2, F.try_element_at(pair, F.lit(position)))
        return given(strip(F.when(fields.isNotNull(), named).otherwise(listed)))

    return raw.select(
        "ordinal",
        end_of(("from", "start", "from_"), 1).alias("segment_from"),
        end_of(("to", "end", "to_"), 2).alias("segment_to"),
    ).filter(F.col("segment_from").isNotNull() & F.col("segment_to").isNotNull())


def settings_segments(spark: SparkSession, settings: Settings) -> DataFrame | None:
    """Segments the settings ask for: the written ones, else weekly ones over the range, else none at all.

    Written ends stay as text beside their dates: a search takes them as they are,
    whole dates or not.
    """
    written = [
        (i, {str(k): str(v) for k, v in s.items() if v} if isinstance(s, Mapping) else None,
         None if isinstance(s, Mapping) else [str(end) for end in s])
        for i, s in enumerate(settings.search_segments)
    ]
    explicit = normalise_segments(
        spark.createDataFrame(written, "ordinal INT, fields MAP<STRING, STRING>, pair ARRAY<STRING>")
    ).select(
        F.col("ordinal").alias("seg_idx"),
        iso_date(F.col("segment_from")).alias("segment_from"),
        iso_date(F.col("segment_to")).alias("segment_to"),
        F.col("segment_from").alias("from_text"),
        F.col("segment_to").alias("to_text"),
    )
    ends = [(settings.segment_start, settings.segment_end)]
    weekly = weekly_segments(spark.createDataFrame(ends, "range_start STRING, range_end STRING")).select(
        "seg_idx", "segment_from", "segment_to"
    )
    for segments in (explicit, weekly):
        if not segments.isEmpty():
            return segments
    return None


def work_list(
    segments: DataFrame | None, languages: Column | Sequence[str], settings: Settings, base: DataFrame | None = None
) -> DataFrame:
    """One row per search page: segments x languages x pages, with its search string.

    Languages and page numbers are exploded from arrays, so no join takes part.
    Without segments, ``base`` is a one-row table; without languages one empty
    language is searched.
    """
    if not isinstance(languages, Column):
        languages = F.array(*[F.lit(x) for x in languages]) if languages else F.array(F.lit(""))
    languages = F.when(F.size(languages) > 0, languages).otherwise(F.array(F.lit("")))
    if segments is None:
        null_date = F.lit(None).cast("date")
        segments = base.select(F.lit(0).alias("seg_idx"), null_date.alias("segment_from"), null_date.alias("segment_to"))
    ends = [
        F.coalesce(F.col(text), F.col(day).cast("string")) if text in segments.columns else F.col(day).cast("string")
        for text, day in (("from_text", "segment_from"), ("to_text", "segment_to"))
    ]
    pages = F.array(*[F.lit(page) for page in range(1, settings.search_pages + 1)]).cast("array<int>")
    return (
        segments.select(
            "seg_idx", "segment_from", "segment_to", ends[0].alias("_from"), ends[1].alias("_to"),
            F.posexplode(languages).alias("lang_idx", "lang"),
        )
        .select("*", F.explode(pages).alias("page"))
        .withColumn(
            "search",
            search_string(
                F.col("lang"),
                F.col("_from"),
                F.col("_to"),
                F.lit(settings.updated_since),
                F.lit(settings.min_stars),
            ),
        )
        .drop("_from", "_to")
    )


def match_segments(repos: DataFrame, segments: DataFrame, created: str = "created_at") -> DataFrame:
    """Repositories with every segment that holds their creation date, ends inclusive.

    Segments are unfolded into days, which turns the range condition into an
    equality, so Spark can hash-join at any size; it broadcasts the day table
    only if its measured size allows. A segment that ends before it begins, or
    lacks a whole date, holds no day.
    """
    segments = segments.filter(F.coalesce(F.col("segment_from") <= F.col("segment_to"), F.lit(False)))
    days = segments.withColumn("_day", F.explode(F.sequence("segment_from", "segment_to", F.expr("INTERVAL 1 DAY"))))
    return (
        repos.withColumn("_day", F.to_date(created))
        .join(days, "_day")
        .drop("_day")
    )


def search_filter(repos: DataFrame, settings: Settings, segments: DataFrame | None = None) -> DataFrame:
    """Repositories a search would list: language, creation segment or update date, stars.

    With segments the update date is not looked at.
    """
    kept = repos
    if settings.languages:
        kept = kept.filter(any_of(F.col("language"), settings.languages))
        position = F.array_position(F.array(*[F.lit(x) for x in settings.languages]), F.col("language"))
        kept = kept.withColumn("lang_idx", (position - 1).cast("int"))
    else:
        kept = kept.withColumn("lang_idx", F.lit(0))
    if settings.min_stars:
        kept = kept.filter(F.col("stargazers_count") >= settings.min_stars)
    if segments is not None:
        return match_segments(kept, segments)
    if settings.updated_since:
        kept = kept.filter(F.col("pushed_at") >= F.lit(settings.updated_since).cast("timestamp"))
    null_date = F.lit(None).cast("date")
    return kept.withColumns({"seg_idx": F.lit(0), "segment_from": null_date, "segment_to": null_date})


def clean_distinct(values: DataFrame, column: str) -> DataFrame:
    """Stripped values of a column, blank ones dropped, each once."""
    return values.select(strip(F.col(column)).alias(column)).filter(F.col(column) != "").distinct()


def append_lists(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all lists; repeated values stay."""
    for other in others:
        first = first.unionByName(other)
    return first


def remove_listed(values: DataFrame, removed: DataFrame, column: str) -> DataFrame:
    """Values that are not listed in ``removed``; repeated values stay."""
    return values.join(removed.select(column).distinct(), column, "left_anti")
