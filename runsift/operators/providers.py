"""CI providers of each repository (J6) and one row per provider."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsift import fixed_values as fv
from runsift.functions.outcomes import content_exists, has_runs
from runsift.operators.first_rows import newest_landings


def detect_providers(probes: DataFrame) -> DataFrame:
    """Ordered provider list per slug from the newest answer to each probe; summed up before the shuffle."""
    probes = newest_landings(probes, "slug", "probe")
    github = (F.col("probe") == "runs") & has_runs(F.col("status"), F.col("total_count"))
    travis = (F.col("probe") == "travis_yml") & content_exists(F.col("status"))
    found = probes.groupBy("slug").agg(F.bool_or(github).alias("_github"), F.bool_or(travis).alias("_travis"))
    return found.select(
        "slug",
        F.array_compact(
            F.array(F.when(F.col("_github"), fv.GITHUB), F.when(F.col("_travis"), fv.TRAVIS))
        ).alias("providers"),
    )


def fan_out(repos: DataFrame, detected: DataFrame) -> DataFrame:
    """One row per repository and provider; a repository without any gets the provider ``unknown``."""
    none = F.array(F.lit(fv.NO_PROVIDER))
    providers = F.when(F.size("providers") > 0, F.col("providers")).otherwise(none)
    return (
        repos.join(detected, "slug", "left")
        .withColumn("provider", F.explode(providers))
        .drop("providers")
    )
