"""Result table on files: each pass writes a whole new version, readers take the newest finished one.

Parquet has no in-place merge. A version becomes current when its success marker
is there, so a pass that dies half-way leaves the version before it in force. A
version's folder names its writer, if it has one, so that a pass that is run
again finds what it wrote and puts the same version in its place.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VERSION = re.compile(r"version=(\d+)(?:\.by=([\w-]+))?$")
#: Finished versions that stay; at least two, as a repeated pass reads the one before its own.
KEPT_VERSIONS = 10


def _folder(spark: SparkSession, base: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(base)
    return hadoop, root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, base: str) -> list[tuple[int, str | None, str]]:
    """(number, writer, path) of the finished versions, the newest last."""
    hadoop, root, fs = _folder(spark, base)
    if not fs.exists(root):
        return []
    found = []
    for entry in fs.listStatus(root):
        path = entry.getPath().toString()
        name = VERSION.search(path)
        if name and fs.exists(hadoop.Path(entry.getPath(), "_SUCCESS")):
            found.append((int(name.group(1)), name.group(2), path))
    return sorted(found, key=lambda version: version[0])


def read_results(spark: SparkSession, base: str, schema: str, before: int | None = None, not_by: str | None = None) -> DataFrame:
    """The newest finished version below ``before`` and before that of the writer ``not_by``; an empty table if there is none."""
    found = _versions(spark, base)
    own = [number for number, writer, _ in found if not_by is not None and writer == not_by]
    usable = [path for number, _, path in found if (not own or number < min(own)) and (before is None or number < before)]
    if not usable:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(usable[-1])


def write_results(rows: DataFrame, base: str, version: int | None = None, by: str | None = None, keep: int = KEPT_VERSIONS) -> None:
    """Write a version: the given one, else that of the writer ``by`` again, else the one after the newest.

    Writing the same version again replaces it. Of the finished versions the
    newest ``keep`` stay.
    """
    spark = rows.sparkSession
    found = _versions(spark, base)
    if version is None:
        own = [number for number, writer, _ in found if by is not None and writer == by]
        version = min(own) if own else max((number for number, _, _ in found), default=-1) + 1
    name = f"version={version}" + (f".by={by}" if by else "")
    rows.write.mode("overwrite").parquet(f"{base}/{name}")
    hadoop, _, fs = _folder(spark, base)
    for _, _, path in _versions(spark, base)[: -max(2, keep)]:
        fs.delete(hadoop.Path(path), True)
