"""Readers of landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runsift.schemas import LANDED, RESULTS


def read_landed(spark: SparkSession, table: str, path: str, fmt: str = "parquet", stamped: bool | None = None) -> DataFrame:
    """A landed table with its declared schema; ``fmt`` is any Spark file format (parquet, orc, json).

    ``stamped`` tables hold the time of each landing, ``ts``, and may hold a page more than once: the newest counts.
    Where it is not given, the rows are looked at for one with such a time.
    """
    if stamped is None:
        stamped = not spark.read.format(fmt).schema("ts TIMESTAMP").load(path).filter("ts IS NOT NULL").isEmpty()
    return spark.read.format(fmt).schema(_schema(table, stamped)).load(path)


def read_landed_stream(
    spark: SparkSession, table: str, path: str, fmt: str = "parquet", files_per_batch: int | None = None,
    stamped: bool = False,
) -> DataFrame:
    """The same table as a stream of newly landed files."""
    reader = spark.readStream.format(fmt).schema(_schema(table, stamped))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _schema(table: str, stamped: bool = False) -> str:
    schema = RESULTS if table == "scan_results" else LANDED[table]
    return f"{schema}, ts TIMESTAMP" if stamped and " ts " not in f" {schema}" else schema
