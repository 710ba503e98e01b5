"""Reading tables, adding columns that are worked out per batch of texts, and cutting lineage."""

from __future__ import annotations

import ctypes
import itertools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


#: Rows that are worked on at once, of the batches that Spark hands over.
_ROWS = 1024


def give_back() -> None:
    """Return freed memory to the system: a worker lives on beside the next task's JVM memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def append_columns(
    frame: DataFrame,
    fields: str,
    work: Callable[..., list],
    inputs: list[str] | tuple[str, ...] = ("text",),
    keep: list[str] | None = None,
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """`frame` with the columns `fields` (DDL), which `work` makes from the Arrow arrays of `inputs`, batch by batch.

    A column of `frame` whose name equals a new one, in any case, is replaced. `keep` names the columns to keep, all by default.
    Workers serve many tasks; `done` is called at the end of each, to give back what `work` has kept in memory.
    """
    new = T.StructType.fromDDL(fields)
    names = {f.name.lower() for f in new}
    kept = [c for c in (frame.columns if keep is None else keep) if c.lower() not in names]
    extra = [c for c in inputs if c not in kept]  # a text that is kept goes to the workers once
    source = frame.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(extra)])
    places = [kept.index(c) if c in kept else len(kept) + extra.index(c) for c in inputs]
    schema = T.StructType([source.schema[c] for c in kept] + list(new))
    kinds = [arrow_type(f.dataType) for f in new]
    columns = [*kept, *[f.name for f in new]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, len(whole), _ROWS):
                batch = whole.slice(low, _ROWS)
                made = work(*[batch.column(i) for i in places])
                arrays = [x if isinstance(x, pa.Array) and x.type == k else pa.array(x, type=k) for x, k in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *arrays], names=columns)
        if done is not None:
            done()
        give_back()

    return source.mapInArrow(run, schema)


def follow_length(frame: DataFrame, length: str | None, text: str = "text") -> DataFrame:
    """The column `length`, where there is one, counts the text's characters again in rows that are marked `__changed`."""
    if length is None or length not in frame.columns:
        return frame
    kind = frame.schema[length].dataType
    return frame.withColumn(length, F.when(F.col("__changed"), F.length(text).cast(kind)).otherwise(F.col(length)))


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared one of the session's settings; below a local one only where none is set and the
    master is local, as in tests. On a cluster without a shared folder it refuses: executors do not see each other's disks.

    Spark's own file system removes it when the application ends.
    """
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if top is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="runsift-")
        spark.sparkContext.setCheckpointDir(top)
    folder = f"{top}/llm-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def settled(frame: DataFrame) -> DataFrame:
    """The same rows, computed now and kept as a table in the shared folder: several readers, no lineage."""
    folder = shared_folder(frame.sparkSession)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def slices(offsets, most_bytes: int = 1 << 20, most_rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `most_bytes` of text together; a longer text stands alone."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = low + 1
        while high < rows and high - low < most_rows and offsets[high + 1] - offsets[low] <= most_bytes:
            high += 1
        yield low, high
        low = high


def chunked(rows, most: int):
    rows = iter(rows)
    return iter(lambda: list(itertools.islice(rows, most)), [])
