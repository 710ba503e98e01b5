"""Cut a lineage that several branches read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def materialise(df: DataFrame) -> DataFrame:
    """The rows written as a table below the folder the session names, so that they are computed once.

    The files outlive the executors that wrote them, and their size is known
    when the branches that read them are planned. Without
    ``spark.checkpoint.dir`` the plan stays lazy and each branch computes its own.
    """
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df
    path = f"{folder.rstrip('/')}/runsift-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
