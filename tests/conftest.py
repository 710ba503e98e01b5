import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tmp_path_factory.mktemp("checkpoints").as_uri())
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Values of a column expression over rows given as tuples, in order."""

    def compute(schema, rows, expression):
        numbered = [(i, *row) for i, row in enumerate(rows)]
        frame = spark.createDataFrame(numbered, f"_n INT, {schema}")
        return [r[0] for r in frame.select(expression.alias("v"), "_n").orderBy("_n").select("v").collect()]

    return compute
