from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tabprep-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # Small tables must meet several key ranges too.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of an expression over one row, given as column values by name."""

    def evaluate(expression, **values):
        schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else _kind(v)}" for k, v in values.items())
        df = spark.createDataFrame([tuple(values.values())], schema) if values else spark.range(1)
        return df.select(expression.alias("v")).first().v

    return evaluate


def _kind(value) -> str:
    import datetime as dt

    return {bool: "boolean", int: "bigint", float: "double", dt.date: "date"}[type(value)]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
