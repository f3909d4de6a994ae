from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from gazetta.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "gazetta-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column built from literal values: one('text', fn) -> value of fn(column)."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def run(value, fn, kind=None):
        kind = kind or T.StringType()
        df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", kind)]))
        return df.select(fn(F.col("v")).alias("out")).first()["out"]

    return run


@pytest.fixture
def rows():
    def as_dicts(df, *keys):
        out = [r.asDict(recursive=True) for r in df.collect()]
        return sorted(out, key=lambda r: tuple(str(r[k]) for k in keys)) if keys else out

    return as_dicts
