"""Versioned Parquet tables.

A write goes to a new folder and becomes visible by one appended row in the
table's version list.  Nothing is ever read and overwritten in the same job, and
a job that dies half-way leaves the table as it was.  One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VERSIONS = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder?  Only lists names, reads nothing."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def exists(spark: SparkSession, root: str) -> bool:
    return path_exists(spark, f"{root}/versions")


def versions(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_VERSIONS).parquet(f"{root}/versions")


def current(spark: SparkSession, root: str) -> tuple[int, str | None, str | None]:
    """Latest version, its folder and batch; (0, None, None) for a new table."""
    if not exists(spark, root):
        return 0, None, None
    latest = F.max(F.struct("version", "path", "batch")).alias("v")
    row = versions(spark, root).agg(latest).first()["v"]
    return (row["version"], row["path"], row["batch"]) if row else (0, None, None)


def read_table(spark: SparkSession, root: str) -> DataFrame:
    _, path, _ = current(spark, root)
    if path is None:
        raise FileNotFoundError(root)
    return spark.read.parquet(path)


def write_table(df: DataFrame, root: str, batch: str | None = None, partition_by: tuple[str, ...] = ()) -> int:
    """Write a new version and publish it; returns its number."""
    spark = df.sparkSession
    number, _, _ = current(spark, root)
    path = f"{root}/data/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    entry = spark.createDataFrame([(number + 1, path, batch)], _VERSIONS)
    entry.coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return number + 1

