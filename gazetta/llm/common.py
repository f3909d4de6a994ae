"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.session import work_path

T = TypeVar("T")

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


#: Rows that go to a worker at a time. Spark's own 10,000 whole texts are held several times on their way there and back.
_ROWS = 2048


def _small_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= _ROWS:
        spark.conf.set(name, str(_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pin_table(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder as Parquet and read back: cuts lineage, keeps column pruning."""
    spark = df.sparkSession
    _small_batches(spark)
    path = work_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches again, in pieces of few rows and few bytes (one row at least), so that Python objects stay small."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            size = min(rows, batch.num_rows - start)
            while size > 1 and batch.slice(start, size).nbytes > max_bytes:
                size = (size + 1) // 2
            yield batch.slice(start, size)
            start += size


_resident: dict[object, object] = {}


def resident(name: object, build: Callable[[], T]) -> T:
    """What a worker keeps between tasks, built once. One thing at a time: another operator's takes its place."""
    if name not in _resident:
        _resident.clear()
        gc.collect()
        _resident[name] = build()
    return _resident[name]


def release() -> None:
    """Let go what a worker keeps from an operator before; called by those that keep nothing themselves."""
    if _resident:
        _resident.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; NULL counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Texts; NULL counts as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def mix64(values: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads 64-bit values."""
    z = values.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        z ^= z >> np.uint64(30)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(27)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return z
