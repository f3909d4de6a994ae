"""Keyed writes on streams, and resumable batch work."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gazetta.operators.dedupe import keep_first, keep_last, not_known
from gazetta.operators.merge import upsert
from gazetta.sources import tables

_BATCH = T.StructField("batch", T.LongType())
_ORDER = "_order"


def stream_insert_only(
    stream: DataFrame, keys: Sequence[str], period: str, watermark: str, path: str, checkpoint: str
) -> StreamingQuery:
    """First row per (key, period), appended to ``path``.

    The period is part of the key and carries the watermark, so its state can be
    dropped once the watermark has passed it without ever writing a key twice.
    Rows later than the watermark are late and ignored; where none may be lost
    use :func:`stream_insert_only_table`.
    """
    unique = stream.withWatermark(period, watermark).dropDuplicates([*keys, period])
    return (
        unique.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_insert_only_table(
    stream: DataFrame, keys: Sequence[str], period: str, order: Sequence[str], root: str, checkpoint: str
) -> StreamingQuery:
    """The same against the table itself: no late rows, and a crowded key is cut down before the shuffle.

    Every micro-batch writes its own folder, replacing it on a replay.  Only
    the periods a batch touches are looked up in the earlier folders.
    """
    by = [*keys, period]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = keep_first(batch, by, order)
        if tables.path_exists(spark, root):
            table = spark.read.schema(T.StructType([*batch.schema, _BATCH])).parquet(root)
            span = batch.agg(F.min(period).alias("low"), F.max(period).alias("high")).first()
            known = table.filter(
                (F.col(_BATCH.name) < batch_id) & F.col(period).between(span["low"], span["high"])
            )
            new = not_known(new, known, by)
        new.write.mode("overwrite").parquet(f"{root}/{_BATCH.name}={batch_id}")

    return _for_each(stream, write, checkpoint)


def stream_upsert(
    stream: DataFrame, keys: Sequence[str], order: str, root: str, checkpoint: str
) -> StreamingQuery:
    """Upsert every micro-batch: the last row per key, by event order, goes to the batch's own folder.

    The work of a batch grows with the batch, not with the table; a replayed
    batch replaces its folder.  :func:`read_upserted` gives the table,
    :func:`compact` folds the batches into a new version of it.  The log keeps the order of its rows, so an
    event that arrives in a later batch than its successors does not undo them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        last = keep_last(batch, keys, [order]).withColumnRenamed(order, _ORDER)
        last.write.mode("overwrite").parquet(f"{root}/log/{_BATCH.name}={batch_id}")

    return _for_each(stream, write, checkpoint)


def _log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(f"{root}/log")


def _pending(spark: SparkSession, root: str, done: int) -> DataFrame | None:
    """Rows of the batches that the current version does not hold."""
    if not tables.path_exists(spark, f"{root}/log"):
        return None
    return _log(spark, root).filter(F.col(_BATCH.name) > done)


def _orders(spark: SparkSession, root: str) -> DataFrame | None:
    """(keys, order) of the events that the current version has applied."""
    return tables.read_table(spark, f"{root}/orders") if tables.exists(spark, f"{root}/orders") else None


def read_upserted(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Latest version of the table with all later batches applied; of a key's events the last by order counts, then by batch."""
    done, base = -1, None
    if tables.exists(spark, root):
        done, base = int(tables.current(spark, root)[2]), tables.read_table(spark, root)
    log = _pending(spark, root, done)
    if log is None:
        return base
    last = keep_last(log, keys, [_ORDER, _BATCH.name]).drop(_BATCH.name)
    orders = _orders(spark, root)
    if base is not None and orders is not None:
        held = orders.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(_ORDER).alias("_held"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        last = last.join(held, same, "left").where(F.col("_held").isNull() | (F.col(_ORDER) >= F.col("_held")))
        last = last.drop("_held", *[f"_k_{k}" for k in keys])
    last = last.drop(_ORDER)
    return last if base is None else upsert(base, last, keys)


def compact(spark: SparkSession, root: str, keys: Sequence[str]) -> int:
    """Publish the current state as a new version; returns its number.

    The applied orders are published first. Should the table not follow, the log's own rows still equal them, and win.
    """
    log = _log(spark, root)
    last = str(log.agg(F.max(_BATCH.name)).first()[0])
    state, applied, orders = read_upserted(spark, root, keys), log.select(*keys, _ORDER), _orders(spark, root)
    if orders is not None:
        done = int(tables.current(spark, f"{root}/orders")[2])
        applied = orders.unionByName(log.filter(F.col(_BATCH.name) > done).select(*keys, _ORDER))
    tables.write_table(applied.groupBy(*keys).agg(F.max(_ORDER).alias(_ORDER)), f"{root}/orders", last)
    return tables.write_table(state, root, last)


def _for_each(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def process_pending(
    work: DataFrame, done_path: str, keys: Sequence[str], step: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Resumable batch: run ``step`` on rows whose key is not in ``done_path``, append its result there.

    Returns all results so far.  Running it again processes nothing twice.
    """
    spark = work.sparkSession
    todo = work
    if tables.path_exists(spark, done_path):
        todo = not_known(work, spark.read.parquet(done_path), keys)
    step(todo).write.mode("append").parquet(done_path)
    return spark.read.parquet(done_path)
