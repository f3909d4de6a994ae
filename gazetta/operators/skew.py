"""Joins whose hot keys are split by measured counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.session import pin


def hot_keys(df: DataFrame, on: Sequence[str], least: int = 1 << 14) -> DataFrame | None:
    """(on, ``_pieces``): keys with more rows than a task's share, and into how many pieces each is to be cut; None without any.

    A share is at least ``least`` rows and a quarter of what a shuffle partition holds on average, so there are at most
    four keys per partition however large the table.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*on).agg(F.count("*").alias("_rows"))
    rows, most = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    share = max(least, -(-(rows or 0) // (4 * parts)))
    if (most or 0) <= share:
        return None
    return pin(counts.where(F.col("_rows") > share).select(*on, F.ceil(F.col("_rows") / share).cast("int").alias("_pieces")))


def split_join(left: DataFrame, right: DataFrame, on: Sequence[str], least: int = 1 << 14) -> DataFrame:
    """Inner equi join; rows of a hot key of ``left`` are dealt to pieces, and the key's rows of ``right`` go to each.

    ``left`` is read twice, so pin it where it is expensive. ``right`` should have few rows per key.
    """
    hot = hot_keys(left, on, least)
    if hot is None:
        return left.join(right, list(on))
    marked = F.broadcast(hot.withColumnsRenamed({c: f"_h_{c}" for c in on}))

    def pieces(df: DataFrame) -> DataFrame:
        match = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_h_{c}") for c in on])
        return df.join(marked, match, "left").drop(*[f"_h_{c}" for c in on])

    dealt = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.coalesce("_pieces", F.lit(1))).cast("int")
    a = pieces(left).withColumn("_piece", dealt).drop("_pieces")
    b = pieces(right).withColumn("_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))).drop("_pieces")
    return a.join(b, [*on, "_piece"]).drop("_piece")
