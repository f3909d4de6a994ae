"""Expectations on built tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions.values import as_col


def one_of(value: Column | str, allowed: Sequence[str]) -> Column:
    """Enum rule; NULL passes, as in a CHECK constraint."""
    return F.coalesce(as_col(value).isin(*allowed), F.lit(True))


def in_range(value: Column | str, low: float | None = None, high: float | None = None) -> Column:
    col = as_col(value)
    ok = F.lit(True)
    if low is not None:
        ok = ok & (col >= F.lit(low))
    if high is not None:
        ok = ok & (col <= F.lit(high))
    return F.coalesce(ok, F.lit(True))


def not_null(value: Column | str) -> Column:
    return as_col(value).isNotNull()


def violations(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """One row per broken rule and row; one narrow pass, whatever the number of rules."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    )
    return df.select(*keys, F.explode(broken).alias("rule"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
