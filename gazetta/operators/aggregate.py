"""Counts, coverage and one-row profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions.values import as_col


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, most common first."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), *keys)


def count_values(df: DataFrame, values: Column, out: str = "value") -> DataFrame:
    """Rows per element of an array column; ``ALL`` stays a bucket of its own."""
    return count_by(df.select(F.explode(values).alias(out)), out)


def sources_per_entity(df: DataFrame, entity: str, source: str, multi: int = 2) -> DataFrame:
    """Distinct sources per entity: count, sorted '|' list, active and multi-source flags.

    The set per entity is bounded by the number of sources, not by the rows.
    """
    sets = df.groupBy(entity).agg(F.array_sort(F.collect_set(source)).alias("_s"))
    n = F.size("_s")
    return sets.select(
        entity,
        n.alias("source_count"),
        F.array_join("_s", "|").alias("sources"),
        (n > 0).alias("is_active"),
        (n >= multi).alias("is_multi_source"),
    )


def profile(
    df: DataFrame,
    counts: Mapping[str, Column] | None = None,
    averages: Mapping[str, Column] | None = None,
    shares: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row of conditional counts, averages and percentages of all rows."""
    aggs = [F.count("*").alias("rows")]
    aggs += [F.count_if(c).alias(n) for n, c in (counts or {}).items()]
    aggs += [F.avg(c).alias(n) for n, c in (averages or {}).items()]
    aggs += [
        (F.lit(100.0) * F.count_if(c) / F.nullif(F.count("*"), F.lit(0))).alias(n)
        for n, c in (shares or {}).items()
    ]
    return df.agg(*aggs)


def observe_profile(df: DataFrame, name: str, counts: Mapping[str, Column]):
    """The same counts riding along a write: returns the frame and its Observation."""
    from pyspark.sql import Observation

    watch = Observation(name)
    aggs = [F.count("*").alias("rows")]
    aggs += [F.count_if(c).alias(n) for n, c in counts.items()]
    return df.observe(watch, *aggs), watch


def worst_of(df: DataFrame, keys: Sequence[str], label: str, ranks: Mapping[str, int]) -> DataFrame:
    """Label with the highest rank per key; unknown labels rank 0."""
    table = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])
    rank = F.coalesce(F.try_element_at(table, F.col(label)), F.lit(0))
    return df.groupBy(*keys).agg(F.max_by(label, F.struct(rank, F.col(label))).alias(label))


def max_suffix(df: DataFrame, keys: Sequence[str], ident: str, out: str = "max_seq") -> DataFrame:
    """Largest number at the end of an identifier per group, 0 if none."""
    number = F.regexp_extract(ident, r"(\d+)$", 1).try_cast("bigint")
    return df.groupBy(*keys).agg(F.coalesce(F.max(number), F.lit(0).cast("bigint")).alias(out))


def any_flag(df: DataFrame, keys: Sequence[str], flag: Column, out: str) -> DataFrame:
    """Is the flag true for any row of the parent?"""
    return df.groupBy(*keys).agg(F.coalesce(F.bool_or(flag), F.lit(False)).alias(out))


def coverage(df: DataFrame, expected: DataFrame, key: str, expected_col: str = "expected") -> DataFrame:
    """Actual against expected row counts per partition value."""
    actual = df.groupBy(key).agg(F.count("*").alias("actual"))
    both = expected.join(actual, key, "left").withColumn(
        "actual", F.coalesce("actual", F.lit(0).cast("bigint"))
    )
    return both.withColumns(
        {
            "missing": F.greatest(F.col(expected_col) - F.col("actual"), F.lit(0)).cast("bigint"),
            "share": F.col("actual") / F.nullif(F.col(expected_col), F.lit(0)),
        }
    )


def outcome_counts(df: DataFrame, outcome: str, labels: Sequence[str]) -> DataFrame:
    """One row with a counter per outcome label."""
    return df.agg(*[F.count_if(as_col(outcome) == x).alias(x.lower()) for x in labels])


def group_members(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Sequence[str]
) -> DataFrame:
    """One row per group: size and the first member's columns.

    Members themselves stay rows of ``df``; a group is never collected.
    """
    head = F.min_by(F.struct(*first), F.struct(*order))
    out = df.groupBy(*keys).agg(F.count("*").alias("n_members"), head.alias("_first"))
    return out.select(*keys, "n_members", *[F.col(f"_first.{c}").alias(f"first_{c}") for c in first])
