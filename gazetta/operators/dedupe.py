"""First/last row per key, running values, sequences and picks.

Spark rows have no order, so every "first wins" rule takes an explicit order.

Hot groups.  ``row_number() <= k`` is planned with a partial group limit *before*
the shuffle, so a task ships at most ``k`` rows per key however large the group.
Running values and sequences need the whole group in order; they are computed
per block of a group and stitched together with one row per block, so that no
task ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions.values import let
from gazetta.session import pin

BLOCK = 1 << 17


# -- one row per key --------------------------------------------------------


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    k: int,
    rank: str | None = None,
    spread: int = 1024,
) -> DataFrame:
    """First ``k`` rows per key in the given order.

    Up to 999 rows the partial group limit bounds what is shuffled.  Larger
    ``k`` first ranks within ``spread`` sub-groups, which bounds it as well.
    """
    name = rank or "_rank"

    def ranked(frame: DataFrame, by: Sequence[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order)
        return frame.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)

    if k >= 1000:
        part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
        df = ranked(df.withColumn("_part", part), [*keys, "_part"]).drop("_part", name)
    out = ranked(df, keys)
    return out if rank else out.drop(name)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return top_k(df, keys, order, 1)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return top_k(df, keys, [F.col(c).desc() for c in order], 1)


def latest_before(df: DataFrame, keys: Sequence[str], date: str, before: Column) -> DataFrame:
    """Latest row per key strictly before a date."""
    return keep_last(df.filter(F.col(date) < before), keys, [date])


def round_robin(
    df: DataFrame, group: str, order: Sequence[Column | str], n: int, rank: str = "turn"
) -> DataFrame:
    """First of every group, then the second of every group, ... ``n`` rows in total."""
    return top_k(df, [group], order, n, rank=rank).orderBy(rank, group).limit(n)


# -- blocks of a group ------------------------------------------------------


def with_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: int | None, least: int = 1 << 15
) -> DataFrame:
    """Add ``_block``: consecutive pieces of each group in order.

    With ``block`` the (single, whole-number) order column is cut arithmetically:
    right for positions, running ids and times, not for hashed numbers, which
    would give every row a block of its own.  Otherwise only groups of more rows than a block may hold are cut, at splitters
    taken from their own rows.  Any splitters are right as long as they stay the same, so they alone are pinned, and a
    row's block follows from its own values.  All groups together have at most ``8 * shuffle partitions``
    splitters, whatever the size of the table.
    """
    if block:
        (col,) = order
        return df.withColumn("_block", F.floor(F.col(col) / F.lit(block)))
    splitters = _splitters(df, keys, order, least)
    if splitters is None:
        return df.withColumn("_block", F.lit(0).cast("bigint"))
    own = [F.col(k).eqNullSafe(splitters[f"_k{i}"]) for i, k in enumerate(keys)]
    joined = df.join(F.broadcast(splitters), reduce(lambda a, b: a & b, own, F.lit(True)), "left")
    place = let(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]), lambda x: _below(F.col("_at"), x))
    return joined.withColumn("_block", F.coalesce(place, F.lit(0)).cast("bigint")).drop("_at", *[f"_k{i}" for i in range(len(keys))])


def _splitters(df: DataFrame, keys: Sequence[str], order: Sequence[str], least: int, sampled: int = 64) -> DataFrame | None:
    """Per large group (``_k0``, ...) the sorted places ``_at`` where it is cut; None if no group is large."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    by = [f"_k{i}" for i in range(len(keys))]
    counts = df.select(*named, F.lit(1).alias("_one")).groupBy(*by).agg(F.count("*").alias("_n"))
    rows, most = counts.agg(F.sum("_n"), F.max("_n")).first()
    size = max(least, -(-(rows or 0) // (8 * parts)))
    if (most or 0) <= size:
        return None
    large = counts.where(F.col("_n") > size)
    # a sample by the hash of the place: the same rows every time, and copies of a place are taken once
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    step = max(1, size // sampled)
    picked = df.select(*named, place.alias("_p")).where(F.pmod(F.xxhash64("_p"), F.lit(step)) == 0).distinct()
    match = [picked[k].eqNullSafe(large[k]) for k in by]
    picked = picked.join(large, reduce(lambda a, b: a & b, match, F.lit(True)), "left_semi")
    sample = picked.groupBy(*by).agg(F.sort_array(F.collect_list("_p")).alias("_s"))
    every = F.filter("_s", lambda _, i: (i + 1) % sampled == 0)
    return pin(sample.select(*by, every.alias("_at")).where(F.size("_at") > 0))


def _below(sorted_places: Column, place: Column) -> Column:
    """Number of places that are not after the given one, by halving."""

    def step(low: Column, reach: Column) -> Column:
        fits = F.coalesce(F.get(sorted_places, low + reach - 1) <= place, F.lit(False))
        return F.when(fits, low + reach).otherwise(low)

    return F.when(sorted_places.isNotNull(), F.aggregate(F.array(*[F.lit(1 << k) for k in range(23, -1, -1)]), F.lit(0), step))


def _grouped(blocked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_g``, one non-NULL key for group and block.

    Window, aggregate and join all cluster by it, so the rows are shuffled once;
    struct equality also lets NULL group keys match each other.
    """
    return blocked.withColumn("_g", F.struct(*keys, "_block"))


def _over_blocks(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*[F.col("_g")[k] for k in keys]).orderBy(F.col("_g")["_block"])


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Sequence[str],
    prefix: str = "prev_",
    bounded: bool = True,
    block: int | None = None,
) -> DataFrame:
    """Add the previous row's columns within each key.

    ``bounded`` keys, as in snapshot tables with one row per key and period, use
    a plain ``lag``.  Otherwise a key may be of any size and is worked in blocks
    (see :func:`with_blocks`).
    """
    if bounded:
        w = Window.partitionBy(*keys).orderBy(order)
        return df.withColumns({prefix + c: F.lag(c).over(w) for c in columns})
    blocked = _grouped(with_blocks(df, keys, [order], block), keys)
    last = F.max_by(F.struct(*columns), F.col(order)).alias("_last")
    ends = blocked.groupBy("_g").agg(last)
    ends = ends.withColumn("_before", F.lag("_last").over(_over_blocks(keys))).drop("_last")
    inner = Window.partitionBy("_g").orderBy(order)
    lagged = blocked.withColumn("_prev", F.lag(F.struct(*columns)).over(inner))
    joined = lagged.join(ends, "_g")
    prev = F.coalesce(F.col("_prev"), F.col("_before"))
    return joined.withColumns({prefix + c: prev[c] for c in columns}).drop(
        "_prev", "_before", "_block", "_g"
    )


def with_delta(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], suffix: str = "_delta"
) -> DataFrame:
    """Difference to the previous row per key; NULL if either value is NULL."""
    prev = with_previous(df, keys, order, columns)
    return prev.withColumns({c + suffix: F.col(c) - F.col("prev_" + c) for c in columns}).drop(
        *["prev_" + c for c in columns]
    )


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    out: str,
    block: int | None = BLOCK,
) -> DataFrame:
    """Last non-NULL ``value`` up to each row within its group, worked in blocks (see :func:`with_blocks`)."""
    blocked = _grouped(with_blocks(df, keys, [order], block), keys)
    seen = F.when(F.col(value).isNotNull(), F.col(order))
    ends = blocked.groupBy("_g").agg(F.max_by(value, seen).alias("_end"))
    earlier = _over_blocks(keys).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
    inner = (
        Window.partitionBy("_g")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    run = blocked.withColumn("_run", F.last(value, ignorenulls=True).over(inner))
    joined = run.join(ends, "_g")
    return joined.withColumn(out, F.coalesce("_run", "_carry")).drop("_run", "_carry", "_block", "_g")


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, block: int | None = None) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group in order, 0 for the first, worked in blocks (see :func:`with_blocks`)."""
    blocked = _grouped(with_blocks(df, keys, order, block), keys)
    sums = blocked.groupBy("_g").agg(F.sum(value).alias("_sum"))
    earlier = _over_blocks(keys).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_skip", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    inner = Window.partitionBy("_g").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    run = blocked.withColumn("_run", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return run.join(sums, "_g").withColumn(out, F.col("_run") + F.col("_skip")).drop("_run", "_skip", "_block", "_g")


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "seq",
    block: int | None = None,
    offset: Column | int = 0,
) -> DataFrame:
    """1, 2, 3 ... per group (or overall with no keys) in order, plus an offset."""
    blocked = _grouped(with_blocks(df, keys, order, block), keys)
    counts = blocked.groupBy("_g").agg(F.count("*").alias("_n"))
    earlier = _over_blocks(keys).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(
        "_skip", F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("bigint"))
    ).drop("_n")
    inner = Window.partitionBy("_g").orderBy(*order)
    ranked = blocked.withColumn("_rn", F.row_number().over(inner))
    joined = ranked.join(counts, "_g")
    start = F.lit(offset) if isinstance(offset, int) else offset
    return joined.withColumn(
        out, (F.col("_rn") + F.col("_skip") + start).cast("bigint")
    ).drop("_rn", "_skip", "_block", "_g")


def sequence_ids(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    pattern: str,
    out: str = "id",
    block: int | None = None,
    offset: Column | int = 0,
) -> DataFrame:
    """Formatted ids such as ``X-%s-%06d`` (group values first, then the number)."""
    numbered = number_rows(df, keys, order, "_seq", block, offset)
    return numbered.withColumn(
        out, F.format_string(pattern, *[F.col(k) for k in keys], F.col("_seq"))
    ).drop("_seq")


def stable_id(prefix: str, *parts: Column | str) -> Column:
    """Id from the row's own key: adding a row never renumbers the others."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    digest = F.sha2(F.concat_ws("|", *[F.lower(F.coalesce(c, F.lit(""))) for c in cols]), 256)
    return F.concat(F.lit(prefix), digest)


# -- set operations ---------------------------------------------------------


def union_with_defaults(
    first: DataFrame, second: DataFrame, defaults: dict[str, object] | None = None
) -> DataFrame:
    """Union by name; columns missing on one side, and NULLs, take the default."""
    both = first.unionByName(second, allowMissingColumns=True)
    fill = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()}
    return both.withColumns(fill) if fill else both


def key_union(*frames: DataFrame) -> DataFrame:
    """Distinct keys of several stores (one column each, positions matched)."""
    return reduce(lambda a, b: a.union(b), frames).distinct()


def not_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not known yet.

    The known keys are made distinct first: copies combine on the map side, so a
    key with very many copies is no hot spot, and the join reuses the exchange.
    """
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")
