"""Keyed writes as DataFrame transformations: the new state of a table from the old one and updates.

Plain Parquet has no MERGE.  Each function returns the new table (or the rows to
append); :mod:`gazetta.sources.tables` writes it as a new version.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions import values as va
from gazetta.operators.dedupe import BLOCK, keep_first, keep_last, not_known, number_rows


def _last_updates(updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One update row per key: the last by ``order``, without order columns the greatest by its own values.

    A keyed write must not turn one row into several, whatever the updates hold.
    """
    if order:
        return keep_last(updates, keys, order).drop(*order)
    return keep_last(updates, keys, [c for c in updates.columns if c not in keys]) if len(updates.columns) > len(keys) else updates.distinct()


def _known_columns(target: DataFrame, updates: DataFrame) -> None:
    surplus = [c for c in updates.columns if c not in target.columns]
    if surplus:
        raise ValueError(f"the target has no columns {', '.join(surplus)}")


def _prefixed(updates: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    cols = [c for c in updates.columns if c not in keys]
    named = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols], F.lit(True).alias("_u"))
    return named, cols


def _merged(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], how: str, rule: Callable[[str], Column]
) -> DataFrame:
    _known_columns(target, updates)
    named, cols = _prefixed(updates, keys)
    joined = target.join(named, list(keys), how)
    return joined.select(
        *[
            F.col(c) if c in keys or c not in cols else rule(c).alias(c)
            for c in target.columns
        ]
    )


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Insert new keys, replace the given columns (also by NULL) of known ones; one row per key."""
    upd = _last_updates(updates, keys, order)
    return _merged(
        target, upd, keys, "full_outer", lambda c: F.when(F.col("_u"), F.col(f"_u_{c}")).otherwise(F.col(c))
    )


def insert_only(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Rows to append: first update row per key that the target does not have yet."""
    return not_known(keep_first(updates, keys, order), target, keys)


def insert_report(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many update rows an insert-only write takes and skips."""
    known = target.select(*keys).distinct().withColumn("_known", F.lit(True))
    per_key = updates.groupBy(*keys).agg(F.count("*").alias("_n")).join(known, list(keys), "left")
    taken = F.col("_known").isNull()
    return per_key.agg(
        F.count_if(taken).alias("inserted"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count_if(taken)).alias("skipped"),
    )


def patch_non_null(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Only non-NULL update values apply; unknown keys are ignored; one row per key."""
    upd = _last_updates(updates, keys, order)
    return _merged(target, upd, keys, "left", lambda c: F.coalesce(f"_u_{c}", c))


def fill_gaps(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    blanks: Sequence[str] = va.BLANKS["gaps"],
    always: Sequence[str] = (),
    stamp: tuple[str, Column] | None = None,
    null_is_gap: bool = True,
    order: Sequence[str] = (),
) -> DataFrame:
    """Updates apply where the target is blank; ``always`` columns take any filled update.

    Without ``null_is_gap`` only the sentinels are gaps, a NULL stays NULL.
    ``stamp`` = (column, value) marks only rows that really changed.  Of several
    updates of a key the last by ``order`` counts.
    """
    last = _last_updates(updates, keys, order)
    _known_columns(target, last)
    named, cols = _prefixed(last, keys)
    joined = target.join(named, list(keys), "left")
    new: dict[str, Column] = {}
    for c in target.columns:
        if c in keys or c not in cols:
            continue
        filled = ~va.is_blank(f"_u_{c}", blanks)
        gap = va.is_blank(c, blanks) if null_is_gap else va.is_blank(c, blanks) & F.col(c).isNotNull()
        new[c] = F.when(filled if c in always else filled & gap, F.col(f"_u_{c}")).otherwise(F.col(c))
    out = {c: new.get(c, F.col(c)) for c in target.columns}
    if stamp:
        name, value = stamp
        changed = reduce(lambda a, b: a | b, [~v.eqNullSafe(F.col(c)) for c, v in new.items()], F.lit(False))
        old = F.col(name) if name in target.columns else F.lit(None).cast("timestamp")
        out[name] = F.when(changed, value).otherwise(old)
    return joined.select(*[v.alias(c) for c, v in out.items()])


def natural_key_upsert(
    target: DataFrame,
    updates: DataFrame,
    ident: str,
    natural: str,
    key_of: Callable[[str], Column],
    order: str,
    pattern: str,
) -> DataFrame:
    """Upsert by a normalised natural key; known rows keep their id, new ones get the next numbers.

    Known rows are patched by non-NULL values.  ``order`` (a whole-number column
    of the updates) decides which copy of a key is taken and the numbering.
    """
    upd = updates.withColumn("_k", key_of(natural)).filter(F.col("_k") != "")
    upd = keep_first(upd, ["_k"], [order])
    tgt = target.withColumn("_k", key_of(natural))
    cols = [c for c in updates.columns if c not in (ident, natural, order)]
    shared = [c for c in cols if c in target.columns]
    patched = patch_non_null(tgt, upd.select("_k", *shared), ["_k"]).drop("_k")
    fresh = upd.join(tgt.select("_k"), "_k", "left_anti")
    highest = F.max(F.regexp_extract(ident, r"(\d+)$", 1).try_cast("bigint"))
    top = target.agg(F.coalesce(highest, F.lit(0))).scalar()
    numbered = number_rows(fresh, [], [order], "_n", block=BLOCK)
    made = numbered.withColumn(
        ident, F.format_string(pattern, (F.col("_n") + top).cast("bigint"))
    ).withColumn(natural, F.col("_k"))
    return patched.unionByName(made.select(*[c for c in target.columns if c in made.columns]), allowMissingColumns=True)


def with_defaults(df: DataFrame, defaults: Mapping[str, Column | object]) -> DataFrame:
    """Column defaults of an insert: missing columns and NULLs take the default."""

    def default(v) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    return df.withColumns(
        {
            c: F.coalesce(F.col(c), default(v)) if c in df.columns else default(v)
            for c, v in defaults.items()
        }
    )


def stamp_changes(
    before: DataFrame, after: DataFrame, keys: Sequence[str], stamp: str, now: Column | None = None
) -> DataFrame:
    """Audit column: new time for rows that differ from before, the old one otherwise."""
    cols = [c for c in after.columns if c not in keys and c != stamp]
    old = before.select(
        *keys, *[F.col(c).alias(f"_o_{c}") for c in [*cols, stamp]], F.lit(True).alias("_o")
    )
    joined = after.join(old, list(keys), "left")
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in cols], F.col("_o").isNotNull()
    )
    return joined.select(
        *keys,
        *cols,
        F.when(same, F.col(f"_o_{stamp}"))
        .otherwise(F.current_timestamp() if now is None else now)
        .alias(stamp),
    )


def change_set(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dry run: ``(keys, action, before, after)`` of every row a write would touch."""
    cols = [c for c in before.columns if c not in keys]
    old = before.select(*keys, F.struct(*cols).alias("before"))
    new = after.select(*keys, F.struct(*cols).alias("after"))
    joined = old.join(new, list(keys), "full_outer")
    action = (
        F.when(F.col("before").isNull(), "insert")
        .when(F.col("after").isNull(), "delete")
        .when(~F.col("before").eqNullSafe(F.col("after")), "update")
    )
    return joined.withColumn("action", action).filter(F.col("action").isNotNull()).select(
        *keys, "action", "before", "after"
    )


def period_key(ts: Column | str, zone: str = "Australia/Sydney", unit: str = "MM") -> Column:
    """First day of the month (or other unit) in a named time zone."""
    local = F.from_utc_timestamp(F.col(ts) if isinstance(ts, str) else ts, zone)
    return F.trunc(local, unit)


def cascade_delete(parents: DataFrame, children: Mapping[str, DataFrame], keys: Sequence[str]) -> dict[str, DataFrame]:
    """Child tables without the rows whose parent is gone."""
    kept = parents.select(*keys).distinct()
    return {n: c.join(kept, list(keys), "left_semi") for n, c in children.items()}
