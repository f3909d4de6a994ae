"""Joins that link records: by key, by similar name, by containment, by time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil, comb, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.functions.containment import finder_of_runs
from gazetta.functions.similarity import key_ratio
from gazetta.functions.text import token_key
from gazetta.operators.dedupe import carry_forward, not_known
from gazetta.session import pin

# -- keys -------------------------------------------------------------------


def lookup_key(df: DataFrame, table: DataFrame, key: Column, table_key: Column, take: Sequence[str]) -> DataFrame:
    """Left join on a computed key (normalised URL, name ...); ``table`` must be unique on it."""
    right = table.select(table_key.alias("_k"), *take)
    return df.withColumn("_k", key).join(right, "_k", "left").drop("_k")


def overlay(base: DataFrame, top: DataFrame, key: str, order: str, filled) -> DataFrame:
    """Filled values of ``top`` replace those of ``base``; per column the last filled row wins."""
    cols = [c for c in top.columns if c in base.columns and c != key]
    last = top.groupBy(key).agg(
        *[F.max_by(c, F.when(filled(c), F.col(order))).alias(f"_t_{c}") for c in cols]
    )
    joined = base.join(last, key, "left")
    return joined.select(
        *[F.coalesce(f"_t_{c}", c).alias(c) if c in cols else F.col(c) for c in base.columns]
    )


def members(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a partner (FK survivors, cascade delete)."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_semi")


def orphans(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a partner (FK violations, unmatched, not yet processed)."""
    return not_known(df, other, keys)


def key_integrity(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many child rows have no partner (``violations``) and how many have one (``survivors``).

    Both sides are counted by key on the map side and nothing is joined or sorted; a NULL key has no partner.
    """
    own = child.select(*keys, F.lit(1).alias("_n"), F.lit(False).alias("_known"))
    known = parent.select(*keys, F.lit(0).alias("_n"), F.lit(True).alias("_known")).dropna(subset=list(keys))
    each = own.unionByName(known).groupBy(*keys).agg(F.sum("_n").alias("_n"), F.max("_known").alias("_known"))

    def rows(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col("_n"))), F.lit(0))

    return each.agg(rows(~F.col("_known")).alias("violations"), rows(F.col("_known")).alias("survivors"))


def flag_members(df: DataFrame, other: DataFrame, key: Column, other_key: Column, out: str) -> DataFrame:
    """Membership as a flag, compared on computed keys; NULL keys are no members."""
    known = other.select(other_key.alias("_k")).distinct().withColumn("_hit", F.lit(True))
    joined = df.withColumn("_k", key).join(known, "_k", "left")
    return joined.withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_k", "_hit")


def fan_out(members_df: DataFrame, results: DataFrame, keys: Sequence[str], salts: int = 1) -> DataFrame:
    """Every member gets its group's single result row.

    A group may hold most of the members: with ``salts`` the result row is
    repeated per salt and the members of one group spread over as many tasks.
    """
    if salts <= 1:
        return members_df.join(results, list(keys), "inner")
    row = F.xxhash64(*[F.col(c) for c in members_df.columns])
    left = members_df.withColumn("_salt", F.pmod(row, F.lit(salts)).cast("int"))
    right = results.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], "inner").drop("_salt")


def array_owner(
    owners: DataFrame, ids: str, order: str, take: Sequence[str], member: str = "member_id"
) -> DataFrame:
    """Array-valued foreign key to one owner per member: the lowest ``order`` wins.

    ``min_by`` combines on the map side, so a member listed by very many owners is no hot spot.
    """
    pairs = owners.select(F.explode(ids).alias(member), order, *[c for c in take if c != order])
    first = F.min_by(F.struct(order, *[c for c in take if c != order]), F.col(order))
    return pairs.groupBy(member).agg(first.alias("_o")).select(member, "_o.*")


def asof(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    take: Sequence[str],
    block: int | None = None,
) -> DataFrame:
    """For every left row the latest right row of the key strictly before it.

    Both sides are merged in time order (left first on equal times, which makes
    the comparison strict) and the right values carried forward block by block.
    Blocks hold about equally many rows, so a busy key or day is spread over
    tasks; ``block`` (in microseconds) cuts by time instead, which needs no
    sampling but suits even times only.  No row pairs are formed.
    """
    payload = F.struct(F.col(right_time).alias("matched_time"), *take)
    tick = F.unix_micros

    both = left.select(
        *keys,
        F.struct(*left.columns).alias("_l"),
        (tick(F.col(left_time).cast("timestamp")) * 2).alias("_t"),
        F.lit(None).cast(right.select(payload).schema[0].dataType).alias("_r"),
    ).unionByName(
        right.select(
            *keys,
            F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_l"),
            (tick(F.col(right_time).cast("timestamp")) * 2 + 1).alias("_t"),
            payload.alias("_r"),
        )
    )
    done = carry_forward(both, keys, "_t", "_r", "_m", block and block * 2).filter(F.col("_l").isNotNull())
    return done.select("_l.*", "_m.*")


# -- similar names ----------------------------------------------------------

_LOOSE_BELOW = 40
#: Candidate pairs of one signature that a task may get before the signature is split.
_PAIRS = 1 << 20
#: Right keys that are held by every task where all pairs are compared, and pairs that cost no more than one signature.
_HELD, _PER_SIGNATURE = 1 << 12, 2


def _occurrences(key: Column) -> Column:
    """Character occurrences of a key: 'e1', 'e2', 'q1' ..."""

    def of_char(ch: Column) -> Column:
        n = F.length(key) - F.length(F.replace(key, ch, F.lit("")))
        return F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(ch, i.cast("string")))

    return F.flatten(F.transform(F.array_distinct(F.split(key, "")), of_char))


def occurrence_order(left: DataFrame, right: DataFrame) -> tuple[dict[str, int], int]:
    """Place of every character occurrence, the rarest among both sides' keys first, and the number of pairs of keys.

    Keys hold letters, digits and blanks, so the occurrences are as many as the longest key has room for, not as the table has rows.
    """
    sides = left.select(F.col("lkey").alias("k"), F.lit(0).alias("side")).unionByName(right.select(F.col("rkey").alias("k"), F.lit(1).alias("side")))
    tokens = sides.select("side", F.explode(F.concat(F.array(F.lit("")), _occurrences(F.col("k")))).alias("t"))
    counts = tokens.groupBy("t").agg(F.count("*").alias("n"), F.count_if(F.col("side") == 0).alias("l")).collect()
    rows = next(((r["l"], r["n"] - r["l"]) for r in counts if r["t"] == ""), (0, 0))
    places = sorted((r["n"], r["t"]) for r in counts if r["t"] != "")
    return {t: i for i, (_, t) in enumerate(places)}, rows[0] * rows[1]


def _rarest_first(key: Column, order: Mapping[str, int]) -> Column:
    """Character occurrences of a key in one global order, the most telling first. Any fixed order is correct."""
    places = F.create_map(*[F.lit(x) for pair in order.items() for x in pair]) if order else F.lit(None).cast("map<string,int>")
    known = F.transform(_occurrences(key), lambda t: F.struct(F.try_element_at(places, t).alias("p"), t.alias("t")))
    return F.transform(F.array_sort(known), lambda x: x["t"])


def _combinations(tokens: Column, depth: Column, *salt: Column) -> Column:
    """Hashes of all combinations of ``depth`` (1 to 3) tokens."""

    def tail(i: Column) -> Column:
        return F.slice(tokens, i + 2, F.size(tokens))

    one = F.transform(tokens, lambda a: F.xxhash64(*salt, a))
    two = F.flatten(
        F.transform(tokens, lambda a, i: F.transform(tail(i), lambda b: F.xxhash64(*salt, a, b)))
    )
    three = F.flatten(
        F.flatten(
            F.transform(
                tokens,
                lambda a, i: F.transform(
                    tail(i),
                    lambda b, j: F.transform(tail(i + j + 1), lambda c: F.xxhash64(*salt, a, b, c)),
                ),
            )
        )
    )
    return F.when(depth == 1, one).when(depth == 2, two).otherwise(three)


def _common_and_depth(size: Column, other: Column, limit: float) -> tuple[Column, Column]:
    """Common characters that two lengths need for the score, and how many of them make a signature."""
    common = F.ceil(F.lit(limit) * (size + other) / 200 - F.lit(1e-9)).cast("int")
    gap = F.greatest(size, other) - common
    deep = F.when(gap <= 8, 3).when(gap <= 20, 2).otherwise(1)
    return common, F.least(deep, common)


def _signature_rows(df: DataFrame, key: str, score: int, block: Sequence[str], right: bool, order: Mapping[str, int]) -> DataFrame:
    """Hashes that two names scoring at least ``score`` must have in common.

    For two lengths the score needs a common subsequence of at least ``c``
    characters, hence ``c`` shared character occurrences.  With occurrences in
    one global order the first ``len - c + depth`` of both names then share at
    least ``depth`` (prefix filter).  A name emits, for every partner length the
    score allows, the combinations of that size together with both lengths: the
    exact ``c`` keeps the prefixes short and the combinations make them rare.
    Below ``_LOOSE_BELOW`` nearly every length is allowed; there single
    occurrences under the weakest ``c`` are used, without lengths.  The
    occurrences travel along as one text, so that a pair is judged where it meets.
    """
    limit = score - 0.5
    share = limit / (200.0 - limit)
    more = [c for c in df.columns if c not in (*block, key)]
    base = df.select(*block, key, *more, F.length(key).alias("_len"), _rarest_first(F.col(key), order).alias("_tok"))
    if score < _LOOSE_BELOW:
        weakest = F.ceil(F.col("_len") * F.lit(share) - F.lit(1e-9)).cast("int")
        ready = base.withColumn("_pre", F.slice("_tok", F.lit(1), F.col("_len") - weakest + 1))
        hashes = F.transform("_pre", lambda t: F.xxhash64(t))
    else:
        shortest = F.ceil(F.col("_len") * F.lit(share) - F.lit(1e-9)).cast("int")
        longest = F.floor(F.col("_len") / F.lit(share) + F.lit(1e-9)).cast("int")
        per_length = base.withColumn("_other", F.explode(F.sequence(shortest, longest)))
        common, depth = _common_and_depth(F.col("_len"), F.col("_other"), limit)
        ready = (
            per_length.withColumn("_c", common)
            .withColumn("_d", depth)
            .withColumn("_pre", F.slice("_tok", F.lit(1), F.col("_len") - F.col("_c") + F.col("_d")))
        )
        lengths = ("_other", "_len") if right else ("_len", "_other")
        hashes = _combinations(F.col("_pre"), F.col("_d"), *[F.col(c) for c in lengths])
    tokens = F.array_join("_tok", "\t").alias("_rtok" if right else "_ltok")
    return ready.select(*block, key, *more, tokens, F.explode(hashes).alias("h"))


def _split_signatures(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Join of both sides' signatures; one that many names of both sides share is split, by pairs, over several tasks."""
    met = a.groupBy(*on).agg(F.count("*").alias("_l")).join(b.groupBy(*on).agg(F.count("*").alias("_r")), on)
    total, most = met.agg(F.sum(F.col("_l") * F.col("_r")), F.max(F.col("_l") * F.col("_r"))).first()
    parts = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(_PAIRS, -(-(total or 0) // (4 * parts)))
    if (most or 0) <= share:
        return a.join(b, on)
    # at most four signatures per partition are that heavy; both sides are cut into a grid of pieces
    heavy = met.where(F.col("_l") * F.col("_r") > share)
    grid = F.ceil(F.sqrt(F.col("_l") * F.col("_r") / share))
    heavy = F.broadcast(pin(heavy.select(*on, F.least(grid, "_l").cast("int").alias("_nl"), F.least(grid, "_r").cast("int").alias("_nr"))))

    def cut(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        dealt = F.pmod(F.xxhash64(key), F.coalesce(own, F.lit(1))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        return df.join(heavy, on, "left").withColumn(f"_p{own}", dealt).withColumn(f"_p{other}", every).drop("_nl", "_nr")

    pieces = ["_p_nl", "_p_nr"]
    return cut(a, "lkey", "_nl", "_nr").join(cut(b, "rkey", "_nr", "_nl"), [*on, *pieces]).drop(*pieces)


def similar_keys(
    left: DataFrame, right: DataFrame, score: int, block: Sequence[str] = (), order: tuple[Mapping[str, int], int] | None = None
) -> DataFrame:
    """All pairs of distinct keys (``lkey``, ``rkey``) scoring at least ``score``, with the score.

    Exact: the candidate filters never lose a pair.  A pair that shares several
    signatures counts only at the one of its first shared occurrences, and only
    where its shared occurrences are enough for the score, so the kernel sees
    each pair once at most.  Other columns of ``right`` come along. ``order`` is that of
    :func:`occurrence_order`, measured here if not given.
    """
    limit = score - 0.5
    places, names = order or occurrence_order(left, right)
    a = _signature_rows(left, "lkey", score, block, False, places)
    b = _signature_rows(right, "rkey", score, block, True, places)
    la, lb = F.length("lkey"), F.length("rkey")
    near = F.lit(200.0) * F.least(la, lb) >= F.lit(limit) * (la + lb)
    shared = F.array_intersect(F.split("_ltok", "\t"), F.split("_rtok", "\t"))
    # few names cannot share a signature heavily
    met = a.join(b, [*block, "h"]) if names <= _PAIRS else _split_signatures(a, b, [*block, "h"])
    pairs = met.filter(near).withColumn("_s", shared)
    pairs = pairs.filter(F.lit(200.0) * F.size("_s") >= F.lit(limit) * (la + lb))
    s = [F.get("_s", F.lit(i)) for i in range(3)]
    if score < _LOOSE_BELOW:
        first = F.xxhash64(s[0])
    else:
        _, depth = _common_and_depth(la, lb, limit)
        first = F.when(depth == 1, F.xxhash64(la, lb, s[0])).when(depth == 2, F.xxhash64(la, lb, s[0], s[1]))
        first = first.otherwise(F.xxhash64(la, lb, s[0], s[1], s[2]))
    once = pairs.filter(F.col("h") == first)
    more = [c for c in right.columns if c not in (*block, "rkey")]
    scored = once.select(*block, "lkey", "rkey", *more, key_ratio("lkey", "rkey").alias("score"))
    return scored.filter(F.col("score") >= score)


def _lengths(left: DataFrame, right: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Number of keys by length, of both sides."""
    sides = left.select(F.lit(0).alias("side"), F.length("lkey").alias("n")).unionByName(right.select(F.lit(1).alias("side"), F.length("rkey").alias("n")))
    counts = sides.groupBy("side", "n").agg(F.count("*").alias("c")).collect()
    return {r["n"]: r["c"] for r in counts if r["side"] == 0}, {r["n"]: r["c"] for r in counts if r["side"] == 1}


def signature_count(lengths: Mapping[int, int], score: int) -> int:
    """Rows that :func:`similar_keys` forms of one side's keys."""
    limit = score - 0.5
    share = limit / (200.0 - limit)

    def of_pair(size: int, other: int) -> int:
        common = ceil(limit * (size + other) / 200 - 1e-9)
        gap = max(size, other) - common
        depth = min(3 if gap <= 8 else 2 if gap <= 20 else 1, common)
        return comb(max(min(size - common + depth, size), 0), depth)

    def of_length(size: int) -> int:
        shortest = ceil(size * share - 1e-9)
        if score < _LOOSE_BELOW:
            return size - shortest + 1
        return sum(of_pair(size, other) for other in range(shortest, floor(size / share + 1e-9) + 1))

    return sum(n * of_length(size) for size, n in lengths.items())


def every_pair(left: DataFrame, right: DataFrame, score: int, block: Sequence[str], pairs: int) -> DataFrame:
    """The same as :func:`similar_keys` by comparing every pair; for few right keys, which every task holds."""
    la, lb = F.length("lkey"), F.length("rkey")
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = left.repartition(max(1, min(4 * parts, -(-pairs // _PAIRS))), "lkey")
    held = F.broadcast(right)
    met = dealt.join(held, list(block)) if block else dealt.crossJoin(held)
    near = met.filter(F.lit(200.0) * F.least(la, lb) >= F.lit(score - 0.5) * (la + lb))
    more = [c for c in right.columns if c not in (*block, "rkey")]
    scored = near.select(*block, "lkey", "rkey", *more, key_ratio("lkey", "rkey").alias("score"))
    return scored.filter(F.col("score") >= score)


def best_keys(
    left: DataFrame,
    right: DataFrame,
    threshold: int,
    block: Sequence[str] = (),
    stages: Sequence[int] = (),
) -> DataFrame:
    """Best right key per left key at or above ``threshold``; the earliest right row wins ties.

    ``left``: ``lkey`` and block columns, ``right``: ``rkey``, ``first`` (smallest
    row order) and block columns, both distinct.  Equal keys are settled by an
    equi join first.  ``stages`` adds higher thresholds to try before: each one
    settles its keys with a much sharper filter and only the rest moves on.
    Where the filter's signatures alone would cost more than comparing all pairs
    with few right keys, the rest is compared in one go.
    """
    on = list(block)
    if stages:
        left, right = pin(left), pin(right)  # every stage reads the distinct names again
    # near misses of very long keys can round to 100 as well, so those go the long way
    same = left.join(right.withColumn("lkey", F.col("rkey")), [*on, "lkey"], "inner").filter(
        F.length("lkey") < 150
    )
    done = [same.select(*on, "lkey", "rkey", F.lit(100).alias("score"))]
    rest = left.join(same.select(*on, "lkey"), [*on, "lkey"], "left_anti")
    lefts, rights = _lengths(rest, right)
    pairs, order = sum(lefts.values()) * sum(rights.values()), None
    for score in [*stages, threshold]:
        every = sum(rights.values()) <= _HELD and pairs <= _PER_SIGNATURE * sum(signature_count(n, score) for n in (lefts, rights))
        if every:
            score = threshold
            scored = every_pair(rest, right, score, on, pairs)
        else:
            order = order or occurrence_order(left, right)
            scored = similar_keys(rest, right, score, on, order)
        rank = F.struct("score", (-F.col("first")).alias("o"))
        best = (
            scored.groupBy(*on, "lkey")
            .agg(F.max_by(F.struct("rkey", "score"), rank).alias("_b"))
            .select(*on, "lkey", "_b.rkey", "_b.score")
        )
        if score != threshold:
            best = pin(best)
            rest = pin(rest.join(best, [*on, "lkey"], "left_anti"))
        done.append(best)
        if score == threshold or rest.isEmpty():
            break
    return reduce(lambda x, y: x.unionByName(y), done)


def fuzzy_link(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    left_name: str,
    right_id: str,
    right_name: str,
    threshold: int,
    left_order: str | None = None,
    right_order: str | None = None,
    block: Sequence[str] = (),
    one_to_one: bool = False,
    stages: Sequence[int] = (),
    report_from: int | None = None,
) -> DataFrame:
    """Best match by name for every left row: adds ``right_id`` and ``score``.

    ``right_id`` is NULL without a match at the threshold.  With ``one_to_one``
    the first left row (by ``left_order``) keeps a right row, later ones stay
    unmatched.  ``report_from`` also reports failing best scores down to that
    value.  Copies of a name are matched once; the order columns are numeric.
    """
    l_ord, r_ord = left_order or left_id, right_order or right_id
    on = list(block)
    named = left.withColumn("lkey", token_key(left_name))
    keyed = right.select(
        *on, token_key(right_name).alias("rkey"), F.col(r_ord).alias("_o"), F.col(right_id).alias("_id")
    ).filter(F.col("rkey") != "")
    firsts = keyed.groupBy(*on, "rkey").agg(
        F.min("_o").alias("first"), F.min_by("_id", "_o").alias("_rid")
    )
    lkeys = named.filter(F.col("lkey") != "").select(*on, "lkey").distinct()
    floor = threshold if report_from is None else min(report_from, threshold)
    steps = [s for s in stages if s > floor]
    if floor < threshold and threshold not in steps:
        steps.append(threshold)
    best = best_keys(
        lkeys, firsts.drop("_rid"), floor, on, sorted(steps, reverse=True)
    ).join(firsts.drop("first"), [*on, "rkey"], "inner")
    if one_to_one:
        # used twice below: one row per distinct name is kept instead of matching again
        best = pin(best)
    out = named.join(best.select(*on, "lkey", "_rid", "score"), [*on, "lkey"], "left").drop("lkey")
    hit = F.col("score") >= threshold
    if one_to_one:
        claim = out.filter(hit).groupBy("_rid").agg(F.min(l_ord).alias("_winner"))
        out = out.join(claim, "_rid", "left")
        hit = hit & (F.col(l_ord) == F.col("_winner"))
    out = out.withColumn("right_id", F.when(hit, F.col("_rid")))
    return out.select(*left.columns, "right_id", "score")


def multi_source_link(
    sources: Mapping[str, DataFrame],
    master: DataFrame,
    master_id: str,
    master_name: str,
    threshold: int = 70,
    master_order: str | None = None,
    stages: Sequence[int] = (),
) -> DataFrame:
    """Rows of several directories (``row_id``, ``name``) against one master, tagged by ``source``.

    One union, one matching pass; any number of rows may match the same master row.
    """
    tagged = [df.withColumn("source", F.lit(tag)) for tag, df in sources.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return fuzzy_link(
        union, master, "row_id", "name", master_id, master_name, threshold,
        right_order=master_order, stages=stages,
    )


def best_candidate(
    df: DataFrame, entity: str, score: str, order: str, take: Sequence[str], threshold: int
) -> DataFrame:
    """First candidate (in query order) at the threshold, else the best one; one row per entity."""
    ok = F.col(score) >= threshold
    rank = F.struct(
        (~ok).alias("fail"),
        F.when(ok, F.lit(0)).otherwise(-F.col(score)).alias("s"),
        F.col(order).alias("o"),
    )
    picked = df.groupBy(entity).agg(F.min_by(F.struct(score, order, *take), rank).alias("_p"))
    return picked.select(entity, "_p.*", (F.col(f"_p.{score}") >= threshold).alias("is_match"))


def accept_or_partial(
    df: DataFrame, score: str, threshold: int, full: Sequence[str], confidence: Column
) -> DataFrame:
    """Below the threshold the ``full`` columns are cleared and the confidence is LOW."""
    ok = F.coalesce(F.col(score) >= threshold, F.lit(False))
    return df.withColumns(
        {
            **{c: F.when(ok, F.col(c)) for c in full},
            "confidence": F.when(ok, confidence).otherwise(F.lit("LOW")),
        }
    )


# -- containment ------------------------------------------------------------

#: Least bytes of texts that meet a block's patterns at a time, and most bytes of patterns that a task holds.
_PIECE, _SHARD = 1 << 20, 32 << 20


def contained_in(
    patterns: DataFrame, texts: DataFrame, block: Sequence[str], pattern: str, text: str, least: str | None = None
) -> DataFrame:
    """Distinct pairs where the pattern occurs in the text, within a block.

    No candidates are formed: a block's patterns go to every piece of its texts, where one pass over a text finds all
    of them.  There are at most a quarter as many pieces as shuffle partitions, and one more per block, so what is
    shuffled grows with the tables, not with the pairs; only where a block has more than ``_SHARD`` of patterns, its texts go
    to several tasks.  With ``least`` the pairs have that column's least value among the text's rows in place of the text.
    """
    on = list(block)
    same = {f"_k{i}": F.col(c).cast("string") for i, c in enumerate(on)} or {"_k0": F.lit("")}
    keys = list(same)
    pats = patterns.select(*on, pattern).filter(F.length(pattern) > 0).withColumns(same).dropna(subset=keys)
    rows = texts.filter(F.length(text) > 0).withColumns(same).dropna(subset=keys)
    by = rows.groupBy(*keys, text)
    txts = by.agg(F.min(least).alias(least)) if least else by.agg(F.count("*")).select(*keys, text)
    pats = pats.distinct()

    # copies are counted as well: any size is right
    text_bytes = rows.groupBy(*keys).agg(F.sum(F.octet_length(text)).alias("_nt"))
    sizes = pin(text_bytes.join(pats.groupBy(*keys).agg(F.sum(F.octet_length(pattern)).alias("_np")), keys))
    total = sizes.agg(F.sum("_nt")).first()[0] or 0
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece = max(_PIECE, -(-4 * total // parts))
    cut = sizes.select(*keys, F.ceil(F.col("_nt") / piece).cast("int").alias("_nt"), F.ceil(F.col("_np") / _SHARD).cast("int").alias("_np"))
    # so few blocks are that large
    cut = F.broadcast(cut.filter("_nt > 1 OR _np > 1"))

    def pieces(df: DataFrame, col: str, own: str, other: str) -> DataFrame:
        dealt = F.pmod(F.xxhash64(col), F.coalesce(own, F.lit(1))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        return df.join(cut, keys, "left").withColumn(f"_p{own}", dealt).withColumn(f"_p{other}", every).drop("_nt", "_np")

    met = pieces(pats, pattern, "_np", "_nt").unionByName(pieces(txts, text, "_nt", "_np"), allowMissingColumns=True)
    runs = [*keys, "_p_nt", "_p_np"]
    ready = met.repartition(*runs).sortWithinPartitions(*runs, F.col(pattern).isNull())
    schema = T.StructType([*pats.select(*on, pattern).schema, *txts.select(least or text).schema])
    return ready.mapInArrow(finder_of_runs(runs, pattern, text, on, [least or text]), schema)


def containment_pairs(
    left: DataFrame,
    right: DataFrame,
    block: Sequence[str],
    left_text: str,
    right_text: str,
    both_ways: bool = True,
) -> DataFrame:
    """Distinct text pairs with ``left_text`` in ``right_text`` (or the reverse)."""
    pairs = contained_in(left, right, block, left_text, right_text)
    if both_ways:
        back = contained_in(right, left, block, right_text, left_text)
        pairs = pairs.unionByName(back.select(*pairs.columns)).distinct()
    return pairs


def _texts(df: DataFrame, block: Sequence[str], text: str) -> DataFrame:
    """Lower-case text and NULL-safe block columns beside the frame's own."""
    safe = {f"_{b}": F.coalesce(F.col(b), F.lit("")) for b in block}
    return df.withColumns({**safe, "_text": F.lower(text)})


def containment_links(
    owners: DataFrame,
    items: DataFrame,
    block: Sequence[str],
    owner_text: str,
    item_text: str,
    item_id: str,
    both_ways: bool = True,
) -> DataFrame:
    """One row per distinct owner text and item it contains or is contained in.

    Texts are compared in lower case, NULL block values match each other.  The
    columns are the block columns with a leading '_', ``_text`` and ``item_id``.
    """
    on = [f"_{b}" for b in block]
    own = _texts(owners, block, owner_text)
    itm = _texts(items, block, item_text).filter(F.length("_text") > 0)
    itm = itm.select(*on, F.col("_text").alias("_item"), item_id)
    pairs = containment_pairs(own, itm, on, "_text", "_item", both_ways)
    return pairs.join(itm, [*on, "_item"], "inner").select(*on, "_text", item_id).distinct()


def containment_align(
    owners: DataFrame,
    items: DataFrame,
    block: Sequence[str],
    owner_text: str,
    item_text: str,
    item_id: str,
    out: str = "aligned_ids",
    both_ways: bool = True,
) -> DataFrame:
    """Owners with the sorted array of the item ids of :func:`containment_links`.

    The array is one value of the owner table and built once per distinct owner
    text.  Where one owner may align with very many items, use the links.
    """
    on = [f"_{b}" for b in block]
    links = containment_links(owners, items, block, owner_text, item_text, item_id, both_ways)
    ids = links.groupBy(*on, "_text").agg(F.array_sort(F.collect_list(item_id)).alias(out))
    empty = F.array().cast(ids.schema[out].dataType)
    joined = _texts(owners, block, owner_text).join(ids, [*on, "_text"], "left")
    return joined.select(*owners.columns, F.coalesce(out, empty).alias(out))

