"""Scores, rankings and work queues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions import values as va
from gazetta.functions.values import as_col

# Tiers from best to worst; anything else ranks 50.
TIERS = ("featured", "premium", "standard", "basic", "directory", "")
UNKNOWN_TIER = 50

# Destination scoring.
PLACE_WORDS = (
    "wine",
    "valley",
    "coast",
    "island",
    "hinterland",
    "mountain",
    "historic",
    "peninsula",
    "ranges",
)
METRO_CORES = (
    "sydney",
    "melbourne",
    "brisbane",
    "perth",
    "adelaide",
    "darwin",
    "canberra",
    "hobart",
)
CENTRE_WORDS = ("cbd", "inner-city", "inner_city", "city-centre", "city_centre")
PHRASE_POINTS, WORD_POINTS, FLAG_POINTS, LEVEL_POINTS = 40, 6, 15, -500
CENTRE_POINTS, CORE_POINTS, GREATER_POINTS, CUT_OFF = -200, -120, -2, -400
AWARD_BONUS = 1_000_000.0


def tier_rank(tier: Column | str, tiers: Sequence[str] = TIERS) -> Column:
    """Position in the tier list; NULL counts as ''."""
    pos = F.array_position(F.array(*[F.lit(t) for t in tiers]), F.lower(va.strip(F.coalesce(as_col(tier), F.lit("")))))
    return F.when(pos > 0, pos - 1).otherwise(F.lit(UNKNOWN_TIER)).cast("int")


def tier_order(
    df: DataFrame, tier: str, numbers: Sequence[str], tie: Sequence[str], tiers: Sequence[str] = TIERS
) -> DataFrame:
    """Best tier first, then the numbers descending with NULLs last, then the tie columns."""
    return df.orderBy(
        tier_rank(tier, tiers), *[F.col(n).desc_nulls_last() for n in numbers], *tie
    )


def top_n(df: DataFrame, score: Column | str, tie: Sequence[str], n: int) -> DataFrame:
    """The ``n`` best rows; planned as one top-n pass, not a full sort."""
    return df.orderBy(as_col(score).desc_nulls_last(), *tie).limit(n)


def award_score(award: Column | str, quality: Column | str) -> Column:
    """Quality number, plus a bonus that puts every award winner first."""
    flag = F.lower(va.strip(award))
    won = ~va.is_blank(award) & ~flag.isin("0", "no", "false")
    return F.when(won, F.lit(AWARD_BONUS)).otherwise(F.lit(0.0)) + F.coalesce(
        va.to_float(quality), F.lit(0.0)
    )


def quality_score(
    rating: Column | str, other_rating: Column | str, listings: Column | str, award: Column | str
) -> Column:
    """40/30/20/10 weighting of two ratings, directory listings (three count in full) and an award; 0-100."""
    own, other = as_col(rating).cast("double"), as_col(other_rating).cast("double")
    count = F.least(F.coalesce(as_col(listings).cast("double"), F.lit(0.0)), F.lit(3.0))
    points = (
        F.coalesce(own / 5.0 * 40.0, F.lit(0.0))
        + F.when(other.between(0, 5), other / 5.0 * 30.0).otherwise(0.0)
        + count / 3.0 * 20.0
        + F.when(va.to_bool(award, "default"), 10.0).otherwise(0.0)
    )
    return va.round_int(F.least(points, F.lit(100.0)))


def metro_penalty(slug: Column | str, name: Column | str) -> Column:
    """Points off for the middle of a big city."""
    s, n = F.lower(as_col(slug)), F.lower(as_col(name))
    greater = s.contains("greater") | n.contains("greater")
    centre = va.has_any(s, CENTRE_WORDS)
    total = F.lit(0)
    for core in METRO_CORES:
        named = s.contains(core) | n.contains(core)
        start = (F.substring_index(s, "-", 1) == core) & (F.length(s) < 28)
        points = (
            F.when(greater, GREATER_POINTS)
            .when(centre, CENTRE_POINTS)
            .when(start, CORE_POINTS)
            .when(n == f"{core} cbd", CENTRE_POINTS)
            .otherwise(0)
        )
        total = total + F.when(named, points).otherwise(0)
    return total


def destination_score(
    slug: Column | str,
    name: Column | str,
    level: Column | str,
    flagged: Column | str,
    phrases: Sequence[str],
    words: Sequence[str] = PLACE_WORDS,
) -> Column:
    """Phrases +40 each, words +6 each, flag +15, top-level regions -500, metro penalty."""
    blob = F.concat_ws(" ", F.lower(as_col(slug)), F.lower(as_col(name)))
    rank = F.coalesce(va.to_int(as_col(level).cast("string"), "strict"), F.lit(0))
    return (
        va.count_hits(blob, phrases) * PHRASE_POINTS
        + va.count_hits(blob, words) * WORD_POINTS
        + F.when(as_col(flagged), FLAG_POINTS).otherwise(0)
        + F.when(rank <= 1, LEVEL_POINTS).otherwise(0)
        + metro_penalty(F.coalesce(as_col(slug), F.lit("")), F.coalesce(as_col(name), F.lit("")))
    )


def pick_scored(
    df: DataFrame, score: Column, tie: Sequence[str], n: int = 40, cut_off: int = CUT_OFF
) -> DataFrame:
    """Rows at or above the cut-off, best first, at most ``n``."""
    scored = df.withColumn("score", score).filter(F.col("score") >= cut_off)
    return top_n(scored, "score", tie, n)


def priority_queue(df: DataFrame, first: Column, tie: Sequence[str]) -> DataFrame:
    """Flagged rows first, the rest behind, each in its own order."""
    return df.withColumn("is_priority", F.coalesce(first, F.lit(False))).orderBy(
        F.desc("is_priority"), *tie
    )


def work_list(df: DataFrame, order: Sequence[Column | str], limit: int | None = None) -> DataFrame:
    """Ordered list, optionally only its head."""
    ordered = df.orderBy(*order)
    return ordered.limit(limit) if limit else ordered
