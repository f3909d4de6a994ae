"""Blank handling, typing, banding and clean-up of single values.

All functions map Columns to Columns and stay inside Spark SQL expressions, so
they fuse into whole-stage code generation.  Casts are the ``try_`` kind:
ANSI mode would otherwise fail the job on the first bad value.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters a text trim removes.
WHITESPACE = " \t\n\r\f\x0b\u00a0\u2028\u3000"

VERIFY_REQUIRED = "VERIFY_REQUIRED"
NOT_FOUND = "NOT_FOUND"

# What each kind of source writes instead of NULL.
BLANKS: dict[str, tuple[str, ...]] = {
    "merge": ("", "verify_required", "nan"),
    "load": ("", "nan"),
    "influencer": ("", "nan", "none", "null"),
    "permit": ("", "null", "none", "n/a", "unknown"),
    "gaps": (
        "",
        "not_available",
        "not applicable",
        "n/a",
        "na",
        "null",
        "none",
        "verify_required",
        "unknown",
        "not_found",
    ),
    "lookup": ("", "null", "none", "n/a", "not found"),
}

_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def as_col(value: Column | str) -> Column:
    """Accept a column or a column name."""
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(as_col(value).cast("string"), F.lit(WHITESPACE))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times.

    Array lambdas are interpreted and evaluate a captured expression anew for
    every element; a bound value they only read.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


# -- blanks -----------------------------------------------------------------


def is_blank(value: Column | str, blanks: Sequence[str] = BLANKS["merge"]) -> Column:
    """True for NULL and for every sentinel in ``blanks`` (any case, trimmed)."""
    return F.coalesce(F.lower(strip(value)).isin(*blanks), F.lit(True))


def nullify(
    value: Column | str, blanks: Sequence[str] = BLANKS["merge"], trimmed: bool = True
) -> Column:
    """Trimmed text, or NULL when blank; ``trimmed=False`` keeps the original."""
    text = strip(value)
    return F.when(~F.lower(text).isin(*blanks), text if trimmed else as_col(value))


def fill_sentinel(
    df: DataFrame, columns: Sequence[str], sentinel: str = VERIFY_REQUIRED
) -> DataFrame:
    """Write-side counterpart of :func:`nullify`."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(sentinel)) for c in columns})


def first_filled(*values: Column | str, zero_is_blank: bool = False) -> Column:
    """First value that is not NULL or empty text; with ``zero_is_blank`` not zero, unless it is the last."""
    if zero_is_blank:
        return F.coalesce(*[F.nullif(as_col(v), F.lit(0)) for v in values[:-1]], as_col(values[-1]))
    return F.coalesce(*[F.nullif(as_col(v), F.lit("")) for v in values])


def count_filled(*values: Column | str) -> Column:
    """How many of the columns hold more than white space."""
    return reduce(
        lambda a, b: a + b,
        [F.when(F.length(strip(v)) > 0, 1).otherwise(0) for v in values],
    )


# -- columns of a frame -----------------------------------------------------


def pick_alias(df: DataFrame, names: Sequence[str]) -> Column:
    """First *existing* column among ``names``, even if its values are blank."""
    for name in names:
        if name in df.columns:
            return F.col(f"`{name}`")
    return F.lit(None).cast("string")


def coalesce_alias(df: DataFrame, names: Sequence[str]) -> Column:
    """Per row, the first non-NULL value among the existing columns."""
    present = [F.col(f"`{n}`") for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def tidy_headers(df: DataFrame, upper: bool = True) -> DataFrame:
    """Trim (and upper-case) column names."""
    return df.toDF(*[c.strip().upper() if upper else c.strip() for c in df.columns])


# -- typing -----------------------------------------------------------------


def to_bool(value: Column | str, mode: str = "tri", default: bool = False) -> Column:
    """``tri``: true/1/yes, false/0/no, else NULL; ``default``: also y/active, else ``default``.

    In ``default`` mode blank text gives ``default`` and any other unknown text gives false.
    """
    text = F.lower(strip(value))
    if mode == "tri":
        return F.when(text.isin("true", "1", "yes", "1.0"), True).when(
            text.isin("false", "0", "no", "0.0"), False
        )
    return F.when(is_blank(value, BLANKS["influencer"]), F.lit(default)).otherwise(
        text.isin("1", "true", "yes", "y", "active")
    )


def to_float(value: Column | str) -> Column:
    """Decimal text to double; anything else (also ``nan``, ``inf``) to NULL."""
    text = strip(value)
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def to_int(value: Column | str, mode: str = "via_float") -> Column:
    """``via_float``: '12.7' -> 12; ``strict``: integers only; ``digits``: '14 days' -> 14, '2-4' -> NULL."""
    text = strip(value)
    if mode == "via_float":
        return to_float(value).try_cast("bigint")
    if mode == "strict":
        return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    if mode == "digits":
        digits = F.regexp_replace(text, r"[^0-9-]", "")
        return F.when(digits.rlike(r"^-?\d+$"), digits.try_cast("bigint"))
    raise ValueError(f"unknown mode {mode!r}")


def round_int(value: Column | str) -> Column:
    """Round half to even, as the scores and distances are defined."""
    return F.bround(as_col(value).cast("double"), 0).cast("bigint")


def postcode_text(value: Column | str) -> Column:
    """'2000.0' -> '2000'; blank -> NULL."""
    return F.nullif(
        F.regexp_replace(nullify(value, BLANKS["load"]), r"\.0$", ""), F.lit("")
    )


def iso_timestamp(value: Column | str) -> Column:
    """ISO text, also with a ``Z`` suffix, to timestamp; unreadable -> NULL."""
    return F.try_to_timestamp(strip(value))


def date_prefix(value: Column | str) -> Column:
    """Date from the first ten characters, NULL when shorter or unreadable."""
    text = strip(value)
    return F.when(
        F.length(text) >= 10, F.to_date(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")))
    )


def date_text(value: Column | str) -> Column:
    """Date or timestamp as ``yyyy-MM-dd`` text."""
    return F.date_format(as_col(value), "yyyy-MM-dd")


def clamp(value: Column | str, low: float, high: float) -> Column:
    """Bound a number; NULL stays NULL (``least``/``greatest`` would skip it)."""
    col = as_col(value)
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(low)), F.lit(high)))


# -- categories -------------------------------------------------------------


def enum_or(value: Column | str, allowed: Sequence[str], default: str | None = None) -> Column:
    """Lower-cased value if allowed, else ``default``."""
    text = F.lower(strip(value))
    return F.when(text.isin(*allowed), text).otherwise(F.lit(default))


def fold_synonyms(
    value: Column | str, groups: Mapping[str, Sequence[str]], default: Column | None = None
) -> Column:
    """Map every spelling listed under a key to that key."""
    text = F.lower(strip(value))
    lookup = F.create_map(
        *[F.lit(x) for key, words in groups.items() for w in words for x in (w.lower(), key)]
    )
    hit = F.try_element_at(lookup, text)
    return hit if default is None else F.coalesce(hit, default)


def classify_text(
    value: Column | str,
    rules: Sequence[tuple[Sequence[str], object]],
    default: object = None,
    whole_words: bool = False,
) -> Column:
    """First rule whose words *all* occur wins; rule order matters.

    With ``whole_words`` 'frequent' no longer matches inside 'infrequent'.
    """
    text = F.lower(as_col(value))

    def occurs(word: str) -> Column:
        return text.rlike(rf"\b{word}\b") if whole_words else text.contains(word)

    out: Column | None = None
    for words, label in rules:
        hit = reduce(lambda a, b: a & b, [occurs(w) for w in words])
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def has_any(value: Column | str, words: Sequence[str]) -> Column:
    """Does the lower-cased text contain any of the words?"""
    text = F.lower(as_col(value))
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def count_hits(value: Column | str, words: Sequence[str]) -> Column:
    """How many different words occur in the lower-cased text."""
    text = F.lower(as_col(value))
    return reduce(lambda a, b: a + b, [text.contains(w).cast("int") for w in words])


def band(value: Column | str, steps: Sequence[tuple[float, str]], default: str | None) -> Column:
    """Label of the first step (descending) the value reaches; NULL gives the default."""
    out: Column | None = None
    for floor, label in steps:
        hit = as_col(value) >= F.lit(floor)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


# Score bands.
MATCH_BANDS = ((85, "HIGH"), (70, "MEDIUM"))
OUTREACH_BANDS = ((8, "p1_this_month"), (6, "p2_this_quarter"))
NAME_RATIO_HIGH = 0.72

# Words a source uses for its own confidence.
CONFIDENCE_WORDS = {
    "high": ("high", "very high", "excellent", "strong"),
    "medium": ("medium", "moderate", "fair", "average"),
}


def match_band(score: Column | str) -> Column:
    return band(score, MATCH_BANDS, "LOW")


def outreach_band(score: Column | str) -> Column:
    return band(score, OUTREACH_BANDS, "p3_backlog")


def name_confidence(ratio: Column | str) -> Column:
    """Two levels only: HIGH from 0.72, MEDIUM below and without a name."""
    return band(ratio, ((NAME_RATIO_HIGH, "HIGH"),), "MEDIUM")


def confidence_band(value: Column | str, numeric: bool = False) -> Column:
    """0-1 or 0-100 numbers, or words, to high/medium/low.

    Numbers above 1 are percentages, so 1.0 is already ``high``.  Numeric
    *text* is a word nobody listed and therefore ``low``.
    """
    if numeric:
        col = as_col(value).cast("double")
        return F.when(
            col > 1, band(col, ((67, "high"), (34, "medium")), "low")
        ).otherwise(band(col, ((0.67, "high"), (0.34, "medium")), "low"))
    return fold_synonyms(value, CONFIDENCE_WORDS, F.lit("low"))


# -- text shapes ------------------------------------------------------------


def ellipsize(value: Column | str, limit: int) -> Column:
    """Trim; longer than ``limit`` ends in '...'; empty -> NULL."""
    text = strip(value)
    cut = F.concat(F.substring(text, 1, limit - 3), F.lit("..."))
    return F.nullif(F.when(F.length(text) > limit, cut).otherwise(text), F.lit(""))


def head_tail(
    value: Column | str, limit: int, marker: str = "\n<!-- TRUNC -->\n", reserve: int = 50
) -> Column:
    """Two thirds from the start, a marker, the rest from the end."""
    text = as_col(value)
    head = limit * 2 // 3
    tail = limit - head - reserve
    return F.when(
        F.length(text) > limit,
        F.concat(F.substring(text, 1, head), F.lit(marker), F.right(text, F.lit(tail))),
    ).otherwise(text)


def query_text(*parts: Column | str, suffix: str | None = None) -> Column:
    """Search text from the filled parts, separated by one blank."""
    cols = [nullify(p, ("",)) for p in parts]
    if suffix:
        cols.append(F.lit(suffix))
    return F.concat_ws(" ", *cols)


def before_slash(value: Column | str) -> Column:
    """'Hunter / Newcastle' -> 'Hunter'."""
    return strip(F.substring_index(as_col(value), "/", 1))


def append_text(old: Column | str, new: Column | str, sep: str = "\n") -> Column:
    """Old text plus a new line of text; NULL or empty parts leave no separator."""
    return F.nullif(F.concat_ws(sep, nullify(old, ("",)), nullify(new, ("",))), F.lit(""))
