"""Names, codes, numbers and contacts found in free text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazetta.functions.values import as_col, let, nullify, strip, to_int

# Region codes and their long names, in matching order.
REGION_CODES = ("NSW", "VIC", "QLD", "WA", "SA", "TAS", "NT", "ACT")
REGION_NAMES = (
    ("New South Wales", "NSW"),
    ("Queensland", "QLD"),
    ("Victoria", "VIC"),
    ("South Australia", "SA"),
    ("Western Australia", "WA"),
    ("Tasmania", "TAS"),
    ("Northern Territory", "NT"),
    ("Australian Capital Territory", "ACT"),
)

# Patterns of contact details.
EMAIL = r"[A-Za-z0-9_.+\-]+@[A-Za-z0-9\-]+\.[A-Za-z0-9.\-]+"
MOBILE = r"04\d{2}[\s.\-]?\d{3}[\s.\-]?\d{3}"
LABELLED_PHONE = r"(?:^|\b)(?:m|p(?:\([Hh]\))?):\s*([0-9+()\s]{6,20})"


# -- names ------------------------------------------------------------------


def squash_name(value: Column | str) -> Column:
    """Lower case with single blanks."""
    return strip(F.regexp_replace(F.lower(F.coalesce(as_col(value), F.lit(""))), r"\s+", " "))


def plain_name(value: Column | str) -> Column:
    """Lower case, everything but letters and digits becomes one blank."""
    return F.btrim(
        F.regexp_replace(F.lower(F.coalesce(as_col(value), F.lit(""))), r"[^a-z0-9]+", " ")
    )


def spaced_name(value: Column | str) -> Column:
    """Lower case, tabs and line breaks removed, blanks kept."""
    return F.btrim(
        F.regexp_replace(F.lower(F.coalesce(as_col(value), F.lit(""))), r"[\t\n\r\f\x0B]", "")
    )


def token_key(value: Column | str) -> Column:
    """Words of the plain name in alphabetical order, joined by blanks."""
    return F.array_join(F.array_sort(F.split(plain_name(value), " ")), " ")


def drop_parenthetical(value: Column | str) -> Column:
    """'Town of X (Regional)' -> 'Town of X', white space collapsed."""
    cut = F.regexp_replace(as_col(value), r"\s*\(.*?\)\s*$", "")
    return strip(F.regexp_replace(cut, r"\s+", " "))


def drop_site_suffix(value: Column | str, site: str) -> Column:
    """'Jane Doe - SITE member page' -> 'Jane Doe'."""
    return strip(F.regexp_replace(strip(value), rf"(?i)\s*[|–\-]\s*{site}.*$", ""))


def slug_id(value: Column | str, prefix: str = "", width: int | None = None) -> Column:
    """Identifier-safe fragment: runs of other characters become one dash; empty -> 'x'."""
    slug = F.btrim(F.regexp_replace(as_col(value), r"[^A-Za-z0-9]+", "-"), F.lit("-"))
    out = F.concat(F.lit(prefix), F.coalesce(F.nullif(slug, F.lit("")), F.lit("x")))
    return F.substring(out, 1, width) if width else out


# -- codes ------------------------------------------------------------------


def code_list(
    value: Column | str, all_code: str = "ALL", all_values: Sequence[str] = REGION_CODES
) -> Column:
    """',' ';' '|' separated codes -> array; a lone ``ALL`` expands, blank -> NULL."""
    parts = F.filter(
        F.transform(F.split(nullify(value, ("", "nan")), r"[,;|]"), lambda x: F.upper(strip(x))),
        lambda x: x != "",
    )
    expanded = F.when(
        (F.size(parts) == 1) & (F.get(parts, F.lit(0)) == all_code),
        F.array(*[F.lit(v) for v in all_values]),
    ).otherwise(parts)
    return F.when(F.size(parts) > 0, expanded)


def code_list_text(value: Column | str, **kwargs) -> Column:
    """:func:`code_list` joined by '|'."""
    return F.array_join(code_list(value, **kwargs), "|")


def region_code(
    value: Column | str,
    codes: Sequence[str] = REGION_CODES,
    names: Sequence[tuple[str, str]] = REGION_NAMES,
    any_case: bool = False,
) -> Column:
    """Short code as a word, else the first long name contained; NULL if neither."""
    text = as_col(value)
    flag = "(?i)" if any_case else ""
    found = F.regexp_extract(text, rf"{flag}\b({'|'.join(codes)})\b", 1)
    code = F.nullif(F.upper(found), F.lit(""))
    low = F.lower(text)
    by_name = F.lit(None).cast("string")
    for name, short in reversed(names):
        by_name = F.when(low.contains(name.lower()), F.lit(short)).otherwise(by_name)
    return F.coalesce(code, by_name)


def postcode(value: Column | str, which: str = "first", country: str = "Australia") -> Column:
    """Four-digit token: the ``first``, or the ``last`` before the country name, which no longer or shorter number may follow."""
    text = as_col(value)
    if which == "first":
        return F.nullif(F.regexp_extract(text, r"\b(\d{4})\b", 1), F.lit(""))
    before = F.substring_index(text, country, 1)
    # a number behind it is the code's place, so the token would be a street number
    number = F.try_element_at(F.regexp_extract_all(before, F.lit(r"\b(\d+)\b"), 1), F.lit(-1))
    return F.when(F.length(number) == 4, number)


def strip_prefix(value: Column | str, prefix: str = "places/") -> Column:
    """'places/X' -> 'X'."""
    text = strip(value)
    return F.when(text.startswith(prefix), F.substring(text, len(prefix) + 1, 2**30)).otherwise(text)


def id_suffix(value: Column | str) -> Column:
    """Digits at the end of an identifier, '' if none."""
    return F.regexp_extract(as_col(value), r"(\d+)$", 1)


def padded_suffix(value: Column | str, width: int = 3) -> Column:
    """Last ``width`` digits of the identifier's suffix, zero padded."""
    return F.lpad(F.right(id_suffix(value), F.lit(width)), width, "0")


# -- numbers ----------------------------------------------------------------


def price(value: Column | str) -> Column:
    """First '$1,234' as a number."""
    raw = F.regexp_extract(as_col(value), r"\$\s*(\d[\d,]*)", 1)
    return F.regexp_replace(raw, ",", "").try_cast("bigint")


def fee_amount(value: Column | str, first: int | None = None) -> Column:
    """Free-text fee to a number: a range gives its midpoint, else the mean of the numbers.

    ``first`` takes that many numbers at most.
    """
    text = as_col(value)
    dense = F.regexp_replace(text, r"[$,\s]", "")
    found = F.regexp_extract_all(dense, F.lit(r"(\d+(?:\.\d+)?)"), 1)
    found = found if first is None else F.slice(found, 1, first)

    def amount(numbers: Column) -> Column:
        used = F.when((F.size(numbers) >= 2) & text.contains("-"), F.slice(numbers, 1, 2)).otherwise(numbers)
        total = F.aggregate(used, F.lit(0.0), lambda a, x: a + x.try_cast("double"))
        return total / F.nullif(F.size(used), F.lit(0))

    return let(found, amount)


def counter(value: Column | str, word: str = "review") -> Column:
    """'37 reviews' -> 37."""
    return F.regexp_extract(as_col(value), rf"(?i)(\d+)\s*{word}s?\b", 1).try_cast("bigint")


# -- contacts ---------------------------------------------------------------


def emails(value: Column | str) -> Column:
    """All e-mail addresses, in order, distinct."""
    found = F.array_distinct(F.regexp_extract_all(as_col(value), F.lit(f"({EMAIL})"), 1))
    # most texts have no '@' at all: the plain search spares them the pattern
    return F.when(as_col(value).contains("@"), found).otherwise(F.array().cast("array<string>"))


def mobiles(value: Column | str, pattern: str = MOBILE) -> Column:
    """All numbers of the given pattern, in order, distinct."""
    return F.array_distinct(F.regexp_extract_all(as_col(value), F.lit(f"({pattern})"), 1))


def labelled_phone(value: Column | str) -> Column:
    """First number behind an ``m:`` or ``p:`` label, white space collapsed."""
    raw = F.regexp_extract(as_col(value), "(?m)" + LABELLED_PHONE, 1)
    return F.nullif(strip(F.regexp_replace(raw, r"\s+", " ")), F.lit(""))


def address_line(value: Column | str, skip_words: Sequence[str] = ("cerem",), lines: int | None = None) -> Column:
    """Postal part of a contact cell: its text lines, each once, joined by blanks.

    Text lines have none of ``skip_words``.  Those that are contact details (an
    ``m:``, ``p:`` or ``p(`` label, or an ``@``) count only where nothing else is
    left, and then without the addresses and a number in front; ``lines`` limits
    how many of them are taken.
    """
    skipped = "|".join(["^$", *(f"(?i){re.escape(w)}" for w in skip_words)])
    text_lines = F.filter(F.transform(F.split(as_col(value), r"\r?\n"), strip), lambda x: ~x.rlike(skipped))
    postal = F.array_distinct(F.filter(text_lines, lambda x: ~x.rlike(r"(?i)^(?:m:|p[:(])|@")))
    stripped = F.transform(
        text_lines, lambda x, i: strip(F.regexp_replace(F.when(i == 0, F.regexp_replace(x, r"(?i)^m:[\d+()\s]+", "")).otherwise(x), EMAIL, ""))
    )
    contact = F.filter(stripped, lambda x: x != "")
    contact = contact if lines is None else F.slice(contact, 1, lines)
    chosen = F.when(F.size(postal) > 0, postal).otherwise(contact)
    return F.nullif(F.array_join(chosen, " "), F.lit(""))


def whole_number(value: Column | str) -> Column:
    """Digits anywhere in the text as a number."""
    return to_int(value, "digits")
