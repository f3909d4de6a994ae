"""Blank handling, casts, bands and text shapes: one case per convention."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.functions import values as va


def each(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_blank_conventions(spark):
    forms = [None, "", "  ", "VERIFY_REQUIRED", "nan", "NaN", "none", "null", "N/A", "unknown", "NOT_FOUND", " x "]
    assert each(spark, forms, va.nullify) == [None] * 6 + ["none", "null", "N/A", "unknown", "NOT_FOUND", "x"]
    load = each(spark, forms, lambda c: va.nullify(c, va.BLANKS["load"]))
    assert load[3] == "VERIFY_REQUIRED" and load[4] is None
    influencer = each(spark, forms, lambda c: va.nullify(c, va.BLANKS["influencer"]))
    assert influencer[6] is None and influencer[7] is None and influencer[9] == "unknown"
    permit = each(spark, forms, lambda c: va.nullify(c, va.BLANKS["permit"]))
    assert permit[8] is None and permit[9] is None and permit[4] == "nan"
    gaps = each(spark, forms, lambda c: va.is_blank(c, va.BLANKS["gaps"]))
    assert gaps == [True, True, True, True, False, False, True, True, True, True, True, False]


def test_untrimmed_nullify_keeps_text(one):
    assert one(" x ", lambda c: va.nullify(c, va.BLANKS["load"], trimmed=False)) == " x "


def test_strip_covers_line_breaks_and_wide_blanks(one):
    assert one("\t a b \n", va.strip) == "a b"


def test_bools(spark):
    forms = ["true", "1", "YES ", "false", "0", "no", "y", "active", "", None, "False", "maybe"]
    assert each(spark, forms, va.to_bool) == [True, True, True, False, False, False, None, None, None, None, False, None]
    assert each(spark, forms, lambda c: va.to_bool(c, "default", True)) == [
        True, True, True, False, False, False, True, True, True, True, False, False,
    ]


def test_ints(spark):
    forms = ["12.7", "12", "14 days", "2-4", "-3", "", None, "abc", "1e2", "12d", "inf", "nan"]
    assert each(spark, forms, va.to_int) == [12, 12, None, None, -3, None, None, None, 100, None, None, None]
    assert each(spark, forms, lambda c: va.to_int(c, "strict"))[:5] == [None, 12, None, None, -3]
    assert each(spark, forms, lambda c: va.to_int(c, "digits"))[:6] == [127, 12, 14, None, -3, None]


def test_numbers_and_codes(spark, one):
    assert each(spark, ["-33.9", "x", "nan", " 7 "], va.to_float) == [-33.9, None, None, 7.0]
    assert each(spark, ["2000.0", "2000", "nan", ""], va.postcode_text) == ["2000", "2000", None, None]


def test_dates(one):
    assert one("2024-05-06T07:08:09Z", va.iso_timestamp) == dt.datetime(2024, 5, 6, 7, 8, 9)
    assert one("soon", va.iso_timestamp) is None
    assert one("2024-05-06 and more", va.date_prefix) == dt.date(2024, 5, 6)
    assert one("2024-5", va.date_prefix) is None
    assert one(dt.date(2024, 5, 6), va.date_text, T.DateType()) == "2024-05-06"


@pytest.mark.parametrize(
    "value, rounded", [(0.5, 0), (1.5, 2), (2.5, 2), (84.5, 84), (69.5, 70), (59.5, 60), (54.5, 54)]
)
def test_rounding_is_half_even(one, value, rounded):
    assert one(value, va.round_int, T.DoubleType()) == rounded


def test_clamp_keeps_null(spark):
    assert each(spark, [None, -1.0, 0.4, 7.0], lambda c: va.clamp(c, 0.0, 1.0), "double") == [None, 0.0, 0.4, 1.0]


def test_categories(spark):
    assert each(spark, ["HIGH", " low ", "x", None], lambda c: va.enum_or(c, ("high", "low"), "medium")) == [
        "high", "low", "medium", "medium",
    ]
    rules = ((("very", "high"), "A"), (("high",), "B"))
    assert each(spark, ["Very HIGH", "high", "low"], lambda c: va.classify_text(c, rules, "C")) == ["A", "B", "C"]
    plain = (("frequent",), "F"),
    assert each(spark, ["infrequent"], lambda c: va.classify_text(c, plain)) == ["F"]
    assert each(spark, ["infrequent"], lambda c: va.classify_text(c, plain, whole_words=True)) == [None]


def test_confidence(spark):
    number = lambda c: va.confidence_band(c, numeric=True)
    assert each(spark, [1.0, 0.67, 0.5, 0.1, 67.0, 50.0, 2.0], number, "double") == [
        "high", "high", "medium", "low", "high", "medium", "low",
    ]
    words = ["Excellent", "fair", "0.9", "High", None]
    assert each(spark, words, va.confidence_band) == ["high", "medium", "low", "high", "low"]


def test_score_bands(spark):
    assert each(spark, [85, 84, 70, 69, None], va.match_band, "int") == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    assert each(spark, [8, 6, 5, None], va.outreach_band, "int") == [
        "p1_this_month", "p2_this_quarter", "p3_backlog", "p3_backlog",
    ]
    assert each(spark, [0.72, 0.7, 0.1], va.name_confidence, "double") == ["HIGH", "MEDIUM", "MEDIUM"]


def test_text_shapes(one):
    assert one("  " + "x" * 12, lambda c: va.ellipsize(c, 10)) == "xxxxxxx..."
    assert one("x" * 10, lambda c: va.ellipsize(c, 10)) == "x" * 10
    assert one("  ", lambda c: va.ellipsize(c, 10)) is None
    text = "".join(str(i % 10) for i in range(200))
    assert one(text, lambda c: va.head_tail(c, 150, "|", 20)) == text[:100] + "|" + text[-30:]
    assert one(text, lambda c: va.head_tail(c, 200, "|", 20)) == text
    assert one("Hunter / Newcastle", va.before_slash) == "Hunter"
    assert one(" a ", lambda c: va.query_text(c, F.lit(""), F.lit("b"), suffix="Z")) == "a b Z"
    assert one(None, lambda c: va.append_text(c, F.lit("n"))) == "n"


def test_fallbacks(spark):
    df = spark.createDataFrame([("", "b", 0, 0), ("a", "b", 3, 5)], "x string, y string, n int, m int")
    out = df.select(
        va.first_filled("x", "y").alias("t"),
        va.first_filled("n", "m", zero_is_blank=True).alias("z"),
        va.count_filled("x", "y", F.lit(" ")).alias("c"),
    ).collect()
    assert [tuple(r) for r in out] == [("b", 0, 1), ("a", 3, 2)]


def test_column_aliases(spark):
    df = spark.createDataFrame([("", "x", None, 2.0)], "`Name` string, `NAME ` string, lat double, latitude double")
    assert df.select(va.pick_alias(df, ["nothing", "Name"]).alias("n")).first()["n"] == ""
    assert df.select(va.coalesce_alias(df, ["lat", "latitude"]).alias("n")).first()["n"] == 2.0
    assert df.select(va.pick_alias(df, ["nothing"]).alias("n")).first()["n"] is None
    assert va.tidy_headers(spark.createDataFrame([(1,)], "` a b ` int")).columns == ["A B"]


def test_let_evaluates_a_value_for_many_uses(one):
    assert one("a,b", lambda c: va.let(F.split(c, ","), lambda a: F.concat(a, a))) == ["a", "b", "a", "b"]
