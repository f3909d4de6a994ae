"""Dedupe, sequences, running values, aggregates, rankings; crowded groups included."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from gazetta.functions import values as va
from gazetta.operators import aggregate as ag
from gazetta.operators import dedupe as dd
from gazetta.operators import score


def skewed(spark, n=3000):
    """A third of the rows in group 0, NULL as a group of its own."""
    rnd = random.Random(4)
    data = []
    for i in range(n):
        g = 0 if i % 3 == 0 else rnd.choice([1, 2, 3, None])
        data.append((g, i * 2, rnd.choice([None, f"v{i}"])))
    rnd.shuffle(data)
    return spark.createDataFrame(data, "g int, pos long, v string")


def test_keep_first_and_last(spark):
    df = skewed(spark)
    first = {r["g"]: r["pos"] for r in dd.keep_first(df, ["g"], ["pos"]).collect()}
    last = {r["g"]: r["pos"] for r in dd.keep_last(df, ["g"], ["pos"]).collect()}
    want = df.groupBy("g").agg(F.min("pos").alias("a"), F.max("pos").alias("b")).collect()
    assert first == {r["g"]: r["a"] for r in want} and last == {r["g"]: r["b"] for r in want}


def test_group_limit_runs_before_the_shuffle(spark):
    df = skewed(spark)
    plan = dd.keep_first(df, ["g"], ["pos"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_large_k_equals_plain_ranking(spark):
    df = skewed(spark)
    got = dd.top_k(df, ["g"], ["pos"], 1200, rank="r")
    w = Window.partitionBy("g").orderBy("pos")
    want = df.withColumn("r", F.row_number().over(w)).filter("r <= 1200")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_blocks_give_the_same_as_whole_groups(spark):
    df = skewed(spark)
    w = Window.partitionBy("g").orderBy("pos")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    for block in (1, 50, 1 << 17, None):
        assert same(
            dd.carry_forward(df, ["g"], "pos", "v", "c", block), df.withColumn("c", F.last("v", True).over(upto))
        )
        assert same(
            dd.with_previous(df, ["g"], "pos", ["pos", "v"], bounded=False, block=block),
            df.withColumns({"prev_pos": F.lag("pos").over(w), "prev_v": F.lag("v").over(w)}),
        )
        assert same(
            dd.number_rows(df, ["g"], ["pos"], "n", block), df.withColumn("n", F.row_number().over(w).cast("bigint"))
        )


def test_numbering_by_text_order(spark):
    df = skewed(spark).withColumn("name", F.concat(F.lit("n"), "pos"))
    w = Window.partitionBy("g").orderBy("name")
    got = dd.number_rows(df, ["g"], ["name"], "n", offset=5)
    assert same(got, df.withColumn("n", F.row_number().over(w).cast("bigint") + 5))
    ids = dd.sequence_ids(df, [], ["name"], "X-%04d").orderBy("name").limit(2).collect()
    assert [r["id"] for r in ids] == ["X-0001", "X-0002"]


def test_one_shuffle_of_the_rows_per_running_value(spark):
    """Window, aggregate and join share one exchange key; only block ends are exchanged besides."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = skewed(spark)
        plan = dd.carry_forward(df, ["g"], "pos", "v", "c", 50)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(_g") <= 3


def test_delta_is_null_next_to_null(spark, rows):
    data = [("a", "2024-01-01", 4.0, 10), ("a", "2024-03-01", None, 12), ("a", "2024-04-01", 4.5, 15), ("b", "2024-01-01", 3.0, 1)]
    df = spark.createDataFrame(data, "e string, d string, rating double, n int").withColumn("d", F.to_date("d"))
    out = rows(dd.with_delta(df, ["e"], "d", ["rating", "n"]), "e", "d")
    assert [(r["rating_delta"], r["n_delta"]) for r in out] == [(None, None), (None, 2), (None, 3), (None, None)]


def test_latest_before_is_strict(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-02-01", 2), ("b", "2024-02-01", 3)], "e string, d string, n int")
    df = df.withColumn("d", F.to_date("d"))
    out = dd.latest_before(df, ["e"], "d", F.lit("2024-02-01").cast("date")).collect()
    assert [(r["e"], r["n"]) for r in out] == [("a", 1)]
    by_max = df.filter("d < '2024-02-01'").groupBy("e").agg(F.max_by("n", "d").alias("n")).collect()
    assert [(r["e"], r["n"]) for r in by_max] == [("a", 1)]


def test_round_robin(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 9)], "g string, o int")
    got = [(r["g"], r["o"]) for r in dd.round_robin(df, "g", ["o"], 3).collect()]
    assert got == [("a", 1), ("b", 9), ("a", 2)]


def test_stable_id_does_not_move(spark):
    a = spark.createDataFrame([("NSW", "B")], "s string, n string").select(dd.stable_id("C-", "s", "n").alias("i"))
    b = spark.createDataFrame([("NSW", "A"), ("NSW", "B")], "s string, n string")
    assert a.first()["i"] in {r["i"] for r in b.select(dd.stable_id("C-", "s", "n").alias("i")).collect()}


def test_set_operations(spark):
    a = spark.createDataFrame([(1, "x")], "id int, c string")
    b = spark.createDataFrame([(2,)], "id int")
    both = dd.union_with_defaults(a, b, {"c": "d"}).orderBy("id").collect()
    assert [tuple(r) for r in both] == [(1, "x"), (2, "d")]
    assert dd.key_union(a.select("id"), b, b).count() == 2
    assert dd.not_known(a.select("id").union(b), b, ["id"]).collect()[0]["id"] == 1


def test_aggregates(spark, rows):
    df = spark.createDataFrame(
        [("e1", "EW", "a|b"), ("e1", "EW", "ALL"), ("e1", "TWS", "a"), ("e2", "WL", "")], "e string, s string, codes string"
    )
    out = rows(ag.sources_per_entity(df, "e", "s"), "e")
    assert [(r["source_count"], r["sources"], r["is_multi_source"]) for r in out] == [(2, "EW|TWS", True), (1, "WL", False)]
    counts = {r["value"]: r["n"] for r in ag.count_values(df, F.split("codes", r"\|")).collect()}
    assert counts == {"a": 2, "b": 1, "ALL": 1, "": 1}
    top = ag.count_by(df, "e").collect()
    assert [(r["e"], r["n"]) for r in top] == [("e1", 3), ("e2", 1)]
    prof = ag.profile(df, {"ew": F.col("s") == "EW"}, shares={"pct": F.col("s") == "EW"}).first()
    assert (prof["rows"], prof["ew"], prof["pct"]) == (4, 2, 50.0)
    watched, obs = ag.observe_profile(df, "p", {"ew": F.col("s") == "EW"})
    watched.collect()
    assert obs.get == {"rows": 4, "ew": 2}
    assert ag.outcome_counts(df, "s", ["EW", "WL", "NONE"]).first().asDict() == {"ew": 2, "wl": 1, "none": 0}
    seq = spark.createDataFrame([("a", "X-007"), ("a", "X-12"), ("b", "none")], "g string, i string")
    assert {r["g"]: r["max_seq"] for r in ag.max_suffix(seq, ["g"], "i").collect()} == {"a": 12, "b": 0}
    sev = spark.createDataFrame([("a", "Rarely"), ("a", "Frequently"), ("b", "Unknown")], "g string, c string")
    worst = ag.worst_of(sev, ["g"], "c", {"Frequently": 4, "Rarely": 2, "Unknown": 1})
    assert {r["g"]: r["c"] for r in worst.collect()} == {"a": "Frequently", "b": "Unknown"}
    cov = ag.coverage(df.withColumnRenamed("e", "k"), spark.createDataFrame([("e1", 5), ("e3", 2)], "k string, expected long"), "k")
    assert {r["k"]: (r["actual"], r["missing"]) for r in cov.collect()} == {"e1": (3, 2), "e3": (0, 2)}


def test_scores(spark):
    df = spark.createDataFrame(
        [(5.0, 5.0, 3, "yes"), (None, 6.0, 1, "no"), (4.0, None, None, None), (2.5, 1.25, 7, "VERIFY_REQUIRED")],
        "r double, o double, n int, a string",
    )
    got = [x["q"] for x in df.select(score.quality_score("r", "o", "n", "a").alias("q")).collect()]
    assert got == [100, 7, 32, 48]  # 20 + 7.5 + 20 = 47.5 rounds to the even 48
    tiers = spark.createDataFrame([("Premium", 1, 9), (None, 5, 8), ("other", 9, 7), ("premium ", None, 6)], "t string, n int, i int")
    order = [r["i"] for r in score.tier_order(tiers, "t", ["n"], ["i"]).collect()]
    assert order == [9, 6, 8, 7]
    award = spark.createDataFrame([("2025", "10"), ("no", "90"), ("VERIFY_REQUIRED", "x")], "a string, q string")
    assert [r["s"] for r in award.select(score.award_score("a", "q").alias("s")).collect()] == [1_000_010.0, 90.0, 0.0]


def test_destination_score(spark):
    data = [
        ("hunter-valley", "Hunter Valley", "2", True),
        ("sydney-cbd", "Sydney CBD", "2", False),
        ("greater-sydney", "Greater Sydney", "2", False),
        ("nsw", "New South Wales", "1", False),
        ("sydney-east", "Sydney East", "x", False),
    ]
    df = spark.createDataFrame(data, "s string, n string, h string, f boolean")
    points = score.destination_score("s", "n", "h", "f", ("hunter valley", "hunter"))
    got = [r["p"] for r in df.select(points.alias("p")).collect()]
    # the slug spells it with a dash, the name with a blank: each phrase counts once
    assert got == [40 + 40 + 6 + 15, -200, -2, -500, -500 - 120]
    picked = score.pick_scored(df, points, ["s"], 10).collect()
    assert [r["s"] for r in picked] == ["hunter-valley", "greater-sydney", "sydney-cbd"]


def test_counts_use_half_even(one):
    from pyspark.sql import types as T

    assert one(2.5, va.round_int, T.DoubleType()) == 2
