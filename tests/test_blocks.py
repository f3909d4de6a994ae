"""Running values over groups of any size: blocks are cut at pinned splitters, the rows themselves are not written."""

import random

import pytest
from pyspark.sql import functions as F

from gazetta.operators import dedupe as dd
from gazetta.operators import link


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(dd.with_blocks, "__defaults__", (200,))


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(8)
    rows = []
    for i in range(6000):
        group = rnd.choices(["hot", "b", "c", None], [70, 10, 5, 15])[0]
        rows.append((i, group, rnd.randrange(4000), rnd.choice([None, f"v{i}"]) if i % 7 else None, rnd.randrange(100)))
    return rows


def frame(spark, data):
    return spark.createDataFrame(data, "id long, g string, t long, v string, n long").repartition(6)


def groups(data):
    out = {}
    for r in sorted(data, key=lambda r: (r[2], r[0])):
        out.setdefault(r[1], []).append(r)
    return out


def test_numbers_run_through_every_group(spark, data, small_blocks):
    got = {r["id"]: r["seq"] for r in dd.number_rows(frame(spark, data), ["g"], ["t", "id"]).collect()}
    assert got == {r[0]: k for own in groups(data).values() for k, r in enumerate(own, 1)}
    whole = {r["id"]: r["seq"] for r in dd.number_rows(frame(spark, data), [], ["t", "id"]).collect()}
    assert whole == {r[0]: k for k, r in enumerate(sorted(data, key=lambda r: (r[2], r[0])), 1)}


def test_totals_before_each_row(spark, data, small_blocks):
    got = {r["id"]: r["before"] for r in dd.running_total(frame(spark, data), ["g"], ["t", "id"], "n", "before").collect()}
    for own in groups(data).values():
        total = 0
        for r in own:
            assert got[r[0]] == total
            total += r[4]


def test_values_carried_and_previous_rows(spark, small_blocks):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["hot", "hot", "hot", None, "x"]), i, f"v{i}" if rnd.random() < 0.1 else None, i % 9) for i in range(4000)]
    df = frame(spark, rows)
    carried = {r["id"]: r["c"] for r in dd.carry_forward(df, ["g"], "t", "v", "c", block=None).collect()}
    before = {r["id"]: r["prev_n"] for r in dd.with_previous(df, ["g"], "t", ["n"], bounded=False).collect()}
    for own in groups(rows).values():
        last = previous = None
        for r in own:
            last = r[3] or last
            assert carried[r[0]] == last and before[r[0]] == previous
            previous = r[4]


def test_asof_over_a_busy_key(spark, small_blocks):
    rnd = random.Random(6)
    left = [(i, "k" if i % 5 else None, rnd.randrange(10_000)) for i in range(1500)]
    right = [(f"r{i}", "k" if i % 4 else None, rnd.randrange(10_000)) for i in range(1500)]
    stamp = F.timestamp_seconds("s").alias("ts")
    a = spark.createDataFrame(left, "id long, k string, s long").select("id", "k", "s", stamp)
    b = spark.createDataFrame(sorted({(k, s): (n, k, s) for n, k, s in right}.values(), key=str), "name string, k string, s long").select("name", "k", stamp)
    got = {r["id"]: r["name"] for r in link.asof(a, b, ["k"], "ts", "ts", ["name"]).collect()}
    unique = {(k, s): n for n, k, s in right}
    for i, k, s in left:
        earlier = [(t, n) for (key, t), n in unique.items() if key == k and t < s]
        assert got[i] == (max(earlier)[1] if earlier else None)


def test_blocks_are_even_and_stay_the_same(spark, data):
    df = dd.with_blocks(frame(spark, data), ["g"], ["t", "id"], None, least=200)
    first, second = ({r["id"]: r["_block"] for r in df.collect()} for _ in range(2))
    assert first == second
    sizes = {}
    for r in data:
        sizes.setdefault((r[1], first[r[0]]), []).append((r[2], r[0]))
    hot = [x for (g, _), x in sizes.items() if g == "hot"]
    assert len(hot) >= 8 and max(map(len, hot)) < 3 * len(data) // 8
    ends = sorted((min(x), max(x)) for x in hot)
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_small_groups_need_no_splitters_and_rows_are_not_written(spark, data, monkeypatch):
    pinned = []
    monkeypatch.setattr(dd, "pin", lambda df: pinned.append(df.columns) or df)
    out = dd.with_blocks(frame(spark, data), ["g"], ["t"], None)
    assert {r["_block"] for r in out.select("_block").distinct().collect()} == {0}
    dd.with_blocks(frame(spark, data), ["g"], ["t"], None, least=100)
    assert pinned == [["_k0", "_at"]]


def test_equal_places_stay_together_and_nulls_come_first(spark):
    rows = [(i, "g", None if i < 500 else 7 if i < 3000 else i, None, 1) for i in range(5000)]
    out = dd.with_blocks(frame(spark, rows), ["g"], ["t"], None, least=100)
    per = {r["t"]: r["n"] for r in out.groupBy("t").agg(F.count_distinct("_block").alias("n")).where("t IS NULL OR t = 7").collect()}
    assert per == {None: 1, 7: 1}
    empty = dd.number_rows(frame(spark, rows).limit(0), ["g"], ["t"])
    assert empty.count() == 0
