"""Crowded regions and keys: nearest places, polygons of very different size, and joins with a hot key."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gazetta.operators import geo, skew


def km(a, b, c, d):
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 12742.0 * math.asin(min(1.0, math.sqrt(h)))


def check_nearest(spark, points, spots, **options):
    df = geo.nearest(
        spark.createDataFrame(points, "pid long, lat double, lng double").repartition(4),
        spark.createDataFrame(spots, "sid long, lat double, lng double").repartition(4),
        ["sid"], "sid", **options,
    )
    got = {r["pid"]: (r["near_sid"], r["near_km"]) for r in df.collect()}
    assert len(got) == len(points)
    for pid, la, lo in points:
        best = min((round(km(la, lo, b, c), 9), s) for s, b, c in spots)
        assert abs(got[pid][1] - best[0]) < 1e-6 and (got[pid][0] == best[1] or abs(km(la, lo, *next(s[1:] for s in spots if s[0] == got[pid][0])) - best[0]) < 1e-9)


def test_all_points_in_one_city_and_places_near_and_far(spark):
    rnd = random.Random(2)
    points = [(i, -33.9 + rnd.random() / 50, 151.2 + rnd.random() / 50) for i in range(700)]
    far = [(i, rnd.uniform(-60, 60), rnd.uniform(-180, 180)) for i in range(200)]
    check_nearest(spark, points, far, least=50)
    check_nearest(spark, points, far + [(1000 + i, -33.9 + rnd.random() / 50, 151.2 + rnd.random() / 50) for i in range(300)], least=50)


def test_a_crowd_of_places_is_opened_into_smaller_cells(spark, monkeypatch):
    rnd = random.Random(4)
    monkeypatch.setattr(geo, "_CROWD", 8)
    spots = [(i, 48.0 + rnd.gauss(0, 0.02), 11.0 + rnd.gauss(0, 0.02)) for i in range(600)] + [(900, -10.0, -70.0)]
    points = [(i, rnd.uniform(44, 52), rnd.uniform(7, 15)) for i in range(150)] + [(500 + i, 48.0 + rnd.gauss(0, 0.02), 11.0) for i in range(100)] + [(990, -80.0, 0.0), (991, 90.0, 10.0)]
    check_nearest(spark, points, spots, least=50)


def test_no_piece_of_a_hot_key_is_large(spark):
    left = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"))
    right = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = {r["k"]: r["_pieces"] for r in skew.hot_keys(left, ["k"], 500).collect()}
    assert set(hot) == {0} and 18_000 / hot[0] <= 20_000 / 16 + 1
    joined = skew.split_join(left, right, ["k"], 500)
    assert joined.count() == 20_000 and joined.where("v <> k * 2").count() == 0 and joined.columns == ["k", "row", "v"]
    assert skew.hot_keys(left, ["k"], 20_000) is None
    assert skew.split_join(left.limit(0), right, ["k"], 1).count() == 0


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


COUNTRY = [(110 + 20 * math.cos(a / 50 * math.tau) + 3 * math.sin(a), -25 + 12 * math.sin(a / 50 * math.tau)) for a in range(50)]
STREET = [(115.0001, -25.0001), (115.0009, -25.0002), (115.0008, -25.0007), (115.0002, -25.0005)]
POLYGONS = {"country": ring(*COUNTRY), "street": ring(*STREET), "line": ring((100, -20), (101, -20)), "point": ring((100, -20)), "none": [], "null": None}


def polygons(spark):
    return spark.createDataFrame(list(POLYGONS.items()), "name string, ring array<struct<x:double,y:double>>")


def contains(points, x, y):
    hit = False
    for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1]):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            hit = not hit
    return hit


@pytest.mark.parametrize("cell", [1.0, 0.3, 7.0])
def test_a_country_and_a_street_in_one_table(spark, cell):
    rnd = random.Random(6)
    points = [(i, rnd.uniform(-40, -10), rnd.uniform(85, 135)) for i in range(1500)] + [(2000 + i, rnd.uniform(-25.001, -25), rnd.uniform(115, 115.001)) for i in range(1500)]
    df = spark.createDataFrame(points, "pid long, lat double, lng double")
    got = {(r["pid"], r["name"]) for r in geo.points_in_polygons(df, polygons(spark), "ring", cell=cell).collect()}
    assert got == {(p, n) for p, la, lo in points for n, r in (("country", COUNTRY), ("street", STREET)) if contains(r, lo, la)}


def test_cells_follow_the_size_of_a_polygon_and_inner_ones_need_no_ray(spark):
    cells = geo.cover_cells(polygons(spark), "ring", splits=2, step=2).collect()
    per = {}
    for c in cells:
        per.setdefault(c["name"], []).append(c)
    assert 20 < len(per["country"]) < 600 and 5 < len(per["street"]) < 600
    assert min(c["_level"] for c in per["street"]) > max(c["_level"] for c in per["country"]) + 6
    inner = [c for c in per["country"] if c["_rays"] is None]
    assert len(inner) > 20
    # a border cell holds few of the sides
    assert max(len(c["_rays"]) for c in per["country"] if c["_rays"] is not None) < 30


def test_no_polygons_and_no_points(spark):
    none = polygons(spark).where("name = 'nobody'")
    points = spark.createDataFrame([(1, -25.0, 110.0), (2, None, 110.0)], "pid long, lat double, lng double")
    assert geo.points_in_polygons(points, none, "ring").count() == 0
    assert geo.points_in_polygons(points, polygons(spark).where("ring IS NULL"), "ring").count() == 0
    assert [r["pid"] for r in geo.points_in_polygons(points, polygons(spark), "ring").collect()] == [1]
