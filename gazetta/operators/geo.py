"""Coordinates, distances, nearest neighbours and polygons."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gazetta.functions import values as va
from gazetta.functions.values import as_col
from gazetta.operators.aggregate import worst_of
from gazetta.operators.dedupe import with_blocks
from gazetta.operators.skew import split_join
from gazetta.session import pin

EARTH_KM = 6371.0
# Accepted bounding box (south, north, west, east).
REGION_BOX = (-45.0, -9.0, 110.0, 155.0)
# Severity ranks and the wording that implies each category, in matching order.
SEVERITY = {
    "Highly Frequently": 5,
    "Frequently": 4,
    "Occasionally": 3,
    "Rarely": 2,
    "Unknown": 1,
    "CHECK_MANUALLY": 0,
}
SEVERITY_RULES = (
    (("check", "manual"), "CHECK_MANUALLY"),
    (("highly", "frequent"), "Highly Frequently"),
    (("high", "frequent"), "Highly Frequently"),
    (("very high",), "Highly Frequently"),
    (("extreme",), "Highly Frequently"),
    (("catastrophic",), "Highly Frequently"),
    (("frequent",), "Frequently"),
    (("likely inundation",), "Frequently"),
    (("occasional",), "Occasionally"),
    (("moderate",), "Occasionally"),
    (("rare",), "Rarely"),
    (("low likelihood",), "Rarely"),
    (("minor",), "Rarely"),
)


def valid_point(
    lat: Column | str, lng: Column | str, box: Sequence[float] = REGION_BOX
) -> Column:
    """Struct of both coordinates rounded to six places; NULL if unreadable, (0, 0) or outside the box."""
    la, lo = va.to_float(as_col(lat)), va.to_float(as_col(lng))
    south, north, west, east = box
    zero = (F.abs(la) < 0.0001) & (F.abs(lo) < 0.0001)
    good = la.between(south, north) & lo.between(west, east) & ~zero
    return F.when(good, F.struct(F.bround(la, 6).alias("lat"), F.bround(lo, 6).alias("lng")))


def haversine_km(lat1: Column | str, lng1: Column | str, lat2: Column | str, lng2: Column | str) -> Column:
    a1, o1, a2, o2 = (as_col(c) for c in (lat1, lng1, lat2, lng2))
    dlat, dlng = F.radians(a2 - a1) / 2, F.radians(o2 - o1) / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(a1)) * F.cos(F.radians(a2)) * F.pow(F.sin(dlng), 2)
    # least() skips NULL: an unknown coordinate must not become the farthest point
    return F.when(h.isNotNull(), F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(h))))


def drive_minutes(km: Column | str, speed: float = 75.0) -> Column:
    """Minutes at the given speed, at least 5, 0 for no distance."""
    col = as_col(km)
    return F.when(col <= 0, F.lit(0).cast("bigint")).when(
        col > 0, F.greatest(F.lit(5).cast("bigint"), va.round_int(col / speed * 60))
    )


# -- nearest neighbour ------------------------------------------------------


def nearest(
    points: DataFrame,
    places: DataFrame,
    place_cols: Sequence[str],
    order: str,
    lat: str = "lat",
    lng: str = "lng",
    least: int = 1 << 14,
) -> DataFrame:
    """Adds ``near_<col>`` of the closest place and ``near_km``; ties go to the lowest ``order``.

    A point's neighbours along a space-filling curve give a ball that holds its nearest place. The ball is looked up in cells
    of about its own size, so a crowded region starts with small cells and a sparse one with large ones; only where a
    cell holds many places is it opened into smaller ones. Joins on cells with more points than ``least`` and than a
    task's share are split. Points without coordinates get NULL, places without are no candidates, and
    without places everything is NULL.
    """
    cols = [c for c in place_cols if c != order]
    usable = places.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull())
    best = _nearest_places(points, usable, cols, order, lat, lng, least)
    found = points.join(best, [lat, lng], "left")
    return found.select(*points.columns, *[F.col("_best")[n].alias(f"near_{n}") for n in (order, *cols)], F.col("_best")["km"].alias("near_km"))


#: Cells halve each axis per level; levels in use are even. A cell with more places is opened, down to the last level.
_LAST_LEVEL, _STEP, _CROWD = 14, 2, 1024
_LEVELS = range(0, _LAST_LEVEL + 1, _STEP)


def _xyz(lat: str, lng: str) -> list[Column]:
    la, lo = F.radians(F.col(lat).cast("double")), F.radians(F.col(lng).cast("double"))
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def _index(value: Column, n: Column | int) -> Column:
    """Cell number of a coordinate from -1 to 1 on an axis of ``n`` cells."""
    count = F.lit(n) if isinstance(n, int) else n
    return F.greatest(F.least(F.floor((value + 1) / 2 * count), count - 1), F.lit(0)).cast("bigint")


def _cells_of(level: Column) -> Column:
    """Cells of a level on each axis."""
    return F.pow(F.lit(2.0), level).cast("bigint")


def _cell(level: int, xyz: Sequence[Column]) -> Column:
    """Cell of a unit vector as one number."""
    n = 1 << level
    x, y, z = (_index(v, n) for v in xyz)
    return (x * n + y) * n + z


def _curve_place(xyz: Sequence[Column], level: int = 16) -> Column:
    """Place on a space-filling curve: the bits of the three cell numbers in turn (binary digits read as octal ones)."""
    spread = [F.conv(F.bin(_index(v, 1 << level)), 8, 10).cast("bigint") for v in xyz]
    return spread[0] * 4 + spread[1] * 2 + spread[2]


def _squared(place: Column, names: Sequence[str] = ("_x", "_y", "_z")) -> Column:
    parts = [place[f"p{n}"] - F.col(n) for n in names]
    return parts[0] * parts[0] + parts[1] * parts[1] + parts[2] * parts[2]


def _curve_bounds(here: DataFrame, spots: DataFrame, lat: str, lng: str) -> DataFrame:
    """Adds ``_limit``: squared chord to the nearer of the places before and after a point on the curve."""
    axes = ["_x", "_y", "_z"]
    asked = here.withColumns({"_m": _curve_place([F.col(c) for c in axes]), "_p": F.lit(None).cast("struct<p_x:double,p_y:double,p_z:double>")})
    spot = F.struct(*[F.col(c).alias(f"p{c}") for c in axes])
    held = spots.select(*axes, spot.alias("_p")).select(
        F.lit(None).cast("double").alias(lat), F.lit(None).cast("double").alias(lng), *axes, _curve_place([F.col(c) for c in axes]).alias("_m"), "_p"
    )
    both = asked.select(F.col(lat).cast("double").alias("_la"), F.col(lng).cast("double").alias("_ln"), lat, lng, *axes, "_m", "_p")
    both = both.unionByName(held.withColumns({"_la": F.lit(None).cast("double"), "_ln": F.lit(None).cast("double")}))
    blocked = with_blocks(both, [], ["_m"], None)
    at = F.when(F.col("_p").isNotNull(), F.col("_m"))
    ends = blocked.groupBy("_block").agg(F.min_by("_p", at).alias("_first"), F.max_by("_p", at).alias("_last"))

    # looking ahead is looking back in falling order: a frame that ends with the group would be read anew for every row
    def latest(value: str, window: WindowSpec, end: int) -> Column:
        return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, end))

    every, inner = Window.partitionBy(), Window.partitionBy("_block")
    ends = ends.select(
        "_block",
        latest("_last", every.orderBy("_block"), -1).alias("_earlier"),
        latest("_first", every.orderBy(F.desc("_block")), -1).alias("_later"),
    )
    near = blocked.withColumns(
        {"_before": latest("_p", inner.orderBy("_m"), 0), "_after": latest("_p", inner.orderBy(F.desc("_m")), 0)}
    )
    near = near.where("_p IS NULL").join(ends, "_block")
    limit = F.least(*[_squared(F.col(c)) for c in ("_before", "_after", "_earlier", "_later")])
    # the slack keeps places that are equally far
    return near.select(lat, lng, *axes, (limit * (1 + 1e-9) + 1e-14).alias("_limit")).where("_limit IS NOT NULL")


def _with_bounds(df: DataFrame) -> DataFrame:
    """Squared distance from a point to the nearest and farthest corner of its cell ``_c`` of ``_level``."""
    n = _cells_of(F.col("_level"))
    size = F.lit(2.0) / n
    idx = [F.floor(F.col("_c") / (n * n)), F.pmod(F.floor(F.col("_c") / n), n), F.pmod(F.col("_c"), n)]
    near, far = F.lit(0.0), F.lit(0.0)
    for axis, i in zip(("_x", "_y", "_z"), idx):
        here, low = F.col(axis), i * size - 1.0
        gap = F.greatest(low - here, here - (low + size), F.lit(0.0))
        reach = F.greatest(F.abs(here - low), F.abs(here - (low + size)))
        near, far = near + gap * gap, far + reach * reach
    return df.withColumns({"_near": near, "_far": far})


def _ball_cells(bounded: DataFrame) -> DataFrame:
    """One row per cell that the ball of a point meets, in cells no smaller than the ball."""
    reach = F.sqrt("_limit")
    fitting = F.floor(-F.log2(reach) / _STEP) * _STEP
    out = bounded.withColumn("_level", F.greatest(F.least(fitting, F.lit(_LAST_LEVEL)), F.lit(0)).cast("int"))
    out = out.withColumn("_n", _cells_of(F.col("_level")))
    for axis in ("_x", "_y", "_z"):
        span = F.sequence(_index(F.col(axis) - reach, F.col("_n")), _index(F.col(axis) + reach, F.col("_n")))
        out = out.withColumn(f"_i{axis}", F.explode(span))
    size, gaps = F.lit(2.0) / F.col("_n"), []
    for axis in ("_x", "_y", "_z"):
        low = F.col(f"_i{axis}") * size - 1.0
        gaps.append(F.greatest(low - F.col(axis), F.col(axis) - low - size, F.lit(0.0)))
    out = out.where(gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2] <= F.col("_limit"))
    cell = (F.col("_i_x") * F.col("_n") + F.col("_i_y")) * F.col("_n") + F.col("_i_z")
    return out.withColumn("_c", cell).drop("_n", "_i_x", "_i_y", "_i_z")


def _nearest_places(points, places, cols, order, lat, lng, least) -> DataFrame:
    """(lat, lng, _best) of every point that has coordinates; nothing without places."""
    spots = places.groupBy(lat, lng).agg(F.min_by(F.struct(order, *cols), order).alias("_place"))
    spots = spots.withColumnsRenamed({lat: "_plat", lng: "_plng"})
    spots = spots.withColumns(dict(zip(("_x", "_y", "_z"), _xyz("_plat", "_plng"))))
    xyz = [F.col(c) for c in ("_x", "_y", "_z")]
    here = points.select(lat, lng).filter(F.col(lat).isNotNull() & F.col(lng).isNotNull()).distinct()
    here = here.withColumns(dict(zip(("_x", "_y", "_z"), _xyz(lat, lng))))
    listed = spots.withColumn("_n", F.explode(F.array(*[F.struct(F.lit(v).alias("_level"), _cell(v, xyz).alias("_c")) for v in _LEVELS])))
    on = ["_level", "_c"]
    nodes = listed.groupBy("_n").agg(F.count("*").alias("_held")).select("_n.*", "_held")
    inside = listed.select("_n.*", "_plat", "_plng", "_place")

    small = (F.col("_held") <= _CROWD) | (F.col("_level") >= _LAST_LEVEL)
    asked = pin(_ball_cells(_curve_bounds(here, spots, lat, lng)).join(nodes, on))
    leaves = []
    while True:
        leaves.append(asked.where(small).select(lat, lng, *on))
        crowded = asked.where(~small).drop("_held")
        if crowded.isEmpty():
            break
        below = F.array(*[F.struct(F.struct(F.lit(v).alias("_level"), _cell(v, xyz).alias("_c")).alias("_up"), _cell(v + _STEP, xyz).alias("_child")) for v in _LEVELS[:-1]])
        children = spots.select(F.explode(below).alias("_e")).select("_e.*").distinct().select("_up.*", "_child")
        opened = split_join(crowded, children, on, least)
        opened = _with_bounds(opened.withColumn("_level", F.col("_level") + _STEP).drop("_c").withColumnRenamed("_child", "_c"))
        # a point knows its nearest place to be no farther than the farthest corner of an occupied cell
        closest = F.min("_far").over(Window.partitionBy(lat, lng)) * (1 + 1e-9) + 1e-14
        opened = opened.withColumn("_limit", F.least("_limit", closest)).where("_near <= _limit").drop("_near", "_far")
        asked = pin(opened.join(nodes, on))
    cells = reduce(lambda a, b: a.unionByName(b), leaves)
    scored = split_join(cells, inside, on, least).withColumn("_km", haversine_km(lat, lng, "_plat", "_plng"))
    found = F.struct(F.col("_km").alias("km"), *[F.col(f"_place.{n}").alias(n) for n in (order, *cols)])
    return scored.groupBy(lat, lng).agg(F.min(found).alias("_best"))


# -- polygons ---------------------------------------------------------------


_EDGE = "struct<ax:double,ay:double,bx:double,by:double>"


def _edges(ring: Column) -> Column:
    """Sides of a ring, the last back to its first point."""
    nxt = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, F.lit(1), F.lit(1)))
    return F.zip_with(ring, nxt, lambda a, b: F.struct(a["x"].cast("double").alias("ax"), a["y"].cast("double").alias("ay"), b["x"].cast("double").alias("bx"), b["y"].cast("double").alias("by")))


def _ray_hits(edges: Column, x: Column, y: Column) -> Column:
    """Whether a ray to the right crosses an odd number of sides."""

    def crosses(e: Column) -> Column:
        spans = (e["ay"] > y) != (e["by"] > y)
        return spans & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0)) + e["ax"])

    return F.size(F.filter(edges, lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1


def _meets_box(e: Column, box: Sequence[Column]) -> Column:
    """Whether a side meets a box: their extents overlap and the corners are not all on one side of its line."""
    x0, y0, x1, y1 = box
    dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
    sides = [dx * (y - e["ay"]) - dy * (x - e["ax"]) for x in (x0, x1) for y in (y0, y1)]
    overlap = (F.greatest(e["ax"], e["bx"]) >= x0) & (F.least(e["ax"], e["bx"]) <= x1) & (F.greatest(e["ay"], e["by"]) >= y0) & (F.least(e["ay"], e["by"]) <= y1)
    return overlap & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def _own_level(ring: str, cell: float, step: int) -> Column:
    """Level whose cells are about as wide as the ring, a multiple of ``step``; NULL without points."""
    xs, ys = F.transform(ring, lambda p: p["x"].cast("double")), F.transform(ring, lambda p: p["y"].cast("double"))
    extent = F.greatest(F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys), F.lit(cell * 2.0**-40))
    return (F.floor(-F.log2(extent / cell) / step) * step).cast("int")


def cover_cells(polygons: DataFrame, ring: str, cell: float = 1.0, splits: int = 1, step: int = 3) -> DataFrame:
    """The polygons with the grid cells that cover them: ``_level``, ``_cx``, ``_cy`` and ``_rays``.

    A cell of level k is ``cell / 2**k`` wide. A polygon starts with the cells of the level that is about as wide as itself, so a country
    and a street take equally few. Cells that a side meets are split ``splits`` times, by ``step`` levels each. Cells within the polygon stay as
    they are and have NULL ``_rays``; those at the border carry the sides that a ray from inside the cell can cross.
    """

    def width(level: Column) -> Column:
        return F.lit(float(cell)) / F.pow(F.lit(2.0), level)

    out = polygons.withColumns({"_level": _own_level(ring, cell, step), "_rays": _edges(F.col(ring))}).where("_level IS NOT NULL")
    for axis in "xy":
        own = F.transform(ring, lambda p: F.floor(p[axis].cast("double") / width(F.col("_level"))))
        out = out.withColumn(f"_c{axis}", F.explode(F.sequence(F.array_min(own), F.array_max(own))))
    out = _classified(out, width)
    n = 1 << step
    for _ in range(splits):
        out = out.withColumn("_part", F.explode(F.when(F.col("_rays").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.lit(n * n - 1)))))
        whole = F.col("_part") < 0
        out = out.select(
            *polygons.columns,
            "_rays",
            F.when(whole, F.col("_level")).otherwise(F.col("_level") + step).alias("_level"),
            F.when(whole, F.col("_cx")).otherwise(F.col("_cx") * n + F.floor(F.col("_part") / n)).alias("_cx"),
            F.when(whole, F.col("_cy")).otherwise(F.col("_cy") * n + F.pmod(F.col("_part"), F.lit(n))).alias("_cy"),
        )
        out = _classified(out, width)
    return out


def _classified(cells: DataFrame, width: Callable[[Column], Column]) -> DataFrame:
    """Cells outside are dropped, those inside lose their ``_rays``, the others keep the sides that matter in them."""
    size = width(F.col("_level"))
    slack = size * 1e-9
    box = (F.col("_cx") * size - slack, F.col("_cy") * size - slack, (F.col("_cx") + 1) * size + slack, (F.col("_cy") + 1) * size + slack)

    def state(b: Column) -> Column:
        corners = [b[c] for c in ("x0", "y0", "x1", "y1")]
        border = F.exists("_rays", lambda e: _meets_box(e, corners))
        middle = _ray_hits(F.col("_rays"), (corners[0] + corners[2]) / 2, (corners[1] + corners[3]) / 2)
        rays = F.filter("_rays", lambda e: (F.greatest(e["ay"], e["by"]) >= corners[1]) & (F.least(e["ay"], e["by"]) <= corners[3]) & (F.greatest(e["ax"], e["bx"]) >= corners[0]))
        none = F.lit(None).cast(f"array<{_EDGE}>")
        return F.when(border, F.struct(F.lit(True).alias("kept"), rays.alias("rays"))).otherwise(F.struct(middle.alias("kept"), none.alias("rays")))

    known = F.when(F.col("_rays").isNull(), F.struct(F.lit(True).alias("kept"), F.lit(None).cast(f"array<{_EDGE}>").alias("rays")))
    boxed = F.struct(*[c.alias(n) for c, n in zip(box, ("x0", "y0", "x1", "y1"))])
    # exploding what is kept judges each cell once; a filter would be moved below and judge it again
    judged = cells.withColumn("_state", F.explode(F.filter(F.array(known.otherwise(va.let(boxed, state))), lambda x: x["kept"])))
    return judged.withColumn("_rays", F.col("_state.rays")).drop("_state")


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    ring: str,
    lat: str = "lat",
    lng: str = "lng",
    cell: float = 1.0,
    salts: int = 8,
) -> DataFrame:
    """Pairs of point and containing polygon.

    Polygons are covered by cells of their own size (see :func:`cover_cells`); points are listed under the cells of every level
    in use, of which there are few. An equi join follows, and rays are cast in border cells only, against the sides that matter there.
    ``salts`` spreads the points of a crowded cell over several tasks and repeats the cell's polygons for each.
    """
    step, splits = 3, 1
    own = [r["_level"] for r in polygons.select(_own_level(ring, cell, step).alias("_level")).distinct().collect()]
    levels = sorted({v + step * k for v in own if v is not None for k in range(splits + 1)})
    if not levels:
        return points.join(polygons, F.lit(False))
    listed = cover_cells(polygons, ring, cell, splits, step)
    width = F.lit(float(cell)) / F.pow(F.lit(2.0), F.col("_level"))
    placed = points.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels])))
    placed = placed.withColumns({"_cx": F.floor(F.col(lng) / width), "_cy": F.floor(F.col(lat) / width)})
    on = ["_level", "_cx", "_cy"]
    if salts > 1:
        on.append("_salt")
        listed = listed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        row = F.xxhash64(*[F.col(c) for c in points.columns])
        placed = placed.withColumn("_salt", F.pmod(row, F.lit(salts)).cast("int"))
    pairs = placed.join(listed, on)
    inside = F.col("_rays").isNull() | _ray_hits(F.col("_rays"), F.col(lng), F.col(lat))
    return pairs.filter(inside).drop(*on, "_rays")


def severity_of(
    text: Column | str, in_zone: bool = True, whole_words: bool = False
) -> Column:
    """Category from free text; unreadable is Unknown inside a mapped zone, Rarely outside."""
    fallback = "Unknown" if in_zone else "Rarely"
    exact = va.fold_synonyms(text, {c: (c,) for c in SEVERITY if c != "CHECK_MANUALLY"})
    return F.coalesce(
        va.classify_text(text, SEVERITY_RULES, whole_words=whole_words), exact, F.lit(fallback)
    )


def worst_severity(
    points: DataFrame,
    polygons: DataFrame,
    point_id: str,
    ring: str,
    attributes: Sequence[str],
    ranks: Mapping[str, int] = SEVERITY,
    **kwargs,
) -> DataFrame:
    """Worst category of the polygons around each point; ``Rarely`` inside none."""
    rated = polygons.select(
        ring, severity_of(F.concat_ws(" ", *attributes)).alias("category")
    )
    inside = points_in_polygons(points, rated, ring, **kwargs)
    worst = worst_of(inside, [point_id], "category", ranks)
    joined = points.join(worst, point_id, "left")
    return joined.withColumn("category", F.coalesce("category", F.lit("Rarely")))
