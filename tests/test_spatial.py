"""Radius join, buffers, point in polygon, density: golden cases and brute-force twins."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from placelens.functions.geometry import Disc, haversine_km, ring
from placelens.operators.containment import CAPACITY, outline_cells, points_in_shapes
from placelens.operators.density import density_grid
from placelens.operators.radius import _weighted_locations, count_within, needed_depth
from tests.conftest import plan_of, rows

POINT = "id BIGINT, country_code STRING, longitude DOUBLE, latitude DOUBLE"


def points(spark, data, country="AA"):
    full = [(i, *(p if len(p) == 3 else (country, *p))) for i, p in enumerate(data)]
    return spark.createDataFrame(full, POINT)


def counts(df):
    return [r.n_within for r in df.orderBy("id").collect()]


def at(distance, degrees):
    return (distance * math.cos(math.radians(degrees)), distance * math.sin(math.radians(degrees)))


def test_golden_radius(spark):
    base = points(spark, [(0.0, 0.0), (50.0, 50.0)])
    near = points(spark, [(0.0, 0.0), at(1.9999, 0), at(1.9999, 360 / 128), (2.0, 0.0)])
    assert counts(count_within(base, near, 2, "circle_deg")) == [3, 0]
    assert counts(count_within(base, near, 2)) == [2, 0]
    assert count_within(base, near).columns == [*base.columns, "n_within"]


def test_border(spark):
    base = points(spark, [("AA", 0.0, 0.0)])
    near = points(spark, [("AA", 0.5, 0.0), ("BB", 0.0, 0.5), (None, 0.0, 0.1)])
    assert counts(count_within(base, near, 1)) == [1]
    # A place without a country still lies somewhere.
    assert counts(count_within(base, near, 1, match_country=False)) == [3]


def test_duplicates_and_nulls(spark):
    base = points(spark, [(0.0, 0.0), (0.0, 0.0), (-0.0, 0.0), (None, 1.0)])
    near = points(spark, [(0.1, 0.0)] * 5 + [(None, 0.0)])
    assert counts(count_within(base, near, 1)) == [5, 5, 5, 0]


def brute(base, near, disc, match=True):
    on = F.lit(True)
    if match:
        on = F.col("b.country_code") == F.col("f.country_code")
    inside = disc.contains(
        F.col("b.longitude"), F.col("b.latitude"), F.col("f.longitude"), F.col("f.latitude")
    )
    joined = base.alias("b").join(near.alias("f"), on & inside, "left")
    return [
        r.n
        for r in joined.groupBy("b.id").agg(F.count("f.id").alias("n")).orderBy("id").collect()
    ]


@pytest.mark.parametrize("metric", ["polygon_deg", "circle_deg"])
@pytest.mark.parametrize("splits", [(4, 4), (3,), (2, 3, 4)])
def test_same_as_nested_loop(spark, metric, splits):
    r = random.Random(5)
    # Uniform, plus a dense cluster that holds most points, plus one point many times.
    def draw(n):
        cloud = [(r.choice("AB"), r.uniform(-6, 6), r.uniform(-6, 6)) for _ in range(n)]
        cluster = [("A", r.gauss(1, 0.3), r.gauss(-1, 0.3)) for _ in range(n)]
        return cloud + cluster + [("A", 0.0, 0.0)] * n

    base, near = points(spark, draw(60)), points(spark, draw(150))
    assert counts(count_within(base, near, 1.3, metric, splits=splits)) == brute(base, near, Disc(metric, 1.3))


@pytest.mark.parametrize("radius", [40.0, 2500.0, 15000.0, 25000.0])
def test_km_over_the_globe(spark, radius):
    r = random.Random(7)

    def draw(n):
        globe = [(r.uniform(-180, 180), math.degrees(math.asin(r.uniform(-1, 1)))) for _ in range(n)]
        seam = [(r.choice([-1, 1]) * r.uniform(179.5, 180), r.uniform(-1, 1)) for _ in range(n)]
        pole = [(r.uniform(-180, 180), r.choice([-1, 1]) * r.uniform(89.5, 90)) for _ in range(n)]
        return globe + seam + pole

    base, near = points(spark, draw(40)), points(spark, draw(80))
    assert counts(count_within(base, near, radius, "km")) == brute(base, near, Disc("km", radius))


def test_counts_grow_with_radius_and_polygon_is_within_circle(spark):
    r = random.Random(3)
    base = points(spark, [(r.uniform(0, 5), r.uniform(0, 5)) for _ in range(80)])
    near = points(spark, [(r.uniform(0, 5), r.uniform(0, 5)) for _ in range(200)])
    small = counts(count_within(base, near, 0.5))
    polygon = counts(count_within(base, near, 1))
    circle = counts(count_within(base, near, 1, "circle_deg"))
    assert all(a <= b <= c for a, b, c in zip(small, polygon, circle))


def test_polygon_formula_is_the_explicit_polygon(spark):
    r = random.Random(11)
    near = [at(r.uniform(1.99, 2.001), r.uniform(0, 360)) for _ in range(3000)]
    corners = [at(2, 360 * i / 64) for i in range(65)]

    def inside(p):
        return all(
            (x2 - x1) * (p[1] - y1) - (y2 - y1) * (p[0] - x1) > 0
            for (x1, y1), (x2, y2) in zip(corners, corners[1:])
        )

    zero = F.lit(0.0)
    test = Disc("polygon_deg", 2).contains(zero, zero, F.col("longitude"), F.col("latitude"))
    got = [row.t for row in points(spark, near).orderBy("id").select(test.alias("t")).collect()]
    assert got == [inside(p) for p in near]


def test_ring(spark):
    got = points(spark, [(10.0, 20.0)]).select(ring(F.col("longitude"), F.col("latitude"), 2).alias("r")).first().r
    assert len(got) == 65
    assert (got[0].lon, got[0].lat) == (12.0, 20.0)
    assert got[64].lon == pytest.approx(12) and got[64].lat == pytest.approx(20)
    assert got[16].lat == pytest.approx(18)  # clockwise
    assert all(math.hypot(p.lon - 10, p.lat - 20) == pytest.approx(2) for p in got)


def test_unknown_metric_and_radius():
    with pytest.raises(ValueError, match="polygon_deg"):
        Disc("miles", 1)
    with pytest.raises(ValueError):
        Disc("km", 0)


def test_radius_depth_comes_from_the_data(spark):
    r = random.Random(11)
    disc = Disc("circle_deg", 1.0)
    sparse = [("A", r.uniform(-9, 9), r.uniform(-9, 9)) for _ in range(60)]
    # Forty times as many in a hundredth of a box's side, and one point many times, which is one location.
    dense = [("A", 0.5 + r.uniform(0, 0.01), 0.5 + r.uniform(0, 0.01)) for _ in range(2400)] + [("A", 3.0, 3.0)] * 500
    depths = [needed_depth(_weighted_locations(points(spark, p), True), disc) for p in (sparse, sparse + dense)]
    assert depths[0] == 1 and depths[1] >= 4
    assert needed_depth(_weighted_locations(points(spark, sparse).limit(0), True), disc) == 1
    base, near = points(spark, sparse + dense[::40]), points(spark, sparse + dense)
    assert counts(count_within(base, near, 1.0, "circle_deg")) == brute(base, near, disc)


def test_hot_box_of_base_points_is_split(spark):
    small = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "20k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    ids = spark.range(40_000).select("id", F.lit("A").alias("country_code"))
    base = ids.select("*", (F.rand(1) * 0.01 + 1).alias("longitude"), (F.rand(2) * 0.01 + 1).alias("latitude"))
    near = ids.limit(40).select("country_code", (F.col("id") / 20).alias("longitude"), (F.col("id") / 20).alias("latitude"))
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        counted = count_within(base, near, 0.9, "circle_deg", splits=(4,))
        assert len(counted.collect()) == 40_000
        assert "SortMergeJoin(skew=true)" in plan_of(counted).split("Initial Plan")[0]
        # Half of all rows at one location meet its count in the last join, the first of the plan's text.
        half = F.when(F.col("id") % 2 == 0, 1.0).otherwise(F.col("longitude") * 20)
        wide = base.select("country_code", half.alias("longitude"), F.lit(1.0).alias("latitude"), F.sha2(F.col("id").cast("string"), 256))
        counted = count_within(wide, near, 0.9, "circle_deg", splits=(4,))
        assert len(counted.collect()) == 40_000
        joins = [line for line in plan_of(counted).split("Initial Plan")[0].splitlines() if "SortMergeJoin" in line]
        assert "skew=true" in joins[0]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_haversine(spark):
    df = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(180.0), F.lit(0.0)).alias("d"))
    assert df.first().d == pytest.approx(math.pi * 6371.0088)


def test_radius_plan_has_no_nested_loop(spark):
    base, near = points(spark, [(0.0, 0.0)]), points(spark, [(0.0, 0.0)])
    for metric in ("polygon_deg", "circle_deg", "km"):
        plan = plan_of(count_within(base, near, 2, metric))
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


# Outlines.

SQUARE = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
HOLE = [[1.0, 1.0], [3.0, 1.0], [3.0, 3.0], [1.0, 3.0], [1.0, 1.0]]
FAR = [[10.0, 10.0], [12.0, 10.0], [11.0, 12.0], [10.0, 10.0]]
SHAPES = "geonameid BIGINT, country_code STRING, polygons ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"


def test_golden_shapes(spark):
    shapes = spark.createDataFrame([(1, "AA", [[SQUARE, HOLE]]), (2, "BB", [[SQUARE], [FAR]])], SHAPES)
    where = points(spark, [(0.5, 0.5), (2.0, 2.0), (7.0, 7.0), (11.0, 11.0), (-1.0, 2.0), (10.1, 11.9)])
    assert rows(points_in_shapes(where, shapes, ["geonameid"]), "id", "geonameid") == [
        (0, 1), (0, 2), (1, 2), (3, 2),
    ]
    own = points_in_shapes(where, shapes, ["country_code"], match=["country_code"])
    assert rows(own, "id", "country_code") == [(0, "AA")]
    assert own.columns.count("country_code") == 1


def test_shapes_same_as_ray_casting(spark):
    r = random.Random(2)

    def star(cx, cy):
        corner = [(cx + d * math.cos(a), cy + d * math.sin(a)) for a, d in
                  ((2 * math.pi * i / 17, r.uniform(2, 9)) for i in range(17))]
        return [list(p) for p in [*corner, corner[0]]]

    stars = [star(r.uniform(-15, 15), r.uniform(-15, 15)) for _ in range(6)]
    shapes = spark.createDataFrame([(i, "AA", [[s]]) for i, s in enumerate(stars)], SHAPES)
    where = [(r.uniform(-20, 20), r.uniform(-20, 20)) for _ in range(400)]

    def inside(p, ring_):
        hits = 0
        for (x1, y1), (x2, y2) in zip(ring_, ring_[1:]):
            if (y1 > p[1]) != (y2 > p[1]):
                hits += p[0] < x1 + (p[1] - y1) * (x2 - x1) / (y2 - y1)
        return hits % 2 == 1

    expected = [(i, j) for i, p in enumerate(where) for j, s in enumerate(stars) if inside(p, s)]
    for capacity in (CAPACITY, 1, 4, 1000):
        got = points_in_shapes(points(spark, where), shapes, ["geonameid"], capacity=capacity)
        assert rows(got, "id", "geonameid") == sorted(expected, key=repr)


def coast(n, cx, cy, seed):
    """A ring of n corners that runs in and out at every scale."""
    r = random.Random(seed)
    waves = [(k, r.uniform(0, 6.28), r.uniform(0.2, 0.6) / k**0.5) for k in (3, 17, 120, 900)]
    ring = []
    for i in range(n):
        a = 2 * math.pi * i / n
        d = 6 + sum(h * math.sin(k * a + s) for k, s, h in waves)
        ring.append([cx + d * math.cos(a), cy + d * math.sin(a)])
    return [*ring, ring[0]]


def test_a_long_outline_is_cut_into_bounded_cells(spark):
    """50,000 edges, with a hole of as many and a part across the grid's origin."""
    outer, hole = coast(50_000, 3.0, 61.0, 1), [[3 + (x - 3) / 3, 61 + (y - 61) / 3] for x, y in coast(50_000, 3.0, 61.0, 2)]
    polygons = [[outer, hole], [coast(3_000, -1.0, 1.0, 3)]]
    shapes = spark.createDataFrame([(1, "AA", polygons)], SHAPES)
    cells = outline_cells(shapes, ["geonameid"]).selectExpr("level", "cx", "cy", "size(edges) AS n", "inside").collect()
    assert max(c.n for c in cells) <= CAPACITY and len({(c.level, c.cx, c.cy) for c in cells}) == len(cells)
    assert sum(c.n == 0 for c in cells) > 100 and all(c.inside for c in cells if not c.n)
    r = random.Random(4)
    where = [(r.uniform(-5, 11), r.uniform(53, 69)) for _ in range(1500)] + [(r.uniform(-8, 6), r.uniform(-6, 8)) for _ in range(500)]
    where += [(x + r.uniform(-1e-3, 1e-3), y + r.uniform(-1e-3, 1e-3)) for x, y in r.sample(outer, 500)]
    edges = np.array([[*a, *b] for polygon in polygons for ring_ in polygon for a, b in zip(ring_, ring_[1:])])
    x1, y1, x2, y2 = edges.T

    def inside(x, y):
        over = (y1 > y) != (y2 > y)
        return (x < x1[over] + (y - y1[over]) * (x2[over] - x1[over]) / (y2[over] - y1[over])).sum() % 2 == 1

    got = points_in_shapes(points(spark, where), shapes, ["geonameid"])
    assert {i for (i,) in rows(got, "id")} == {i for i, (x, y) in enumerate(where) if inside(x, y)}


def test_shapes_and_points_out_of_the_ordinary(spark):
    shapes = spark.createDataFrame(
        [(1, "AA", [[SQUARE]]), (2, "AA", None), (3, "AA", []), (4, "AA", [[[[0.0, 0.0]], []]]), (5, "AA", [[[[0.0, 0.0], [0.0, 0.0]]]]),
         (6, "AA", [[[[500.0, 100.0], [900.0, 100.0], [900.0, 400.0], [500.0, 400.0], [500.0, 100.0]]]]), (1, "AA", [[SQUARE]])],
        SHAPES,
    )
    where = [(1.0, 1.0), (math.nan, 1.0), (1.0, math.inf), (None, 1.0), (700.0, 300.0), (-1e300, 1.0), (2.0, 3.999999)]
    got = points_in_shapes(points(spark, where), shapes, ["geonameid"])
    assert rows(got, "id", "geonameid") == [(0, 1), (0, 1), (4, 6), (6, 1), (6, 1)]


def test_shapes_plan(spark):
    shapes = spark.createDataFrame([(1, "AA", [[SQUARE]])], SHAPES)
    plan = plan_of(points_in_shapes(points(spark, [(1.0, 1.0)]), shapes, ["geonameid"]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# Density.

WORLD = [[[-90.0, -80.0], [90.0, -80.0], [90.0, 80.0], [-90.0, 80.0], [-90.0, -80.0]]]


def kde(data, x, y):
    n = len(data)
    mx, my = (sum(p[i] for p in data) / n for i in (0, 1))
    vx, vy, c = (
        sum((p[i] - m) * (p[j] - k) for p in data) / (n - 1)
        for i, j, m, k in ((0, 0, mx, mx), (1, 1, my, my), (0, 1, mx, my))
    )
    s = n ** (-1 / 3)
    vx, vy, c = vx * s, vy * s, c * s
    det = vx * vy - c * c
    total = sum(
        math.exp(-0.5 * (vy * (x - px) ** 2 - 2 * c * (x - px) * (y - py) + vx * (y - py) ** 2) / det)
        for px, py in data
    )
    return total / (2 * math.pi * math.sqrt(det) * n)


def test_density_is_the_kernel_sum(spark):
    r = random.Random(9)
    data = [(r.gauss(3, 2), 0.7 * r.gauss(0, 1) + r.uniform(-4, 4)) for _ in range(300)] + [(20.0, 10.0)] * 20
    shapes = spark.createDataFrame([(1, "AA", [WORLD])], SHAPES)
    cells = density_grid(points(spark, data), shapes, size=12).collect()
    assert len(cells) == 144
    peak = max(c.density for c in cells)
    for c in cells:
        assert c.density == pytest.approx(kde(data, c.longitude, c.latitude), abs=1e-10 * peak)
        assert c.density >= -1e-12 * peak


def test_density_integrates_to_one(spark):
    r = random.Random(4)
    data = [(r.gauss(0, 1), r.gauss(0, 2)) for _ in range(200)]
    shapes = spark.createDataFrame([(1, "AA", [WORLD])], SHAPES)
    cells = density_grid(points(spark, data), shapes, size=60).collect()
    step = lambda name: sorted({getattr(c, name) for c in cells})[1] - sorted({getattr(c, name) for c in cells})[0]
    assert sum(c.density for c in cells) * step("longitude") * step("latitude") == pytest.approx(1, abs=0.02)


def test_density_clip_and_degenerate(spark):
    r = random.Random(4)
    data = [("AA", r.uniform(0, 4), r.uniform(0, 4)) for _ in range(50)]
    line = [("BB", float(i), 2.0 * i) for i in range(9)]
    few = [("CC", 1.0, 1.0), ("CC", 2.0, 5.0)]
    unknown = [("DD", r.uniform(0, 4), r.uniform(0, 4)) for _ in range(9)]
    shapes = spark.createDataFrame([(1, "AA", [[SQUARE, HOLE]]), (2, "BB", [WORLD]), (3, "CC", [WORLD])], SHAPES)
    cells = density_grid(points(spark, data + line + few + unknown), shapes, size=20).collect()
    assert cells and {c.country_code for c in cells} == {"AA"}
    for c in cells:
        assert 0 < c.longitude < 4 and 0 < c.latitude < 4
        assert not (1 < c.longitude < 3 and 1 < c.latitude < 3)
    free = density_grid(points(spark, data), shapes, size=20, clip=False)
    assert free.count() == 400


def test_points_without_a_place_do_not_empty_a_country(spark):
    r = random.Random(5)
    data = [(r.uniform(0, 4), r.uniform(0, 4)) for _ in range(50)]
    shapes = spark.createDataFrame([(1, "AA", [WORLD])], SHAPES)
    rounded = [F.round(c, 12).alias(c) for c in ("longitude", "latitude", "density")]
    grid = lambda rows_: rows(density_grid(points(spark, rows_), shapes, size=8).select("ix", "iy", *rounded))
    plain = grid(data)
    assert len(plain) == 64
    for odd in (math.nan, math.inf, -math.inf, None):
        assert grid([*data, (odd, 1.0), (1.0, odd), (odd, odd)]) == plain


def test_kernels_are_summed_within_reach_only(spark):
    """Two clusters far apart: most of the grid is out of reach of every bin, and the sums agree with every term added."""
    r = random.Random(6)
    data = [(r.gauss(0, 1), r.gauss(0, 1)) for _ in range(3000)] + [(60 + r.gauss(0, 1), 30 + r.gauss(0, 3)) for _ in range(3)]
    shapes = spark.createDataFrame([(1, "AA", [WORLD])], SHAPES)
    table = points(spark, data)
    got, exact = (density_grid(table, shapes, size=30, exact=x).orderBy("ix", "iy").collect() for x in (False, True))
    assert [(c.ix, c.iy, c.longitude, c.latitude) for c in got] == [(c.ix, c.iy, c.longitude, c.latitude) for c in exact] and len(got) == 900
    peak = max(c.density for c in exact)
    assert sum(c.density == 0 for c in got) > 100
    for c, d in zip(got, exact):
        assert c.density == pytest.approx(d.density, abs=1e-10 * peak)
    for c in exact[::97]:
        assert c.density == pytest.approx(kde(data, c.longitude, c.latitude), abs=1e-12 * peak)


def test_density_plan(spark):
    shapes = spark.createDataFrame([(1, "AA", [WORLD])], SHAPES)
    plan = plan_of(density_grid(points(spark, [(0.0, 1.0)]), shapes, size=5))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_radius_ignores_nan_and_keeps_all_columns(spark):
    near = [(0.5 + i / 100, 0.5, "AA") for i in range(5)]
    bad = [(float("nan"), 0.5, "AA"), (0.5, float("inf"), "AA"), (None, 0.5, "AA")]
    schema = "longitude double, latitude double, country_code string"
    facilities = spark.createDataFrame(near + bad, schema)
    base = spark.createDataFrame([(0.5, 0.5, "AA"), *bad], schema).selectExpr(
        "*", "'a' AS area", "'b' AS lon", "'c' AS lat", "'d' AS _area"
    )
    out = count_within(base, facilities, 3.0, "circle_deg")
    assert out.columns == [*base.columns, "n_within"]
    got = sorted((r.n_within, r.area, r.lon, r.lat, r._area) for r in out.collect())
    assert got == [(n, "a", "b", "c", "d") for n in (0, 0, 0, 5)]
