"""Two-dimensional Gaussian kernel density of points on a grid, per country.

Bandwidth is Scott's rule: kernel covariance = n^(-1/3) x sample covariance. The grid
spans the points' range plus ``cut`` bandwidths on each side.

The sum over points is not taken point by point. In coordinates where the kernel is
round and one bandwidth wide, points are binned into squares of half a bandwidth and each
bin keeps the moments of its points about its centre. With x from the bin centre to a
grid cell and t from the centre to a point,

    exp(-(x-t)^2/2) = exp(-x^2/2) * sum_k x^k * [exp(-t^2/2) t^k / k!]

and the bracket, summed over points, is the moment. Cut off after order 10 the error is
below 1e-10 of the kernel's height, far under the rounding of a plot. Moments add up, so
one partial aggregation over the points does the work; what follows grows with the
number of occupied bins and grid cells, not with the points.

A bin only meets the columns and rows of the grid within ``REACH`` bandwidths of its centre: beyond, a kernel is
below 1e-12 of its height. So what is summed is bounded by bins times that reach, however large the grid is
against the kernel. Cells are clipped by the outline before sums are joined to them.

``exact`` sums every location's kernel at every cell instead, with no cut; its cost is locations times cells.
"""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelens.operators.containment import points_in_shapes
from placelens.plans.joins import is_small, join_dimension

ORDER = 10
REACH = 8.0
BINS_PER_BANDWIDTH = 2
# Not null, NaN (which Spark orders above infinity) or infinite.
FINITE = "abs(longitude) < double('infinity') AND abs(latitude) < double('infinity')"
SHAPE_COLUMNS = ["n", "mid_x", "mid_y", "l11", "l21", "l22", "low_x", "low_y", "step_x", "step_y"]


def kernel_shapes(points: DataFrame, size: int, cut: float) -> DataFrame:
    """Per country: count, centre, Cholesky factor of the kernel covariance, and the grid.

    Countries with fewer than 3 points, or with all points on a line, have no density.
    """
    x, y = "longitude", "latitude"
    moments = points.groupBy("country_code").agg(
        F.count("*").alias("n"),
        F.avg(x).alias("mid_x"),
        F.avg(y).alias("mid_y"),
        F.var_samp(x).alias("vx"),
        F.var_samp(y).alias("vy"),
        F.covar_samp(x, y).alias("cxy"),
        F.min(x).alias("min_x"),
        F.max(x).alias("max_x"),
        F.min(y).alias("min_y"),
        F.max(y).alias("max_y"),
    )
    scott = F.pow(F.col("n").cast("double"), F.lit(-1.0 / 6))
    usable = moments.filter("n >= 3 AND vx * vy - cxy * cxy > 1e-12 * vx * vy")
    kernel = usable.withColumns(
        {
            "l11": F.sqrt("vx") * scott,
            "l21": F.col("cxy") / F.sqrt("vx") * scott,
            "l22": F.sqrt(F.col("vy") - F.col("cxy") * F.col("cxy") / F.col("vx")) * scott,
            "reach_x": F.sqrt("vx") * scott * cut,
            "reach_y": F.sqrt("vy") * scott * cut,
        }
    )
    return kernel.withColumns(
        {
            "low_x": F.col("min_x") - F.col("reach_x"),
            "low_y": F.col("min_y") - F.col("reach_y"),
            "step_x": (F.col("max_x") - F.col("min_x") + 2 * F.col("reach_x")) / (size - 1),
            "step_y": (F.col("max_y") - F.col("min_y") + 2 * F.col("reach_y")) / (size - 1),
        }
    ).select("country_code", *SHAPE_COLUMNS)


def density_grid(
    points: DataFrame,
    outlines: DataFrame,
    size: int = 100,
    cut: float = 3.0,
    clip: bool = True,
    exact: bool = False,
) -> DataFrame:
    """Density at the cells of a size x size grid over each country that has an outline.

    ``outlines`` has country_code and polygons; with ``clip`` only cells inside the
    outline stay. Densities integrate to 1 over the whole plane. Points with a null, NaN or infinite
    coordinate don't count.
    """
    if size < 2:
        raise ValueError("a grid needs at least 2 cells a side")
    located = points.select("country_code", F.col("longitude").cast("double"), F.col("latitude").cast("double")).filter(
        f"country_code IS NOT NULL AND {FINITE}"
    )
    countries = outlines.select("country_code").distinct()
    shapes = kernel_shapes(located, size, cut).join(countries, "country_code", "left_semi")
    # One narrow row per outlined country, so what counts is how many those are, not how detailed.
    small = is_small(countries)
    placed = join_dimension(located, shapes, ["country_code"], small=small)
    sums = _sum_over_locations(placed, size) if exact else _sum_over_bins(_bin_moments(placed), size)
    steps = F.sequence(F.lit(0), F.lit(size - 1))
    cells = shapes.withColumn("ix", F.explode(steps)).withColumn("iy", F.explode(steps)).select(
        "country_code", "ix", "iy", _along("x").alias("longitude"), _along("y").alias("latitude")
    )
    if clip:
        cells = points_in_shapes(cells, outlines, ["country_code"], match=["country_code"])
    return cells.join(sums, ["country_code", "ix", "iy"], "left").select(
        *cells.columns, F.coalesce("density", F.lit(0.0)).alias("density")
    )


def _along(axis: str) -> Column:
    """Longitude or latitude of a grid column or row."""
    return F.col(f"low_{axis}") + F.col(f"i{axis}") * F.col(f"step_{axis}")


def _near(axis: str, size: int, low: str, high: str) -> Column:
    """The numbers of the columns or rows that lie between two coordinates."""
    at = lambda f, c: f"{f}(greatest(-1e9D, least(1e9D, ({c} - low_{axis}) / step_{axis})))"
    first, last = f"greatest(0, int({at('ceil', low)}))", f"least({size - 1}, int({at('floor', high)}))"
    return F.expr(f"if({first} <= {last}, sequence({first}, {last}), cast(array() AS array<int>))")


def _sum_over_locations(placed: DataFrame, size: int) -> DataFrame:
    """Density at each cell from every distinct location, term by term."""
    steps = F.sequence(F.lit(0), F.lit(size - 1))
    u1, u2 = _rounded_space(F.col("longitude"), F.col("latitude"))
    locations = placed.groupBy("country_code", "longitude", "latitude").agg(
        F.count("*").alias("weight"), *[F.any_value(c).alias(c) for c in SHAPE_COLUMNS]
    )
    cells = locations.withColumns({"u1": u1, "u2": u2}).withColumn("ix", F.explode(steps)).withColumn("iy", F.explode(steps))
    v1, v2 = _rounded_space(_along("x"), _along("y"))
    square = (v1 - F.col("u1")) * (v1 - F.col("u1")) + (v2 - F.col("u2")) * (v2 - F.col("u2"))
    height = 2 * F.pi() * F.col("l11") * F.col("l22") * F.col("n")
    return cells.groupBy("country_code", "ix", "iy").agg(F.sum(F.exp(-square / 2) * F.col("weight") / height).alias("density"))


def _bin_moments(placed: DataFrame) -> DataFrame:
    """Moments of the points of every occupied bin, with the kernel of its country."""
    bin_width = 1.0 / BINS_PER_BANDWIDTH
    u1, u2 = _rounded_space(F.col("longitude"), F.col("latitude"))
    binned = placed.withColumns({"u1": u1, "u2": u2}).withColumns(
        {"bin1": F.floor(F.col("u1") / bin_width), "bin2": F.floor(F.col("u2") / bin_width)}
    )
    offsets = binned.withColumns(
        {
            "c1": (F.col("bin1") + 0.5) * bin_width,
            "c2": (F.col("bin2") + 0.5) * bin_width,
        }
    ).withColumns({"t1": F.col("u1") - F.col("c1"), "t2": F.col("u2") - F.col("c2")})
    t1, t2 = F.col("t1"), F.col("t2")
    weighted = offsets.withColumn("w", F.exp(-(t1 * t1 + t2 * t2) / 2))
    # As SQL text: 66 sums of products, one call to the JVM each.
    sums = [
        F.expr(f"sum(w{' * t1' * i}{' * t2' * j}) / {float(factorial(i) * factorial(j))}D").alias(_name(i, j))
        for i, j in _orders()
    ]
    return weighted.groupBy("country_code", "bin1", "bin2").agg(
        *sums, *[F.any_value(c).alias(c) for c in ["c1", "c2", *SHAPE_COLUMNS]]
    )


def _sum_over_bins(bins: DataFrame, size: int) -> DataFrame:
    """Density at each cell. What depends on the column alone is summed once per column."""
    reached = _near("x", size, f"(mid_x + l11 * (c1 - {REACH}D))", f"(mid_x + l11 * (c1 + {REACH}D))")
    across = bins.withColumn("ix", F.explode(reached)).withColumn("longitude", _along("x"))
    u1, rest = _rounded_space(F.col("longitude"), F.lit(0.0))
    height = 1 / (2 * F.pi() * F.col("l11") * F.col("l22") * F.col("n"))
    columns = across.withColumns({"x1": u1 - F.col("c1"), "rest": rest})
    columns = columns.withColumn("factor", F.exp(F.expr("-x1 * x1 / 2")) * height).select(
        "country_code", "ix", "bin2", "longitude", "rest", "c2", "low_y", "step_y", "l22",
        *[
            F.expr(f"factor * ({_horner('x1', [_name(i, j) for i in range(ORDER - j + 1)])})").alias(f"k{j}")
            for j in range(ORDER + 1)
        ],
    )
    # What the row doesn't change is added up over a column's bins before rows multiply them.
    kept = ["rest", "longitude", "low_y", "step_y", "l22", "c2"]
    columns = columns.groupBy("country_code", "ix", "bin2").agg(
        *[F.any_value(c).alias(c) for c in kept], *[F.sum(f"k{j}").alias(f"k{j}") for j in range(ORDER + 1)]
    )
    reached = _near("y", size, f"((c2 - rest - {REACH}D) * l22)", f"((c2 - rest + {REACH}D) * l22)")
    cells = columns.withColumn("iy", F.explode(reached)).withColumn("latitude", _along("y"))
    offsets = cells.withColumn("x2", F.col("latitude") / F.col("l22") + F.col("rest") - F.col("c2"))
    powers = _horner("x2", [f"k{j}" for j in range(ORDER + 1)])
    value = F.expr(f"exp(-x2 * x2 / 2) * ({powers})")
    return offsets.groupBy("country_code", "ix", "iy").agg(F.sum(value).alias("density"))


def _rounded_space(x: Column, y: Column) -> tuple[Column, Column]:
    """Coordinates in which the kernel is the standard normal."""
    u1 = (x - F.col("mid_x")) / F.col("l11")
    return u1, (y - F.col("mid_y") - F.col("l21") * u1) / F.col("l22")


def _orders() -> list[tuple[int, int]]:
    return [(i, j) for i in range(ORDER + 1) for j in range(ORDER + 1 - i)]


def _name(i: int, j: int) -> str:
    return f"m{i}_{j}"


def _horner(x: str, coefficients: list[str]) -> str:
    """The polynomial with these coefficients, lowest first, as nested SQL text."""
    *lower, text = coefficients
    for c in reversed(lower):
        text = f"({text}) * {x} + {c}"
    return text
