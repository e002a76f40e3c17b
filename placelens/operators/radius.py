"""Radius join: how many facilities lie within a distance of each base point.

The answer is a count, so pairs need not be listed. Facilities are summarised in boxes
of a grid, level by level. A base point looks up the boxes near it; a box that lies
wholly inside its disc adds its total, a box wholly outside is dropped, and only boxes
the rim cuts are opened: into smaller boxes, at last into single locations.

* Equal coordinates collapse into one weighted location on both sides before anything
  is joined, so a pile of copies (such as places without coordinates, all at 0/0) costs
  one row.
* The depth comes from the data: boxes are split until the fullest holds a few locations,
  so a key meets at most that many, or splits^d boxes, on the facility side.
* All joins are equi-joins on box keys, each between two plain shuffles, so adaptive
  execution splits the base points that share a hot box or a hot location over many tasks.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelens.functions.geometry import Disc
from placelens.plans.joins import free_names

PLACE = ["area", "lon", "lat"]
# Not null, NaN (which Spark orders above infinity) or infinite.
FINITE = "abs(lon) < double('infinity') AND abs(lat) < double('infinity')"
# Grid steps are a hair wider than the reach, and boxes within a hair of the rim are
# opened, so rounding in cell numbers and box tests never decides a point.
SLACK = 1e-9
# Each level cuts a box into this many a side, until no box holds more than CROWD
# locations or boxes are too small to tell: then the last join meets what is left.
SPLIT = 4
CROWD = 32
DEEPEST = 7


def count_within(
    base: DataFrame,
    facilities: DataFrame,
    radius: float = 2.0,
    metric: str = "polygon_deg",
    match_country: bool = True,
    splits: tuple[int, ...] | None = None,
) -> DataFrame:
    """``base`` with ``n_within``: facilities strictly inside the disc around each row.

    Both inputs need longitude and latitude, and country_code unless ``match_country`` is
    off. ``metric`` is ``polygon_deg`` (64-sided buffer, radius in degrees), ``circle_deg``
    or ``km``. Every base row stays, with 0 where nothing is near. Facilities and base rows with a
    null, NaN or infinite coordinate are near nothing. All columns of ``base`` stay.

    ``splits`` says how finely each level divides the boxes of the one before it. Without it,
    one job over the facilities finds how deep to go; it brings a few numbers to the driver.
    """
    disc = Disc(metric, radius)
    tags = free_names([f"_{name}" for name in PLACE], base)
    place = _place_columns(match_country)
    base = base.withColumns({tag: place[name] for tag, name in zip(tags, PLACE)})
    locations = _weighted_locations(facilities, match_country)
    counts = _counts_by_location(
        base.select(*[F.col(tag).alias(name) for tag, name in zip(tags, PLACE)]).filter(FINITE).distinct(),
        locations,
        disc,
        (SPLIT,) * needed_depth(locations, disc) if splits is None else splits,
    )
    # A shuffle of its own: adaptive execution splits a hot location only between two shuffles.
    counts = counts.withColumnsRenamed(dict(zip(PLACE, tags))).repartition(*tags)
    return (
        base.join(counts, tags, "left")
        .drop(*tags)
        .withColumn("n_within", F.coalesce("n_within", F.lit(0).cast("bigint")))
    )


def _place_columns(match_country: bool) -> dict[str, Column]:
    return {
        "area": F.col("country_code") if match_country else F.lit(""),
        "lon": F.col("longitude").cast("double"),
        "lat": F.col("latitude").cast("double"),
    }


def _weighted_locations(facilities: DataFrame, match_country: bool) -> DataFrame:
    place = [c.alias(name) for name, c in _place_columns(match_country).items()]
    return (
        facilities.select(*place)
        .filter(f"area IS NOT NULL AND {FINITE}")
        .groupBy(*PLACE)
        .agg(F.count("*").alias("weight"))
    )


def needed_depth(locations: DataFrame, disc: Disc) -> int:
    """How many levels bring the fullest box down to ``CROWD`` locations, from 1 to ``DEEPEST``.

    Each location counts once for its box at every level; partial sums go through one shuffle, a row a level comes back.
    """
    cells = [f"cell{i}" for i in range(disc.dimensions)]
    finest = disc.reach * (1 + SLACK) / SPLIT**DEEPEST
    at = disc.coordinates(F.col("lon"), F.col("lat"))
    smallest = locations.select("area", *[F.floor(a / finest).alias(c) for a, c in zip(at, cells)])
    boxes = [
        f"struct({level} AS level, " + ", ".join(f"floor({c} / {SPLIT ** (DEEPEST - level)}) AS {c}" for c in cells) + ")"
        for level in range(1, DEEPEST)
    ]
    counted = (
        smallest.select("area", F.expr(f"inline(array({', '.join(boxes)}))"))
        .groupBy("area", "level", *cells)
        .count()
        .groupBy("level")
        .agg(F.max("count").alias("fullest"))
    )
    return 1 + counted.where(F.col("fullest") > CROWD).agg(F.coalesce(F.max("level"), F.lit(0))).first()[0]


def _counts_by_location(
    base: DataFrame, facilities: DataFrame, disc: Disc, splits: tuple[int, ...]
) -> DataFrame:
    axes = range(disc.dimensions)
    at = [f"at{i}" for i in axes]

    def located(df: DataFrame) -> DataFrame:
        return df.withColumns(dict(zip(at, disc.coordinates(F.col("lon"), F.col("lat")))))

    def key(level: int) -> list[str]:
        return [f"cell{level}_{i}" for i in axes]

    base, facilities = located(base), located(facilities)
    finest = disc.reach * (1 + SLACK)
    for n in splits:
        finest /= n
    # Finest cell from the coordinates, the levels above by integer division, so they nest.
    levels = range(len(splits), -1, -1)
    width = 1
    for level in levels:
        cell = {
            # Never null, so no null test differs between levels and keeps Spark from
            # reusing one shuffle of the locations for all of them.
            name: F.coalesce(F.floor(F.floor(F.col(a) / finest) / width), F.lit(0))
            for name, a in zip(key(level), at)
        }
        facilities = facilities.withColumns(cell)
        if level == 0:
            base = base.withColumns(cell)
        else:
            width *= splits[level - 1]

    frontier = _nearby_cells(base, key(0))
    settled = []
    for level in range(1, len(splits) + 1):
        parent = key(level - 1)
        opened = frontier.join(_boxes(facilities, parent, key(level), at), ["area", *parent])
        settled.append(opened.filter(_whole_box_inside(disc, at)).select(*PLACE, "weight"))
        cut = opened.filter(_rim_cuts_crowded_box(disc, at))
        frontier = cut.select(*PLACE, *at, *key(level))
    last = ["area", *key(len(splits))]
    points = facilities.select(
        *last, F.col("lon").alias("f_lon"), F.col("lat").alias("f_lat"), "weight"
    )
    inside = disc.contains(F.col("lon"), F.col("lat"), F.col("f_lon"), F.col("f_lat"))
    settled.append(frontier.join(points, last).filter(inside).select(*PLACE, "weight"))
    return (
        reduce(DataFrame.unionByName, settled)
        .groupBy(*PLACE)
        .agg(F.sum("weight").cast("bigint").alias("n_within"))
    )


def _nearby_cells(base: DataFrame, cells: list[str]) -> DataFrame:
    """Each location once per cell that its disc may touch: its own and all around it."""
    structs = [
        "struct(" + ", ".join(f"{c} + {step} AS {c}" for c, step in zip(cells, steps)) + ")"
        for steps in product((-1, 0, 1), repeat=len(cells))
    ]
    around = F.expr(f"array({', '.join(structs)})")
    others = [c for c in base.columns if c not in cells]
    return base.select(*others, F.explode(around).alias("near")).select(*others, "near.*")


def _boxes(facilities: DataFrame, parent: list[str], own: list[str], at: list[str]) -> DataFrame:
    """The occupied cells one level below each parent cell.

    Of each: bounding box, number of locations, total weight, and a location (the only
    one, if there is one).
    """
    bounds = [
        agg(a).alias(f"{side}_{a}") for a in at for side, agg in (("low", F.min), ("high", F.max))
    ]
    return facilities.groupBy("area", *parent, *own).agg(
        F.count("*").alias("locations"),
        F.sum("weight").alias("weight"),
        F.min("lon").alias("box_lon"),
        F.min("lat").alias("box_lat"),
        *bounds,
    )


# Squared distances to the nearest and farthest corner of a box, as SQL text: the same
# test is built many times, and text is one call to the JVM instead of dozens.


def _near_square(at: list[str]) -> str:
    gaps = [f"greatest(low_{a} - {a}, {a} - high_{a}, 0D)" for a in at]
    return " + ".join(f"{gap} * {gap}" for gap in gaps)


def _far_square(at: list[str]) -> str:
    spans = [f"greatest({a} - low_{a}, high_{a} - {a})" for a in at]
    return " + ".join(f"{span} * {span}" for span in spans)


def _whole_box_inside(disc: Disc, at: list[str]) -> Column:
    """Distances settle nearly every box; a single location near the rim is tested exactly."""
    exact = disc.contains(F.col("lon"), F.col("lat"), F.col("box_lon"), F.col("box_lat"))
    safely = F.expr(f"{_far_square(at)} < {_core_square(disc)}")
    return safely | (F.expr(f"locations = 1 AND {_near_square(at)} < {_reach_square(disc)}") & exact)


def _rim_cuts_crowded_box(disc: Disc, at: list[str]) -> str:
    """Single locations are settled by the exact test; only boxes of several need opening."""
    return (
        f"locations > 1 AND {_near_square(at)} < {_reach_square(disc)}"
        f" AND {_far_square(at)} >= {_core_square(disc)}"
    )


def _core_square(disc: Disc) -> str:
    return f"{(disc.core * (1 - SLACK)) ** 2!r}D"


def _reach_square(disc: Disc) -> str:
    return f"{(disc.reach * (1 + SLACK)) ** 2!r}D"
