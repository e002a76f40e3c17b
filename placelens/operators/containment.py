"""Point in polygon as an equi-join on classed cells.

Every outline is cut into a tree of square cells, each split in 8 x 8 until it holds at most ``capacity`` edges. A cell
no edge touches is wholly inside or outside; outside cells are dropped. A cell that edges cut keeps those edges alone, and
whether its lower right corner is inside. A point meets one cell of an outline at most: if no edge cuts it, the point is inside;
else the edges are counted that cross the way from the corner up the cell's right side and then west to the point. So what a
point is tested against is bounded by the capacity, however long the outline is; only where more edges than that meet
within the smallest cells (1/512 of a degree) is there more to test.

Cutting is a chain of expressions on the outlines, without a shuffle. Points get one key for each size of cell and meet the
cells in one equi-join, which is a broadcast if the cells are small enough. While the plan is built, one small job
asks how many edges an outline has at most: plain shapes need no splitting, and points one key.

The grid is shifted by a fraction of a thousandth of a degree, so that round coordinates don't lie on cell sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.plans.joins import free_names, join_dimension

CAPACITY = 24
#: Sizes of cells in degrees, by level; each is an eighth of the one before.
SIZES = [64.0 / 8**level for level in range(6)]
SHIFT = 0.000271828
PARTS = 8
FAR_EAST = "double('infinity')"


def _crosses_row(y: str, west: str, east: str) -> str:
    """Whether edge ``e`` crosses the way along latitude ``y`` between two longitudes."""
    at = f"(e.x1 + try_divide(({y} - e.y1) * (e.x2 - e.x1), e.y2 - e.y1))"
    return f"((e.y1 > {y}) <> (e.y2 > {y}) AND {at} > {west} AND {at} <= {east})"


def _crosses_column(x: str, south: str, north: str) -> str:
    """Whether edge ``e`` crosses the way along longitude ``x`` between two latitudes."""
    at = f"(e.y1 + try_divide(({x} - e.x1) * (e.y2 - e.y1), e.x2 - e.x1))"
    return f"((e.x1 > {x}) <> (e.x2 > {x}) AND {at} >= {south} AND {at} < {north})"


def outline_edges(polygons: str = "polygons") -> str:
    """All edges x1, y1, x2, y2 of every ring (outer rings and holes alike), as one array, in SQL."""
    edge = "named_struct('x1', get(get(r, i - 1), 0), 'y1', get(get(r, i - 1), 1), 'x2', get(get(r, i), 0), 'y2', get(get(r, i), 1))"
    ring = f"if(size(r) > 1, transform(sequence(1, size(r) - 1), i -> {edge}), array())"
    whole = f"flatten(transform({polygons}, p -> flatten(transform(p, r -> {ring}))))"
    return f"filter({whole}, e -> isnotnull(e.x1 + e.y1 + e.x2 + e.y2) AND (e.x1 <> e.x2 OR e.y1 <> e.y2))"


def outline_cells(shapes: DataFrame, key: list[str], capacity: int = CAPACITY, levels: range = range(len(SIZES))) -> DataFrame:
    """The key, level, cx, cy (of a cell), edges and whether the cell's lower right corner is ``inside``."""
    size = SIZES[levels[0]]
    cell = lambda c: f"floor(({c} - {SHIFT}D) / {size!r}D)"
    bound = lambda agg, a: f"array_{agg}(flatten(transform(edges, e -> array(e.{a}1, e.{a}2))))"
    rows = shapes.select(*key, F.expr(outline_edges()).alias("edges")).where("size(edges) > 0")
    for name, a in (("cx", "x"), ("cy", "y")):
        rows = rows.withColumn(name, F.explode(F.expr(f"sequence({cell(bound('min', a))}, {cell(bound('max', a))})")))
    # Of the largest cells, the corner's side by a ray to the east over the whole outline.
    east, south = f"((cx + 1) * {size!r}D + {SHIFT}D)", f"(cy * {size!r}D + {SHIFT}D)"
    crossed = f"size(filter(edges, e -> {_crosses_row(south, east, FAR_EAST)}))"
    rows = rows.select(
        *key,
        F.lit(levels[0]).alias("level"),
        "cx",
        "cy",
        F.expr(f"filter(edges, e -> {_touches(size, 'cx', 'cy')})").alias("edges"),
        F.expr(f"{crossed} % 2 = 1").alias("inside"),
    ).where("inside OR size(edges) > 0")
    for level in levels[1:]:
        rows = _split(rows, key, level, capacity)
    return rows


def _touches(size: float, cx: str, cy: str) -> str:
    """Whether edge ``e`` meets the cell: their boxes meet, and not all corners are clearly on one side of the edge's line."""
    x, y = (f"(({c} + 0.5D) * {size!r}D + {SHIFT}D)" for c in (cx, cy))
    half = f"{size / 2 * (1 + 1e-9)!r}D"
    return (
        f"least(e.x1, e.x2) <= {x} + {half} AND greatest(e.x1, e.x2) >= {x} - {half}"
        f" AND least(e.y1, e.y2) <= {y} + {half} AND greatest(e.y1, e.y2) >= {y} - {half}"
        f" AND abs(({x} - e.x1) * (e.y2 - e.y1) - ({y} - e.y1) * (e.x2 - e.x1))"
        f" <= {half} * (abs(e.x2 - e.x1) + abs(e.y2 - e.y1))"
    )


def _split(rows: DataFrame, key: list[str], level: int, capacity: int) -> DataFrame:
    """Cells with too many edges of the level above, split: first into strips, then strips into cells."""
    whole, part = SIZES[level - 1], SIZES[level]
    east = f"((cx + 1) * {whole!r}D + {SHIFT}D)"
    south = f"(cy * {whole!r}D + {SHIFT}D)"
    at = f"((cy * {PARTS} + j) * {part!r}D + {SHIFT}D)"
    # A strip's corner is straight above the cell's, and a small cell's straight west of its strip's.
    strip = (
        f"named_struct('cy', cy * {PARTS} + j,"
        f" 'inside', inside <> (size(filter(edges, e -> {_crosses_column(east, south, at)})) % 2 = 1),"
        f" 'edges', filter(edges, e -> least(e.y1, e.y2) <= {at} + {part * (1 + 1e-9)!r}D AND greatest(e.y1, e.y2) >= {at} - {part * 1e-9!r}D))"
    )
    corner = f"((cx * {PARTS} + i + 1) * {part!r}D + {SHIFT}D)"
    crossed = _crosses_row(f"(s.cy * {part!r}D + {SHIFT}D)", corner, east)
    cell = (
        f"named_struct('level', {level}, 'cx', cx * {PARTS} + i, 'cy', s.cy,"
        f" 'edges', filter(s.edges, e -> {_touches(part, f'(cx * {PARTS} + i)', 's.cy')}),"
        f" 'inside', s.inside <> (size(filter(s.edges, e -> {crossed})) % 2 = 1))"
    )
    steps = f"sequence(0L, {PARTS - 1}L)"
    cells = f"filter(transform({steps}, i -> {cell}), c -> c.inside OR size(c.edges) > 0)"
    split = f"flatten(transform(transform({steps}, j -> {strip}), s -> {cells}))"
    same = "array(named_struct('level', level, 'cx', cx, 'cy', cy, 'edges', edges, 'inside', inside))"
    kept = f"if(level = {level - 1} AND size(edges) > {capacity}, {split}, {same})"
    return rows.select(*key, F.explode(F.expr(kept)).alias("c")).select(*key, "c.*")


def points_in_shapes(
    points: DataFrame,
    shapes: DataFrame,
    shape_key: list[str],
    match: list[str] | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """Every (point, shape) with the point inside; columns of the point plus ``shape_key``.

    ``shapes`` has ``polygons`` and the key columns. ``match`` names columns that must be
    equal on both sides, such as country_code to clip points to their own country. Points with a null, NaN or infinite
    coordinate lie in no shape.
    """
    match = match or []
    keys = list(dict.fromkeys([*shape_key, *match]))
    own = ["level", "cx", "cy", "edges", "inside", "east", "south"]
    names = free_names([f"_{name}" for name in own], points, shapes)
    level, cx, cy, edges, inside, east, south = names
    # Where no outline has more edges than a cell may have, cells of one size do.
    most = shapes.select(F.max(F.expr(f"size({outline_edges()})"))).first()[0] or 0
    levels = range(1, 2) if most <= capacity else range(len(SIZES))
    cells = outline_cells(shapes, keys, capacity, levels)
    size = f"element_at(array({', '.join(f'{s!r}D' for s in SIZES)}), level + 1)"
    sides = F.expr(f"(cx + 1) * {size} + {SHIFT}D").alias("east"), F.expr(f"cy * {size} + {SHIFT}D").alias("south")
    cells = cells.select("*", *sides).withColumnsRenamed(dict(zip(own, names)))
    place = lambda c, size: f"floor((double({c}) - {SHIFT}D) / {size!r}D)"
    at = {i: (place("longitude", SIZES[i]), place("latitude", SIZES[i])) for i in levels}
    located = points.where("abs(double(longitude)) < double('infinity') AND abs(double(latitude)) < double('infinity')")
    if len(at) == 1:
        ((x, y),) = at.values()
        placed, cells = located.withColumns({cx: F.expr(x), cy: F.expr(y)}), cells.drop(level)
    else:
        around = ", ".join(f"named_struct('{level}', {i}, '{cx}', {x}, '{cy}', {y})" for i, (x, y) in at.items())
        (key,) = free_names(["_at"], points, shapes)
        placed = located.select("*", F.explode(F.expr(f"array({around})")).alias(key)).select(*located.columns, f"{key}.*")
    crossed = f"{_crosses_column(east, south, 'double(latitude)')} <> {_crosses_row('double(latitude)', 'double(longitude)', east)}"
    hit = F.expr(f"{inside} <> (size(filter({edges}, e -> {crossed})) % 2 = 1)")
    on = [*match, *([level] if len(at) > 1 else []), cx, cy]
    return join_dimension(placed, cells, on).filter(hit).drop(*names)
