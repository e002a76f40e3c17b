"""Distances, buffers and containment as plain column expressions.

Points are (longitude, latitude) in degrees: x is longitude.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# A disc buffer has 16 segments per quarter turn; mean Earth radius.
BUFFER_SEGMENTS = 64
EARTH_RADIUS_KM = 6371.0088

METRICS = ("polygon_deg", "circle_deg", "km")

# A point this close to the rim, relative to the radius, lies on it and is not inside.
# Far above rounding error and far below any coordinate's precision, so that a point
# exactly on the rim is never decided by rounding.
RIM = 1e-12


def ring(lon: Column, lat: Column, radius: float) -> Column:
    """Closed ring of the buffer polygon around a point: 65 positions, clockwise from east."""
    step = -2 * math.pi / BUFFER_SEGMENTS
    return F.transform(
        F.sequence(F.lit(0), F.lit(BUFFER_SEGMENTS)),
        lambda i: F.struct(
            (lon + F.lit(radius) * F.cos(i * F.lit(step))).alias("lon"),
            (lat + F.lit(radius) * F.sin(i * F.lit(step))).alias("lat"),
        ),
    )


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_dlon), 2
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


@dataclass(frozen=True)
class Disc:
    """A radius under one metric, in the coordinates the search grid uses.

    ``reach`` bounds every inside point, ``core`` is a distance below which every
    point is inside. Both are Euclidean distances between ``coordinates``.
    """

    metric: str
    radius: float

    def __post_init__(self):
        if self.metric not in METRICS:
            raise ValueError(f"unknown metric {self.metric!r}; known: {', '.join(METRICS)}")
        if not self.radius > 0:
            raise ValueError("radius must be positive")

    @property
    def dimensions(self) -> int:
        return 3 if self.metric == "km" else 2

    @property
    def reach(self) -> float:
        if self.metric == "km":
            # Straight-line distance on the unit sphere: no seam at 180 degrees or the poles.
            return 2 * math.sin(min(self.radius / (2 * EARTH_RADIUS_KM), math.pi / 2))
        return self.radius

    @property
    def core(self) -> float:
        if self.metric == "polygon_deg":
            return self.radius * math.cos(math.pi / BUFFER_SEGMENTS)
        return self.reach

    def coordinates(self, lon: Column, lat: Column) -> list[Column]:
        if self.metric != "km":
            return [lon, lat]
        lam, phi = F.radians(lon), F.radians(lat)
        return [F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)]

    def contains(self, lon: Column, lat: Column, other_lon: Column, other_lat: Column) -> Column:
        """Whether the other point lies strictly inside the disc around (lon, lat)."""
        limit = self.radius * (1 - RIM)
        if self.metric == "km":
            return haversine_km(lon, lat, other_lon, other_lat) < limit
        dx, dy = other_lon - lon, other_lat - lat
        square = dx * dx + dy * dy
        if self.metric == "circle_deg":
            return square < limit * limit
        # Inside the polygon: the part of the offset along the normal of its side is
        # shorter than the distance from centre to side. Only offsets between that
        # distance and the radius depend on the direction.
        sector = 2 * math.pi / BUFFER_SEGMENTS
        off_normal = F.pmod(F.atan2(dy, dx) + F.lit(2 * math.pi), F.lit(sector)) - F.lit(sector / 2)
        core = self.core * (1 - RIM)
        return (square < core * core) | (
            (square < limit * limit) & (F.sqrt(square) * F.cos(off_normal) < core)
        )


def crossings(lon: Column, lat: Column, edges: Column) -> Column:
    """Number of edges a ray going east from the point crosses; odd means inside.

    ``edges`` is an array of structs x1, y1, x2, y2 without horizontal edges.
    """

    def crosses(e: Column) -> Column:
        straddles = (e["y1"] > lat) != (e["y2"] > lat)
        at = e["x1"] + F.try_divide((lat - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"])
        return straddles & (lon < at)

    return F.size(F.filter(edges, crosses))
