"""GeoJSON parsing and plane and sphere geometry as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8

# Nesting depth of ``coordinates`` for each geometry type.
_DEPTH = {
    "Point": 0,
    "MultiPoint": 1,
    "LineString": 1,
    "Polygon": 2,
    "MultiLineString": 2,
    "MultiPolygon": 3,
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _rings(coordinates: Column, depth: int) -> Column:
    """Coordinates of any depth as a list of point chains: the rings of all parts, or the one chain of simpler geometries."""
    kind = "array<double>"
    for _ in range(depth):
        kind = f"array<{kind}>"
    parsed = F.from_json(coordinates, kind)
    if depth == 3:
        return F.flatten(parsed)
    return parsed if depth == 2 else F.array(F.array(parsed)) if depth == 0 else F.array(parsed)


def _box(kind: Column, rings: Column) -> Column:
    points = F.flatten(rings)
    sound = (F.size(points) > 0) & F.forall(
        points, lambda p: (F.size(p) >= 2) & F.get(p, 0).isNotNull() & F.get(p, 1).isNotNull()
    )
    xs, ys = F.transform(points, lambda p: F.get(p, 0)), F.transform(points, lambda p: F.get(p, 1))
    return F.when(
        F.coalesce(sound, F.lit(False)),
        F.struct(
            kind.alias("type"),
            F.filter(rings, lambda r: F.size(r) > 0).alias("rings"),
            F.array_min(xs).alias("min_x"),
            F.array_min(ys).alias("min_y"),
            F.array_max(xs).alias("max_x"),
            F.array_max(ys).alias("max_y"),
        ),
    )


def parse_geometry(geojson: Column) -> Column:
    """Struct of type, rings and bounding box; null for text that is not a usable geometry.

    The rings of all parts stand side by side, outer ones and holes alike: which is which follows from
    the parity of crossings. Points and lines are one chain; empty rings are left out.
    """
    kind = F.get_json_object(geojson, "$.type")
    coordinates = F.get_json_object(geojson, "$.coordinates")
    rings = F.when(F.lit(False), F.lit(None).cast("array<array<array<double>>>"))
    for name, depth in _DEPTH.items():
        rings = rings.when(kind == name, _rings(coordinates, depth))
    return let(F.struct(kind.alias("kind"), rings.alias("rings")), lambda g: _box(g["kind"], g["rings"]))


def unit_vector(lon: Column, lat: Column) -> dict[str, Column]:
    """Position on the unit sphere: no seam at the date line and no thinning at the poles."""
    lam, phi = F.radians(lon), F.radians(lat)
    return {"x": F.cos(phi) * F.cos(lam), "y": F.cos(phi) * F.sin(lam), "z": F.sin(phi)}


def chord_to_metres(chord: Column) -> Column:
    """Great-circle distance of two points whose unit vectors are ``chord`` apart."""
    return F.asin(F.least(chord / 2, F.lit(1.0))) * 2 * EARTH_RADIUS_M


def ring_edges(ring: Column) -> Column:
    """Edges of a ring as structs; the ring is closed if its last point is not its first."""
    closed = F.when(F.element_at(ring, 1) == F.element_at(ring, -1), ring).otherwise(
        F.concat(ring, F.array(F.element_at(ring, 1)))
    )
    return F.zip_with(
        F.slice(closed, 1, F.size(closed) - 1),
        F.slice(closed, 2, F.size(closed) - 1),
        lambda a, b: F.struct(
            F.get(a, 0).alias("ax"), F.get(a, 1).alias("ay"), F.get(b, 0).alias("bx"), F.get(b, 1).alias("by")
        ),
    )


def area_edges(rings: Column) -> Column:
    """Edges of all rings of an area; no edge joins one ring to the next."""
    return F.flatten(F.transform(rings, ring_edges))


def any_ring_inside(rings: Column, edges: Column) -> Column:
    """Whether the first point of any ring lies inside the area with these edges."""
    return F.exists(rings, lambda r: ring_contains(edges, F.get(F.get(r, 0), 0), F.get(F.get(r, 0), 1)))


def ring_contains(edges: Column, x: Column, y: Column) -> Column:
    """Ray casting: a point is inside if a ray to the right crosses an odd number of edges.

    Over the edges of all rings this is right for holes and for parts that do not overlap.
    """

    def crosses(e: Column) -> Column:
        at = (e["bx"] - e["ax"]) * (y - e["ay"]) / (e["by"] - e["ay"]) + e["ax"]
        return ((e["ay"] > y) != (e["by"] > y)) & F.when(e["ay"] == e["by"], F.lit(False)).otherwise(x < at)

    return F.size(F.filter(edges, crosses)) % 2 == 1


def _turn(px: Column, py: Column, qx: Column, qy: Column, rx: Column, ry: Column) -> Column:
    return F.signum((qx - px) * (ry - py) - (qy - py) * (rx - px))


def edges_cross(left: Column, right: Column) -> Column:
    """Whether any edge of one area properly crosses an edge of the other."""

    def pair(a: Column, b: Column) -> Column:
        one = _turn(a["ax"], a["ay"], a["bx"], a["by"], b["ax"], b["ay"])
        two = _turn(a["ax"], a["ay"], a["bx"], a["by"], b["bx"], b["by"])
        three = _turn(b["ax"], b["ay"], b["bx"], b["by"], a["ax"], a["ay"])
        four = _turn(b["ax"], b["ay"], b["bx"], b["by"], a["bx"], a["by"])
        return (one != two) & (three != four)

    return F.exists(left, lambda a: F.exists(right, lambda b: pair(a, b)))
