"""Spatial operators against brute force."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from attestry.functions.geo import parse_geometry
from attestry.operators import match


@pytest.mark.parametrize(
    ("text", "box"),
    [
        ('{"type":"Point","coordinates":[1,2]}', (1, 2, 1, 2)),
        ('{"type":"LineString","coordinates":[[1,2],[3,-4]]}', (1, -4, 3, 2)),
        ('{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,5],[0,0]]]}', (0, 0, 4, 5)),
        ('{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[8,8],[9,8],[9,9],[8,8]]]]}', (0, 0, 9, 9)),
        ('{"type":"Polygon","coordinates":"bad"}', None),
        ('{"type":"Polygon","coordinates":[]}', None),
        ('{"type":"Point","coordinates":[1]}', None),
        ('{"type":"Circle","coordinates":[1,2]}', None),
        ("not json", None),
        (None, None),
    ],
)
def test_parse_geometry(spark, text, box):
    g = spark.createDataFrame([(text,)], "t string").select(parse_geometry(F.col("t")).alias("g")).first().g
    assert (None if g is None else (g.min_x, g.min_y, g.max_x, g.max_y)) == box


def unit(lon, lat):
    a, b = math.radians(lon), math.radians(lat)
    return math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b)


def test_nearest_station_matches_brute_force(spark):
    rng = random.Random(5)
    crowd = [(10 + rng.random() / 1000, 50 + rng.random() / 1000) for _ in range(300)]
    stations = crowd + [(179.9, 0.0), (-179.9, 1.0), (0.0, 90.0), (45.0, -90.0), (0.0, 0.0), (0.0, 0.0)]
    points = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(150)] + crowd[:20] + [(-179.99, 0.1), (100.0, 89.9), (0.0, 0.0)]
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "point_id int, lon double, lat double")
    right = spark.createDataFrame([(i, *s) for i, s in enumerate(stations)], "station_id int, lon double, lat double")
    got = {r.point_id: r for r in match.nearest_station(left, right, "point_id", "station_id").collect()}
    assert len(got) == len(points)
    for i, p in enumerate(points):
        best = min(math.dist(unit(*p), unit(*s)) for s in stations)
        assert math.isclose(math.dist(unit(*p), unit(*stations[got[i].station_id])), best, abs_tol=1e-12)
    assert got[len(points) - 1].station_id == 304 and got[len(points) - 1].distance_m == 0


def test_points_move_once(spark):
    """One exchange of points and stations, whatever the depth; the others carry needs, stations of ranges and edges."""
    rng = random.Random(6)
    rows = lambda n: [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(n)]
    left, right = spark.createDataFrame(rows(400), "point_id int, lon double, lat double"), spark.createDataFrame(rows(50), "station_id int, lon double, lat double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = match.nearest_station(left, right, "point_id", "station_id")
        assert found.count() == 400
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = {m[1]: m[0] for m in re.findall(r"Exchange (.*?plan_id=(\d+))", plan)}
    assert [e for e in exchanges.values() if "point_id" in e] == []
    # The points, once, and the stations that were written by range.
    assert 1 <= sum("direct_shuffle_partition_id" in e for e in exchanges.values()) <= 2


def test_points_without_coordinates_or_stations(spark):
    left = spark.createDataFrame([(1, None, 2.0), (2, 1.0, 2.0), (2, 1.0, 2.0)], "point_id int, lon double, lat double")
    right = spark.createDataFrame([(7, 0.0, 0.0), (8, None, 0.0)], "station_id int, lon double, lat double")
    assert sorted((r.point_id, r.station_id) for r in match.nearest_station(left, right, "point_id", "station_id").collect()) == [(1, None), (2, 7)]
    assert {r.point_id for r in match.nearest_station(left, right.limit(0), "point_id", "station_id").filter("station_id IS NULL").collect()} == {1, 2}
    assert match.nearest_station(left.limit(0), right, "point_id", "station_id").collect() == []


def polygons(spark, rings):
    rows = [(i, '{"type":"Polygon","coordinates":[%s]}' % [list(p) for p in r]) for i, r in enumerate(rings)]
    df = spark.createDataFrame(rows, "area_id int, t string")
    return df.select("area_id", parse_geometry(F.col("t")).alias("geometry"))


def boxes(rng, n):
    out = []
    for _ in range(n):
        size = 10 ** rng.uniform(-2, 2)
        x, y = rng.uniform(-100, 100), rng.uniform(-50, 50)
        out.append((x, y, x + size, y + size * rng.uniform(0.2, 3)))
    return out


def ring(b):
    return [(b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3]), (b[0], b[1])]


def test_contains_and_intersects_match_brute_force(spark):
    rng = random.Random(3)
    areas = boxes(rng, 60)
    points = [(rng.uniform(-110, 110), rng.uniform(-60, 60)) for _ in range(400)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "point_id int, lon double, lat double")
    parsed = polygons(spark, [ring(b) for b in areas])
    got = {(r.point_id, r.area_id) for r in match.match_contains(df, parsed, "geometry").collect()}
    want = {(i, j) for i, (x, y) in enumerate(points) for j, b in enumerate(areas) if b[0] < x < b[2] and b[1] < y < b[3]}
    assert got == want and want
    pairs = [(r.area_id, r.other_area_id) for r in match.match_intersects(parsed, parsed, "area_id", "area_id").collect()]
    overlap = {(i, j) for i, a in enumerate(areas) for j, b in enumerate(areas) if a[0] < b[2] and b[0] < a[2] and a[1] < b[3] and b[1] < a[3]}
    assert len(pairs) == len(set(pairs)) and set(pairs) == overlap


def test_enforced_guard_fails(spark):
    facts = spark.createDataFrame([("k", "e1", True), ("k", "e2", True), ("z", "e2", False)], "k string, era string, geo boolean")
    context = spark.createDataFrame([("k", "e1")], "k string, context_era string")
    judged = match.guarded_join(facts, context, "k", F.col("geo"), "era", "context_era")
    assert sorted((r.refusal or "", r.context_era or "") for r in judged.collect()) == [("", "e1"), ("NO_GEOGRAPHY", ""), ("UNDECLARED_CROSS_ERA", "")]
    allowed = match.guarded_join(facts, context, "k", F.lit(True), "era", "context_era", declared=[("e2", "e1")])
    assert allowed.filter("refusal IS NOT NULL").isEmpty()
    with pytest.raises(Exception, match="refused join"):
        match.enforce(judged).collect()
    with pytest.raises(ValueError):
        match.era_union([facts])


def test_parts_and_holes_match_brute_force(spark):
    rng = random.Random(11)

    def parts(n):
        """Disjoint boxes side by side, each with a hole of half its size; as GeoJSON and as (outer, hole) pairs."""
        size, x, y = 2 ** rng.uniform(0, 4), rng.uniform(-60, 40), rng.uniform(-40, 20)
        boxes = [(x + 2 * k * size, y, x + (2 * k + 1) * size, y + size) for k in range(n)]
        return [(b, (b[0] + size / 4, b[1] + size / 4, b[2] - size / 4, b[3] - size / 4)) for b in boxes]

    shapes = [parts(1 + i % 4) for i in range(40)] + [[((0, 0, 16, 16), (4, 4, 12, 12))], [((6, 6, 10, 10), (7, 7, 9, 9))]]
    texts = ['{"type":"MultiPolygon","coordinates":%s}' % [[[list(p) for p in ring(b)] for b in part] for part in shape] for shape in shapes]
    rows = [*enumerate(texts), (900, '{"type":"LineString","coordinates":[[-99,-99],[99,-99],[99,99],[-99,99]]}'), (901, None)]
    df = spark.createDataFrame(rows, "area_id int, t string").select("area_id", parse_geometry(F.col("t")).alias("geometry"))

    def within(x, y, b):
        return b[0] < x < b[2] and b[1] < y < b[3]

    points = [(rng.uniform(-70, 120), rng.uniform(-50, 40)) for _ in range(600)] + [(8.1, 8.3), (6.5, 6.6), (2.2, 2.1)]
    placed = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "point_id int, lon double, lat double")
    got = [(r.point_id, r.area_id) for r in match.match_contains(placed, df, "geometry").collect()]
    want = {(i, j) for i, (x, y) in enumerate(points) for j, s in enumerate(shapes) if any(within(x, y, o) and not within(x, y, h) for o, h in s)}
    assert len(got) == len(set(got)) and set(got) == want

    def meet(a, b):
        return a[0] < b[2] and b[0] < a[2] and a[1] < b[3] and b[1] < a[3]

    def holds(outer, b):
        return outer[0] <= b[0] and b[2] <= outer[2] and outer[1] <= b[1] and b[3] <= outer[3]

    # Two frames share a point unless their boxes do not meet or one lies in the hole of the other.
    overlap = {
        (i, j) for i, a in enumerate(shapes) for j, b in enumerate(shapes)
        if any(meet(oa, ob) and not holds(ha, ob) and not holds(hb, oa) for oa, ha in a for ob, hb in b)
    }
    pairs = [(r.area_id, r.other_area_id) for r in match.match_intersects(df, df, "area_id", "area_id").collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == overlap and (40, 41) not in overlap
