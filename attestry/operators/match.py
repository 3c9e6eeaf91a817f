"""Guarded joins across sources, era handling and spatial matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.functions.geo import any_ring_inside, area_edges, chord_to_metres, edges_cross, ring_contains, unit_vector
from attestry.operators.segments import Ordered, join_on_key
from attestry.session import cut_lineage


def guarded_join(
    facts: DataFrame,
    context: DataFrame,
    key: str,
    has_geography: Column,
    fact_era: str,
    context_era: str,
    declared: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Left join whose forbidden rows are refused visibly.

    A fact from a source without geography, or of another era than its context without a declared
    method for that pair of eras, keeps its row with ``refusal`` set and no context columns.
    """
    pairs = [F.lit(a + "\x1f" + b) for a, b in declared]
    pair = F.concat(F.col(fact_era), F.lit("\x1f"), F.col(context_era))
    allowed = pair.isin(*pairs) if pairs else F.lit(False)
    joined = join_on_key(facts, context, [key], "left")
    crossing = F.col(context_era).isNotNull() & ~F.col(fact_era).eqNullSafe(F.col(context_era)) & ~F.coalesce(allowed, F.lit(False))
    refusal = F.when(~F.coalesce(has_geography, F.lit(False)), "NO_GEOGRAPHY").when(crossing, "UNDECLARED_CROSS_ERA")
    judged = joined.withColumn("refusal", refusal)
    extra = [c for c in context.columns if c != key]
    return judged.withColumns({c: F.when(F.col("refusal").isNull(), F.col(c)) for c in extra})


def enforce(judged: DataFrame) -> DataFrame:
    """Turn refusals into a failure of the job."""
    checked = F.when(F.col("refusal").isNotNull(), F.raise_error(F.concat(F.lit("refused join: "), F.col("refusal"))))
    return judged.withColumn("refusal", checked.cast("string"))


def era_union(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack era versions side by side; every part must name its era and source version."""
    out = None
    for part in parts:
        for name in ("era", "data_source_version_id"):
            if name not in part.columns:
                raise ValueError(f"era_union needs a column {name}")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("era_union needs at least one part")
    return out


def match_direct(points: DataFrame, areas: DataFrame, key: str) -> DataFrame:
    """DIRECT_KEY: equality on a shared key."""
    return points.join(areas, key)


_AXES = ("x", "y", "z")
_R = "__range"
#: Levels of the tree of cubes over the unit sphere: every fourth one, down to cubes of about 200 m.
_STEP, _DEEPEST = 4, 16


def _cells(level: int, df: DataFrame, prefix: str, axes: Sequence[str] = _AXES) -> DataFrame:
    size = 2.0 ** (1 - level)
    return df.withColumns({f"{prefix}{a}": F.floor((F.col(axis) + 1) / size) for a, axis in zip(_AXES, axes)})


def _curve(df: DataFrame) -> DataFrame:
    """Add ``__code``: the place of the row's smallest cube on a curve through all cubes. The curve runs through the 4,096 parts of a cube one
    after the other, and through the parts of each in the same way: a digit per axis and depth, the coarse ones first."""
    code = F.lit(0).cast("bigint")
    for depth in range(4, _DEEPEST + 1, 4):
        for a in _AXES:
            digit = F.least(F.floor((F.col(a) + 1) * 2.0 ** (depth - 1)), F.lit(2**depth - 1)) % 16
            code = code * 16 + digit.cast("bigint")
    return df.withColumn("__code", code)


def _gap(axes: Sequence[str]) -> Column:
    return sum(((F.col(a) - F.col(o)) * (F.col(a) - F.col(o)) for a, o in zip(_AXES, axes)), F.lit(0.0))


def _pruned(live: DataFrame, point_id: str, level: int) -> DataFrame:
    """Drop cubes of ``level`` whose nearest corner is beyond the farthest corner of the point's best cube; cubes of other levels wait."""
    size = 2.0 ** (1 - level)
    near, far = F.lit(0.0), F.lit(0.0)
    for a in _AXES:
        low = F.col(f"c{a}") * size - 1
        out = F.greatest(low - F.col(a), F.col(a) - (low + size), F.lit(0.0))
        reach = F.greatest(F.abs(F.col(a) - low), F.abs(F.col(a) - (low + size)))
        near, far = near + out * out, far + reach * reach
    here = F.col("__level") == level
    best = F.min(F.when(here, far)).over(Window.partitionBy(_R, point_id))
    kept = live.withColumns({"__near": near, "__best": best})
    return kept.filter(~here | (F.col("__near") <= F.col("__best") + 1e-12)).drop("__near", "__best")


def nearest_station(points: DataFrame, stations: DataFrame, point_id: str, station_id: str) -> DataFrame:
    """NEAREST_STATION: the closest station of every point, exactly, with the distance in metres.

    Points and stations are laid on one space-filling curve through the cubes of the unit sphere and dealt by ranges of it: that is
    the only exchange of points, made in each of two passes. In the first the stations next to a point on the curve bound its distance; the cubes that its ball touches (at most eight, of a
    size to fit) are what its range needs, and the stations of these cubes are written by range. In the second the points descend the
    tree of cubes: at each level a point keeps only cubes that can still hold its station, so the number kept is bounded by geometry,
    however many stations crowd one place. All joins and windows of the descent stay inside a range.

    Stations at one position count once (smallest id). A row per row of ``points``, equal rows once; rows without coordinates, and all
    rows when there is no station, have a null station.
    """
    where = unit_vector(F.col("lon"), F.col("lat"))
    spots = stations.withColumns(where).groupBy(*_AXES).agg(F.min(station_id).alias(station_id)).filter("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")
    placed = points.select(point_id, *[v.alias(a) for a, v in where.items()])
    lost = F.col("x").isNull() | F.col("y").isNull() | F.col("z").isNull()
    kinds = {station_id: dict(spots.dtypes)[station_id], point_id: dict(points.dtypes)[point_id]}
    line = placed.filter(~lost).select(*_AXES, F.col(point_id).alias("__p"), F.lit(None).cast(kinds[station_id]).alias("__s"))
    line = _curve(line.unionByName(spots.select(*_AXES, F.lit(None).cast(kinds[point_id]).alias("__p"), F.col(station_id).alias("__s"))))
    station = F.col("__s").isNotNull()
    dealt = Ordered(line, [], ["__code", "__s", "__p"]).between(F.when(station, F.struct(*_AXES)), "__a", "__b")
    bound = F.sqrt(F.least(*[_gap([f"{side}.{a}" for a in _AXES]) for side in ("__a", "__b")])) * (1 + 1e-9) + 1e-12
    asked = dealt.filter(~station).dealt.select(_R, F.col("__p").alias(point_id), *_AXES, bound.alias("__d"))
    # Cubes at least as wide as the ball: two along each axis at most.
    fitting = F.greatest(F.least(F.floor(-F.log2("__d") / _STEP) * _STEP, F.lit(_DEEPEST)), F.lit(0))
    sized = asked.filter("__d IS NOT NULL").withColumn("__level", fitting.cast("int")).withColumn("__size", F.pow(F.lit(2.0), 1 - F.col("__level")))
    touched = [F.sequence(*[F.floor((F.col(a) + side * F.col("__d") + 1) / F.col("__size")) for side in (-1, 1)]) for a in _AXES]
    cells = F.flatten(F.transform(touched[0], lambda x: F.flatten(F.transform(touched[1], lambda y: F.transform(touched[2], lambda z: F.struct(x.alias("cx"), y.alias("cy"), z.alias("cz")))))))
    live = sized.select(_R, point_id, *_AXES, "__level", F.inline(cells))
    cube = [f"c{a}" for a in _AXES]
    needed = live.select(_R, "__level", *cube).distinct()
    levels = range(0, _DEEPEST + 1, _STEP)
    every = spots.withColumn("__level", F.explode(F.array(*[F.lit(n) for n in levels])))
    every = every.withColumns({f"c{a}": F.floor((F.col(a) + 1) / F.pow(F.lit(2.0), 1 - F.col("__level"))) for a in _AXES})
    own = [F.col(a).alias(f"s{a}") for a in _AXES]
    # Written once: five joins read them, and the plan of each stays short.
    sent = cut_lineage(needed.join(every, ["__level", *cube]).select(_R, station_id, *own).distinct()).repartitionById(dealt.n, _R)
    corner = [f"s{a}" for a in _AXES]
    for level in levels[:-1]:
        cubes = _cells(level + _STEP, _cells(level, sent, "c", corner), "n", corner)
        cubes = cubes.select(_R, F.lit(level).alias("__level"), *cube, *[f"n{a}" for a in _AXES]).distinct()
        # Rows of a smaller cube have no match and go on as they are; of those at this level only cubes with stations stay.
        grown = live.join(cubes, [_R, "__level", *cube], "left").filter((F.col("__level") != level) | F.col("nx").isNotNull())
        live = grown.select(
            _R, point_id, *_AXES, F.when(F.col("nx").isNotNull(), level + _STEP).otherwise(F.col("__level")).alias("__level"), *[F.coalesce(f"n{a}", f"c{a}").alias(f"c{a}") for a in _AXES]
        )
        live = _pruned(live, point_id, level + _STEP)
    leaves = _cells(_DEEPEST, sent, "c", corner)
    found = (
        live.join(leaves, [_R, *cube])
        .withColumn("__chord", F.sqrt(_gap(corner)))
        .groupBy(_R, point_id, *_AXES)
        .agg(F.min(F.struct("__chord", station_id)).alias("m"))
        .select(point_id, F.col(f"m.{station_id}").alias(station_id), chord_to_metres(F.col("m.__chord")).alias("distance_m"))
    )
    unmatched = asked.filter("__d IS NULL").select(point_id).unionByName(placed.filter(lost).select(point_id))
    return found.unionByName(unmatched, allowMissingColumns=True)


def _areas(df: DataFrame, geometry: str) -> DataFrame:
    """Rows whose geometry has an inside."""
    return df.filter(F.col(f"{geometry}.type").isin("Polygon", "MultiPolygon"))


def _box_level(geometry: str) -> Column:
    span = F.greatest(
        F.col(f"{geometry}.max_x") - F.col(f"{geometry}.min_x"), F.col(f"{geometry}.max_y") - F.col(f"{geometry}.min_y")
    )
    return F.greatest(F.ceil(F.log2(F.greatest(span, F.lit(1e-9)) / 4)), F.lit(-20)).cast("int")


def _cover(df: DataFrame, geometry: str, level: Column) -> DataFrame:
    """Grid cells of a box at ``level``: at most five per axis at the box's own level."""
    size = F.pow(F.lit(2.0), level)

    def span(axis: str) -> Column:
        low, high = F.floor(F.col(f"{geometry}.min_{axis}") / size), F.floor(F.col(f"{geometry}.max_{axis}") / size)
        return F.sequence(low, high)

    return df.withColumn("__cx", F.explode(span("x"))).withColumn("__cy", F.explode(span("y")))


def match_contains(points: DataFrame, areas: DataFrame, geometry: str) -> DataFrame:
    """CONTAINS: points joined to the areas (parsed geometry of any parts and holes) that contain them.

    Every area is laid on the grid whose cells fit its own size; a point looks up its cell once
    per grid in use (at most a few dozen). Only points of a cell meet the areas of that cell.
    """
    sized = _areas(areas, geometry).withColumn("__level", _box_level(geometry))
    levels = sized.agg(F.collect_set("__level").alias("levels")).scalar()
    covered = _cover(sized, geometry, F.col("__level")).withColumn("__edges", area_edges(F.col(f"{geometry}.rings")))
    placed = points.withColumn("__level", F.explode(levels))
    size = F.pow(F.lit(2.0), F.col("__level"))
    placed = placed.withColumns({"__cx": F.floor(F.col("lon") / size), "__cy": F.floor(F.col("lat") / size)})
    box = F.col("lon").between(F.col(f"{geometry}.min_x"), F.col(f"{geometry}.max_x")) & F.col("lat").between(
        F.col(f"{geometry}.min_y"), F.col(f"{geometry}.max_y")
    )
    met = placed.join(covered, ["__level", "__cx", "__cy"])
    return met.filter(box & ring_contains(F.col("__edges"), F.col("lon"), F.col("lat"))).drop(
        "__level", "__cx", "__cy", "__edges"
    )


def match_intersects(left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """INTERSECTS: pairs of areas that share a point: their rings cross, or a ring of one lies inside the other.

    A pair meets on the coarser grid of the two, in the one cell that holds the lower corner of
    their common box, so no pair is produced twice.
    """

    def prepare(df: DataFrame, name: str, ident: str) -> DataFrame:
        return _areas(df, "geometry").select(F.col(ident).alias(f"__{name}_id"), F.col("geometry").alias(f"__{name}")).withColumns(
            {f"__{name}_level": _box_level(f"__{name}"), f"__{name}_edges": area_edges(F.col(f"__{name}.rings"))}
        )

    a, b = prepare(left, "a", left_id), prepare(right, "b", right_id)
    levels = (
        a.select(F.col("__a_level").alias("l")).unionByName(b.select(F.col("__b_level").alias("l"))).agg(F.collect_set("l")).scalar()
    )

    def spread(df: DataFrame, name: str) -> DataFrame:
        placed = df.withColumn("__level", F.explode(levels)).filter(F.col("__level") >= F.col(f"__{name}_level"))
        return _cover(placed, f"__{name}", F.col("__level"))

    met = spread(a, "a").join(spread(b, "b"), ["__level", "__cx", "__cy"])
    size = F.pow(F.lit(2.0), F.col("__level"))
    corner_x = F.greatest(F.col("__a.min_x"), F.col("__b.min_x"))
    corner_y = F.greatest(F.col("__a.min_y"), F.col("__b.min_y"))
    boxes = (corner_x <= F.least(F.col("__a.max_x"), F.col("__b.max_x"))) & (
        corner_y <= F.least(F.col("__a.max_y"), F.col("__b.max_y"))
    )
    once = (F.floor(corner_x / size) == F.col("__cx")) & (F.floor(corner_y / size) == F.col("__cy"))
    met = met.filter((F.col("__level") == F.greatest("__a_level", "__b_level")) & boxes & once)
    ea, eb = F.col("__a_edges"), F.col("__b_edges")
    touch = edges_cross(ea, eb) | any_ring_inside(F.col("__a.rings"), eb) | any_ring_inside(F.col("__b.rings"), ea)
    return met.filter(touch).select(F.col("__a_id").alias(left_id), F.col("__b_id").alias(f"other_{right_id}"))


def match_area_weighted(values: DataFrame, weights: DataFrame, source: str, target: str, measure: str) -> DataFrame:
    """AREA_WEIGHTED: weighted mean of source areas per target area; missing values take no weight."""
    joined = join_on_key(values, weights, [source], "inner")
    has = F.col(measure).isNotNull()
    base = F.sum(F.when(has, F.col("weight")))
    return joined.groupBy(target).agg(
        F.when(base != 0, F.sum(F.when(has, F.col(measure) * F.col("weight"))) / base).alias(measure),
        F.count_if(has).alias("n_sources"),
        F.count_if(~has).alias("n_missing"),
    )
