"""Nearest, k-nearest, radius and point-to-line joins over a nested cell grid.

All four joins work on pairs of *occupied cells*, coarse to fine.  A pair of cells has a
lower and an upper bound on the distance of its points; pairs that cannot matter are
dropped, the rest go on to the next level as equi-joins on the parent cell.  Rows meet
rows only in the finest cells, whose size is chosen from the data so that none of them
holds more than a fixed number of distinct points.  Copies of one coordinate are folded
into a single point first, so neither dense areas nor repeated points make a large group.
"""
from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accessgrid.functions import scalars as fx
from accessgrid.functions.scalars import finite
from accessgrid.functions.geodesy import (
    EARTH_RADIUS_MILES,
    METERS_PER_MILE,
    albers_xy,
    angles,
    chord_of_miles,
    haversine_of_angles,
    miles_of_haversine,
    point_segment_distance,
    unit_vector,
)
from accessgrid.operators.lookup import HOT_SALTS, SALTS, hot_keys, lookup_left
from accessgrid.storage import importable, materialize

MAX_LEVEL = 28
FIRST_LEVEL = 3
LEVEL_STEP = 2
QUERY_CELL_POINTS = 4096
TARGET_CELL_POINTS = 8
LINE_CELL_POINTS = 16
BLOCK_POINTS = 512
CANDIDATES_PER_ROW = 512
POINTS_PER_TASK = 2000
GROUPS_PER_PARTITION = 4
GROUP_LEVELS = 3
RELATIVE_SLACK = 1e-7
ABSOLUTE_SLACK = 1e-12


@dataclass(frozen=True)
class Grid:
    """Square (or cubic) root box and the level of its finest cells."""

    low: tuple[float, ...]
    extent: float
    level: int
    points: int = 0

    def cell_side(self, level: int) -> float:
        return self.extent / 2**level

    def levels(self) -> list[int]:
        first = min(FIRST_LEVEL, self.level)
        steps = list(range(first, self.level, LEVEL_STEP))
        return [*steps, self.level]


def _axes(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if c.startswith("_x"))


def _with_axes(df: DataFrame, axes: list[Column]) -> DataFrame:
    return df.select("*", *[a.alias(f"_x{i}") for i, a in enumerate(axes)])


def _cell_columns(grid: Grid, axes: list[str], level: int) -> list[Column]:
    top = 2**level - 1
    return [
        F.least(
            F.floor((F.col(a) - F.lit(low)) / F.lit(grid.cell_side(level))).cast("int"), F.lit(top)
        ).alias(f"_c{i}")
        for i, (a, low) in enumerate(zip(axes, grid.low))
    ]


def _fullest_cells(sides: list[DataFrame], grid: Grid, axes: list[str], level: int) -> list[int]:
    """Points in the fullest cell of each side, from one job."""
    cells = _cell_columns(grid, axes, level)
    fullest = [
        df.groupBy(*cells).count().agg(F.lit(i).alias("side"), F.max("count").alias("m"))
        for i, df in enumerate(sides)
    ]
    found = reduce(DataFrame.unionByName, fullest).collect()
    return [r["m"] or 0 for r in sorted(found, key=lambda r: r["side"])]


def fit_grid(sides: list[tuple[DataFrame, int]]) -> Grid:
    """Root box of all sides and a level at which no cell is over its side's point limit."""
    frames, limits = [df for df, _ in sides], [limit for _, limit in sides]
    axes = _axes(frames[0])
    ends = [f(a).alias(n + a) for a in axes for f, n in ((F.min, "lo"), (F.max, "hi"))]
    bounds = [df.agg(F.lit(i).alias("side"), F.count(F.lit(1)).alias("n"), *ends) for i, df in enumerate(frames)]
    bounds = sorted(reduce(DataFrame.unionByName, bounds).collect(), key=lambda b: b["side"])
    filled = [b for b in bounds if b["n"]]
    if not filled:
        return Grid(tuple(0.0 for _ in axes), 1.0, 0)
    low = tuple(min(b[f"lo{a}"] for b in filled) for a in axes)
    high = tuple(max(b[f"hi{a}"] for b in filled) for a in axes)
    extent = max(max(h - lo for h, lo in zip(high, low)), 1e-12) * (1 + 1e-9)
    grid = Grid(low, extent, 0)
    level, fullest = 0, [b["n"] for b in bounds]
    # Points spread over a surface, so one level more holds about a quarter of them.
    while level < MAX_LEVEL and any(f > limit for f, limit in zip(fullest, limits)):
        over = max(f / limit for f, limit in zip(fullest, limits))
        level = min(MAX_LEVEL, level + max(1, math.ceil(math.log(over, 4))))
        fullest = _fullest_cells(frames, grid, axes, level)
    return Grid(low, extent, level, sum(b["n"] for b in bounds))


def _leaf_cells(df: DataFrame, grid: Grid) -> DataFrame:
    return df.select("*", *_cell_columns(grid, _axes(df), grid.level))


def _finest_cells(leaf: DataFrame, dims: int, prefix: str, aggs: list[Column]) -> DataFrame:
    """Occupied finest cells with the box their points really fill.

    The points are read for this once; all coarser levels are built from these cells.
    """
    ends = {"lo": F.min, "hi": F.max}
    box = [
        f(f"_x{i}").alias(f"{prefix}_{end}{i}")
        for i in range(dims)
        for end, f in ends.items()
    ]
    cells = [F.col(f"_c{i}").alias(f"{prefix}{i}") for i in range(dims)]
    return materialize(leaf.groupBy(*cells).agg(*aggs, *box))


def _cells_at(finest: DataFrame, dims: int, shift: int, prefix: str, aggs: list[Column]) -> DataFrame:
    """The cells some levels above the finest ones; ``aggs`` are sums or extremes of their own results."""
    cells = [F.shiftright(f"{prefix}{i}", shift).alias(f"{prefix}{i}") for i in range(dims)]
    box = [
        f(f"{prefix}_{end}{i}").alias(f"{prefix}_{end}{i}")
        for i in range(dims)
        for f, end in ((F.min, "lo"), (F.max, "hi"))
    ]
    return finest.groupBy(*cells).agg(*aggs, *box)


def _pair_bounds(dims: int) -> tuple[Column, Column]:
    """Least and greatest distance between the points of two boxes."""
    gaps, spans = [], []
    for i in range(dims):
        right = F.col(f"t_lo{i}") - F.col(f"q_hi{i}")
        left = F.col(f"q_lo{i}") - F.col(f"t_hi{i}")
        gaps.append(F.greatest(right, left, F.lit(0.0)))
        spans.append(F.greatest(F.col(f"t_hi{i}") - F.col(f"q_lo{i}"), F.col(f"q_hi{i}") - F.col(f"t_lo{i}")))
    low, high = (F.sqrt(reduce(Column.__add__, [d * d for d in ds])) for ds in (gaps, spans))
    return low, high


def _next_pairs(
    open_pairs: DataFrame | None,
    q_cells: DataFrame,
    t_cells: DataFrame,
    grid: Grid,
    level: int,
    previous: int,
    target_aggs: list[Column],
) -> DataFrame:
    """Children of the open cell pairs at ``level`` with their distance bounds."""
    dims = len(grid.low)
    q = _cells_at(q_cells, dims, grid.level - level, "q", [])
    t = _cells_at(t_cells, dims, grid.level - level, "t", target_aggs)
    step = level - previous

    def parent(prefix: str) -> list[Column]:
        return [F.shiftright(f"{prefix}{i}", step).alias(f"p{prefix}{i}") for i in range(dims)]

    q = q.select("*", *parent("q"))
    t = t.select("*", *parent("t"))
    pq, pt = [f"pq{i}" for i in range(dims)], [f"pt{i}" for i in range(dims)]
    if open_pairs is None:
        # All first-level cells share the root cell: at most 8 per axis on either side.
        on = reduce(Column.__and__, [F.col(a) == F.col(b) for a, b in zip(pq, pt)])
        pairs = q.join(t, on)
    else:
        renamed = open_pairs.select(
            *[F.col(f"q{i}").alias(pq[i]) for i in range(dims)],
            *[F.col(f"t{i}").alias(pt[i]) for i in range(dims)],
        )
        pairs = _spread_out(renamed, pq, grid).join(q, pq).join(t, pt)
    low, high = _pair_bounds(dims)
    boxes = [f"{p}_{end}{i}" for p in "qt" for end in ("lo", "hi") for i in range(dims)]
    return pairs.withColumns({"low": low, "high": high}).drop(*pq, *pt, *boxes)


def _nearest_candidates(
    queries: DataFrame, targets: DataFrame, grid: Grid, k: int, payload: list[str], held: str | None = None
) -> DataFrame:
    """Query points with all targets that can be among their k nearest, as arrays.

    ``held`` names the column with the number of rows a target stands for, else it is one.

    Returns the query columns and ``near``, an array of target structs.  A finest cell's
    targets travel as one short array, and the arrays a query cell needs are put together
    once for all its points, so no (point, target) rows are shuffled.  Where a query cell
    needs many targets they come in several rows of about ``CANDIDATES_PER_ROW`` each.
    """
    dims = len(grid.low)
    q_key, t_key = [f"q{i}" for i in range(dims)], [f"t{i}" for i in range(dims)]
    q_cells = _finest_cells(queries, dims, "q", [])
    stands_for = F.col(held) if held else F.lit(1)
    t_boxes = _finest_cells(targets, dims, "t", [F.sum(stands_for).alias("n")])
    pairs, previous = None, 0
    for level in grid.levels():
        pairs = _next_pairs(pairs, q_cells, t_boxes, grid, level, previous, [F.sum("n").alias("n")])
        if level == grid.level:
            pairs = _spread_out(pairs, q_key, grid)  # the window below needs no other shuffle
        by_cell = Window.partitionBy(*q_key)
        if k == 1:
            pairs = pairs.withColumn("reach", F.min("high").over(by_cell))
        else:
            # The first distance within which cells hold k targets bounds the k-th nearest.
            nearer = by_cell.orderBy("high").rangeBetween(Window.unboundedPreceding, Window.currentRow)
            pairs = pairs.withColumn("held", F.sum("n").over(nearer))
            enough = F.when(F.col("held") >= k, F.col("high"))
            pairs = pairs.withColumn("reach", F.min(enough).over(by_cell))
        reach = F.col("reach") * (1 + RELATIVE_SLACK) + grid.extent * ABSOLUTE_SLACK
        pairs = pairs.where(F.col("reach").isNull() | (F.col("low") <= reach))
        if level == grid.level:
            rows = F.ceil(F.sum("n").over(by_cell) / CANDIDATES_PER_ROW)
            pairs = pairs.withColumn("near_row", F.pmod(F.xxhash64(*t_key), rows))
        pairs = pairs.drop("low", "high", "held", "reach", "n")
        previous = level
    t_cells = targets.withColumnsRenamed({f"_c{i}": c for i, c in enumerate(t_key)})
    t_cells = t_cells.groupBy(*t_key).agg(F.collect_list(F.struct(*payload)).alias("cell"))
    near = pairs.join(t_cells, t_key).groupBy(*q_key, "near_row")
    near = near.agg(F.flatten(F.collect_list("cell")).alias("near"))
    points = queries.withColumnsRenamed({f"_c{i}": c for i, c in enumerate(q_key)})
    return points.join(near, q_key).drop(*q_key, *[f"_x{i}" for i in range(dims)], "near_row")


def _spread_out(pairs: DataFrame, q_key: list[str], grid: Grid) -> DataFrame:
    """Cell pairs in as many partitions as their points are worth, up to the session's.

    A pair of cells is a few bytes that become many rows, so the size of the pairs must not
    decide how many tasks there are.
    """
    most = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(max(1, min(most, grid.points // POINTS_PER_TASK)), *q_key)


def _coordinates(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Distinct usable coordinates and how many rows have them."""
    return (
        df.select(F.col(lat).alias("q_lat"), F.col(lon).alias("q_lon"))
        .where(F.col("q_lat").isNotNull() & F.col("q_lon").isNotNull())
        .where(finite(F.col("q_lat")) & finite(F.col("q_lon")))
        .groupBy("q_lat", "q_lon")
        .agg(F.count(F.lit(1)).alias("q_rows"))
    )


def _finest(queries: DataFrame, targets: DataFrame) -> tuple[Grid, DataFrame, DataFrame]:
    queries, targets = materialize(queries), materialize(targets)
    grid = fit_grid([(targets, TARGET_CELL_POINTS), (queries, QUERY_CELL_POINTS)])
    return grid, _leaf_cells(queries, grid), _leaf_cells(targets, grid)


def attach_by_place(
    df: DataFrame, found: DataFrame, places: DataFrame | None = None, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Per-coordinate results back on the rows; rows without coordinates get NULL."""
    names = {"q_lat": lat, "q_lon": lon}
    places = _coordinates(df, lat, lon) if places is None else places
    hot = hot_keys(places.withColumnsRenamed(names), [lat, lon], "q_rows")
    return lookup_left(
        df, found.withColumnsRenamed(names), [lat, lon], salts=HOT_SALTS, hot=hot
    )


def nearest_point(
    df: DataFrame,
    sites: DataFrame,
    site_id: str,
    lat: str = "lat",
    lon: str = "lon",
    distance: str = "nearest_miles",
    nearest: str = "nearest_id",
) -> DataFrame:
    """Each row with the haversine miles to its nearest site and that site's id.

    Sites that share a coordinate count as the one with the smallest id; so do ties.
    """
    queries = _with_axes(_coordinates(df, lat, lon), unit_vector(F.col("q_lat"), F.col("q_lon")))
    targets = (
        sites.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .where(finite(F.col(lat)) & finite(F.col(lon)))
        .groupBy(F.col(lat).alias("t_lat"), F.col(lon).alias("t_lon"))
        .agg(F.min(site_id).alias("t_id"))
    )
    targets = _with_axes(targets, unit_vector(F.col("t_lat"), F.col("t_lon")))
    grid, queries, targets = _finest(queries, targets)
    names = ["phi", "lam", "cos"]
    target_angles = [a.alias(n) for a, n in zip(angles(F.col("t_lat"), F.col("t_lon")), names)]
    targets = targets.select("*", *target_angles)
    near = _nearest_candidates(queries, targets, grid, 1, [*names, "t_id"])
    own = [a.alias(n) for a, n in zip(angles(F.col("q_lat"), F.col("q_lon")), names)]
    # The smallest haversine is the smallest distance; the arc is taken of the winner only.
    hits = F.transform(
        "near",
        lambda t: F.struct(
            haversine_of_angles([F.col(n) for n in names], [t[n] for n in names]).alias("h"),
            t["t_id"].alias("t_id"),
        ),
    )
    best = (
        near.select("q_lat", "q_lon", "near", *own)
        .select("q_lat", "q_lon", F.array_min(hits).alias("hit"))
        .groupBy("q_lat", "q_lon")
        .agg(F.min("hit").alias("hit"))
        .select(
            "q_lat",
            "q_lon",
            miles_of_haversine(F.col("hit.h")).alias(distance),
            F.col("hit.t_id").alias(nearest),
        )
    )
    return attach_by_place(df, best, queries, lat, lon)


def nearest_neighbours(
    df: DataFrame, key: str, k: int, payload: list[str], lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """The k nearest rows (the row itself included) of every distinct coordinate.

    Distance is Euclidean in degrees; ties go to the smaller key.  All rows of one
    coordinate have the same neighbours, and only the k smallest keys of a coordinate can
    be anyone's neighbours, so copies are cut to those before anything is paired.
    Returns q_lat, q_lon, neighbour key, squared distance, payload, position 1..k.
    """
    usable = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    usable = usable.where(finite(F.col(lat)) & finite(F.col(lon)))
    queries = _with_axes(_coordinates(usable, lat, lon), [F.col("q_lat"), F.col("q_lon")])
    same_place = Window.partitionBy(lat, lon).orderBy(key)
    # One target per coordinate, so that the depth of the grid depends on distinct ones only.
    targets = (
        usable.select(key, lat, lon, *payload)
        .withColumn("copy", F.row_number().over(same_place))
        .where(F.col("copy") <= k)
        .groupBy(F.col(lat).alias("t_lat"), F.col(lon).alias("t_lon"))
        .agg(F.collect_list(F.struct(key, *payload)).alias("copies"), F.count(F.lit(1)).alias("t_rows"))
    )
    targets = _with_axes(targets, [F.col("t_lat"), F.col("t_lon")])
    grid, queries, targets = _finest(queries, targets)
    near = _nearest_candidates(queries, targets, grid, k, ["t_lat", "t_lon", "copies"], held="t_rows")

    def neighbours(t: Column) -> Column:
        d_lat, d_lon = F.col("q_lat") - t["t_lat"], F.col("q_lon") - t["t_lon"]
        square = d_lat * d_lat + d_lon * d_lon
        return F.transform(
            t["copies"],
            lambda c: F.struct(
                square.alias("distance2"), c[key].alias(key), *[c[p].alias(p) for p in payload]
            ),
        )

    first = F.slice(F.array_sort(F.flatten(F.transform("near", neighbours))), 1, k)
    ranked = Window.partitionBy("q_lat", "q_lon").orderBy("distance2", key)
    return (
        near.select("q_lat", "q_lon", F.explode(first).alias("hit"))
        .select("q_lat", "q_lon", "hit.*")
        .withColumn("position", F.row_number().over(ranked))
        .where(F.col("position") <= k)
    )


def neighbour_spread(
    df: DataFrame,
    key: str,
    value: str,
    k: int = 9,
    lat: str = "lat",
    lon: str = "lon",
    out: str = "ruggedness",
) -> DataFrame:
    """Population standard deviation of ``value`` over the k nearest rows with a value."""
    valued = df.where(F.col(value).isNotNull())
    near = nearest_neighbours(valued, key, k, [value], lat, lon)
    spread = near.groupBy("q_lat", "q_lon").agg(F.stddev_pop(value).alias(out))
    spread = attach_by_place(df, spread, None, lat, lon)
    return spread.withColumn(out, F.when(F.col(value).isNotNull(), F.col(out)))


def _segments_by_cell(queries: DataFrame, ends: DataFrame, grid: Grid) -> DataFrame:
    """(q0, q1, near_row, near): the segments that can be nearest to a point of each finest cell.

    All points of a cell are within ``r`` of the middle of its box, so a segment that is nearest to
    one of them is at most 2 ``r`` farther from the middle than the segment nearest to that.  From
    level to level the cells below a cell choose among its segments, which travel as arrays of about
    ``CANDIDATES_PER_ROW``; a segment stays whole, and boxes shrink with the points, however long it is.
    """
    parts = max(1, math.ceil(ends.count() / CANDIDATES_PER_ROW))
    part = F.pmod(F.xxhash64(*ends.columns), F.lit(parts)).alias("near_row")
    near = ends.groupBy(part).agg(F.collect_list(F.struct(*ends.columns)).alias("near"))
    near = near.select(F.lit(0).alias("q0"), F.lit(0).alias("q1"), "near_row", "near")
    finest = _finest_cells(queries, 2, "q", [])
    middle = [((F.col(f"q_lo{i}") + F.col(f"q_hi{i}")) / 2).alias(f"m{i}") for i in range(2)]
    sides = [F.col(f"q_hi{i}") - F.col(f"q_lo{i}") for i in range(2)]
    twice = F.sqrt(sides[0] * sides[0] + sides[1] * sides[1])
    slack = F.lit(grid.extent * ABSOLUTE_SLACK)
    by_cell, previous = Window.partitionBy("q0", "q1"), 0

    def measured(segment: Column) -> Column:
        distance = point_segment_distance(F.col("m0"), F.col("m1"), *[segment[c] for c in ends.columns])
        return F.struct(distance.alias("d"), *[segment[c].alias(c) for c in ends.columns])

    def within(reach: Column) -> Callable[[Column], Column]:
        return lambda segment: segment["d"] <= reach

    def reach_of(hits: Column) -> Column:
        return (F.array_min(hits)["d"] + F.col("twice")) * (1 + RELATIVE_SLACK) + slack

    def closest(hits: Column) -> Column:
        return fx.once(reach_of(hits), lambda reach: F.struct(reach.alias("reach"), F.filter(hits, within(reach)).alias("near")))

    for level in grid.levels():
        cells = _cells_at(finest, 2, grid.level - level, "q", [])
        parent = [F.shiftright(f"q{i}", level - previous).alias(f"p{i}") for i in range(2)]
        cells = cells.select("q0", "q1", *parent, *middle, twice.alias("twice"))
        if previous == 0:
            cells = F.broadcast(cells)  # at most 8 on each axis
        children = near.withColumnsRenamed({"q0": "p0", "q1": "p1"}).join(cells, ["p0", "p1"])
        chosen = children.select("q0", "q1", "near_row", fx.once(F.transform("near", measured), closest).alias("c"))
        chosen = _spread_out(chosen.select("q0", "q1", "near_row", "c.*"), ["q0", "q1"], grid)
        chosen = chosen.withColumn("reach", F.min("reach").over(by_cell))
        chosen = chosen.withColumn("near", F.filter("near", within(F.col("reach")))).where(F.size("near") > 0)
        rows = F.ceil(F.sum(F.size("near")).over(by_cell) / CANDIDATES_PER_ROW)
        chosen = chosen.withColumn("near_row", F.pmod(F.xxhash64("near_row"), rows))
        near = chosen.groupBy("q0", "q1", "near_row").agg(F.flatten(F.collect_list("near")).alias("near"))
        previous = level
    return near


def nearest_segment(
    df: DataFrame,
    segments: DataFrame,
    lat: str = "lat",
    lon: str = "lon",
    out: str = "line_miles",
) -> DataFrame:
    """Each row with the planar (projected) miles to the nearest segment (lat1, lon1, lat2, lon2)."""
    x, y = albers_xy(F.col("q_lat"), F.col("q_lon"))
    queries = _coordinates(df, lat, lon).select("q_lat", "q_lon", "q_rows", x.alias("qx"), y.alias("qy"))
    queries = materialize(_with_axes(queries, [F.col("qx"), F.col("qy")]))
    (x1, y1), (x2, y2) = (albers_xy(F.col(f"lat{i}"), F.col(f"lon{i}")) for i in (1, 2))
    ends = segments.select(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")).dropna()
    ends = materialize(ends.distinct())
    grid = fit_grid([(queries, LINE_CELL_POINTS)])
    leaf = _leaf_cells(queries, grid)
    near = _segments_by_cell(leaf, ends, grid)
    points = leaf.withColumnsRenamed({"_c0": "q0", "_c1": "q1"})
    near = points.join(near, ["q0", "q1"])
    metres = F.transform(
        "near",
        lambda t: point_segment_distance(
            F.col("qx"), F.col("qy"), t["x1"], t["y1"], t["x2"], t["y2"]
        ),
    )
    best = near.select("q_lat", "q_lon", F.array_min(metres).alias("m")).groupBy("q_lat", "q_lon")
    best = best.agg((F.min("m") / METERS_PER_MILE).alias(out))
    return attach_by_place(df, best, queries, lat, lon)


def _radius_states(
    queries: DataFrame, targets: DataFrame, grid: Grid, miles: float, aggs: list[Column], settled: Column
) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """Cell pairs wholly within the radius per level, and the open pairs of finest cells."""
    dims = len(grid.low)
    chord = chord_of_miles(miles)
    inside = (F.col("high") < F.lit(chord * (1 - RELATIVE_SLACK))) & F.coalesce(settled, F.lit(True))
    q_cells = _finest_cells(queries, dims, "q", [])
    t_cells = _finest_cells(targets, dims, "t", aggs)
    covers, open_pairs, previous = [], None, 0
    for level in grid.levels():
        pairs = _next_pairs(open_pairs, q_cells, t_cells, grid, level, previous, aggs)
        pairs = pairs.where(F.col("low") <= F.lit(chord * (1 + RELATIVE_SLACK)))
        pairs = materialize(pairs.withColumn("inside", inside))
        covers.append((level, pairs.where("inside")))
        open_pairs = pairs.where(~F.col("inside")).select(
            *[f"q{i}" for i in range(dims)], *[f"t{i}" for i in range(dims)]
        )
        previous = level
    return covers, open_pairs


def pairs_within(
    centers: DataFrame,
    points: DataFrame,
    miles: float,
    center_id: str,
    point_id: str,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """All (center, point) pairs within ``miles`` (inclusive) with their distance.

    The pairs are the result here; for per-center totals use :func:`coverage_totals`,
    which does not build them.
    """
    c = _with_axes(_coordinates(centers, lat, lon), unit_vector(F.col("q_lat"), F.col("q_lon")))
    p = _with_axes(_coordinates(points, lat, lon), unit_vector(F.col("q_lat"), F.col("q_lon")))
    c, p = materialize(c), materialize(p)
    grid = fit_grid([(p, BLOCK_POINTS), (c, BLOCK_POINTS)])
    _, leaf = _radius_states(_leaf_cells(c, grid), _leaf_cells(p, grid), grid, miles, [], F.lit(False))
    names = ["phi", "lam", "cos"]

    # Rows, copies of a place among them, travel as arrays of a cell's part; pairs of parts are dealt
    # out evenly, and pairs of rows are made and filtered where those arrive.
    def parts(df: DataFrame, key: str, side: str) -> DataFrame:
        usable = df.select(F.col(key).alias("key"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
        usable = usable.where(finite(F.col("lat")) & finite(F.col("lon")))
        rows = _leaf_cells(_with_axes(usable, unit_vector(F.col("lat"), F.col("lon"))), grid)
        rows = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        cell = [F.col(f"_c{i}").alias(f"{side}{i}") for i in range(len(grid.low))]
        rows = rows.select(*cell, "salt", "key", *[a.alias(n) for a, n in zip(angles(F.col("lat"), F.col("lon")), names)])
        at = [f"{side}{i}" for i in range(len(grid.low))]
        number = F.row_number().over(Window.partitionBy(*at, "salt").orderBy("key"))
        rows = rows.withColumn("part", F.floor((number - 1) / BLOCK_POINTS))
        rows = rows.groupBy(*at, "salt", "part").agg(F.collect_list(F.struct("key", *names)).alias(f"{side}_rows"))
        return rows.withColumnsRenamed({"salt": f"{side}_salt", "part": f"{side}_part"})

    keys = {side: [f"{side}{i}" for i in range(len(grid.low))] for side in "qt"}
    met = leaf.join(parts(centers, center_id, "q"), keys["q"]).join(parts(points, point_id, "t"), keys["t"])
    met = _spread_out(met, [f"{side}{end}" for side in "qt" for end in ("_salt", "_part")] + keys["q"] + keys["t"], grid)
    met = met.select("t_rows", F.explode("q_rows").alias("q")).select("q", F.explode("t_rows").alias("t"))
    d = miles_of_haversine(haversine_of_angles(*[[F.col(f"{side}.{n}") for n in names] for side in "qt"]))
    met = met.select(F.col("q.key").alias(center_id), F.col("t.key").alias(point_id), d.alias("miles"))
    return met.where(F.col("miles") <= miles)


def _unit_vectors(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    phi, lam = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(phi) * np.cos(lam), np.cos(phi) * np.sin(lam), np.sin(phi)], 1)


def _pair_miles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Haversine miles between rows (lat, lon) of both, as :func:`haversine` has them."""
    (phi_a, lam_a), (phi_b, lam_b) = np.radians(a).T, np.radians(b).T
    half_lat, half_lon = np.sin((phi_b - phi_a) / 2), np.sin((lam_b - lam_a) / 2)
    h = half_lat * half_lat + np.cos(phi_a) * np.cos(phi_b) * half_lon * half_lon
    return 2 * EARTH_RADIUS_MILES * np.arcsin(np.sqrt(np.minimum(h, 1)))


def _block_totals(centers: np.ndarray, points: np.ndarray, miles: float) -> np.ndarray:
    """For each center (lat, lon) the sums over the points (lat, lon, need, n, ...) within ``miles``:
    n and the rest, and last max(need - distance, 0) * n.

    The scalar product of unit vectors decides; pairs too near to the radius for that, and those whose
    shortfall counts, are measured.
    """
    places, need, weights = points[:, :2], points[:, 2], points[:, 3:]
    product = _unit_vectors(*centers.T) @ _unit_vectors(*places.T).T
    edge = 1 - chord_of_miles(miles) ** 2 / 2
    slack = 2 * RELATIVE_SLACK * (1 - edge) + ABSOLUTE_SLACK
    inside = product >= edge
    at = np.nonzero(np.abs(product - edge) <= slack)
    inside[at] = _pair_miles(centers[at[0]], places[at[1]]) <= miles
    odd = ~np.isfinite(weights)
    sums = inside.astype(float) @ np.where(odd, 0.0, weights)
    for j in np.flatnonzero(odd.any(1)):
        sums[inside[:, j]] += np.where(odd[j], weights[j], 0.0)
    saved = np.zeros(len(centers))
    reach = np.cos(np.minimum(np.maximum(need, 0), math.pi * EARTH_RADIUS_MILES) / EARTH_RADIUS_MILES)
    center, point = np.nonzero(inside & (need > 0) & (product >= reach - slack))
    short = np.maximum(need[point] - _pair_miles(centers[center], places[point]), 0) * weights[point, 0]
    np.add.at(saved, center, short)
    return np.column_stack([sums, saved])


def _group_levels(grid: Grid, partitions: int) -> int:
    """How many levels above the finest cells those are that go to a task together: some for each partition."""
    cells = grid.points / BLOCK_POINTS / (GROUPS_PER_PARTITION * partitions)
    return min(GROUP_LEVELS, grid.level, max(0, math.floor(math.log(max(cells, 1), 4))))


def _rim_totals(
    leaf: DataFrame, centers: DataFrame, points: DataFrame, grid: Grid, miles: float, sums: list[str], reduction: str
) -> DataFrame:
    """Totals of the open pairs of finest cells: q_lat, q_lon, _n, sums, reduction.

    A cell's points travel as arrays, once to each group of neighbouring center cells, with the cells
    that need them, and a group's rows come one after the other, its centers first, so that no pair of
    points and no partial sum of a center is a row.  As points grow, groups hold more cells, so that what
    travels grows with the points and not with the cells along the rim.  A task holds the centers of one
    group, at most about 4 ** GROUP_LEVELS cells, and one batch of rows at a time.
    """
    dims = len(grid.low)
    q_key, t_key, g_key = ([f"{p}{i}" for i in range(dims)] for p in "qtg")
    measures = ["t_lat", "t_lon", "_need", "_n", *sums]
    shift = _group_levels(grid, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    group = [F.shiftright(q, shift).alias(g) for q, g in zip(q_key, g_key)]
    packed = F.collect_list(F.struct(*[F.col(m).cast("double").alias(m) for m in measures]))
    cells = points.withColumnsRenamed({f"_c{i}": t_key[i] for i in range(dims)}).groupBy(*t_key).agg(packed.alias("cell"))
    child = F.concat_ws(",", *q_key)
    needed = leaf.groupBy(*group, *t_key).agg(F.collect_list(child).alias("children"))
    near = needed.join(cells, t_key).select(*g_key, F.lit(1).alias("kind"), "children", *[F.col(f"cell.{m}").alias(m) for m in measures])
    own = centers.withColumnsRenamed({f"_c{i}": q_key[i] for i in range(dims)}).groupBy(*q_key)
    own = own.agg(F.collect_list(F.struct("q_lat", "q_lon")).alias("cell"))
    none = F.array().cast("array<double>")
    own = own.select(
        *group, F.lit(0).alias("kind"), F.array(child).alias("children"), F.col("cell.q_lat").alias("t_lat"), F.col("cell.q_lon").alias("t_lon"), *[none.alias(m) for m in measures[2:]]
    )
    rows = _spread_out(own.unionByName(near), g_key, grid).sortWithinPartitions(*g_key, "kind")
    names = ["q_lat", "q_lon", "_n", *sums, reduction]

    def run(batches):
        held, totals, at = {}, {}, None

        def done():
            for name, found in totals.items():
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in np.column_stack([held[name], found]).T], names=names)

        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(dims))))
            kinds, children = batch.column(dims).to_pylist(), batch.column(dims + 1).to_pylist()
            lists = [batch.column(i) for i in range(dims + 2, batch.num_columns)]
            for row, kind in enumerate(kinds):
                if keys[row] != at:
                    yield from done()
                    held, totals, at = {}, {}, keys[row]
                arrays = [c[row].values.to_numpy(zero_copy_only=False) for c in lists[: 2 if kind == 0 else None]]
                if kind == 0:
                    held[children[row][0]] = np.column_stack(arrays)
                    continue
                block = np.column_stack(arrays)
                for name in children[row]:
                    for start in range(0, len(block), 8 * BLOCK_POINTS):
                        found = _block_totals(held[name], block[start : start + 8 * BLOCK_POINTS], miles)
                        totals[name] = totals[name] + found if name in totals else found
        yield from done()

    importable(points.sparkSession)
    types = {f.name: f.dataType for f in points.schema.fields}
    made = rows.select(*g_key, "kind", "children", *measures).mapInArrow(run, ", ".join(f"`{n}` double" for n in names))
    return made.select("q_lat", "q_lon", *[F.col(n).cast(types[n]) for n in ["_n", *sums]], reduction)


def coverage_totals(
    centers: DataFrame,
    points: DataFrame,
    miles: float,
    sums: list[str],
    shortfall_of: str,
    lat: str = "lat",
    lon: str = "lon",
    reduction: str = "distance_reduction",
    members: str = "covered",
) -> DataFrame:
    """Totals over the points within ``miles`` of each distinct center coordinate.

    ``sums`` are added up, NULL as 0; ``reduction`` adds max(shortfall_of - distance, 0).  Cells
    that lie wholly within the radius and hold no point with a shortfall contribute their cell
    totals at once.  Points meet centers only along the rim of the radius and where the
    shortfall really depends on the distance.  Returns q_lat, q_lon, members, sums, reduction.
    """
    c = _with_axes(_coordinates(centers, lat, lon), unit_vector(F.col("q_lat"), F.col("q_lon")))
    p = (
        points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .where(finite(F.col(lat)) & finite(F.col(lon)))
        .groupBy(
            F.col(lat).alias("t_lat"), F.col(lon).alias("t_lon"), F.col(shortfall_of).alias("_need")
        )
        .agg(F.count(F.lit(1)).alias("_n"), *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in sums])
    )
    p = _with_axes(p, unit_vector(F.col("t_lat"), F.col("t_lon")))
    c, p = materialize(c), materialize(p)
    grid = fit_grid([(p, BLOCK_POINTS), (c, BLOCK_POINTS)])
    c, p = _leaf_cells(c, grid), _leaf_cells(p, grid)
    dims = len(grid.low)
    measures = [F.sum("_n").alias("_n"), *[F.sum(s).alias(s) for s in sums]]
    # An arc is never shorter than its chord, so this bound on the shortfall is safe.
    shortest = F.col("low") * F.lit(EARTH_RADIUS_MILES * (1 - RELATIVE_SLACK))
    settled = F.col("_need") <= shortest
    covers, leaf = _radius_states(c, p, grid, miles, [*measures, F.max("_need").alias("_need")], settled)
    rim = _rim_totals(leaf, c, p, grid, miles, sums, reduction)
    # Whole-cell totals belong to a center cell; hand them down to the cells below, level by
    # level, and to the centers themselves only at the end (a bounded number per cell).
    held, previous = None, 0
    for level, pairs in covers:
        keys = [f"q{i}" for i in range(dims)]
        here = pairs.select(*keys, "_n", *sums)
        if held is not None:
            step = level - previous
            at = [F.shiftright(f"_c{i}", grid.level - level).alias(f"q{i}") for i in range(dims)]
            children = c.select(*at).distinct()
            up = [F.shiftright(f"q{i}", step).alias(f"p{i}") for i in range(dims)]
            down = held.withColumnsRenamed({f"q{i}": f"p{i}" for i in range(dims)})
            down = down.join(children.select("*", *up), [f"p{i}" for i in range(dims)])
            here = here.unionByName(down.select(*keys, "_n", *sums))
        held = here.groupBy(*keys).agg(*measures)
        previous = level
    cells = c.withColumnsRenamed({f"_c{i}": f"q{i}" for i in range(dims)})
    whole = held.join(cells, [f"q{i}" for i in range(dims)]).select(
        "q_lat", "q_lon", "_n", *sums, F.lit(0.0).alias(reduction)
    )
    return (
        rim.unionByName(whole)
        .groupBy("q_lat", "q_lon")
        .agg(
            F.sum("_n").alias(members),
            *[F.sum(s).alias(s) for s in sums],
            F.sum(reduction).alias(reduction),
        )
    )
