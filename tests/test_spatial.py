import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from accessgrid.operators import spatial as s

RNG = np.random.default_rng(11)


def miles(a, b, c, d):
    a, b, c, d = map(np.radians, (a, b, c, d))
    h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return 2 * 3958.8 * np.arcsin(np.sqrt(np.minimum(h, 1)))


def uneven(n, lat, lon, spread=1e-2):
    """A third at one coordinate, a third close by, the rest anywhere."""
    a = n // 3
    rest = n - 2 * a
    lats = np.concatenate([np.full(a, lat), lat + RNG.uniform(0, spread, a), RNG.uniform(25, 49, rest)])
    lons = np.concatenate([np.full(a, lon), lon + RNG.uniform(0, spread, a), RNG.uniform(-124, -67, rest)])
    return lats, lons


def frame(spark, lats, lons, **more):
    return spark.createDataFrame(pd.DataFrame({"k": np.arange(len(lats)), "lat": lats, "lon": lons, **more}))


def values(df, *cols):
    return df.select("k", *cols).toPandas().sort_values("k")


@pytest.fixture(scope="module")
def queries():
    return uneven(900, 40.0, -100.0)


@pytest.fixture(scope="module")
def targets():
    return uneven(300, 40.0005, -100.0)


@pytest.mark.parametrize("spread", [1e-2, 1e-4])
def test_nearest_matches_brute_force(spark, spread):
    queries, targets = uneven(900, 40.0, -100.0, spread), uneven(300, 40.0005, -100.0, spread)
    sites = frame(spark, *targets).withColumnRenamed("k", "site_id")
    got = values(s.nearest_point(frame(spark, *queries), sites, "site_id"), "nearest_miles", "nearest_id")
    d = miles(queries[0][:, None], queries[1][:, None], targets[0][None], targets[1][None])
    assert np.allclose(got.nearest_miles, d.min(1), atol=1e-9)
    assert np.allclose(d[np.arange(len(d)), got.nearest_id], d.min(1), atol=1e-9)


def test_nearest_across_the_date_line_and_poles(spark):
    rows = frame(spark, np.array([0.0, 89.9, -89.9]), np.array([179.9, 10.0, 10.0]))
    sites = spark.createDataFrame([(1, 0.0, -179.9), (2, 0.0, 170.0), (3, 89.9, -170.0), (4, -80.0, 10.0)], "site_id long, lat double, lon double")
    got = values(s.nearest_point(rows, sites, "site_id"), "nearest_id")
    assert got.nearest_id.tolist() == [1, 3, 4]


def test_nearest_keeps_rows_without_coordinates(spark):
    rows = spark.createDataFrame([(1, 40.0, -100.0), (2, None, -100.0), (3, float("nan"), 1.0)], "k int, lat double, lon double")
    sites = spark.createDataFrame([(7, 40.0, -100.0), (5, 40.0, -100.0), (6, None, None)], "site_id int, lat double, lon double")
    got = {r["k"]: (r["nearest_miles"], r["nearest_id"]) for r in s.nearest_point(rows, sites, "site_id").collect()}
    assert got == {1: (0.0, 5), 2: (None, None), 3: (None, None)}


def test_nearest_without_sites(spark):
    rows = spark.createDataFrame([(1, 40.0, -100.0)], "k int, lat double, lon double")
    sites = spark.createDataFrame([], "site_id int, lat double, lon double")
    assert s.nearest_point(rows, sites, "site_id").first()["nearest_miles"] is None


def test_pairs_within_matches_brute_force(spark, queries, targets):
    centers = frame(spark, *targets).withColumnRenamed("k", "c")
    got = s.pairs_within(centers, frame(spark, *queries), 60.0, "c", "k").toPandas()
    d = miles(targets[0][:, None], targets[1][:, None], queries[0][None], queries[1][None])
    assert set(zip(got.c, got.k)) == set(zip(*np.where(d <= 60.0)))


def test_radius_is_inclusive(spark):
    lat = np.degrees(25.0 / 3958.8)
    centers = spark.createDataFrame([(1, 0.0, 0.0)], "c int, lat double, lon double")
    points = spark.createDataFrame([(1, float(lat * (1 - 1e-12)), 0.0), (2, float(lat * (1 + 1e-9)), 0.0)], "k int, lat double, lon double")
    assert [r["k"] for r in s.pairs_within(centers, points, 25.0, "c", "k").collect()] == [1]


@pytest.mark.parametrize("need", [0.0, 2.0, 400.0])
def test_coverage_totals_match_brute_force(spark, queries, targets, need):
    weight = RNG.integers(0, 50, len(queries[0])).astype(float)
    near = RNG.uniform(0, 1, len(queries[0])) * need
    points = frame(spark, *queries, w=weight, near=near)
    centers = frame(spark, *targets)
    totals = s.coverage_totals(centers, points, 25.0, ["w"], "near")
    got = values(s.attach_by_place(centers, totals), "covered", "w", "distance_reduction").fillna(0)
    d = miles(targets[0][:, None], targets[1][:, None], queries[0][None], queries[1][None])
    within = d <= 25.0
    assert got.covered.astype(int).tolist() == within.sum(1).tolist()
    assert np.allclose(got.w, (within * weight).sum(1))
    assert np.allclose(got.distance_reduction, (np.maximum(near - d, 0) * within).sum(1), atol=1e-6)


def test_neighbours_match_brute_force(spark, queries):
    value = RNG.integers(0, 100, len(queries[0])).astype(float)
    got = values(s.neighbour_spread(frame(spark, *queries, v=value), "k", "v"), "ruggedness")
    keys = np.arange(len(value))
    for i in range(0, len(value), 7):
        d2 = (queries[0][i] - queries[0]) ** 2 + (queries[1][i] - queries[1]) ** 2
        chosen = np.lexsort((keys, d2))[:9]
        assert got.ruggedness.iloc[i] == pytest.approx(value[chosen].std(), abs=1e-9)


def test_fewer_rows_than_neighbours(spark):
    rows = spark.createDataFrame([(1, 1.0, 1.0, 2.0), (2, 5.0, 5.0, 4.0), (3, 2.0, 2.0, None)], "k int, lat double, lon double, v double")
    got = {r["k"]: r["ruggedness"] for r in s.neighbour_spread(rows, "k", "v").collect()}
    assert got == {1: 1.0, 2: 1.0, 3: None}


def test_segments_match_brute_force(spark, queries):
    n = 60
    a, b = (RNG.uniform(25, 49, n), RNG.uniform(-124, -67, n)), (RNG.uniform(25, 49, n), RNG.uniform(-124, -67, n))
    short = n // 2
    b = (np.where(np.arange(n) < short, a[0] + 0.01, b[0]), np.where(np.arange(n) < short, a[1], b[1]))
    b[0][0], b[1][0] = a[0][0], a[1][0]
    segments = spark.createDataFrame(pd.DataFrame({"lat1": a[0], "lon1": a[1], "lat2": b[0], "lon2": b[1]}))
    rows = frame(spark, *queries)
    got = values(s.nearest_segment(rows, segments), "line_miles")
    px, py = s.albers_xy(F.col("lat"), F.col("lon"))
    p = values(rows.select("k", px.alias("x"), py.alias("y")), "x", "y")
    ends = []
    for i in (1, 2):
        x, y = s.albers_xy(F.col(f"lat{i}"), F.col(f"lon{i}"))
        ends.append(segments.select(x.alias("x"), y.alias("y")).toPandas())
    d = ends[1] - ends[0]
    length2 = (d.x**2 + d.y**2).to_numpy()
    dx = p.x.to_numpy()[:, None] - ends[0].x.to_numpy()[None]
    dy = p.y.to_numpy()[:, None] - ends[0].y.to_numpy()[None]
    t = np.clip((dx * d.x.to_numpy() + dy * d.y.to_numpy()) / np.where(length2 > 0, length2, 1), 0, 1)
    want = np.hypot(dx - t * d.x.to_numpy(), dy - t * d.y.to_numpy()).min(1) / 1609.344
    assert np.allclose(got.line_miles, want, atol=1e-6)


def test_no_finest_cell_is_over_its_limit(spark, queries):
    places = s._with_axes(s._coordinates(frame(spark, *queries), "lat", "lon"), [F.col("q_lat"), F.col("q_lon")])
    grid = s.fit_grid([(places, 8)])
    assert s._fullest_cells([places], grid, ["_x0", "_x1"], grid.level)[0] <= 8


@pytest.mark.parametrize("search", ["pairs", "neighbours"])
def test_copies_and_unusable_rows_leave_the_grid_as_it_is(spark, monkeypatch, search):
    lats, lons = RNG.uniform(25, 49, 400), RNG.uniform(-124, -67, 400)
    odd = [(1000 + i, 35.0, -90.0) for i in range(12)]
    odd += [(2000 + i, None, None) for i in range(12)] + [(3000, float("inf"), -90.0)]
    plain = frame(spark, lats, lons)
    more = plain.unionByName(spark.createDataFrame(odd, "k long, lat double, lon double"))
    levels, fit = [], s.fit_grid

    def noted(sides):
        levels.append(fit(sides).level)
        return fit(sides)

    monkeypatch.setattr(s, "fit_grid", noted)
    found = []
    for points in (plain, more):
        if search == "pairs":
            centers = points.withColumnRenamed("k", "c")
            found.append(s.pairs_within(centers, points, 40.0, "c", "k").select("c", "k").toPandas())
        else:
            found.append(s.nearest_neighbours(points, "k", 9, []).toPandas())
    assert abs(levels[1] - levels[0]) <= 1
    if search == "pairs":
        ids = found[1].query("c >= 1000 and k >= 1000")
        assert len(ids) == 144 and ids["k"].max() < 2000
    else:
        own = found[1].query("q_lat == 35 and q_lon == -90")
        assert own["k"].tolist() == list(range(1000, 1009))


def test_long_segments_leave_few_candidates(spark):
    """Long lines that cross everywhere: what a finest cell keeps does not depend on their length."""
    n = 1500
    lat, lon = RNG.uniform(30, 42, (2, n)), RNG.uniform(-110, -90, (2, n))
    columns = {f"{a}{i + 1}": v[i] for a, v in (("lat", lat), ("lon", lon)) for i in range(2)}
    segments = spark.createDataFrame(pd.DataFrame(columns))
    rows = frame(spark, RNG.uniform(30, 42, n), RNG.uniform(-110, -90, n))
    taken, search = [], s._segments_by_cell

    def noted(queries, ends, grid):
        near = s.materialize(search(queries, ends, grid))
        taken.append(near.agg(F.sum(F.size("near")) / F.countDistinct("q0", "q1")).first()[0])
        return near

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(s, "_segments_by_cell", noted)
        got = values(s.nearest_segment(rows, segments), "line_miles").line_miles
    assert taken[0] < n / 5
    x, y = s.albers_xy(F.col("lat"), F.col("lon"))
    p = values(rows.select("k", x.alias("x"), y.alias("y")), "x", "y")
    ends = [segments.select(*[c.alias(n) for c, n in zip(s.albers_xy(F.col(f"lat{i}"), F.col(f"lon{i}")), "xy")]).toPandas() for i in (1, 2)]
    (px, py), (ax, ay), (bx, by) = ((e.x.to_numpy(), e.y.to_numpy()) for e in (p, *ends))
    t = np.clip(((px[:, None] - ax) * (bx - ax) + (py[:, None] - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2), 0, 1)
    want = np.hypot(px[:, None] - ax - t * (bx - ax), py[:, None] - ay - t * (by - ay)).min(1) / 1609.344
    assert np.allclose(got, want, atol=1e-6)


def test_radius_totals_meet_in_few_cell_pairs(spark, monkeypatch):
    """Pairs of cells are far fewer than points; a weight that is no number stays with those it covers."""
    n = 3000
    lat, lon = RNG.uniform(30, 42, (2, n)), RNG.uniform(-110, -90, (2, n))
    need, weight = RNG.uniform(0, 60, n), RNG.integers(0, 50, n).astype(float)
    weight[7] = np.inf
    pairs, states = [], s._radius_states

    def noted(*args):
        covers, leaf = states(*args)
        pairs.append(leaf.count())
        return covers, leaf

    monkeypatch.setattr(s, "_radius_states", noted)
    centers, points = frame(spark, lat[0], lon[0]), frame(spark, lat[1], lon[1], w=weight, near=need)
    totals = s.coverage_totals(centers, points, 40.0, ["w"], "near")
    got = values(s.attach_by_place(centers, totals), "covered", "w", "distance_reduction").fillna(0)
    d = miles(lat[0][:, None], lon[0][:, None], lat[1][None], lon[1][None])
    within = d <= 40.0
    assert 0 < pairs[0] < n / 2
    assert got.covered.astype(int).tolist() == within.sum(1).tolist()
    assert np.allclose(got.w, [weight[row].sum() for row in within])
    assert np.allclose(got.distance_reduction, (np.maximum(need - d, 0) * within).sum(1), atol=1e-6)


def test_pairs_are_not_shuffled(spark):
    """After the last exchange of cells' arrays come only explodes and the filter; copies and null ids stay."""
    lats, lons = np.append(RNG.uniform(39, 41, 700), [40.0] * 20), np.append(RNG.uniform(-101, -99, 700), [-100.0] * 20)
    points = frame(spark, lats, lons)
    centers = points.where("k >= 690").withColumn("c", F.when(F.col("k") != 700, F.col("k"))).drop("k")
    out = s.pairs_within(centers, points, 25.0, "c", "k")
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan[: plan.index("Generate")]
    want = miles(lats[690:, None], lons[690:, None], lats[None], lons[None]) <= 25
    got = out.toPandas()
    assert len(got) == want.sum() and got.c.isna().sum() == want[10].sum()


def test_groups_of_center_cells_grow_with_the_points():
    def levels(points):
        return s._group_levels(s.Grid((0.0, 0.0, 0.0), 1.0, 9, points), 8)

    assert levels(0) == levels(10_000) == 0
    assert levels(16 * s.BLOCK_POINTS * s.GROUPS_PER_PARTITION * 8) == 2
    assert levels(10**8) == s.GROUP_LEVELS


def test_totals_of_grouped_cells_match_brute_force(spark, monkeypatch):
    """Each group takes a cell's points once; a cell that is whole for one center cell and cut for another counts once."""
    monkeypatch.setattr(s, "BLOCK_POINTS", 8)
    monkeypatch.setattr(s, "GROUPS_PER_PARTITION", 1)
    n = 3000
    lat, lon = RNG.uniform(38, 40, (2, n)), RNG.uniform(-100, -97, (2, n))
    need, weight = RNG.uniform(0, 60, n), RNG.integers(0, 50, n).astype(float)
    levels, chosen = [], s._group_levels
    monkeypatch.setattr(s, "_group_levels", lambda *args: levels.append(chosen(*args)) or levels[-1])
    centers, points = frame(spark, lat[0], lon[0]), frame(spark, lat[1], lon[1], w=weight, near=need)
    totals = s.coverage_totals(centers, points, 25.0, ["w"], "near")
    got = values(s.attach_by_place(centers, totals), "covered", "w", "distance_reduction").fillna(0)
    d = miles(lat[0][:, None], lon[0][:, None], lat[1][None], lon[1][None])
    within = d <= 25.0
    assert levels[0] >= 2
    assert got.covered.astype(int).tolist() == within.sum(1).tolist()
    assert np.allclose(got.w, (within * weight).sum(1))
    assert np.allclose(got.distance_reduction, (np.maximum(need - d, 0) * within).sum(1), atol=1e-6)
