"""Triangulation, holes and scattered points against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from climgrid.functions.triangulate import delaunay
from climgrid.grid import Grid
from climgrid.operators import gaps, triangles
from climgrid.plans import delta


def turn(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def in_circle(a, b, c, d):
    (ax, ay), (bx, by), (cx, cy) = [(p[0] - d[0], p[1] - d[1]) for p in (a, b, c)]
    return (ax * ax + ay * ay) * (bx * cy - by * cx) - (bx * bx + by * by) * (ax * cy - ay * cx) + (cx * cx + cy * cy) * (ax * by - ay * bx)


def hull_area(points):
    """Twice the area of the hull."""
    out = []
    for part in (sorted(points), sorted(points, reverse=True)):
        half = []
        for q in part:
            while len(half) > 1 and turn(half[-2], half[-1], q) <= 0:
                half.pop()
            half.append(q)
        out += half[:-1]
    return sum(out[i - 1][0] * out[i][1] - out[i][0] * out[i - 1][1] for i in range(len(out)))


def test_triangles_have_empty_circles_and_cover_the_hull():
    for seed in range(400):
        rng = random.Random(seed)
        wide = rng.choice([2, 4, 6, 9, 30, 10**6])
        points = list({(rng.randint(0, wide), rng.randint(0, wide)) for _ in range(rng.randint(1, 40))})
        rng.shuffle(points)
        found = delaunay(points)
        corners = [[points[i] for i in t] for t in found]
        assert all(turn(*t) > 0 and all(in_circle(*t, p) <= 0 for p in points) for t in corners)
        assert sum(turn(*t) for t in corners) == (hull_area(points) if len(points) > 2 else 0)
        again = random.Random(seed + 1).sample(points, len(points))
        assert sorted(map(sorted, corners)) == sorted(sorted(again[i] for i in t) for t in delaunay(again))


def possible(points, values, at):
    """Values at a place by all triangles of points with an empty circle that hold it."""
    out = []
    for t in combinations(range(len(points)), 3):
        a, b, c = (points[i] for i in t)
        side = turn(a, b, c)
        if not side:
            continue
        if side < 0:
            a, b = b, a
            t = (t[1], t[0], t[2])
        parts = [turn(b, c, at), turn(c, a, at), turn(a, b, at)]
        if min(parts) >= 0 and all(in_circle(a, b, c, p) <= 0 for p in points):
            out.append(sum(p * values[i] for p, i in zip(parts, t)) / abs(side))
    return out


def slices_of(ny, nx, masks, seed=1):
    rng = np.random.default_rng(seed)
    fields = [np.where(m, np.nan, rng.normal(size=(ny, nx))) for m in masks]
    rows = [
        (2000, k + 1, r, c, None if np.isnan(v[r, c]) else float(v[r, c]))
        for k, v in enumerate(fields)
        for r in range(ny)
        for c in range(nx)
        if not np.isnan(v[r, c]) or rng.random() < 0.7 or (r, c) == (0, 0)
    ]
    return fields, rows


def test_holes_get_the_triangles_of_the_whole_slice(spark):
    ny, nx = 6, 7
    rng = np.random.default_rng(3)
    ring = np.zeros((ny, nx), bool)
    ring[1:5, 1:6] = True
    ring[2, 3] = False  # an island in the hole
    corner = np.zeros((ny, nx), bool)
    corner[:3, 4:] = corner[5, :3] = True  # holes open to the edge
    masks = [ring, corner, ring, ~corner, np.ones((ny, nx), bool), *(rng.random((ny, nx)) < p for p in (0.2, 0.5, 0.7, 0.9))]
    fields, rows = slices_of(ny, nx, masks)
    df = spark.createDataFrame(rows, "year int, month int, row int, col int, value double").repartition(4)
    got = {(r.month - 1, r.row, r.col): r.value for r in gaps.fill_gaps(df, Grid(nx, ny, 0.0, 6.0, 1.0, 1.0), "triangles").collect()}
    assert len(got) == len(masks) * ny * nx
    for k, v in enumerate(fields):
        places = [(c, -r) for r in range(ny) for c in range(nx) if not np.isnan(v[r, c])]
        values = [v[-y, x] for x, y in places]
        for r in range(ny):
            for c in range(nx):
                if np.isnan(v[r, c]):
                    some = possible(places, values, (c, -r))
                    assert (got[k, r, c] is None) == (not some)
                    assert not some or min(abs(got[k, r, c] - x) for x in some) < 1e-9
                else:
                    assert got[k, r, c] == v[r, c]


def test_a_plane_comes_back_in_a_ragged_hole(spark):
    rng = np.random.default_rng(4)
    hole = rng.random((30, 40)) < 0.75
    rows = [("a", None, 1, r, c, None if hole[r, c] else 3.0 * r - 0.7 * c) for r in range(30) for c in range(40)]
    df = spark.createDataFrame(rows, "model string, scenario string, month int, row int, col int, value double")
    out = gaps.fill_gaps(df, Grid(40, 30, 0.0, 30.0, 1.0, 1.0), "triangles").where("value is not null").collect()
    assert max(abs(r.value - (3.0 * r.row - 0.7 * r.col)) for r in out) < 1e-9
    assert len(out) > 1000 and {r.scenario for r in out} == {None}


def test_many_slices_of_one_pattern_in_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(triangles, "CHUNK", 3)
    hole = np.zeros((5, 5), bool)
    hole[1:4, 1:4] = True
    rows = [(2000 + k, 1, r, c, float(r + c * k)) for k in range(8) for r in range(5) for c in range(5) if not hole[r, c]]
    df = spark.createDataFrame(rows, "year int, month int, row int, col int, value double")
    out = gaps.fill_gaps(df, Grid(5, 5, 0.0, 5.0, 1.0, 1.0), "triangles").collect()
    assert len(out) == 200 and all(abs(r.value - (r.row + r.col * (r.year - 2000))) < 1e-9 for r in out)


def test_no_group_of_a_fill_holds_a_slice():
    """The rim of a hole grows with its edge: 400 of 10,000 cells, and what a task gets of a
    pattern are its runs."""
    import pandas as pd

    runs = pd.DataFrame({"pattern": "p", "row": range(1, 99), "c0": 1, "c1": 98})
    out = triangles._label(Grid(100, 100, 0.0, 100.0, 1.0, 1.0))(runs)
    rim = out[~out["missing"]]
    assert (rim["c1"] - rim["c0"] + 1).sum() == 4 * 98 and out["hole"].nunique() == 1


def test_filling_reads_each_line_once(spark, grid_df):
    """No window runs on from each row to the end of its line."""
    plan = gaps.fill_gaps_linear(grid_df([[1, None, 3]]))._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedfollowing" not in plan.lower().replace(" ", "").replace("unboundedpreceding$(),unboundedfollowing", "")


@pytest.mark.parametrize("busiest", [1500, 12])
def test_points_get_the_triangles_of_all_points(spark, monkeypatch, busiest):
    monkeypatch.setattr(triangles, "BUSIEST", busiest)
    rng = random.Random(6)
    # binary fractions, so that places are whole numbers of steps
    places = list({(rng.randint(0, 200) / 16, rng.randint(0, 120) / 16) for _ in range(40)})
    places += [(x / 1024 + 9, y / 1024 + 3) for x, y in {(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(15)}]
    rows = [(m, y, x, (x * x - y if m == 1 else 2 * x - y)) for m in (1, 2) for x, y in places]
    rows += [(3, y, x, 1.0 * x) for x, y in places[:2]] + [(4, None, 1.0, 1.0), (4, 2.0, float("nan"), 1.0), (4, 2.0, 1.0, None)]
    rows += [(1, places[0][1], places[0][0], places[0][0] ** 2 - places[0][1] + 2)]  # a second value of one place
    df = spark.createDataFrame(rows, "month int, lat double, lon double, value double").repartition(3)
    grid = Grid(14, 9, -0.5, 8.5, 1.0, 1.0)
    got = {(r.month, r.row, r.col): r.value for r in gaps.regrid_points(df, grid, "triangles").collect()}
    assert len(got) == 4 * 14 * 9
    whole = [(int(x * 1024), int(y * 1024)) for x, y in places]
    for m, f in ((1, lambda x, y: x * x - y), (2, lambda x, y: 2 * x - y)):
        values = [f(x, y) for x, y in places]
        if m == 1:
            values[0] += 1.0
        for r in range(9):
            for c in range(14):
                some = possible(whole, values, (c * 1024, (8 - r) * 1024))
                assert (got[m, r, c] is None) == (not some)
                assert not some or min(abs(got[m, r, c] - v) for v in some) < 1e-6
    assert all(got[m, r, c] is None for m in (3, 4) for r in range(9) for c in range(14))


def test_points_of_an_oblong_grid_and_of_nothing(spark):
    rng = np.random.default_rng(2)
    rows = [(float(y), float(x), float(4 * x - y)) for x, y in zip(rng.uniform(0, 20, 300), rng.uniform(40, 60, 300))]
    df = spark.createDataFrame(rows, "lat double, lon double, value double")
    grid = Grid(20, 80, 0.0, 60.0, 1.0, 0.25)
    out = gaps.regrid_points(df, grid, "triangles").where("value is not null").collect()
    assert len(out) > 1000
    assert max(abs(r.value - (4 * (r.col + 0.5) - (60 - (r.row + 0.5) * 0.25))) for r in out) < 1e-9
    assert gaps.regrid_points(df.limit(0), grid, "triangles").count() == 0


def test_pipelines_take_the_method(spark):
    rows = [(y, m, r, c, float(r + c + m + y % 3)) for y in (1990, 1991, 1992) for m in (1, 2) for r in range(5) for c in range(5) if (r, c) != (2, 2)]
    cells = spark.createDataFrame(rows, "year int, month int, row int, col int, value double")
    base = spark.createDataFrame([(m, r, c, 1.0) for m in (1, 2) for r in range(5) for c in range(5)], "month int, row int, col int, value double")
    g = Grid(5, 5, 0.0, 5.0, 1.0, 1.0)
    for fix in (False, True):
        out = delta.delta_pipeline(cells, base, g, g, begin=1990, end=1992, fill="triangles", method="nearest", fix_clim=fix)
        assert out.where(F.col("value").isNull()).count() == 0
    with pytest.raises(ValueError):
        gaps.fill_gaps(cells, g, "cubes")


def test_holes_are_triangulated_by_several_tasks(spark):
    """Few bytes a hole, but much work: Spark must not merge them into one task."""
    rows = [(1, r, c, 1.0) for r in range(40) for c in range(40) if (r % 4, c % 4) != (2, 2)]
    df = spark.createDataFrame(rows, "month int, row int, col int, value double")
    rim = df.withColumn("pattern", F.lit("p")).withColumn("hole", F.floor(F.col("row") / 4) * 10 + F.floor(F.col("col") / 4))
    from climgrid.storage import dealt_by

    found = dealt_by(rim, "pattern", "hole").groupBy("pattern", "hole").applyInPandas(
        triangles._triangulate, triangles._CORNERS.format(k="long") + ", pattern string, hole long"
    )
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert gaps.fill_gaps(df, Grid(40, 40, 0.0, 40.0, 1.0, 1.0), "triangles").where("value = 1").count() == 1600


def test_many_holes_are_triangulated_together(spark):
    """No data frame is made for each hole, and holes of one shape, at any place, are solved once."""
    rows = [(1, r, c, 1.0 * r) for r in range(24) for c in range(24) if (r % 4, c % 4) not in ((2, 2), (2, 1))]
    rims = [sorted((r + dr, c + dc) for r, c in ((1, 1), (1, 2), (3, 1), (3, 2), (2, 0), (2, 3))) for dr in (0, 8) for dc in (0, 12)]
    lists = [(rims[k], f"p{k % 2}", k) for k in range(4)]
    part = spark.createDataFrame(
        [([r for r, _ in rim], [c for _, c in rim], p, h) for rim, p, h in lists], "rows array<int>, cols array<int>, pattern string, hole long"
    )
    triangles._small.cache_clear()
    batch = part.toArrow().combine_chunks().to_batches()
    found = [r for b in triangles._triangulate_rims(batch) for r in b.to_pylist()]
    assert triangles._small.cache_info().misses == 1
    for rim, pattern, hole in lists:
        own = {tuple((r[f"row{i}"], r[f"col{i}"]) for i in (1, 2, 3)) for r in found if r["hole"] == hole}
        points = sorted((c, -r) for r, c in rim)
        assert own == {tuple((-points[i][1], points[i][0]) for i in t) for t in delaunay(points)} and len(own) > 1
        assert {r["pattern"] for r in found if r["hole"] == hole} == {pattern}
    df = spark.createDataFrame(rows, "month int, row int, col int, value double")
    filled = gaps.fill_gaps(df, Grid(24, 24, 0.0, 24.0, 1.0, 1.0), "triangles")
    assert filled.where("abs(value - row) < 1e-9").count() == 576
