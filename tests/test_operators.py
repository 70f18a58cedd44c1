"""Operators against brute force and by their properties, on small grids."""

import numpy as np
import pytest
from conftest import as_array
from pyspark.sql import functions as F

from checks import cube
from climgrid.grid import Grid
from climgrid.operators import aggregate, climate, gaps, neighbors, precip, regrid, select, spatial
from climgrid.plans import delta, policy

N = None


def test_operation_and_policy_names():
    with pytest.raises(ValueError):
        climate.check_operation("divide")
    with pytest.raises(ValueError):
        policy.variable_policy("nothing")
    with pytest.raises(ValueError):
        aggregate.metric_column("median")


def test_climatology_must_overlap(spark, sf):
    with pytest.raises(ValueError):
        climate.require_overlap(cube.cells(spark, sf), 1961, 1990)


def test_base_period_anomalies_average_to_zero(spark, sf):
    c = cube.cells(spark, sf)
    clim = climate.climatology(c, cube.BEGIN, cube.END, by=["row", "col"])
    a = select.select_years(climate.anomaly(c, clim, "add"), cube.BEGIN, cube.END)
    worst = a.groupBy("row", "col", "month").agg(F.abs(F.avg("value")).alias("m")).agg(F.max("m")).first()[0]
    assert worst < 1e-12


def test_zero_climatology_gives_null(spark):
    s = spark.createDataFrame([(2000, 1, 0, 0, 3.0)], "year int, month int, row int, col int, value double")
    c = spark.createDataFrame([(1, 0, 0, 0.0)], "month int, row int, col int, clim double")
    assert climate.anomaly(s, c, "mult").first()["value"] is None


@pytest.mark.parametrize("method", ["nearest", "bilinear", "cubic", "cubic_spline", "lanczos"])
def test_regrid_against_brute_force(spark, grid_df, method):
    rng = np.random.default_rng(1)
    src, dst = Grid.global_latlon(6, 5), Grid.global_latlon(18, 20)
    field = rng.normal(size=(5, 6)).round(3)
    cells = [[None if (r, c) in {(1, 2), (4, 5)} else field[r, c] for c in range(6)] for r in range(5)]
    target = spark.createDataFrame([(r, c) for r in range(20) for c in range(18)], "row int, col int")
    got = as_array(regrid.regrid(grid_df(cells), target, src, dst, method), 20, 18)

    def kernel(d):
        d = abs(d)
        if method == "bilinear":
            return max(0.0, 1 - d)
        if method == "cubic":
            return 1.5 * d**3 - 2.5 * d**2 + 1 if d <= 1 else (-0.5 * d**3 + 2.5 * d**2 - 4 * d + 2 if d < 2 else 0)
        if method == "cubic_spline":
            return 0.5 * d**3 - d**2 + 2 / 3 if d <= 1 else ((2 - d) ** 3 / 6 if d < 2 else 0)
        return float(np.sinc(d) * np.sinc(d / 3)) if d < 3 else 0

    want = np.full((20, 18), np.nan)
    for r in range(20):
        for c in range(18):
            fy, fx = round((r + 0.5) / 4 - 0.5, 9), round((c + 0.5) / 3 - 0.5, 9)
            if method == "nearest":
                i, j = int(np.floor(fy + 0.5)), int(np.floor(fx + 0.5)) % 6
                want[r, c] = np.nan if cells[i][j] is None else cells[i][j]
                continue
            num = den = 0.0
            for i in range(int(np.floor(fy)) - 3, int(np.floor(fy)) + 5):
                for j in range(int(np.floor(fx)) - 2, int(np.floor(fx)) + 4):
                    if 0 <= i < 5 and cells[i][j % 6] is not None:
                        w = kernel(fy - i) * kernel(fx - j)
                        num, den = num + w * cells[i][j % 6], den + w
            if den > 1e-6:
                want[r, c] = num / den
    np.testing.assert_allclose(got, want, atol=1e-8)


def test_bilinear_keeps_a_linear_field(spark, grid_df):
    src, dst = Grid(8, 8, 0, 8, 1, 1), Grid(16, 16, 0, 8, 0.5, 0.5)
    cells = [[3 * r + 2 * c for c in range(8)] for r in range(8)]
    target = spark.createDataFrame([(r, c) for r in range(1, 15) for c in range(1, 15)], "row int, col int")
    for r in regrid.regrid(grid_df(cells), target, src, dst).collect():
        assert r["value"] == pytest.approx(3 * ((r["row"] + 0.5) / 2 - 0.5) + 2 * ((r["col"] + 0.5) / 2 - 0.5))


def test_fill_gaps_between_valid_cells_only(grid_df):
    cells = [[1, N, 3], [N, N, N], [7, 5, N]]
    got = as_array(gaps.fill_gaps_linear(grid_df(cells)), 3, 3)
    want = [[1, 2, 3], [4, np.nan, np.nan], [7, 5, np.nan]]
    np.testing.assert_allclose(got, want)


def test_iterative_fill_against_brute_force(spark, grid_df):
    rng = np.random.default_rng(7)
    cells = rng.integers(-50, 50, size=(9, 9)).astype(float)
    cells[rng.random((9, 9)) < 0.6] = np.nan
    inside = rng.random((9, 9)) < 0.85
    df = grid_df([[N if np.isnan(v) else v for v in line] for line in cells])
    mask = spark.createDataFrame(
        [(r, c, int(inside[r, c])) for r in range(9) for c in range(9)], "row int, col int, inside int"
    )
    want = np.where(inside, cells, np.nan)
    while True:
        new = want.copy()
        for r in range(9):
            for c in range(9):
                if inside[r, c] and np.isnan(want[r, c]):
                    around = want[max(0, r - 1) : r + 2, max(0, c - 1) : c + 2]
                    if not np.isnan(around).all():
                        new[r, c] = int(np.nanmean(around))
        if np.array_equal(new, want, equal_nan=True):
            break
        want = new
    got = as_array(neighbors.fill_mask_iterative(df, mask), 9, 9)
    np.testing.assert_array_equal(got, want)


def test_quantile_is_exact_on_skewed_slices(spark):
    rng = np.random.default_rng(3)
    slices = {1: np.r_[np.zeros(900), rng.exponential(50, 100)], 2: np.full(50, 4.0), 3: rng.normal(size=777), 4: np.array([2.0])}
    rows = [(k, float(v)) for k, vs in slices.items() for v in vs]
    df = spark.createDataFrame(rows, "month int, value double")
    got = {r["month"]: r for r in precip.slice_quantile(df, ["month"], 0.95).collect()}
    for k, vs in slices.items():
        q = np.percentile(vs, 95)
        assert got[k]["quantile"] == pytest.approx(q)
        assert abs(got[k]["nearest"] - q) == pytest.approx(np.abs(vs - q).min())


def test_precip_correction_of_a_climatology(spark, grid_df):
    """Boundary cells are floored, inner ones dropped and filled again."""
    cells = [[4, 4, 4, 4], [4, 0.1, 4, 4], [4, 4, 0.2, N], [4, 4, 4, 4]]
    grid = Grid(4, 4, 0, 4, 1, 1)
    _, clim = precip.fix_precip(grid_df(cells), grid, 2000, 2000, find_bounds=True)
    got = as_array(clim.withColumnRenamed("clim", "value"), 4, 4)
    assert got[1, 1] == 4.0  # inner: under the floor, filled from its neighbours
    assert got[2, 2] == 0.5  # touches the missing cell: raised to the floor
    assert np.nanmin(got) >= 0.5


def test_rotate_twice_is_identity(spark, grid_df):
    grid = Grid.global_latlon(6, 2)
    df = grid_df([[1, 2, 3, 4, 5, 6], [7, 8, 9, 10, 11, 12]])
    west, g1 = select.rotate_lon(df, grid, to_pacific=False)
    back, g2 = select.rotate_lon(west, g1, to_pacific=True)
    assert g1.x0 == -180 and g2.x0 == 0
    np.testing.assert_array_equal(as_array(back, 2, 6), as_array(df, 2, 6))


def test_ensemble_of_equal_models_is_the_model(spark, grid_df):
    one = grid_df([[1, 2], [3, N]])
    five = one.withColumn("model", F.explode(F.array(*[F.lit(f"m{i}") for i in range(5)])))
    e = aggregate.ensemble_mean(five)
    np.testing.assert_array_equal(as_array(e, 2, 2), as_array(one, 2, 2))
    assert {r["model"] for r in e.select("model").distinct().collect()} == {"5ModelAvg"}


def test_pack_and_unpack(spark, grid_df):
    df = grid_df([[1, 2], [3, N]], [[5, 6], [7, 8]])
    packed = aggregate.pack_series(df.unionByName(df))  # copies fold
    assert packed.selectExpr("max(size(steps))").first()[0] == 2
    assert aggregate.unpack_series(packed).count() == 8


def test_zone_masks_against_ray_casting(spark):
    grid = Grid(24, 18, 0.0, 18.0, 1.0, 1.0)
    rings = {1: [(1.3, 2.2), (17.1, 4.4), (9.6, 15.7), (1.3, 2.2)], 2: [(3, 3.1), (20, 3.1), (20, 16.2), (11.5, 6.3), (3, 16.2), (3, 3.1)]}
    polys = spark.createDataFrame(
        [(z, [{"x": float(x), "y": float(y)} for x, y in ring]) for z, ring in rings.items()],
        "zone_id int, ring array<struct<x: double, y: double>>",
    )
    edges = spatial.ring_edges(polys)
    got = {(r["zone_id"], r["row"], r["col"]) for r in spatial.rasterize_zones(edges, grid).collect()}
    want = set()
    for z, ring in rings.items():
        for r in range(18):
            for c in range(24):
                x, y = c + 0.5, 18 - (r + 0.5)
                odd = False
                for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                    if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                        odd = not odd
                if odd:
                    want.add((z, r, c))
    assert got == want
    touched = {(r["zone_id"], r["row"], r["col"]) for r in spatial.rasterize_zones(edges, grid, True).collect()}
    assert want < touched


def test_far_future_years(spark, grid_df):
    past, later = grid_df([[10, 20]], year=1990), grid_df([[13, 26]], year=2300)
    grid = Grid(2, 1, 0, 1, 1, 1)
    base = spark.createDataFrame([(1, 0, 0, 5.0), (1, 0, 1, 6.0)], "month int, row int, col int, value double")
    out = delta.delta_pipeline_farfuture(past, later, base, grid, grid, begin=1961, end=1990)
    assert {(r["year"], r["col"], r["value"]) for r in out.collect()} == {(2300, 0, 8.0), (2300, 1, 12.0)}


def test_minmax_stays_in_order(spark, sf):
    """min <= mean <= max survives the refinement."""
    coarse, fine = cube.grids(spark, sf)
    mean = cube.cells(spark, sf).drop("variable")
    fine_mean = delta.delta_pipeline(mean, cube.baseline(spark, sf), coarse, fine, begin=cube.BEGIN, end=cube.END)
    keys = ["scenario", "year", "month", "row", "col"]
    low, high = (
        delta.delta_pipeline_minmax(cube.cells(spark, sf, v), mean, fine_mean, coarse, fine).select(*keys, F.col("value").alias(v))
        for v in ("tasmin", "tasmax")
    )
    j = fine_mean.select(*keys, "value").join(low, keys).join(high, keys)
    assert j.count() > 0
    assert j.where((F.col("tasmin") > F.col("value") + 1e-9) | (F.col("value") > F.col("tasmax") + 1e-9)).count() == 0


def test_fill_in_the_pipeline_never_changes_valid_cells(spark, sf):
    g = cube.gappy(spark, sf).drop("scenario", "variable")
    filled = gaps.fill_gaps_linear(g).withColumnRenamed("value", "filled")
    j = g.join(filled, ["year", "month", "row", "col"])
    assert j.where(F.col("value").isNotNull() & (F.col("value") != F.col("filled"))).count() == 0


def test_partition_count_does_not_matter(spark, sf):
    from checks.verify import compare
    from checks import load

    run = load()[0]["delta_pipeline"]
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # both sides shuffled
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        few = run(spark, sf).toPandas()
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        many = run(spark, sf).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert compare(few, many) is None
