"""Several scenarios, grids and levels in one table, absent rows, wide gaps, odd names."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from climgrid.functions.projection import lonlat, project
from climgrid.grid import Grid
from climgrid.operators import climate, gaps, neighbors, precip, regrid, spatial
from climgrid.plans import delta, policy
from climgrid.sources import catalog, series

CELLS = "year int, month int, row int, col int, value double"


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_fill_reaches_across_a_gap_of_any_width(spark):
    line = [(2000, 1, 0, c, 10.0 if c in (0, 214) else None) for c in range(215)]
    mask = spark.createDataFrame([(0, c, 1) for c in range(215)], "row int, col int, inside int")
    out = neighbors.fill_mask_iterative(spark.createDataFrame(line, CELLS).coalesce(1), mask.coalesce(1))
    assert {r.value for r in out.collect()} == {10.0}


def test_climatology_is_each_scenarios_own(spark):
    past = [("historical", y, 1, 0, 0, float(y - 1980)) for y in range(1981, 1991)]
    later = {s: [(s, y, 1, 0, 0, base + y - 1980) for y in range(1991, 2011)] for s, base in (("rcp26", 0.0), ("rcp85", 50.0))}
    shape = "scenario string, " + CELLS
    src, dst = Grid(1, 1, 0.0, 1.0, 1.0, 1.0), Grid(2, 2, 0.0, 1.0, 0.5, 0.5)
    base = spark.createDataFrame([(1, r, c, 1.0) for r in range(2) for c in range(2)], "month int, row int, col int, value double")
    run = lambda rows: rows_of(
        delta.delta_pipeline(spark.createDataFrame(past, shape), base, src, dst, future=spark.createDataFrame(rows, shape), begin=1981, end=2010),
        "scenario", "year", "row", "col", "value",
    )
    assert run(later["rcp26"] + later["rcp85"]) == sorted(run(later["rcp26"]) + run(later["rcp85"]), key=repr)


def test_scenario_without_months_in_the_base_period_is_served(spark):
    rows = [("historical", 1990, 1, 0, 0, 5.0), ("rcp60", 2050, 1, 0, 0, 8.0)]
    df = spark.createDataFrame(rows, "scenario string, " + CELLS)
    assert rows_of(climate.anomaly(df, climate.climatology(df, 1981, 1990), "add"), "scenario", "value") == [("historical", 0.0), ("rcp60", 3.0)]


@pytest.mark.parametrize("key, one, two", [("grid_id", "a", "b"), ("level", 10.0, 50.0)])
def test_grids_and_levels_stay_apart(spark, key, one, two):
    kind = "string" if key == "grid_id" else "double"
    at = [(r, c) for r in range(3) for c in range(3)]
    field = lambda k, v: [(k, 2000, m, r, c, None if (r, c) == (1, 1) else v + r) for m in (1, 2) for r, c in at]
    df = spark.createDataFrame(field(one, 1.0) + field(two, 100.0), f"{key} {kind}, {CELLS}")
    mask = spark.createDataFrame([(r, c, 1) for r, c in at], "row int, col int, inside int")
    grid = Grid(3, 3, 0.0, 3.0, 1.0, 1.0, grid_id="a")
    for op in (
        lambda d: neighbors.fill_mask_neighbors(d, mask),
        lambda d: neighbors.fill_mask_iterative(d, mask),
        lambda d: gaps.fill_gaps_linear(d),
        lambda d: climate.climatology(d, 2000, 2000).withColumnRenamed("clim", "value"),
        lambda d: neighbors.mosaic_first(d, d),
        lambda d: neighbors.find_boundary(d, grid).withColumn("value", F.lit(1.0)),
        lambda d: precip.correct_values(d),
    ):
        parts = [rows_of(op(df.where(F.col(key) == k)), key, "row", "col", "value") for k in (one, two)]
        assert rows_of(op(df), key, "row", "col", "value") == sorted(parts[0] + parts[1], key=repr)
    if key == "level":
        fine = spark.createDataFrame([(r, c) for r in range(6) for c in range(6)], "row int, col int")
        put = lambda d: regrid.regrid(d, fine, grid, Grid(6, 6, 0.0, 3.0, 0.5, 0.5), "bilinear")
        parts = [rows_of(put(df.where(F.col(key) == k)), key, "month", "row", "col", "value") for k in (one, two)]
        assert rows_of(put(df), key, "month", "row", "col", "value") == sorted(parts[0] + parts[1], key=repr)


def test_boundary_of_scenarios_is_that_of_the_whole_series(spark):
    hist = [("historical", 2000, 1, 0, c, None if c == 2 else 1.0) for c in range(5)]
    later = [("rcp26", 2001, 1, 0, c, None if c == 4 else 1.0) for c in range(5)]
    df = spark.createDataFrame(hist + later, "scenario string, " + CELLS)
    assert rows_of(neighbors.find_boundary(df, Grid(5, 1, 0.0, 1.0, 1.0, 1.0)), "row", "col") == [(0, 1), (0, 3)]


def test_boundary_closes_round_the_globe(spark):
    df = spark.createDataFrame([(2000, 1, 0, c, None if c == 4 else 1.0) for c in range(5)], CELLS)
    assert rows_of(neighbors.find_boundary(df, Grid(5, 1, 0.0, 1.0, 1.0, 1.0, cyclic=True)), "col") == [(0,), (3,)]


@pytest.mark.parametrize("method", ["nearest", "bilinear", "cubic", "lanczos", "average"])
def test_every_target_cell_is_returned(spark, method):
    df = spark.createDataFrame([(2000, m, 0, 0, 5.0) for m in (1, 2)], CELLS)
    src, dst = Grid(4, 4, 0.0, 4.0, 1.0, 1.0), Grid(5, 5, -2.0, 6.0, 2.0, 2.0)
    target = spark.createDataFrame([(r, c) for r in range(5) for c in range(5)], "row int, col int")
    out = regrid.regrid(df, target, src, dst, method)
    assert out.count() == 50 and (method == "nearest" or out.where("value IS NOT NULL").count() > 0)


def test_absent_cells_are_filled_and_rows_close_at_the_seam(spark):
    df = spark.createDataFrame([(2000, 1, 0, 1, 1.0), (2000, 1, 0, 3, 3.0)], CELLS)
    plain = gaps.fill_gaps_linear(df, Grid(5, 1, 0.0, 1.0, 1.0, 1.0))
    assert rows_of(plain, "col", "value") == [(0, None), (1, 1.0), (2, 2.0), (3, 3.0), (4, None)]
    ring = gaps.fill_gaps_linear(df, Grid(5, 1, 0.0, 1.0, 1.0, 1.0, cyclic=True))
    assert [(c, round(v, 6)) for c, v in rows_of(ring, "col", "value")] == [(0, 1.666667), (1, 1.0), (2, 2.0), (3, 3.0), (4, 2.333333)]


def test_empty_base_period_is_an_error(spark):
    df = spark.createDataFrame([(2000, 1, 0, 0, 5.0)], CELLS)
    base = spark.createDataFrame([(1, 0, 0, 1.0)], "month int, row int, col int, value double")
    grid = Grid(1, 1, 0.0, 1.0, 1.0, 1.0)
    with pytest.raises(ValueError):
        delta.delta_pipeline(df, base, grid, grid)


def test_quantile_ranks_few_rows_beside_an_outlier(spark):
    n = 60_000
    values = spark.range(n).select((F.pmod(F.col("id") * 7919, F.lit(n)) / 1000.0).alias("value"), F.lit(1).alias("month"))
    df = values.union(spark.createDataFrame([(1e9, 1)], "value double, month int"))
    got = precip.slice_quantile(df, ["month"], 0.95).first()
    want = np.quantile(np.append(np.arange(n) / 1000.0, 1e9), 0.95)
    assert math.isclose(got["quantile"], want, rel_tol=1e-12)
    plan = precip.slice_quantile(df, ["month"], 0.95)
    plan.collect()
    ranked = [x for x in plan._jdf.queryExecution().executedPlan().toString().split("\n") if "Window" in x]
    assert ranked  # only the bracket reaches it
    ends = df.agg(F.percentile_approx("value", [0.9497, 0.9503], 10_000).alias("e")).first()["e"]
    assert df.where(F.col("value").between(*ends)).count() < n / 500


def test_foreign_names_end_no_job(spark):
    names = [("tas_mean_C_ar5_M0_rcp60_01_1995.tif",), ("tas_mean_C_ar5_M0_rcp60_01_1995_anom.tif",), ("README.md",), ("",), ("a_b_c_d_e_f_1-x.nc",)]
    df = spark.createDataFrame(names, "name string")
    assert rows_of(catalog.anti_derived(catalog.catalog_parse(df)), "name") == [names[0]]
    catalog.catalog_parse_raw(df).collect()


def test_projection_there_and_back(spark):
    df = spark.range(400).select((F.col("id") % 20 * 4 - 179.5).alias("lon"), (F.floor(F.col("id") / 20) * 1.8 + 45).alias("lat"))
    x, y = project("EPSG:3338", F.col("lon"), F.col("lat"))
    lon, lat = lonlat("EPSG:3338", F.col("x"), F.col("y"))
    back = df.withColumns({"x": x, "y": y}).select("lon", "lat", lon.alias("lon2"), lat.alias("lat2")).collect()
    assert max(abs(r.lat - r.lat2) for r in back) < 1e-6
    assert max(abs((r.lon - r.lon2 + 180) % 360 - 180) for r in back) < 1e-6
    with pytest.raises(ValueError):
        project("EPSG:9999", F.col("lon"), F.col("lat"))


def test_points_without_data_keep_a_row(spark):
    grid = Grid(2, 1, 0.0, 1.0, 1.0, 1.0)
    df = spark.createDataFrame([("M", 2000, 1, 0, 0, 5.0)], "model string, " + CELLS)
    points = spark.createDataFrame([("in", 0.5, 0.5), ("empty", 0.5, 1.5), ("out", 0.5, 9.5)], "name string, lat double, lon double")
    assert rows_of(spatial.point_profile(df, points, grid, ["M"]), "name", "M") == [("empty", None), ("in", 5.0), ("out", None)]


def test_overlapping_parts_keep_whole_records(spark):
    shape = CELLS + ", units string"
    one = spark.createDataFrame([(2000, 1, 0, 0, 5.0, "K"), (2000, 2, 0, 0, 1.0, "K")], shape)
    two = spark.createDataFrame([(2000, 2, 0, 0, 2.0, "C"), (2000, 3, 0, 0, 3.0, "C")], shape)
    assert rows_of(series.combine_parts(one, two), "month", "value", "units") == [(1, 5.0, "K"), (2, 2.0, "C"), (3, 3.0, "C")]


def test_policy_by_source():
    assert policy.variable_policy("pr", "cru").find_bounds and not policy.variable_policy("pr", "CMIP5").find_bounds
    assert policy.variable_policy("hur", cap=100).cap == 100


def test_decades_and_seasons_count_times_not_rows(spark):
    from climgrid.operators import aggregate

    rows = [(2000, m, 0, 0, 1.0) for m in (6, 7)] + [(2000, 7, 0, 0, 1.0)]
    assert aggregate.seasonal_grid(spark.createDataFrame(rows, CELLS)).count() == 0
    years = [(y, 1, 0, 0, 1.0) for y in range(2000, 2010)] + [(2003, 1, 0, 0, 1.0)]
    assert aggregate.decadal_monthly(spark.createDataFrame(years, CELLS)).count() == 1


def test_refinement_joins_the_fine_grid_once(spark):
    """Exchanges of the plan with broadcasts off: the fine side moves once."""
    grid, fine = Grid(2, 2, 0.0, 2.0, 1.0, 1.0), Grid(4, 4, 0.0, 2.0, 0.5, 0.5)
    df = spark.createDataFrame([(y, 1, r, c, 1.0) for y in (1961, 1962) for r in range(2) for c in range(2)], CELLS)
    base = spark.createDataFrame([(1, r, c, 1.0, 1) for r in range(4) for c in range(4)], "month int, row int, col int, value double, inside int")
    plan = delta.delta_pipeline(df, base, grid, fine)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("inside#") and plan.count("Join") <= 3
