"""Readers, writers and the plans they give."""

import gzip

import pytest
from pyspark.sql import functions as F

from checks import cube
from climgrid.plans.prepare import prepare_point_baseline
from climgrid.grid import Grid
from climgrid.sources import series, sinks, text


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_point_text_drops_the_variation_columns(spark, tmp_path):
    f = tmp_path / "tmp.dat.gz"
    months = " ".join(str(m + 0.5) for m in range(1, 13))
    with gzip.open(f, "wt") as out:
        out.write(f"  61.5  -148.25  {months} {' '.join(['9'] * 12)}\n\n -10 20 {months}\n")
    rows = text.scan_point_climatology(spark, str(f)).collect()
    assert len(rows) == 24
    assert {(r["lat"], r["lon"]) for r in rows} == {(61.5, -148.25), (-10.0, 20.0)}
    assert all(r["value"] == r["month"] + 0.5 for r in rows)


def test_elevation_text_has_one_column(spark, tmp_path):
    (tmp_path / "elv.dat").write_text("10 20 0.35\n")
    r = text.scan_point_climatology(spark, str(tmp_path / "elv.dat"), months=1).first()
    assert (r["lat"], r["lon"], r["month"], r["value"]) == (10.0, 20.0, None, 0.35)


def test_ascii_grids_without_the_annual_one(spark, tmp_path):
    head = "ncols 3\nnrows 2\nxllcorner 10\nyllcorner 50\ncellsize 2\nNODATA_value -9999\n"
    for m in (1, 12, 14):
        (tmp_path / f"tas_{m:02d}.asc").write_text(head + f"1 2 -9999\n4 5 {m}\n")
    df = text.scan_ascii_grid(spark, str(tmp_path / "*.asc"))
    assert {r["month"] for r in df.select("month").distinct().collect()} == {1, 12}
    jan = {(r["row"], r["col"]): (r["lat"], r["lon"], r["value"]) for r in df.where("month = 1").collect()}
    assert jan[(0, 0)] == (53.0, 11.0, 1.0)
    assert jan[(0, 2)] == (53.0, 15.0, None)
    assert jan[(1, 2)] == (51.0, 15.0, 1.0)


def test_prepared_series_is_not_overwritten(spark, sf, tmp_path):
    c = cube.cells(spark, sf)
    sinks.sink_prepped(c, str(tmp_path / "p"))
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.sink_prepped(c, str(tmp_path / "p"))
    sinks.sink_prepped(c, str(tmp_path / "p"), overwrite=True)


def test_scan_pushes_filters_and_prunes(spark, sf, tmp_path):
    path = str(tmp_path / "cells")
    sinks.sink_grid(series.with_identity(cube.cells(spark, sf), model="obs"), path)
    df = series.scan_series(spark, path, variable="tas", begin=1996, end=1997).where(F.col("row") == 0)
    text_ = plan(df.select("row", "value"))
    assert "PartitionFilters: [" in text_ and "year" in text_.split("PartitionFilters")[1].split("]")[0]
    assert "EqualTo(row,0)" in text_
    assert "ReadSchema: struct<row:int,value:double>" in text_


def test_summary_csv_rounds_by_variable(spark, tmp_path):
    s = spark.createDataFrame([("pr", 1, 12.6), ("tas", 1, -3.25), ("tas", 12, 4.0)], "variable string, month int, mean double")
    sinks.sink_summary_csv(s, str(tmp_path / "out"), ["variable"], ["mean"])
    rows = {r["variable"]: r for r in spark.read.csv(str(tmp_path / "out" / "mean"), header=True).collect()}
    assert rows["pr"]["01"] == "13" and rows["tas"]["01"] == "-3.2" and rows["tas"]["12"] == "4.0"
    assert rows["pr"]["02"] is None


def test_point_baseline_by_hand(spark):
    """Stations on three of four cells; the fourth cannot be bracketed."""
    pts = spark.createDataFrame([(7, 45.0, -90.0, 1.24), (7, 45.0, 90.0, 3.0), (7, -45.0, 90.0, 5.0)], "month int, lat double, lon double, value double")
    coarse = Grid.global_latlon(2, 2)
    template = spark.createDataFrame([(0, 0, 1), (0, 1, 1), (1, 0, 0), (1, 1, 1)], "row int, col int, inside int")
    out = prepare_point_baseline(pts, coarse, template, coarse, "tas", "nearest")
    got = {(r["row"], r["col"]): r["value"] for r in out.collect()}
    assert got == {(0, 0): 3.0, (0, 1): 1.2, (1, 0): None, (1, 1): None}


def test_no_python_and_no_products_in_the_flagship_plan(spark, sf):
    from checks import load

    text_ = plan(load()[0]["delta_pipeline"](spark, sf))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "SinglePartition"):
        assert word not in text_
