"""What must hold so that work and memory grow no faster than the tables."""

import pytest
from pyspark.sql import functions as F

from checks import cube, q_spatial
from climgrid import storage
from climgrid.grid import Grid
from climgrid.operators import climate, compare, gaps, regrid, spatial
from climgrid.plans import delta
from climgrid.sources import text

CELLS = "year int, month int, row int, col int, value double"
SRC, DST = Grid(3, 2, 0.0, 2.0, 1.0, 1.0), Grid(6, 4, 0.0, 2.0, 0.5, 0.5)


@pytest.fixture
def series(spark):
    rows = [(y, m, r, c, float(y - 1990 + m * r + c)) for y in (1990, 1991) for m in (1, 2) for r in range(2) for c in range(3)]
    return spark.createDataFrame(rows, CELLS)


@pytest.fixture
def baseline(spark):
    """Fine cells, spread over months by the plan: Spark's guess of its size is that of the cells."""
    at = spark.createDataFrame([(r, c) for r in range(4) for c in range(6)], "row int, col int")
    return at.select("row", "col", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")).withColumn("value", F.col("month") + 0.5)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_baseline_never_passes_through_the_driver(series, baseline):
    fine = regrid.regrid(series, baseline.select("row", "col").distinct(), SRC, DST, "nearest")
    refined = delta.delta_pipeline(series, baseline, SRC, DST, begin=1990, end=1991)
    for df in (
        climate.apply_delta(fine, baseline, "add"),
        climate.join_month_lookup(fine, baseline, "base"),
        climate.join_baseline_time(fine, fine, "base"),
        delta.refine_anomalies(series, baseline, SRC, DST, "mult"),
        compare.roundtrip_residual(refined, refined.withColumn("value", F.col("anomaly")), baseline),
    ):
        # the join on top is that with the baseline; below it a climatology of coarse size may be broadcast
        assert plan(df).split("Join")[0].endswith("SortMerge")


def test_cells_of_a_frame_are_dealt_over_tasks(spark, series):
    one = series.where("year = 1990 AND month = 1").coalesce(1)
    held = gaps.frame(one, ["year", "month"], (0, 199), (0, 49)).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 10000
    assert len(held) > 1 and max(r["count"] for r in held) < 5000


@pytest.mark.parametrize("method", ["bilinear", "cubic", "lanczos"])
@pytest.mark.parametrize("cyclic", [True, False])
def test_stencils_do_not_multiply_cells_by_the_kernel(spark, method, cyclic):
    """Against places gathered one by one; of two records of a cell the greater counts, and a
    narrow globe comes round more than once."""
    grid = Grid(3, 4, 0.0, 90.0, 120.0, 45.0, cyclic)
    rows = [(1, r, c, float(10 * r + c)) for r in range(4) for c in range(3) if (r, c) != (1, 1)]
    df = spark.createDataFrame([*rows, (1, 2, 2, 99.0), (1, None, 2, 5.0), (2, 0, 0, None)], "month int, row int, col int, value double")
    lo, hi = regrid._SPAN[method]
    got = regrid.stencils(df, grid, method)
    assert "explode(array(struct" not in plan(got)
    at = {(m, r, c): v for m, r, c, v in [*rows, (1, 2, 2, 99.0)]}
    found = {(r["month"], r["r0"], r["c0"]): r for r in got.collect()}
    (r0, r1), (c0, c1) = regrid._reach(grid, lo, hi)
    assert set(found) == {(m, r, c) for m in (1, 2) for r in range(r0, r1 + 1) for c in range(c0, c1 + 1)} | {(m, regrid.NOWHERE, 0) for m in (1, 2)}
    for (m, r, c), row in found.items():
        for k, (i, j) in enumerate((i, j) for i in range(lo, hi + 1) for j in range(lo, hi + 1)):
            v = at.get((m, r + i, (c + j) % 3 if cyclic else c + j)) if r != regrid.NOWHERE else None
            assert row[regrid._place(i, j)] == (v or 0.0) and bool(row["_seen"] >> k & 1) == (v is not None)


def test_place_names_beyond_32_bits(spark, tmp_path):
    n = 1900  # a fine grid of 220 rows
    spark.range(n).withColumnRenamed("id", "s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    parts = spark.createDataFrame([(219 * 176 + 3, 20)], "p_partkey long, p_size int")
    parts.write.parquet(f"{tmp_path}/part.parquet")
    names = {r["name"] for r in q_spatial.point_profile_projected(spark, str(tmp_path)).collect()}
    assert names == {2190000003}


def test_months_of_a_baseline_are_dealt_over_tasks(spark, sf):
    held = cube.baseline(spark, sf).groupBy(F.spark_partition_id()).count().collect()
    assert len(held) > 1 and sum(r["count"] for r in held) == 12 * cube.fine_cells(spark, sf).count()


def test_a_larger_grid_is_dealt_over_more_tasks(spark):
    """What a task sorts stays the same: also the windows and the join of a refinement."""
    grid, fine = Grid(3, 2, 0.0, 2.0, 1.0, 1.0), Grid(900, 600, 0.0, 2.0, 1 / 300, 1 / 300)
    src = spark.createDataFrame([(1, r, c, 1.0) for r in range(2) for c in range(3)], "month int, row int, col int, value double")
    at = spark.createDataFrame([(0, 0), (599, 899)], "row int, col int")
    for method in ("nearest", "bilinear", "average", "mode"):
        assert f", {900 * 600 // storage.CELLS_A_TASK})" in plan(regrid.regrid(src, at, grid, fine, method))


@pytest.mark.parametrize("method", ["average", "mode"])
def test_cells_of_a_finer_grid_within_one_source_cell_are_not_added_up(spark, method):
    """At an exact ratio no source cell is spread over its targets; the rows are those of the
    sums, with repeated cells, missing ones, and targets beyond either grid."""
    src = Grid(3, 2, 0.0, 2.0, 1.0, 1.0)
    rows = [(1, 0, 0, 1.0), (1, 0, 0, 4.0), (1, 0, 1, 2.0), (1, 0, 2, None), (1, 1, 1, 7.0), (2, 1, 1, 3.0), (2, None, 1, 9.0)]
    df = spark.createDataFrame(rows, "month int, row int, col int, value double")
    exact, shifted = Grid(8, 6, -0.5, 2.5, 0.5, 0.5), Grid(9, 7, -0.6, 2.7, 0.4, 0.4)
    for dst in (exact, shifted):
        at = spark.createDataFrame([(r, c) for r in [*range(-1, dst.ny + 1), None] for c in range(dst.nx)], "row int, col int")
        got = regrid.regrid(df, at, src, dst, method)
        if dst is exact:
            assert "sequence(greatest" not in plan(got)
        want = {(m, r, c): None for m in (1, 2) for r in range(dst.ny) for c in range(dst.nx)}
        for m, r, c in want:
            top, left, met = 2.0 - dst.y0 + r * dst.dy, dst.x0 + c * dst.dx, {}
            for sm, sr, sc, v in rows:
                if sm == m and sr is not None and v is not None:
                    high = min(top + dst.dy, sr + 1) - max(top, sr)
                    wide = min(left + dst.dx, sc + 1) - max(left, sc)
                    if high > 1e-9 and wide > 1e-9:
                        met[v] = met.get(v, 0.0) + high * wide
            if met and method == "average":
                want[m, r, c] = round(sum(v * w for v, w in met.items()) / sum(met.values()), 9)
            elif met:
                want[m, r, c] = max(met, key=lambda v: (round(met[v], 9), -v))
        found = [((x["month"], x["row"], x["col"]), None if x["value"] is None else round(x["value"], 9)) for x in got.collect()]
        assert len(found) == len(want) and dict(found) == want


def test_a_series_is_made_once_for_a_refinement(spark, tmp_path):
    """Its timesteps and its values come from storage, not from two runs of what makes them."""
    runs = spark.sparkContext.accumulator(0)
    made = spark.createDataFrame([(1, r, c, 1.0) for r in range(2) for c in range(3)], "month int, row int, col int, value double").coalesce(1)

    def counted(batches):
        runs.add(1)
        yield from batches

    series = made.mapInArrow(counted, made.schema)
    at = spark.createDataFrame([(0, 0), (3, 5)], "row int, col int")
    for i, method in enumerate(("nearest", "bilinear", "average"), 1):
        assert regrid.regrid(series, at, SRC, DST, method).count() == 2
        assert runs.value == i


def test_running_sums_over_a_raster_hold_no_texts(spark, tmp_path):
    """A window holds a whole part of a raster: numbers of values, not the values of its lines."""
    head = "ncols 3\nnrows 2\nxllcorner 10\nyllcorner 50\ncellsize 2\nNODATA_value -9999\n"
    (tmp_path / "tas_01.asc").write_text(head + "1 2\n\n 3 4 5\t-9999 \n")
    cells = text.scan_ascii_grid(spark, str(tmp_path / "*.asc"))

    def windows(node):
        if node.nodeName() == "Window":
            yield {node.output().apply(i).dataType().simpleString() for i in range(node.output().size()) if node.output().apply(i).name() != "path"}
        for i in range(node.children().size()):
            yield from windows(node.children().apply(i))

    held = list(windows(cells._jdf.queryExecution().optimizedPlan()))
    assert len(held) == 2 and set().union(*held) <= {"bigint", "int"}
    got = {(r["row"], r["col"]): r["value"] for r in cells.collect()}
    assert got == {(0, 0): 1.0, (0, 1): 2.0, (0, 2): 3.0, (1, 0): 4.0, (1, 1): 5.0, (1, 2): None}


PLACES = [("a", 1.5, 0.5), ("b", 1.5, 0.5), ("c", 0.5, 2.5), (None, 0.5, 2.5), ("off", 50.0, 0.5), ("nowhere", None, 0.5)]


@pytest.mark.parametrize("few", [0, spatial.FEW_CELLS])
def test_values_of_a_profile_never_pass_through_the_driver(spark, monkeypatch, tmp_path, few):
    """Spark's guess of the size of a series spread over months is that of its cells; of the cells
    with points so many may be broadcast as a constant says."""
    monkeypatch.setattr(spatial, "FEW_CELLS", few)
    spark.createDataFrame([(r, c) for r in range(2) for c in range(3)], "row int, col int").write.parquet(f"{tmp_path}/cells")
    spark.createDataFrame(PLACES, "name string, lat double, lon double").write.parquet(f"{tmp_path}/points")
    series = spark.read.parquet(f"{tmp_path}/cells").withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    series = series.withColumns({"model": F.lit("M"), "value": F.col("month") + 0.5})
    got = spatial.point_profile(series, spark.read.parquet(f"{tmp_path}/points"), SRC, ["M"])
    joins = [line.split("[")[0].strip(" :+-") for line in plan(got).splitlines() if "Join" in line]
    assert joins == ["SortMergeJoin", "BroadcastHashJoin" if few else "SortMergeJoin"]
    want = [(n, m, m + 0.5) for n in ("a", "b", "c", None) for m in range(1, 13)] + [("off", None, None), ("nowhere", None, None)]
    assert sorted(map(tuple, got.select("name", "month", "M").collect()), key=str) == sorted(want, key=str)


def test_a_profile_repeats_no_projection_in_its_conditions(spark, baseline):
    """A filter of the plan was over 200,000 characters long."""
    grid = Grid(6, 4, -2000000.0, 2400000.0, 500000.0, 500000.0, crs="EPSG:3338")
    points = spark.createDataFrame([("in", 65.0, -154.0), ("out", -65.0, 20.0)], "name string, lat double, lon double")
    got = spatial.point_profile(baseline.withColumn("model", F.lit("M")), points, grid, ["M"])
    assert "SIN(" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {r["name"]: (r["n"], r["s"]) for r in got.groupBy("name").agg(F.count("month").alias("n"), F.sum("M").alias("s")).collect()} == {"in": (12, 84.0), "out": (0, None)}


def test_points_beyond_the_grid_are_dealt_over_tasks(spark, baseline):
    lat = F.when(F.col("id") == 0, 0.5).otherwise(-50.0)
    points = spark.range(4000).select(F.col("id").alias("name"), lat.alias("lat"), F.lit(0.5).alias("lon"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        got = spatial.point_profile(baseline.withColumn("model", F.lit("M")), points, SRC, ["M"])
        held = got.select(F.spark_partition_id().alias("task"), "M").collect()
    finally:
        spark.conf.unset(coalesce)
    tasks = [r["task"] for r in held if r["M"] is None]
    assert len(tasks) == 3999 and len(held) == 3999 + 12
    assert max(map(tasks.count, set(tasks))) < 1500
