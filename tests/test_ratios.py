"""Regridding at any ratio, projections and tiles in storage."""

import glob
import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from climgrid.functions.projection import PROJECTIONS, LambertConformal, PolarStereographic, register_projection
from climgrid.grid import Grid
from climgrid.operators import regrid, spatial
from climgrid.sources import series, sinks

PAIRS = [
    (Grid(6, 4, 0.0, 4.0, 1.0, 1.0), Grid(24, 16, 0.0, 4.0, 0.25, 0.25)),
    (Grid(12, 8, 0.0, 8.0, 1.0, 1.0), Grid(5, 3, -0.5, 8.2, 2.3, 2.7)),
    (Grid.global_latlon(12, 6), Grid(10, 5, -180.0, 90.0, 36.0, 36.0, True)),
    (Grid.global_latlon(12, 6), Grid(7, 4, -20.0, 50.0, 11.0, 9.0)),
]


def field(spark, grid, seed=1, holes=0.2):
    rng = np.random.default_rng(seed)
    v = np.round(rng.normal(size=(grid.ny, grid.nx)) * 2)
    v[rng.random(v.shape) < holes] = np.nan
    rows = [(1, r, c, None if np.isnan(v[r, c]) else float(v[r, c])) for r in range(grid.ny) for c in range(grid.nx)]
    return v, spark.createDataFrame(rows, "month int, row int, col int, value double")


def onto(spark, df, src, dst, method):
    target = spark.createDataFrame([(r, c) for r in range(dst.ny) for c in range(dst.nx)], "row int, col int")
    out = np.full((dst.ny, dst.nx), np.nan)
    rows = regrid.regrid(df, target, src, dst, method).collect()
    assert len(rows) == dst.ny * dst.nx
    for r in rows:
        if r.value is not None:
            out[r.row, r.col] = r.value
    return out


@pytest.mark.parametrize("src, dst", PAIRS)
def test_area_weights_against_brute_force(spark, src, dst):
    v, df = field(spark, src)
    mean, mode = np.full((dst.ny, dst.nx), np.nan), np.full((dst.ny, dst.nx), np.nan)
    for r in range(dst.ny):
        for c in range(dst.nx):
            x, y, area, total = dst.x0 + c * dst.dx, dst.y0 - r * dst.dy, {}, 0.0
            for i, j in np.argwhere(~np.isnan(v)):
                for turn in (-360, 0, 360) if src.cyclic else (0,):
                    a, b = src.x0 + j * src.dx + turn, src.y0 - i * src.dy
                    w = max(0, min(a + src.dx, x + dst.dx) - max(a, x)) * max(0, min(b, y) - max(b - src.dy, y - dst.dy))
                    if w > 1e-9:
                        area[v[i, j]] = area.get(v[i, j], 0) + w
                        total += w
            if area:
                mean[r, c] = sum(k * w for k, w in area.items()) / total
                mode[r, c] = min(area, key=lambda k: (-round(area[k], 6), k))
    np.testing.assert_allclose(onto(spark, df, src, dst, "average"), mean, atol=1e-8)
    np.testing.assert_allclose(onto(spark, df, src, dst, "mode"), mode)


def test_the_integral_is_kept(spark):
    src, dst = Grid(12, 8, 0.0, 8.0, 1.0, 1.0), Grid(5, 3, 0.0, 8.0, 2.4, 8 / 3)
    v, df = field(spark, src, holes=0)
    assert abs(onto(spark, df, src, dst, "average").mean() - v.mean()) < 1e-9


def kernel(method, d):
    if method == "bilinear":
        return max(0.0, 1 - d)
    if method == "cubic":
        return (1.5 * d - 2.5) * d * d + 1 if d <= 1 else ((2.5 - 0.5 * d) * d - 4) * d + 2 if d < 2 else 0.0
    if method == "cubic_spline":
        return (0.5 * d - 1) * d * d + 2 / 3 if d <= 1 else (2 - d) ** 3 / 6 if d < 2 else 0.0
    return 1.0 if d < 1e-9 else np.sinc(d) * np.sinc(d / 3) if d < 3 else 0.0


@pytest.mark.parametrize("method", ["bilinear", "cubic", "cubic_spline", "lanczos"])
@pytest.mark.parametrize("src, dst", [*PAIRS[1:], (Grid(20, 4, 0.0, 4.0, 1.0, 1.0), Grid(5, 8, 0.0, 4.0, 4.0, 0.5))])
def test_wide_kernels_against_brute_force(spark, method, src, dst):
    v, df = field(spark, src)
    want = np.full((dst.ny, dst.nx), np.nan)
    sx, sy = max(src.dx, dst.dx), max(src.dy, dst.dy)
    for r in range(dst.ny):
        for c in range(dst.nx):
            x, y, num, den = dst.x0 + (c + 0.5) * dst.dx, dst.y0 - (r + 0.5) * dst.dy, 0.0, 0.0
            for i, j in np.argwhere(~np.isnan(v)):
                for turn in (-720, -360, 0, 360, 720) if src.cyclic else (0,):
                    a, b = src.x0 + (j + 0.5) * src.dx + turn, src.y0 - (i + 0.5) * src.dy
                    w = kernel(method, abs(a - x) / sx) * kernel(method, abs(b - y) / sy)
                    num, den = num + w * v[i, j], den + w
            if den > 1e-6:
                want[r, c] = num / den
    np.testing.assert_allclose(onto(spark, df, src, dst, method), want, atol=1e-6)


@pytest.mark.parametrize("method", ["bilinear", "cubic", "cubic_spline", "lanczos"])
def test_a_checkerboard_becomes_grey(spark, method):
    src, dst = Grid(32, 32, 0.0, 32.0, 1.0, 1.0), Grid(8, 8, 0.0, 32.0, 4.0, 4.0)
    rows = [(1, r, c, float((r + c) % 2)) for r in range(32) for c in range(32)]
    out = onto(spark, spark.createDataFrame(rows, "month int, row int, col int, value double"), src, dst, method)
    assert abs(out - 0.5).max() < 0.01


def at(spark, expressions, *values):
    return spark.createDataFrame([tuple(map(float, values))], "p double, q double").select(*[e.alias(n) for e, n in zip(expressions, "xy")]).first()


@pytest.mark.parametrize("crs", sorted(PROJECTIONS))
def test_there_and_back(spark, crs):
    p = PROJECTIONS[crs]
    south = isinstance(p, PolarStereographic) and p.lat_ts < 0
    rows = [(lon, -lat if south else lat) for lon in np.linspace(-179, 179, 21).tolist() for lat in np.linspace(35, 89, 12).tolist()]
    if not isinstance(p, PolarStereographic):
        rows = [(p.lon_0 + 60 * lon / 180, lat) for lon, lat in rows]
    df = spark.createDataFrame(rows, "lon double, lat double")
    x, y = p.xy(F.col("lon"), F.col("lat"))
    back = df.withColumns({"x": x, "y": y}).select("lon", "lat", p.longitude(F.col("x"), F.col("y")).alias("a"), p.latitude(F.col("x"), F.col("y")).alias("b"))
    assert max(max(abs(math.remainder(r.a - r.lon, 360)), abs(r.b - r.lat)) for r in back.collect()) < 1e-7


def test_published_control_points(spark):
    """Numerical examples of Snyder 1987 (pages 296 and 315)."""
    conic = LambertConformal(33, 45, 23, -96, a=6378206.4, inv_f=294.978698)
    r = at(spark, conic.xy(F.col("p"), F.col("q")), -75, 35)
    assert abs(r.x - 1894410.9) < 0.5 and abs(r.y - 1564649.5) < 0.5
    polar = PolarStereographic(-71, -100, a=6378388.0, inv_f=297.0)
    r = at(spark, polar.xy(F.col("p"), F.col("q")), 150, -75)
    assert abs(r.x + 1540033.6) < 0.5 and abs(r.y + 560526.4) < 0.5


def test_a_projection_of_ones_own(spark):
    register_projection("mine", LambertConformal(50, 50, 50, 10))
    try:
        points = spark.createDataFrame([("p", 50.0, 10.0)], "name string, lat double, lon double")
        r = spatial.point_cells(points, Grid(10, 10, -5000.0, 5000.0, 1000.0, 1000.0, crs="mine")).first()
        assert (r.row, r.col) == (5, 5)
    finally:
        del PROJECTIONS["mine"]


def test_tiles_keep_a_crop_to_few_row_groups(spark, tmp_path):
    rows = spark.range(2 * 256 * 256).select(
        F.lit("tas").alias("variable"), F.lit("m").alias("model"), F.lit("rcp60").alias("scenario"), F.lit(2000).alias("year"),
        (F.floor(F.col("id") / 65536) + 1).cast("int").alias("month"), F.floor(F.col("id") % 65536 / 256).cast("int").alias("row"),
        (F.col("id") % 256).cast("int").alias("col"), F.rand(1).alias("value"),
    )
    sinks.sink_tiles(rows, str(tmp_path / "tiles"), tile=32, group_bytes=64 << 10, files=4)
    sinks.sink_grid(rows.orderBy("month", "row", "col"), str(tmp_path / "lines"))

    def touched(folder):
        """Rows of the row groups that a box of 20 x 20 cells cannot leave out."""
        held = 0
        for f in glob.glob(f"{folder}/**/*.parquet", recursive=True):
            meta = pq.ParquetFile(f).metadata
            names = [meta.schema.column(i).name for i in range(meta.num_columns)]
            for g in range(meta.num_row_groups):
                stats = [meta.row_group(g).column(names.index(c)).statistics for c in ("row", "col")]
                held += meta.row_group(g).num_rows * all(s.max >= 40 and s.min < 60 for s in stats)
        return held

    assert touched(tmp_path / "tiles") * 4 < touched(tmp_path / "lines")
    grid = Grid(256, 256, 0.0, 256.0, 1.0, 1.0)
    crop, sub = spatial.crop_to_bounds(series.scan_series(spark, str(tmp_path / "tiles")), grid, 40, 196, 60, 216)
    assert crop.count() == 2 * sub.nx * sub.ny == 2 * 20 * 20
    a, b = (spark.read.parquet(str(tmp_path / n)).select("month", "row", "col", "value") for n in ("tiles", "lines"))
    assert a.exceptAll(b).isEmpty() and a.count() == b.count()


def test_tiles_follow_a_curve(spark):
    cells = spark.createDataFrame([(0, 0), (0, 9), (9, 0), (9, 9), (0, 17), (25, 9)], "row int, col int")
    assert [r.k for r in cells.select(sinks.tile_key(8).alias("k")).collect()] == [0, 1, 2, 3, 4, 11]


def test_a_text_raster_of_several_parts(spark, tmp_path):
    from climgrid.sources import text

    rng = np.random.default_rng(1)
    v = rng.integers(-50, 50, (60, 70))
    lines = [" ".join(map(str, row)) for row in v]
    lines[10:12] = [lines[10] + " " + lines[11][:20].rsplit(" ", 1)[0], lines[11][len(lines[11][:20].rsplit(" ", 1)[0]) + 1 :]]  # broken elsewhere
    head = "NCOLS 70\nnrows 60\nxllcenter 10.5\nyllcenter 20.5\ncellsize 1\nnodata_value -7\n"
    for m in (3, 14):
        (tmp_path / f"pr_{m:02d}.asc").write_text(head + "\n".join(lines) + "\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = text.scan_ascii_grid(spark, str(tmp_path / "*.asc"))
        assert spark.read.text(str(tmp_path / "pr_03.asc")).rdd.getNumPartitions() > 4
        got = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(got) == 60 * 70 and {r.month for r in got} == {3}
    assert all(r.value == (None if v[r.row, r.col] == -7 else v[r.row, r.col]) for r in got)
    assert {(r.lat, r.lon) for r in got if (r.row, r.col) == (59, 0)} == {(20.5, 10.5)}


def test_a_deep_lake_takes_few_rounds(spark, monkeypatch):
    """500 cells from the shore: eight tiles of 64, not 500 rounds."""
    from climgrid.operators import neighbors

    stored = []
    monkeypatch.setattr(neighbors, "cut_lineage", lambda df, keep=neighbors.cut_lineage: (stored.append(1), keep(df))[1])
    rows = [(None, 1, r, c, 7.5 if c == 0 else None) for r in range(3) for c in range(520)]
    df = spark.createDataFrame(rows, "model string, month int, row int, col int, value double")
    mask = spark.createDataFrame([(r, c, 1) for r in range(3) for c in range(510)], "row int, col int, inside int")
    out = neighbors.fill_mask_iterative(df, mask).collect()
    assert len(out) == len(rows) and len(stored) <= 10
    assert all(x.value == (7.5 if x.col == 0 else 7.0 if x.col < 510 else None) for x in out)


@pytest.mark.parametrize("tile", [1, 3, 64])
@pytest.mark.parametrize("cyclic", [False, True])
def test_tiles_fill_as_the_whole_grid(spark, tile, cyclic):
    from climgrid.operators import neighbors

    rng = np.random.default_rng(9)
    ny, nx = 11, 14
    v = rng.integers(-50, 50, (ny, nx)).astype(float)
    v[rng.random((ny, nx)) < 0.9] = np.nan
    inside = rng.random((ny, nx)) < 0.9
    want = np.where(inside, v, np.nan)
    while True:
        new = want.copy()
        for r, c in np.argwhere(inside & np.isnan(want)):
            spots = [(r + i, (c + j) % nx if cyclic else c + j) for i, j in neighbors.QUEEN]
            some = [want[s] for s in spots if 0 <= s[0] < ny and 0 <= s[1] < nx and not np.isnan(want[s])]
            if some:
                new[r, c] = int(sum(some) / len(some))
        if np.array_equal(new, want, equal_nan=True):
            break
        want = new
    df = spark.createDataFrame([(r, c, None if np.isnan(v[r, c]) else float(v[r, c])) for r in range(ny) for c in range(nx)], "row int, col int, value double")
    mask = spark.createDataFrame([(r, c, int(inside[r, c])) for r in range(ny) for c in range(nx)], "row int, col int, inside int")
    got = np.full((ny, nx), np.nan)
    for x in neighbors.fill_mask_iterative(df, mask, Grid(nx, ny, 0.0, 11.0, 1.0, 1.0, cyclic=cyclic), tile).collect():
        got[x.row, x.col] = np.nan if x.value is None else x.value
    np.testing.assert_array_equal(got, want)


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    from climgrid.operators import climate

    cells = spark.range(3 * 12 * 40).selectExpr(
        "cast(2000 + id % 3 AS int) AS year", "cast(1 + floor(id / 3) % 12 AS int) AS month", "cast(floor(id / 36) % 5 AS int) AS row",
        "cast(floor(id / 180) AS int) AS col", "cast(id AS double) AS value",
    )
    base = cells.where("year = 2000").drop("year")
    sinks.sink_bucketed(cells, str(tmp_path / "a"), 4)
    sinks.sink_bucketed(base, str(tmp_path / "b"), 4)
    schema = "month int, row int, col int, value double"
    spark.sql(f"DROP TABLE {sinks._bucket_table(str(tmp_path / 'b'))}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = sinks.scan_bucketed(spark, str(tmp_path / "a"), f"year int, {schema}", 4)
        two = sinks.scan_bucketed(spark, str(tmp_path / "b"), schema, 4)
        out = climate.apply_delta(one, two, "add")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = climate.apply_delta(cells, base, "add")
        assert out.count() == want.count() == 1440 and out.select(want.columns).exceptAll(want).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
