"""Polygons, zones, neighbours, points, windows and baselines."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from checks import cube
from checks.q_delta import filled_sql, whole_sql
from checks.registry import CTES, R, R6, bilinear_sql, fine_place, query, r6
from climgrid.functions.projection import lonlat
from climgrid.operators import gaps, neighbors, regrid, spatial
from climgrid.plans import prepare

YMRC = ("year", "month", "row", "col")


def edges(spark, sf):
    return spatial.ring_edges(cube.polygons(spark, sf)).drop("zone_name")


def coarse_grid(spark, sf):
    return cube.grids(spark, sf)[0]


@query("rasterize_zones", "SELECT z.zone_id, n_name AS zone_name, row, col FROM inzone z JOIN nation ON n_nationkey = z.zone_id")
def rasterize_zones(spark, sf):
    cells = spatial.rasterize_zones(edges(spark, sf), coarse_grid(spark, sf))
    names = cube.polygons(spark, sf).select("zone_id", "zone_name")
    return cells.join(names, "zone_id").select("zone_id", "zone_name", "row", "col")


@query("rasterize_polygon", "SELECT DISTINCT row, col, 1 AS inside FROM inzone")
def rasterize_polygon(spark, sf):
    return spatial.rasterize_polygon(edges(spark, sf), coarse_grid(spark, sf))


# a cell is touched when a piece of an edge, cut to the cell's box, is not empty
CTES["touched"] = (
    "SELECT zone_id, row, col FROM inzone UNION SELECT zone_id, row, col FROM ("
    "SELECT zone_id, row, col, greatest(0e0, least((xl - x1) / (x2 - x1), (xr - x1) / (x2 - x1)), "
    "least((yb - y1) / (y2 - y1), (yt - y1) / (y2 - y1))) AS t0, "
    "least(1e0, greatest((xl - x1) / (x2 - x1), (xr - x1) / (x2 - x1)), greatest((yb - y1) / (y2 - y1), (yt - y1) / (y2 - y1))) AS t1 "
    "FROM (SELECT zone_id, x1, y1, x2 + CASE WHEN x1 = x2 THEN 1e-12 ELSE 0 END AS x2, y2 + CASE WHEN y1 = y2 THEN 1e-12 ELSE 0 END AS y2 FROM edges) e, "
    "(SELECT row, col, col * (360e0 / nx) AS xl, (col + 1) * (360e0 / nx) AS xr, 90 - row * (180e0 / ny) AS yt, 90 - (row + 1) * (180e0 / ny) AS yb "
    "FROM g, (SELECT unnest(range(0, ny)) AS row FROM g), (SELECT unnest(range(0, nx)) AS col FROM g)) c) WHERE t0 <= t1"
)


@query("rasterize_all_touched", "SELECT zone_id, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col FROM touched")
def rasterize_all_touched(spark, sf):
    """Also the cells that a polygon's outline passes through."""
    return spatial.rasterize_zones(edges(spark, sf), coarse_grid(spark, sf), all_touched=True)


@query(
    "join_zone",
    f"SELECT zone_id, year, month, count(*) AS cells, {R6('avg(value)')} AS value FROM cells_tas JOIN inzone USING (row, col) GROUP BY ALL",
)
def join_zone(spark, sf):
    zones = spatial.rasterize_zones(edges(spark, sf), coarse_grid(spark, sf))
    j = spatial.join_zone(cube.cells(spark, sf), zones).groupBy("zone_id", "year", "month")
    return j.agg(F.count(F.lit(1)).alias("cells"), r6(F.avg("value")).alias("value"))


@query("mask_intersect_nodata", "SELECT zone_id, row, col FROM inzone WHERE (row, col) IN (SELECT row, col FROM gappy_tas WHERE value IS NOT NULL)")
def mask_intersect_nodata(spark, sf):
    zones = spatial.rasterize_zones(edges(spark, sf), coarse_grid(spark, sf))
    return spatial.mask_intersect_nodata(zones, cube.gappy(spark, sf))


@query(
    "mask_to_extent",
    f"SELECT zone_id, {R6('min(col) * (360e0 / any_value(nx))')} AS xmin, {R6('90 - (max(row) + 1) * (180e0 / any_value(ny))')} AS ymin, "
    f"{R6('(max(col) + 1) * (360e0 / any_value(nx))')} AS xmax, {R6('90 - min(row) * (180e0 / any_value(ny))')} AS ymax FROM inzone, g GROUP BY zone_id",
)
def mask_to_extent(spark, sf):
    grid = coarse_grid(spark, sf)
    zones = spatial.rasterize_zones(edges(spark, sf), grid).withColumn("inside", F.lit(1))
    e = spatial.mask_to_extent(zones, grid)
    return e.select("zone_id", *[r6(c).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


BOX = (60.0, -45.0, 240.0, 50.0)
LON, LAT = "((col + 0.5e0) * (360e0 / nx))", "(90 - (row + 0.5e0) * (180e0 / ny))"


@query(
    "crop_to_bounds",
    f"WITH kept AS (SELECT year, month, row, col, value FROM cells_tas, g WHERE {LON} BETWEEN 60 AND 240 AND {LAT} BETWEEN -45 AND 50), "
    "corner AS (SELECT CAST(ceil((90 - 50) / (180e0 / ny) - 0.5e0) AS INTEGER) AS r0, CAST(ceil(60 / (360e0 / nx) - 0.5e0) AS INTEGER) AS c0 FROM g) "
    "SELECT year, month, row - r0 AS row, col - c0 AS col, value FROM kept, corner",
)
def crop_to_bounds(spark, sf):
    cropped, _ = spatial.crop_to_bounds(cube.cells(spark, sf), coarse_grid(spark, sf), *BOX)
    return cropped.select(*YMRC, "value")


@query(
    "crop_to_polygon",
    "WITH m AS (SELECT DISTINCT row, col FROM inzone), b AS (SELECT min(row) AS r0, min(col) AS c0 FROM m) "
    "SELECT year, month, CAST(row - r0 AS INTEGER) AS row, CAST(col - c0 AS INTEGER) AS col, value FROM cells_tas JOIN m USING (row, col), b",
)
def crop_to_polygon(spark, sf):
    return spatial.crop_to_polygon(cube.cells(spark, sf), edges(spark, sf), coarse_grid(spark, sf)).select(*YMRC, "value")


CTES["half"] = "SELECT CAST(nx // 2 AS INTEGER) AS hx, CAST(ny // 2 AS INTEGER) AS hy FROM g"
CTES["halfcells"] = (
    "SELECT CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, (c + 0.5e0) * (360e0 / hx) AS px, 90 - (r + 0.5e0) * (180e0 / hy) AS py, "
    "c * (360e0 / hx) AS xl, (c + 1) * (360e0 / hx) AS xr, 90 - r * (180e0 / hy) AS yt, 90 - (r + 1) * (180e0 / hy) AS yb "
    "FROM half, (SELECT unnest(range(0, hy)) AS r FROM half), (SELECT unnest(range(0, hx)) AS c FROM half)"
)
CTES["halfmask"] = (
    "SELECT row, col FROM halfcells JOIN edges ON ((y1 > py) <> (y2 > py)) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1) "
    "GROUP BY zone_id, row, col HAVING count(*) % 2 = 1 UNION SELECT row, col FROM ("
    "SELECT row, col, greatest(0e0, least((xl - x1) / (x2 - x1), (xr - x1) / (x2 - x1)), least((yb - y1) / (y2 - y1), (yt - y1) / (y2 - y1))) AS t0, "
    "least(1e0, greatest((xl - x1) / (x2 - x1), (xr - x1) / (x2 - x1)), greatest((yb - y1) / (y2 - y1), (yt - y1) / (y2 - y1))) AS t1 "
    "FROM (SELECT x1, y1, x2 + CASE WHEN x1 = x2 THEN 1e-12 ELSE 0 END AS x2, y2 + CASE WHEN y1 = y2 THEN 1e-12 ELSE 0 END AS y2 FROM edges) e, halfcells) "
    "WHERE t0 <= t1"
)


@query(
    "crop_resample",
    "SELECT t.year, t.month, h.row, h.col, value FROM halfmask h CROSS JOIN g CROSS JOIN half CROSS JOIN (SELECT DISTINCT year, month FROM cells_tas) t LEFT JOIN cells_tas c ON "
    "c.year = t.year AND c.month = t.month AND c.col = floor(round_even((((h.col + 0.5e0) * (360e0 / hx)) / (360e0 / nx) - 0.5e0) * 1e9, 0) / 1e9 + 0.5e0) AND "
    "c.row = floor(round_even(((90 - (90 - (h.row + 0.5e0) * (180e0 / hy))) / (180e0 / ny) - 0.5e0) * 1e9, 0) / 1e9 + 0.5e0)",
)
def crop_resample(spark, sf):
    """On a grid of half the resolution, cells that a polygon touches."""
    from climgrid.grid import Grid

    src = coarse_grid(spark, sf)
    dst = Grid.global_latlon(max(1, src.nx // 2), max(1, src.ny // 2), "half")
    return spatial.crop_resample(cube.cells(spark, sf), edges(spark, sf), src, dst).select(*YMRC, "value")


@query(
    "resample_to_template",
    f"SELECT t.year, t.month, f.row, f.col, CASE WHEN f.inside = 1 THEN round_even(c.value * 1e1, 0) / 1e1 + 0e0 END AS value FROM "
    f"(SELECT row, col, inside, floor(fy + 0.5e0) AS r0, floor(fx + 0.5e0) AS c0 FROM (SELECT *, {fine_place()} FROM fine)) f "
    "JOIN (SELECT DISTINCT year, month FROM cells_tas) t ON true LEFT JOIN cells_tas c ON c.row = f.r0 AND c.col = f.c0 AND c.year = t.year AND c.month = t.month",
)
def resample_to_template(spark, sf):
    coarse, fine = cube.grids(spark, sf)
    out = spatial.resample_to_template(cube.cells(spark, sf), cube.fine_mask(spark, sf), coarse, fine, "tas")
    return out.select(*YMRC, (F.col("value") + 0.0).alias("value"))


def points(spark, sf):
    """Customers as named places."""
    c = cube.table(spark, sf, "customer")
    lat = F.lit(89.7) - (F.col("c_custkey") * 7.3) % 170
    lon = (F.col("c_custkey") * 11.9) % 359 + 0.3
    return c.select(F.col("c_name").alias("name"), lat.alias("lat"), lon.alias("lon"))


SERIES = [f"M{m}_{s}_tas" for m in range(5) for s in ("historical", "rcp60")]


@query(
    "point_profile",
    "SELECT name, year, month, "
    + ", ".join(f"max(CASE WHEN model || '_' || scenario || '_tas' = '{s}' THEN value END) AS \"{s}\"" for s in SERIES)
    + " FROM (SELECT c_name AS name, CAST(floor(round_even(((90 - (89.7e0 - fmod(c_custkey * 7.3e0, 170))) / (180e0 / ny) - 0.5e0) * 1e9, 0) / 1e9 + 0.5e0) AS INTEGER) AS row, "
    "CAST(floor(round_even(((fmod(c_custkey * 11.9e0, 359) + 0.3e0) / (360e0 / nx) - 0.5e0) * 1e9, 0) / 1e9 + 0.5e0) AS INTEGER) AS col FROM customer, g) "
    "LEFT JOIN model_tas USING (row, col) GROUP BY ALL",
)
def point_profile(spark, sf):
    """The models and their scenarios at each place, one column each."""
    return spatial.point_profile(cube.models(spark, sf), points(spark, sf), coarse_grid(spark, sf), SERIES)


@query(
    "point_profile_projected",
    "SELECT name, month, max(value) AS obs FROM (SELECT row * 10000000 + col AS name, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col FROM proj WHERE inside = 1) "
    "JOIN base_tas USING (row, col) GROUP BY ALL",
)
def point_profile_projected(spark, sf):
    """Places given in degrees, at the centres of cells of a projected grid."""
    grid = cube.projected(spark, sf)
    lon, lat = lonlat(grid.crs, grid.x(), grid.y())
    name = (F.col("row").cast("long") * 10000000 + F.col("col")).alias("name")  # beyond 32 bits from row 215 on
    places = cube.fine_mask(spark, sf).where(F.col("inside") == 1).select(name, lon.alias("lon"), lat.alias("lat"))
    series = cube.baseline(spark, sf).withColumn("model", F.lit("obs"))
    return spatial.point_profile(series, places, grid, ["obs"]).select("name", "month", "obs")


# ---- neighbours -----------------------------------------------------------------


AROUND = "greatest(abs(a.row - b.row), abs(a.col - b.col)) = 1"


@query(
    "join_neighbors",
    f"SELECT a.year, a.month, a.row, a.col, count(*) AS n, {R6('avg(b.value)')} AS value FROM cells_tas a JOIN cells_tas b "
    f"ON a.year = b.year AND a.month = b.month AND {AROUND} GROUP BY ALL",
)
def join_neighbors(spark, sf):
    j = neighbors.join_neighbors(cube.cells(spark, sf)).groupBy(*YMRC)
    return j.agg(F.count(F.lit(1)).alias("n"), r6(F.avg("nvalue")).alias("value"))


# three quarters of the suppliers lie inside; debt still marks missing data
CTES["area"] = "SELECT row, col, CASE WHEN s_nationkey < 19 THEN 1 ELSE 0 END AS inside FROM sup"


def area(spark, sf):
    z = cube.zones(spark, sf)
    return z.select("row", "col", F.when(F.col("zone_id") < 19, 1).otherwise(0).alias("inside"))


def gappy(spark, sf):
    return cube.gappy(spark, sf).drop("scenario", "variable")


@query(
    "fill_mask_neighbors",
    f"SELECT year, month, row, col, CASE WHEN inside = 1 THEN {R6('coalesce(value, fill)')} END AS value FROM gappy_tas "
    "JOIN area USING (row, col) LEFT JOIN (SELECT a.year, a.month, a.row, a.col, avg(b.value) AS fill FROM gappy_tas a JOIN gappy_tas b "
    f"ON a.year = b.year AND a.month = b.month AND {AROUND} WHERE a.value IS NULL GROUP BY ALL) USING (year, month, row, col)",
)
def fill_mask_neighbors(spark, sf):
    return neighbors.fill_mask_neighbors(gappy(spark, sf), area(spark, sf)).select(*YMRC, r6("value").alias("value"))


@query(
    "fill_negative_neighbors",
    f"SELECT year, month, row, col, {R6('CASE WHEN inside = 1 AND value < 0 THEN coalesce(fill, 0) ELSE value END')} AS value FROM cells_tas "
    "JOIN area USING (row, col) LEFT JOIN (SELECT a.year, a.month, a.row, a.col, avg(b.value) AS fill FROM cells_tas a JOIN cells_tas b "
    f"ON a.year = b.year AND a.month = b.month AND {AROUND} WHERE a.value < 0 AND b.value >= 0 GROUP BY ALL) USING (year, month, row, col)",
)
def fill_negative_neighbors(spark, sf):
    c = cube.cells(spark, sf).drop("scenario", "variable")
    return neighbors.fill_negative_neighbors(c, area(spark, sf)).select(*YMRC, r6("value").alias("value"))


def _rounds(n: int) -> str:
    """The rounds of the iterative fill one by one; more than the gaps of the data need."""
    parts = ["r0 AS (SELECT year, month, row, col, inside, CASE WHEN inside = 1 AND value > -15 THEN value END AS value FROM gappy_tas JOIN area USING (row, col))"]
    for k in range(1, n + 1):
        parts.append(
            f"f{k} AS (SELECT a.year, a.month, a.row, a.col, trunc(avg(b.value)) AS fill FROM r{k - 1} a JOIN r{k - 1} b "
            f"ON a.year = b.year AND a.month = b.month AND {AROUND} WHERE a.inside = 1 AND a.value IS NULL AND b.value IS NOT NULL GROUP BY ALL), "
            f"r{k} AS MATERIALIZED (SELECT year, month, row, col, inside, coalesce(value, fill) AS value FROM r{k - 1} LEFT JOIN f{k} USING (year, month, row, col))"
        )
    return f"WITH {', '.join(parts)} SELECT year, month, row, col, value FROM r{n}"


@query("fill_mask_iterative", _rounds(12))
def fill_mask_iterative(spark, sf):
    """Rounds of filling until nothing changes."""
    wet = gappy(spark, sf).withColumn("value", F.when(F.col("value") > -15, F.col("value")))
    return neighbors.fill_mask_iterative(wet, area(spark, sf)).select(*YMRC, "value")


@query(
    "mosaic_first",
    "SELECT year, month, row, col, coalesce(a.value, b.value) AS value FROM gappy_tas a FULL JOIN cells_tasmin b USING (year, month, row, col)",
)
def mosaic_first(spark, sf):
    """Temperature with its gaps filled from a second layer."""
    second = cube.cells(spark, sf, "tasmin").drop("scenario", "variable")
    return neighbors.mosaic_first(gappy(spark, sf), second).select(*YMRC, "value")


# ---- baselines ------------------------------------------------------------------


@query(
    "prepare_scaled_baseline",
    "WITH anoms AS (SELECT year, month, row, col, round_even(value * 1e1, 0) / 1e1 AS value FROM cells_tas) "
    f"SELECT r.year, r.month, r.row, r.col, CASE WHEN f.inside = 1 THEN {R6('rv')} END AS value "
    f"FROM ({bilinear_sql('anoms')}) r JOIN fine f USING (row, col)",
)
def prepare_scaled_baseline(spark, sf):
    coarse, fine = cube.grids(spark, sf)
    tenths = cube.cells(spark, sf).withColumn("value", F.rint(F.col("value") * 10.0))
    out = prepare.prepare_scaled_baseline(tenths, cube.fine_mask(spark, sf), coarse, fine)
    return out.select(*YMRC, r6("value").alias("value"))


MOSAIC = (
    "SELECT month, row, col, coalesce(a.v, b.v) AS value FROM (SELECT month, row, col, CASE WHEN p_size > 10 THEN round_even(value * 1e1, 0) END AS v "
    "FROM base_tas JOIN (SELECT row, col, p_size FROM fine) USING (row, col)) a "
    "JOIN (SELECT month, row, col, CASE WHEN p_size > 5 THEN round_even((value + 1) * 1e1, 0) END AS v "
    "FROM base_tas JOIN (SELECT row, col, p_size FROM fine) USING (row, col)) b USING (month, row, col)"
)


@query(
    "prepare_mosaic_baseline",
    f"WITH m AS ({MOSAIC}) SELECT month, row, col, CASE WHEN f.p_size > 2 THEN {R6('coalesce(m.value, fill) / 10')} END AS value FROM m "
    "JOIN fine f USING (row, col) LEFT JOIN (SELECT a.month, a.row, a.col, avg(b.value) AS fill FROM m a JOIN m b ON a.month = b.month "
    f"AND {AROUND} WHERE a.value IS NULL GROUP BY ALL) USING (month, row, col)",
)
def prepare_mosaic_baseline(spark, sf):
    """Two regional layers in tenths and units; the smallest cells lie outside the template."""
    b = cube.baseline(spark, sf).join(cube.fine_cells(spark, sf).select("row", "col", "p_size"), ["row", "col"])
    v = F.col("value")
    first = b.select("month", "row", "col", F.when(F.col("p_size") > 10, F.rint(v * 10.0)).alias("value"))
    second = b.select("month", "row", "col", F.when(F.col("p_size") > 5, v + 1).alias("value"))
    inside = F.when(F.col("p_size") > 2, 1).otherwise(0)
    mask = cube.fine_cells(spark, sf).select("row", "col", inside.alias("inside"))
    out = prepare.prepare_mosaic_baseline(first, second, mask)
    return out.select("month", "row", "col", r6("value").alias("value"))


CTES["stations"] = "SELECT 0 AS year, month, row, col, avg(value) AS value FROM cells_tas WHERE year <= 1999 GROUP BY month, row, col"


@query(
    "prepare_point_baseline",
    f"WITH {whole_sql('stations', 'year, month', '_st')}, {filled_sql('whole_st', 'year, month', '_st')}, anoms AS (SELECT * FROM filled_st) "
    f"SELECT r.month, r.row, r.col, CASE WHEN f.inside = 1 THEN {R('rv', 1)} + 0e0 END AS value FROM ({bilinear_sql('anoms')}) r JOIN fine f USING (row, col)",
)
def prepare_point_baseline(spark, sf):
    """Suppliers as scattered stations in -180..180, carried to the fine template."""
    coarse, fine = cube.grids(spark, sf)
    c = cube.cells(spark, sf).where(F.col("year") <= cube.END).groupBy("row", "col", "month").agg(F.avg("value").alias("value"))
    west = F.when(coarse.x() > 180, coarse.x() - 360).otherwise(coarse.x())
    pts = c.select("month", coarse.y().alias("lat"), west.alias("lon"), "value")
    out = prepare.prepare_point_baseline(pts, coarse, cube.fine_mask(spark, sf), fine, "tas")
    return out.select("month", "row", "col", (F.col("value") + 0.0).alias("value"))


@query("prepare_series", "SELECT year, month, row, col, value FROM cells_tas WHERE year BETWEEN 1996 AND 2000")
def prepare_series(spark, sf):
    """Historical and later files with an overlap, sliced."""
    c = cube.cells(spark, sf).select(*YMRC, "value")
    return prepare.prepare_series(c.where(F.col("year") <= 1999), c.where(F.col("year") >= 1999), begin=1996, end=2000)


@query("prepare_farfuture", "SELECT year + 300 AS year, month, row, col, value FROM cells_tas")
def prepare_farfuture(spark, sf):
    """Years up to 2301, in three files."""
    c = cube.cells(spark, sf).select((F.col("year") + 300).alias("year"), "month", "row", "col", "value")
    y = F.col("year")
    return prepare.prepare_farfuture(c.where(y <= 2296), c.where(y.between(2297, 2298)), c.where(y >= 2299)).select(*YMRC, "value")
