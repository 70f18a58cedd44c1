"""Scans, catalog, sinks and selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import cube
from checks.registry import R6, q16, query, r6
from climgrid.functions import calendar, values
from climgrid.operators import aggregate, select
from climgrid.schema import CELLS_DDL
from climgrid.sources import catalog, netcdf, series, sinks, text
from climgrid.storage import dealt_by, work_folder

V = ("scenario", "year", "month", "row", "col", "value")
CELLS = "SELECT scenario, year, month, row, col, value FROM cells_tas"


@query("scan_series", CELLS + " WHERE year BETWEEN 1996 AND 1998")
def scan_series(spark, sf):
    """Cells stored in the partitioned layout and read back with pushed filters."""
    path = work_folder(spark, "series")
    sinks.sink_grid(series.with_identity(cube.cells(spark, sf), model="obs"), path)
    return series.scan_series(spark, path, variable="tas", model="obs", begin=1996, end=1998).select(*V)


@query("scan_multi", "SELECT year, month, row, col, value FROM cells_tas")
def scan_multi(spark, sf):
    """Two parts that share the years 1997-1998."""
    c = cube.cells(spark, sf).select("year", "month", "row", "col", "value")
    one, two = work_folder(spark, "part"), work_folder(spark, "part")
    whole = series.with_identity(c, variable="tas", model="obs", scenario="historical")
    sinks.sink_grid(whole.where(F.col("year") <= 1998), one)
    sinks.sink_grid(whole.where(F.col("year") >= 1997), two)
    return series.scan_multi(spark, [one, two], variable="tas").select("year", "month", "row", "col", "value")


@query("scan_baseline", "SELECT row, col, month, value FROM base_tas")
def scan_baseline(spark, sf):
    path = work_folder(spark, "baseline")
    cube.baseline(spark, sf).write.parquet(path)
    return series.scan_baseline(spark, path)


@query(
    "drop_annual_member",
    "SELECT row, col, month, value FROM base_tas",
)
def drop_annual_member(spark, sf):
    """A thirteenth layer, the annual mean, is made and left out again."""
    b = cube.baseline(spark, sf)
    annual = b.groupBy("row", "col").agg(F.lit(13).alias("month"), F.avg("value").alias("value"))
    return series.drop_annual_member(b.unionByName(annual))


POINTS = """
SELECT CAST(s_suppkey AS DOUBLE) / 4 AS lat, CAST(s_nationkey AS DOUBLE) / 2 AS lon, m.month,
       CAST(round_even(s_acctbal + m.month, 0) AS DOUBLE) AS value
FROM supplier, months m
"""


def point_lines(spark, sf, cv: bool = True):
    s = cube.table(spark, sf, "supplier")
    number = lambda c: c.cast("double").cast("string")
    fields = [number(F.col("s_suppkey") / 4), number(F.col("s_nationkey") / 2)]
    fields += [number(F.rint(F.col("s_acctbal") + m)) for m in range(1, 13)]
    fields += [F.lit("0.5")] * (12 if cv else 0)
    return s.select(F.concat(F.lit("  "), F.concat_ws("   ", *fields)).alias("value"))


@query("scan_point_climatology", POINTS)
def scan_point_climatology(spark, sf):
    """Gzipped text with latitude, longitude, twelve months and twelve columns to drop."""
    path = work_folder(spark, "points")
    point_lines(spark, sf).write.option("compression", "gzip").text(path)
    return text.scan_point_climatology(spark, path)


@query(
    "scan_ascii_grid",
    "SELECT month, row, col, 20 + (5 * ny - row - 0.5e0) * 0.5e0 AS lat, 10.5e0 + (col + 0.5e0) * 0.5e0 AS lon, value "
    "FROM months CROSS JOIN (SELECT ny, CAST(unnest(range(0, 5 * ny)) AS INTEGER) AS row FROM g) CROSS JOIN (SELECT CAST(unnest(range(0, 4 * nx)) AS INTEGER) AS col FROM g) "
    "LEFT JOIN (SELECT month, row, col, CAST(value AS DOUBLE) AS value FROM base_tas WHERE inside = 1) USING (month, row, col)",
)
def scan_ascii_grid(spark, sf):
    """The fine baseline written as one ASCII raster a month, with an annual one, and read back."""
    _, fine = cube.grids(spark, sf)
    b = cube.baseline(spark, sf).join(cube.fine_mask(spark, sf).where("inside = 1").drop("inside"), ["row", "col"])
    cell = F.max(F.struct(F.col("col"), F.col("value").cast("string").alias("v")))
    b = dealt_by(b, "month", "row", cells=fine.nx * fine.ny)  # one shuffle for both groupings
    one = b.groupBy("month", "row", "col").agg(cell.alias("c")).groupBy("month", "row").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("c.col"), F.col("c.v")))).alias("m")
    )
    numbers = F.explode(F.array(*[F.lit(m) for m in (*range(1, 13), text.ANNUAL_FILE)])).alias("month")
    rows = spark.range(fine.ny).select(F.col("id").cast("int").alias("row")).select("row", numbers)
    line = F.transform(F.sequence(F.lit(0), F.lit(fine.nx - 1)), lambda c: F.coalesce(F.element_at("m", c), F.lit("-9999")))
    lines = rows.join(one, ["month", "row"], "left").select("month", "row", F.when(F.col("m").isNull(), F.repeat(F.lit("-9999 "), fine.nx)).otherwise(F.array_join(line, " ")).alias("value"))
    head = (f"ncols {fine.nx}", f"nrows {fine.ny}", "xllcorner 10.5", "yllcorner 20", "cellsize 0.5", "NODATA_value -9999")
    top = rows.where("row = 0").select("month", F.posexplode(F.array(*[F.lit(h) for h in head])).alias("row", "value"))
    whole = top.withColumn("row", F.col("row") - len(head)).unionByName(lines)
    path = work_folder(spark, "rasters")
    whole.repartition("month").sortWithinPartitions("month", "row").drop("row").write.partitionBy("month").text(path)
    return text.scan_ascii_grid(spark, f"{path}/*/*.txt").select("month", "row", "col", "lat", "lon", "value")


@query(
    "scan_netcdf",
    "SELECT t.model, t.year, t.month, r.row, c.col, value FROM (SELECT DISTINCT model, year, month FROM model_tas WHERE year BETWEEN 1996 AND 1998) t "
    "CROSS JOIN (SELECT CAST(unnest(range(0, ny)) AS INTEGER) AS row FROM g) r CROSS JOIN (SELECT CAST(unnest(range(0, nx)) AS INTEGER) AS col FROM g) c "
    "LEFT JOIN model_tas x ON x.model = t.model AND x.year = t.year AND x.month = t.month AND x.row = r.row AND x.col = c.col WHERE t.model IN ('M1', 'M3')",
)
def scan_netcdf(spark, sf):
    """Two models written as NetCDF, a file a year, and read back by their years."""
    coarse, _ = cube.grids(spark, sf)
    parts = []
    for model in ("M1", "M3"):
        path = work_folder(spark, "netcdf")
        netcdf.sink_netcdf(cube.models(spark, sf).where(F.col("model") == model), path, coarse, "C")
        parts.append(netcdf.scan_netcdf(spark, path, "tas", begin=1996, end=1998, model=model))
    return parts[0].unionByName(parts[1]).select("model", "year", "month", "row", "col", "value")


@query(
    "parse_ascii_grid",
    "SELECT month, row % 5 AS row, col % 4 AS col, CAST(CASE WHEN inside = 1 THEN value END AS DOUBLE) AS value, "
    "CAST(row // 5 AS INTEGER) AS tile_row, CAST(col // 4 AS INTEGER) AS tile_col "
    "FROM base_tas WHERE month <= 12",
)
def parse_ascii_grid(spark, sf):
    """The fine baseline cut in tiles of 5 x 4 cells, each written as an ASCII raster."""
    _, fine = cube.grids(spark, sf)
    b = cube.baseline(spark, sf).join(cube.fine_mask(spark, sf), ["row", "col"])
    tile = b.select(
        F.floor(F.col("row") / 5).cast("int").alias("tr"), F.floor(F.col("col") / 4).cast("int").alias("tc"),
        (F.col("row") % 5).alias("r"), (F.col("col") % 4).alias("c"), "month",
        F.when(F.col("inside") == 1, F.col("value").cast("string")).otherwise("-9999").alias("v"),
    )
    at = [F.coalesce(F.max(F.when((F.col("r") == i) & (F.col("c") == j), F.col("v"))), F.lit("-8888")) for i in range(5) for j in range(4)]
    head = "ncols 4\nnrows 5\nxllcorner 10.5\nyllcorner 20\ncellsize 0.5\nNODATA_value -9999\n"
    files = tile.groupBy("tr", "tc", "month").agg(F.concat(F.lit(head), F.concat_ws(" ", *at)).alias("value"))
    files = files.withColumn("path", F.concat_ws("_", F.lit("tas"), "tr", "tc", "month"))
    cells = text.parse_ascii_grid(files.select("path", "value"))
    p = F.split("path", "_")
    part = lambda k: F.get(p, F.lit(k)).cast("int")
    return cells.where(F.col("value").isNull() | (F.col("value") != -8888)).select(
        part(3).alias("month"), "row", "col", "value", part(1).alias("tile_row"), part(2).alias("tile_col")
    )


# ---- catalog -------------------------------------------------------------------

NAMES = (
    "SELECT DISTINCT 'tas_mean_C_ar5_' || model || '_' || scenario || '_' || lpad(CAST(month AS VARCHAR), 2, '0') || '_' || year AS stem, "
    "model, scenario, year, month FROM model_tas"
)


def names(spark, sf):
    """One output file name per model and month of the data."""
    m = cube.models(spark, sf).select("model", "scenario", "variable", "year", "month").distinct()
    m = m.withColumns({"metric": F.lit("mean"), "units": F.lit("C"), "project": F.lit("ar5")})
    return m.select(F.concat(F.lit("/data/out/"), catalog.output_name(), F.lit(".tif")).alias("name"))


@query(
    "catalog_parse",
    f"SELECT '/data/out/' || stem || '.tif' AS name, 'tas' AS variable, 'mean' AS metric, 'C' AS units, 'ar5' AS project, "
    f"model, scenario, month, year FROM ({NAMES}) "
    f"UNION ALL SELECT replace('/data/out/' || stem || '.tif', '_ar5_', '_'), 'tas', 'mean', 'C', NULL, model, scenario, month, year FROM ({NAMES})",
)
def catalog_parse(spark, sf):
    full = names(spark, sf)
    short = full.select(F.regexp_replace("name", "_ar5_", "_").alias("name"))
    return catalog.catalog_parse(full.unionByName(short))


@query("catalog_sort", f"SELECT stem AS name, year, month FROM ({NAMES}) ORDER BY year, month, stem")
def catalog_sort(spark, sf):
    c = catalog.catalog_parse(names(spark, sf))
    stem = F.regexp_extract("name", r"([^/]+)\.tif$", 1)
    return catalog.catalog_sort(c.withColumn("name", stem)).select("name", "year", "month")


@query("catalog_years", f"SELECT model, year, month FROM ({NAMES}) WHERE year BETWEEN 1996 AND 1999")
def catalog_years(spark, sf):
    return catalog.catalog_years(catalog.catalog_parse(names(spark, sf)), 1996, 1999).select("model", "year", "month")


RAW_NAMES = (
    "SELECT 'tas_Amon_' || model || '_' || scenario || '_r1i1p1_' || year || lpad(CAST(min(month) AS VARCHAR), 2, '0') || '-' || "
    "year || lpad(CAST(max(month) AS VARCHAR), 2, '0') || '.nc' AS name, model, scenario, year, min(month) AS m0, max(month) AS m1 "
    "FROM model_tas GROUP BY model, scenario, year"
)


def raw_names(spark, sf):
    """One raw file per model, scenario and year."""
    m = cube.models(spark, sf).groupBy("model", "scenario", "year").agg(F.min("month").alias("m0"), F.max("month").alias("m1"))
    stamp = lambda c: F.concat(F.col("year").cast("string"), calendar.pad_month(F.col(c)))
    span = F.concat(stamp("m0"), F.lit("-"), stamp("m1"))
    return m.select(F.concat(F.concat_ws("_", F.lit("tas"), F.lit("Amon"), "model", "scenario", F.lit("r1i1p1"), span), F.lit(".nc")).alias("name"))


@query(
    "catalog_parse_raw",
    "SELECT name, 'tas' AS variable, 'Amon' AS cmor_table, model, scenario, 'r1i1p1' AS experiment, year AS begin_year, "
    f"m0 AS begin_month, year AS end_year, m1 AS end_month FROM ({RAW_NAMES})",
)
def catalog_parse_raw(spark, sf):
    return catalog.catalog_parse_raw(raw_names(spark, sf))


@query(
    "catalog_year_span",
    f"SELECT 'tas' AS variable, model, scenario, min(year * 100 + m0) AS \"begin\", max(year * 100 + m1) AS \"end\", count(*) AS files "
    f"FROM ({RAW_NAMES}) GROUP BY model, scenario",
)
def catalog_year_span(spark, sf):
    return catalog.catalog_year_span(catalog.catalog_parse_raw(raw_names(spark, sf)))


@query(
    "catalog_latest_version",
    "SELECT model, 'v' || max(year) AS version FROM model_tas GROUP BY model",
)
def catalog_latest_version(spark, sf):
    """Each year of a model is published as a version of its dataset."""
    c = cube.models(spark, sf).select("model", F.concat(F.lit("v"), F.col("year").cast("string")).alias("version")).distinct()
    return catalog.catalog_latest_version(c, ["model"])


@query(
    "historical_future_pairs",
    "SELECT 'tas' AS variable, f.model, f.scenario, h.name AS historical_name, f.name AS future_name FROM "
    f"(SELECT model, scenario, max(name) AS name FROM ({RAW_NAMES}) GROUP BY ALL) f JOIN "
    f"(SELECT model, scenario, max(name) AS name FROM ({RAW_NAMES}) GROUP BY ALL) h "
    "ON f.model = h.model AND h.scenario = 'historical' AND f.scenario <> 'historical'",
)
def historical_future_pairs(spark, sf):
    """The last file of each series stands for it."""
    c = catalog.catalog_parse_raw(raw_names(spark, sf))
    last = c.groupBy("variable", "model", "scenario").agg(F.max("name").alias("name"))
    return catalog.historical_future_pairs(last)


@query("anti_derived", f"SELECT model, year, month FROM ({NAMES})")
def anti_derived(spark, sf):
    """Anomaly files beside each output file, annual files and foreign names are left out."""
    plain = names(spark, sf)
    derived = plain.select(F.regexp_replace("name", r"\.tif$", "_anom.tif").alias("name"))
    annual = plain.select(F.regexp_replace("name", r"_\d\d_(\d+)\.tif$", "_13_$1.tif").alias("name")).distinct()
    foreign = plain.select(F.concat(F.lit("README_"), "name", F.lit(".md")).alias("name"))
    whole = plain.unionByName(derived).unionByName(annual).unionByName(foreign)
    return catalog.anti_derived(catalog.catalog_parse(whole)).where("size(split(name, '_')) = 8").select("model", "year", "month")


# ---- sinks ---------------------------------------------------------------------


@query("sink_grid", CELLS)
def sink_grid(spark, sf):
    path = work_folder(spark, "grid")
    sinks.sink_grid(cube.cells(spark, sf), path)
    return spark.read.parquet(path).select(*V)


@query("sink_prepped", CELLS)
def sink_prepped(spark, sf):
    path = work_folder(spark, "prepped")
    sinks.sink_prepped(cube.cells(spark, sf), path)
    return spark.read.parquet(path).select(*V)


@query(
    "sink_anomaly",
    f"SELECT c.year, c.month, c.row, c.col, {R6('c.value - m.clim')} AS anomaly FROM cells_tas c LEFT JOIN clim_tas m USING (row, col, month)",
)
def sink_anomaly(spark, sf):
    from climgrid.operators import climate

    c = cube.cells(spark, sf)
    clim = climate.climatology(c, cube.BEGIN, cube.END, by=["row", "col"])
    anom = climate.anomaly(c, clim, "add").withColumnRenamed("value", "anomaly")
    both = anom.withColumn("value", F.col("anomaly") * 2)
    out, side = work_folder(spark, "out"), work_folder(spark, "anom")
    sinks.sink_with_anomaly(both, out, side)
    return spark.read.parquet(side).select("year", "month", "row", "col", r6("value").alias("anomaly"))


ZONAL = "SELECT zone_id, month, avg(value) AS mean, min(value) AS min, max(value) AS max FROM cells_tas JOIN zones USING (row, col) GROUP BY ALL"


def zonal_table(spark, sf, variable="tas"):
    joined = cube.cells(spark, sf, variable).join(cube.zones(spark, sf), ["row", "col"])
    return joined.groupBy("variable", "zone_id", "month").agg(
        F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")
    )


@query("sink_summary_json", f"SELECT zone_id, month, {R6('mean')} AS mean, min, max FROM ({ZONAL})")
def sink_summary_json(spark, sf):
    path = work_folder(spark, "summary")
    sinks.sink_summary_json(zonal_table(spark, sf), path, ["zone_id"], ["mean", "min", "max"])
    schema = "zone_id int, months map<string, struct<mean: double, min: double, max: double>>"
    back = spark.read.schema(schema).json(path)
    flat = back.select("zone_id", F.explode("months").alias("month", "m"))
    return flat.select("zone_id", F.col("month").cast("int").alias("month"), r6("m.mean").alias("mean"), "m.min", "m.max")


def _wide(v):
    one, whole = f"printf('%.1f', round_even({v} * 1e1, 0) / 1e1)", f"printf('%.0f', round_even({v}, 0))"
    return ", ".join(f"max(CASE WHEN month = {m} THEN CASE WHEN variable = 'pr' THEN {whole} ELSE {one} END END) AS \"{m:02d}\"" for m in range(1, 13))


METRICS = ("mean", "min", "max")


@query(
    "sink_summary_csv",
    " UNION ALL ".join(
        f"SELECT '{k}' AS metric, variable, zone_id, {_wide(k)} FROM (SELECT 'tas' AS variable, * FROM ({ZONAL}) UNION ALL "
        f"SELECT 'pr', * FROM ({ZONAL.replace('cells_tas', 'cells_pr')})) GROUP BY variable, zone_id"
        for k in METRICS
    ),
)
def sink_summary_csv(spark, sf):
    """All metrics of a variable with a decimal and of one in whole numbers."""
    path = work_folder(spark, "summary")
    both = zonal_table(spark, sf, ["tas", "pr"])
    sinks.sink_summary_csv(both, path, ["variable", "zone_id"], list(METRICS))
    schema = "variable string, zone_id int, " + ", ".join(f"`{m:02d}` string" for m in range(1, 13))
    read = [spark.read.schema(schema).csv(f"{path}/{k}", header=True).withColumn("metric", F.lit(k)) for k in METRICS]
    return read[0].unionByName(read[1]).unionByName(read[2])


@query(
    "pack_series",
    "SELECT row, col, CAST(count(*) AS INTEGER) AS steps, min(year * 12 + month) AS first, max(year * 12 + month) AS last, "
    "min_by(value, year * 12 + month) AS first_value, sum(value) AS total FROM cells_tas GROUP BY row, col",
)
def pack_series(spark, sf):
    """The packed arrays, described by length, ends and sum."""
    c = cube.cells(spark, sf).select("row", "col", "year", "month", "value")
    p = aggregate.pack_series(c)
    at = lambda i, f: F.element_at("steps", i)[f]
    stamp = lambda i: at(i, "year") * 12 + at(i, "month")
    return p.select(
        "row", "col", F.size("steps").alias("steps"), stamp(1).alias("first"), stamp(-1).alias("last"),
        at(1, "value").alias("first_value"),
        F.aggregate("steps", F.lit(0.0), lambda a, s: a + s["value"]).alias("total"),
    )


@query(
    "stage_layer",
    "SELECT CAST((year - 1995) * 12 + month - 1 AS INTEGER) AS layer, row, col, value FROM cells_tas "
    "WHERE (year - 1995) * 12 + month - 1 IN (0, 6, 12)",
)
def stage_layer(spark, sf):
    c = cube.cells(spark, sf).drop("scenario")
    return series.stage_layer(c, [0, 6, 12]).select("layer", "row", "col", "value")


# ---- selection -----------------------------------------------------------------


@query("select_years", CELLS + " WHERE year BETWEEN 1996 AND 1999")
def select_years(spark, sf):
    return select.select_years(cube.cells(spark, sf), 1996, 1999).select(*V)


@query(
    "select_level",
    "SELECT level, k AS cell, year, month, CAST(q AS DOUBLE) AS value FROM "
    "(SELECT l_suppkey AS k, CAST(l_linenumber AS DOUBLE) AS level, CAST(year(l_shipdate) AS INTEGER) AS year, "
    "CAST(month(l_shipdate) AS INTEGER) AS month, sum(l_quantity) AS q FROM lineitem GROUP BY ALL) WHERE level = 2",
)
def select_level(spark, sf):
    """Line numbers stand for the levels of a vertical axis."""
    s = cube.monthly_sums(spark, sf, level=F.col("l_linenumber").cast("double"))
    return select.select_level(s, 2).select("level", F.col("k").alias("cell"), "year", "month", F.col("q").alias("value"))


@query("select_nearest_years", "SELECT year, month, row, col, value FROM cells_tas WHERE year BETWEEN 1995 AND 1998")
def select_nearest_years(spark, sf):
    """The wanted span starts before the data and is clamped."""
    c = cube.cells(spark, sf).drop("scenario")
    return select.select_nearest_years(c, 1960, 1998).select("year", "month", "row", "col", "value")


@query("select_years_by_position", "SELECT year, month, row, col, value FROM cells_tas WHERE year BETWEEN 1997 AND 1998")
def select_years_by_position(spark, sf):
    c = cube.cells(spark, sf).drop("scenario")
    return select.select_years_by_position(c, 1995, 1997, 1998).select("year", "month", "row", "col", "value")


@query("select_months", CELLS + " WHERE month BETWEEN 5 AND 9")
def select_months(spark, sf):
    return select.select_months(cube.cells(spark, sf)).select(*V)


@query(
    "trim_partial_seasons",
    CELLS + ", (SELECT scenario AS s, min(year) AS y0, max(year) AS y1 FROM cells_tas GROUP BY 1) "
    "WHERE scenario = s AND NOT (year = y0 AND month <= 2) AND NOT (year = y1 AND month = 12)",
)
def trim_partial_seasons(spark, sf):
    return select.trim_partial_seasons(cube.cells(spark, sf)).select(*V)


@query(
    "full_decades_only",
    "SELECT year, month, row, col, value FROM cells_tas WHERE year // 10 IN "
    "(SELECT year // 10 FROM cells_tas GROUP BY 1 HAVING count(DISTINCT year) = 5)",
)
def full_decades_only(spark, sf):
    """The data's 1990s have five years."""
    c = cube.cells(spark, sf).drop("scenario")
    return select.full_decades_only(c, members=5).select("year", "month", "row", "col", "value")


SEASON = "CASE WHEN month IN (12, 1, 2) THEN 'DJF' WHEN month <= 5 THEN 'MAM' WHEN month <= 8 THEN 'JJA' ELSE 'SON' END"


@query(
    "time_keys",
    f"SELECT year, month, (year // 10 * 10) || 's' AS decade, {SEASON} AS season, "
    "CAST(year + CASE WHEN month = 12 THEN 1 ELSE 0 END AS INTEGER) AS season_year, row, col FROM cells_tas",
)
def time_keys(spark, sf):
    return select.with_time_keys(cube.cells(spark, sf)).select(
        "year", "month", "decade", "season", "season_year", "row", "col"
    )


def _flipped(spark, sf):
    """The grid stored south-up, with coordinates."""
    coarse, _ = cube.grids(spark, sf)
    c = cube.cells(spark, sf).withColumns({"lat": coarse.y(), "lon": coarse.x(), "grid_id": F.lit("coarse")})
    return c.withColumn("row", F.lit(coarse.ny - 1) - F.col("row"))


@query("northup", CELLS)
def northup(spark, sf):
    return select.north_up(_flipped(spark, sf)).select(*V)


@query(
    "rotate_lon",
    "SELECT year, month, row, (col + nx // 2) % nx AS col, value, "
    f"{R6('-180e0 + (nx % 2) * (180e0 / nx) + ((col + nx // 2) % nx + 0.5e0) * (360e0 / nx)')} AS lon FROM cells_tas, g",
)
def rotate_lon(spark, sf):
    coarse, _ = cube.grids(spark, sf)
    out, _ = select.rotate_lon(cube.cells(spark, sf), coarse, to_pacific=False)
    return out.select("year", "month", "row", "col", "value", r6("lon").alias("lon"))


@query("lon_convention", "SELECT 'coarse' AS grid_id, max((col + 0.5e0) * (360e0 / nx)) > 200 AS pacific FROM cells_tas, g")
def lon_convention(spark, sf):
    coarse, _ = cube.grids(spark, sf)
    c = cube.cells(spark, sf).withColumns({"lon": coarse.x(), "grid_id": F.lit("coarse")})
    return select.lon_convention(c)


AFFINE = (
    "SELECT min((col + 0.5e0) * (360e0 / nx)) AS x0, max((col + 0.5e0) * (360e0 / nx)) AS x1, "
    "min(90 - (row + 0.5e0) * (180e0 / ny)) AS y0, max(90 - (row + 0.5e0) * (180e0 / ny)) AS y1, "
    "count(DISTINCT col) AS nx, count(DISTINCT row) AS ny FROM sup, g"
)


@query(
    "grid_affine",
    f"SELECT 'coarse' AS grid_id, nx, ny, 0e0 AS x0, 90e0 AS y0, {R6('(x1 - x0) / (nx - 1)')} AS dx, "
    f"{R6('(y1 - y0) / (ny - 1)')} AS dy FROM ({AFFINE})",
)
def grid_affine(spark, sf):
    coarse, _ = cube.grids(spark, sf)
    c = cube.mask(spark, sf).withColumns({"lat": coarse.y(), "lon": coarse.x(), "grid_id": F.lit("coarse")})
    return select.grid_affine(c, global_corner=True).withColumns({"dx": r6("dx"), "dy": r6("dy")})


@query(
    "cell_centers",
    f"SELECT row, col, {R6('(col + 0.5e0) * (360e0 / (4 * nx))')} AS x, {R6('90 - (row + 0.5e0) * (180e0 / (5 * ny))')} AS y FROM fine",
)
def cell_centers(spark, sf):
    _, fine = cube.grids(spark, sf)
    return select.with_centers(cube.fine_mask(spark, sf), fine).select("row", "col", r6("x").alias("x"), r6("y").alias("y"))


@query("kelvin_to_celsius", f"SELECT year, month, row, col, {R6('value + 300 - 273.15e0')} AS value FROM cells_tas")
def kelvin_to_celsius(spark, sf):
    k = F.col("value") + 300
    return cube.cells(spark, sf).select("year", "month", "row", "col", r6(values.kelvin_to_celsius(k)).alias("value"))


@query(
    "flux_to_monthly_mm",
    f"SELECT year, month, row, col, {R6('value / 1e5 * 86400 * [31,28,31,30,31,30,31,31,30,31,30,31][month]')} AS value FROM cells_pr",
)
def flux_to_monthly_mm(spark, sf):
    flux = values.flux_to_monthly_mm(F.col("value") / 1e5, F.col("month"))
    return cube.cells(spark, sf, "pr").select("year", "month", "row", "col", r6(flux).alias("value"))


@query(
    "scale_tenths",
    "SELECT year, month, row, col, round_even(value * 1e1, 0) + 0e0 AS tenths, round_even(value * 1e1, 0) / 1e1 + 0e0 AS value FROM gappy_tas",
)
def scale_tenths(spark, sf):
    t = values.to_tenths(F.col("value"))
    return cube.gappy(spark, sf).select(
        "year", "month", "row", "col", (t + 0.0).alias("tenths"), (values.from_tenths(t) + 0.0).alias("value")
    )


@query("normalize_nodata", "SELECT year, month, row, col, CASE WHEN value >= 0 THEN value END AS value FROM gappy_tas")
def normalize_nodata(spark, sf):
    """Missing cells carry -9999, freezing ones the float32 nodata number."""
    v = F.when(F.col("value").isNull(), -9999.0).when(F.col("value") < 0, -3.39999995e38).otherwise(F.col("value"))
    return cube.gappy(spark, sf).select("year", "month", "row", "col", values.normalize_nodata(v).alias("value"))


@query(
    "rename_models",
    "SELECT CASE model WHEN 'M0' THEN 'NCAR-CCSM4' WHEN 'M1' THEN '5ModelAvg' ELSE model END AS model, count(*) AS n FROM model_tas GROUP BY 1",
)
def rename_models(spark, sf):
    raw = F.when(F.col("model") == "M0", "CCSM4").when(F.col("model") == "M1", "5MODELAVG").otherwise(F.col("model"))
    renamed = cube.models(spark, sf).withColumn("model", values.rename_model(raw))
    return renamed.groupBy("model").agg(F.count(F.lit(1)).alias("n"))


@query("pad_month", "SELECT DISTINCT year, lpad(CAST(month AS VARCHAR), 2, '0') AS month FROM cells_tas")
def pad_month(spark, sf):
    return cube.cells(spark, sf).select("year", calendar.pad_month(F.col("month")).alias("month")).distinct()


@query(
    "round_by_variable",
    "SELECT 'tas' AS variable, year, month, row, col, round_even(value * 1e1, 0) / 1e1 + 0e0 AS value FROM cells_tas "
    "UNION ALL SELECT 'pr', year, month, row, col, round_even(value, 0) + 0e0 FROM cells_pr",
)
def round_by_variable(spark, sf):
    c = cube.cells(spark, sf, ["tas", "pr"])
    v = values.round_by_variable(F.col("value"), F.col("variable")) + 0.0
    return c.select("variable", "year", "month", "row", "col", v.alias("value"))


@query("apply_mask", "SELECT year, month, row, col, value FROM gappy_tas")
def apply_mask(spark, sf):
    return select.apply_mask(cube.cells(spark, sf), cube.mask(spark, sf)).select("year", "month", "row", "col", "value")


@query("head_months", "SELECT DISTINCT year, month FROM cells_tas ORDER BY year, month LIMIT 12")
def head_months(spark, sf):
    return select.head_months(cube.cells(spark, sf))
