"""Delta method, regridding and precipitation correction."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import cube
from checks.registry import CTES, PROJ_PLACE, R, R6, bilinear_sql, fine_place, query, r6
from climgrid.functions import values
from climgrid.operators import climate, gaps, neighbors, precip, regrid, select
from climgrid.plans import delta, policy
from climgrid.sources import sinks
from climgrid.storage import cut_lineage, work_folder

YMRC = ("year", "month", "row", "col")


def out(df, *names, value="value"):
    """The time and cell columns with the value to six decimals."""
    return df.select(*names, *YMRC, r6(value).alias("value"))


# ---- climatology and anomalies -------------------------------------------------


def clim_of(spark, sf, variable="tas"):
    c = cube.cells(spark, sf, variable)
    return climate.climatology(c, cube.BEGIN, cube.END, by=["row", "col"])


@query("concat_series", "SELECT scenario, year, month, row, col, value FROM cells_tas")
def concat_series(spark, sf):
    c = cube.cells(spark, sf)
    past, later = c.where(F.col("scenario") == "historical"), c.where(F.col("scenario") != "historical")
    return climate.concat_series(past, later).select("scenario", *YMRC, "value")


@query("climatology", f"SELECT row, col, month, {R6('clim')} AS clim FROM clim_tas")
def climatology(spark, sf):
    return clim_of(spark, sf).select("row", "col", "month", r6("clim").alias("clim"))


ANOM = "SELECT scenario, year, month, row, col, c.value - m.clim AS value FROM cells_tas c LEFT JOIN clim_tas m USING (row, col, month)"
RATIO = (
    "SELECT scenario, year, month, row, col, CASE WHEN m.clim <> 0 THEN c.value / m.clim END AS value "
    "FROM cells_pr c LEFT JOIN clim_pr m USING (row, col, month)"
)


@query("anomaly_add", f"SELECT scenario, year, month, row, col, {R6('value')} AS value FROM ({ANOM})")
def anomaly_add(spark, sf):
    return out(climate.anomaly(cube.cells(spark, sf), clim_of(spark, sf), "add"), "scenario")


@query("anomaly_mult", f"SELECT scenario, year, month, row, col, {R6('value')} AS value FROM ({RATIO})")
def anomaly_mult(spark, sf):
    return out(climate.anomaly(cube.cells(spark, sf, "pr"), clim_of(spark, sf, "pr"), "mult"), "scenario")


@query("anomaly_restrict", f"SELECT scenario, year, month, row, col, {R6('value')} AS value FROM ({ANOM}) WHERE scenario = 'rcp60'")
def anomaly_restrict(spark, sf):
    c = cube.cells(spark, sf)
    future = c.where(F.col("scenario") == "rcp60")
    return out(climate.restrict_times(climate.anomaly(c, clim_of(spark, sf), "add"), future), "scenario")


def _split(spark, sf, variable="tas"):
    c = cube.cells(spark, sf, variable)
    return c.where(F.col("scenario") == "historical"), c.where(F.col("scenario") == "rcp60")


@query("anomaly_farfuture", f"SELECT year, month, row, col, {R6('value')} AS value FROM ({ANOM}) WHERE scenario = 'rcp60'")
def anomaly_farfuture(spark, sf):
    past, later = _split(spark, sf)
    return out(delta.anomaly_farfuture(past, later, cube.BEGIN, cube.END, "add"))


@query(
    "anomaly_lowres_export",
    f"SELECT 'tas' AS variable, year, month, row, col, {R6('value')} AS value FROM ({ANOM}) "
    f"UNION ALL SELECT 'pr', year, month, row, col, {R6('value')} FROM ({RATIO})",
)
def anomaly_lowres_export(spark, sf):
    c = cube.cells(spark, sf, ["tas", "pr"]).drop("scenario")
    return out(climate.lowres_anomalies(c, cube.BEGIN, cube.END), "variable")


@query("delta_minmax", "SELECT year, month, row, col, a.value - b.value AS value FROM cells_tasmax a JOIN cells_tas b USING (year, month, row, col)")
def delta_minmax(spark, sf):
    return climate.delta_to_mean(cube.cells(spark, sf, "tasmax"), cube.cells(spark, sf)).select(*YMRC, "value")


@query("semi_future_times", "SELECT year, month, row, col, value FROM cells_tas WHERE year >= 2000")
def semi_future_times(spark, sf):
    later = _split(spark, sf)[1].select("year", "month")
    return climate.restrict_times(cube.cells(spark, sf), later).select(*YMRC, "value")


# ---- recombination ----------------------------------------------------------------

# coarse cells on the fine ones by the nearest centre
CTES["near_tas"], CTES["near_pr"] = (
    f"SELECT c.year, c.month, f.row, f.col, c.value FROM (SELECT row, col, floor(fy + 0.5e0) AS r0, floor(fx + 0.5e0) AS c0 "
    f"FROM (SELECT *, {fine_place()} FROM fine)) f JOIN cells_{v} c ON c.row = f.r0 AND c.col = f.c0"
    for v in ("tas", "pr")
)
SAME_CELL = "SELECT c.year, c.month, c.row, c.col, {} AS value FROM near_{} c JOIN base_{} b USING (row, col, month)"


def _near(spark, sf, variable="tas"):
    coarse, fine = cube.grids(spark, sf)
    return regrid.regrid(cube.cells(spark, sf, variable), _target(spark, sf), coarse, fine, "nearest").where("value IS NOT NULL")


@query("join_baseline_month", SAME_CELL.format("b.value", "tas", "tas"))
def join_baseline_month(spark, sf):
    """The monthly baseline beside each fine cell of the series."""
    return climate.join_month_lookup(_near(spark, sf), cube.baseline(spark, sf), "base").select(*YMRC, F.col("base").alias("value"))


@query(
    "join_baseline_time",
    "SELECT year, month, row, col, a.value AS extreme, b.value AS mean FROM cells_tasmin a JOIN cells_tas b USING (year, month, row, col)",
)
def join_baseline_time(spark, sf):
    """The mean series as a baseline of its own for each month of each year."""
    j = climate.join_baseline_time(cube.cells(spark, sf, "tasmin").drop("variable"), cube.cells(spark, sf), "mean")
    return j.select(*YMRC, F.col("value").alias("extreme"), "mean")


@query("apply_delta_add", SAME_CELL.format("b.value + c.value", "tas", "tas"))
def apply_delta_add(spark, sf):
    return climate.apply_delta(_near(spark, sf), cube.baseline(spark, sf), "add").select(*YMRC, "value")


@query("apply_delta_bucketed", SAME_CELL.format("b.value + c.value", "tas", "tas"))
def apply_delta_bucketed(spark, sf):
    """Series and baseline stored in the same buckets, joined without a shuffle."""
    a, b = work_folder(spark, "series"), work_folder(spark, "baseline")
    series = sinks.sink_bucketed(_near(spark, sf).select(*YMRC, "value"), a, 8)
    base = sinks.sink_bucketed(cube.baseline(spark, sf), b, 8)
    return climate.apply_delta(series, base, "add").select(*YMRC, "value")


@query("apply_delta_mult", SAME_CELL.format("b.value * c.value", "pr", "pr"))
def apply_delta_mult(spark, sf):
    return climate.apply_delta(_near(spark, sf, "pr"), cube.baseline(spark, sf, "pr"), "mult").select(*YMRC, "value")


@query(
    "apply_delta_minmax",
    "SELECT year, month, row, col, m.value + (x.value - m.value) AS value FROM cells_tasmax x JOIN cells_tas m USING (year, month, row, col)",
)
def apply_delta_minmax(spark, sf):
    mean = cube.cells(spark, sf).drop("variable")
    deltas = climate.delta_to_mean(cube.cells(spark, sf, "tasmax"), mean)
    return climate.apply_delta(deltas, mean, "add").select(*YMRC, "value")


@query("inf_to_nodata", "SELECT year, month, row, col, CASE WHEN value <> 0 THEN 1 / value END AS value FROM cells_pr")
def inf_to_nodata(spark, sf):
    """Dry cells have an infinite reciprocal."""
    v = F.when(F.col("value") != 0, 1 / F.col("value")).otherwise(float("inf"))
    return cube.cells(spark, sf, "pr").select(*YMRC, values.inf_to_null(v).alias("value"))


@query("post_function", "SELECT year, month, row, col, greatest(value, 0) AS value FROM cells_tas")
def post_function(spark, sf):
    positive = lambda x: F.greatest(x, F.lit(0.0))
    return climate.post_function(cube.cells(spark, sf), positive).select(*YMRC, "value")


def _clamp(name, expr, fn):
    @query(name, f"SELECT year, month, row, col, CAST({expr} AS DOUBLE) AS value FROM cells_hur")
    def run(spark, sf):
        return cube.cells(spark, sf, "hur").select(*YMRC, fn(F.col("value")).alias("value"))


_clamp("clamp_humidity", "CASE WHEN value < 0 THEN 0 WHEN value > 100 THEN 95 ELSE value END", values.clamp_humidity)
_clamp("clamp_cloud", "least(greatest(value, 0), 100)", values.clamp_cloud)
_clamp("clamp_legacy", "CASE WHEN value > 100 AND value < 500 THEN 95 ELSE value END", values.clamp_legacy)


@query(
    "variable_policy",
    "SELECT 'tas' AS variable, 'add' AS operation, year, month, row, col, round_even(value * 1e1, 0) / 1e1 + 0e0 AS value FROM cells_tas "
    "UNION ALL SELECT 'pr', 'mult', year, month, row, col, round_even(value, 0) + 0e0 FROM cells_pr "
    "UNION ALL SELECT 'hur', 'mult', year, month, row, col, round_even((CASE WHEN value < 0 THEN 0 WHEN value > 100 THEN 95 ELSE value END) * 1e1, 0) / 1e1 + 0e0 FROM cells_hur",
)
def variable_policy(spark, sf):
    """Each variable's operation and post function, as the policy gives them."""
    c = cube.cells(spark, sf, ["tas", "pr", "hur"])
    parts = []
    for v in ("tas", "pr", "hur"):
        p = policy.variable_policy(v)
        own = c.where(F.col("variable") == v).withColumn("operation", F.lit(p.operation))
        parts.append(climate.post_function(own, p.post()).select("variable", "operation", *YMRC, (F.col("value") + 0.0).alias("value")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- regridding ----------------------------------------------------------------------


def _target(spark, sf):
    return cube.fine_cells(spark, sf).select("row", "col")


@query(
    "regrid_nearest",
    f"SELECT t.year, t.month, f.row, f.col, c.value FROM (SELECT row, col, floor(fy + 0.5e0) AS r0, floor(fx + 0.5e0) AS c0 "
    f"FROM (SELECT *, {fine_place()} FROM fine)) f JOIN (SELECT DISTINCT year, month FROM cells_tas) t ON true "
    "LEFT JOIN cells_tas c ON c.row = f.r0 AND c.col = f.c0 AND c.year = t.year AND c.month = t.month",
)
def regrid_nearest(spark, sf):
    coarse, fine = cube.grids(spark, sf)
    return regrid.regrid(cube.cells(spark, sf), _target(spark, sf), coarse, fine, "nearest").select(*YMRC, "value")


@query("regrid_bilinear", f"SELECT year, month, row, col, {R6('rv')} AS value FROM ({bilinear_sql('gappy_tas')})")
def regrid_bilinear(spark, sf):
    """With missing source cells: the weights of those present are scaled up."""
    coarse, fine = cube.grids(spark, sf)
    return out(regrid.regrid(cube.gappy(spark, sf), _target(spark, sf), coarse, fine, "bilinear"))


PI = "3.141592653589793e0"
KERNELS = {
    "cubic": ((-1, 2), "CASE WHEN {d} <= 1 THEN (1.5e0 * {d} - 2.5e0) * {d} * {d} + 1 WHEN {d} < 2 THEN ((-0.5e0 * {d} + 2.5e0) * {d} - 4) * {d} + 2 ELSE 0 END"),
    "cubic_spline": ((-1, 2), "CASE WHEN {d} <= 1 THEN (0.5e0 * {d} - 1) * {d} * {d} + 2e0 / 3 WHEN {d} < 2 THEN (2 - {d}) ** 3 / 6 ELSE 0 END"),
    "lanczos": ((-2, 3), f"CASE WHEN {{d}} < 1e-9 THEN 1 WHEN {{d}} < 3 THEN 3 * sin({PI} * {{d}}) * sin({PI} * {{d}} / 3) / ({PI} * {PI} * {{d}} * {{d}}) ELSE 0 END"),
}


def kernel_sql(method: str) -> str:
    """Weighted mean over the kernel's source cells, one joined row per cell of it."""
    (lo, hi), w = KERNELS[method]
    return (
        f"SELECT year, month, row, col, CASE WHEN sum(w) > 1e-6 THEN {R6('sum(w * value) / sum(w)')} END AS value FROM "
        f"(SELECT year, month, row, col, CASE WHEN value IS NOT NULL THEN w END AS w, value FROM (SELECT t.year, t.month, f.row, f.col, {w.format(d='abs(ty - i)')} * {w.format(d='abs(tx - j)')} AS w, c.value FROM "
        "(SELECT row, col, nx, floor(fy) AS r0, floor(fx) AS c0, round_even((fy - floor(fy)) * 1e9, 0) / 1e9 AS ty, "
        f"round_even((fx - floor(fx)) * 1e9, 0) / 1e9 AS tx FROM (SELECT *, {fine_place()} FROM fine)) f "
        "JOIN (SELECT DISTINCT year, month FROM gappy_tas) t ON true "
        f"CROSS JOIN range({lo}, {hi + 1}) a(i) CROSS JOIN range({lo}, {hi + 1}) b(j) "
        "LEFT JOIN gappy_tas c ON c.row = r0 + i AND c.col = (c0 + j + nx) % nx AND c.year = t.year AND c.month = t.month)) "
        "GROUP BY year, month, row, col"
    )


def _kernel(method):
    @query(f"regrid_{method}", kernel_sql(method))
    def run(spark, sf):
        coarse, fine = cube.grids(spark, sf)
        return out(regrid.regrid(cube.gappy(spark, sf), _target(spark, sf), coarse, fine, method))


for _m in KERNELS:
    _kernel(_m)


def _fine_field(spark, sf):
    """The fine baseline as a series of twelve months."""
    return cube.baseline(spark, sf)


PARENT = (
    "SELECT month, CAST(floor((0e0 + row + 0.5e0) / 5) AS INTEGER) AS row, CAST(floor((0e0 + col + 0.5e0) / 4) AS INTEGER) AS col, value FROM base_tas"
)


def _coarse_target(spark, sf):
    return cube.mask(spark, sf).select("row", "col")


@query("regrid_average", f"SELECT month, row, col, {R6('avg(value)')} AS value FROM (SELECT row, col, month FROM sup CROSS JOIN months) LEFT JOIN ({PARENT}) USING (month, row, col) GROUP BY month, row, col")
def regrid_average(spark, sf):
    coarse, fine = cube.grids(spark, sf)
    r = regrid.regrid(_fine_field(spark, sf), _coarse_target(spark, sf), fine, coarse, "average")
    return r.select("month", "row", "col", r6("value").alias("value"))


@query(
    "regrid_mode",
    "SELECT month, row, col, max_by(value, n * 1e6 - value) AS value FROM (SELECT row, col, month FROM sup CROSS JOIN months) LEFT JOIN "
    f"(SELECT month, row, col, value, count(*) AS n FROM ({PARENT}) GROUP BY ALL) USING (month, row, col) GROUP BY month, row, col",
)
def regrid_mode(spark, sf):
    coarse, fine = cube.grids(spark, sf)
    r = regrid.regrid(_fine_field(spark, sf), _coarse_target(spark, sf), fine, coarse, "mode")
    return r.select("month", "row", "col", "value")


# ---- area resampling at other ratios -------------------------------------------


def overlap_sql(source: str, keys: str, sdx: str, sdy: str, tnx: str, tny: str) -> str:
    """SELECT of keys, trow, tcol, value and shared area ``w`` of a global source with cells of
    sdx by sdy degrees and a global target of tnx by tny cells."""
    tdx, tdy = f"(360e0 / ({tnx}))", f"(180e0 / ({tny}))"
    wx = f"(least((s.col + 1) * {sdx}, (tcol + 1) * {tdx}) - greatest(s.col * {sdx}, tcol * {tdx})) / {tdx}"
    wy = f"(least((s.row + 1) * {sdy}, (trow + 1) * {tdy}) - greatest(s.row * {sdy}, trow * {tdy})) / {tdy}"
    return (
        f"SELECT {keys}, trow, tcol, value, wx * wy AS w FROM (SELECT s.*, trow, tcol, {wx} AS wx, {wy} AS wy FROM ({source}) s "
        f"CROSS JOIN (SELECT CAST(unnest(range(0, {tny})) AS INTEGER) AS trow FROM g) CROSS JOIN (SELECT CAST(unnest(range(0, {tnx})) AS INTEGER) AS tcol FROM g)) "
        "WHERE value IS NOT NULL AND wx > 1e-9 AND wy > 1e-9"
    )


# an uneven ratio: fewer columns, more rows than the coarse grid has
_UNEVEN = overlap_sql("SELECT *, nx, ny FROM gappy_tas, g", "year, month", "(360e0 / nx)", "(180e0 / ny)", "nx - 2", "ny + 3")
_UNEVEN_ALL = (
    "(SELECT DISTINCT year, month FROM gappy_tas) CROSS JOIN (SELECT CAST(unnest(range(0, ny + 3)) AS INTEGER) AS trow FROM g) "
    "CROSS JOIN (SELECT CAST(unnest(range(0, nx - 2)) AS INTEGER) AS tcol FROM g)"
)


def _uneven(spark, sf, method):
    from climgrid.grid import Grid

    coarse, _ = cube.grids(spark, sf)
    target = Grid.global_latlon(coarse.nx - 2, coarse.ny + 3, "uneven")
    cells = cube.gappy(spark, sf).drop("scenario", "variable")
    where = gaps.frame(cells, [], (0, target.ny - 1), (0, target.nx - 1))
    return regrid.regrid(cells, where, coarse, target, method)


@query(
    "regrid_average_uneven",
    f"SELECT year, month, trow AS row, tcol AS col, {R6('sum(w * value) / sum(w)')} AS value "
    f"FROM {_UNEVEN_ALL} LEFT JOIN ({_UNEVEN}) USING (year, month, trow, tcol) GROUP BY ALL",
)
def regrid_average_uneven(spark, sf):
    return out(_uneven(spark, sf, "average"))


@query(
    "regrid_mode_uneven",
    "SELECT year, month, trow AS row, tcol AS col, value FROM "
    f"{_UNEVEN_ALL} LEFT JOIN (SELECT year, month, trow, tcol, value, row_number() OVER (PARTITION BY year, month, trow, tcol "
    f"ORDER BY round_even(sum(w) * 1e9, 0) DESC, value) AS k FROM ({_UNEVEN}) GROUP BY year, month, trow, tcol, value QUALIFY k = 1) "
    "USING (year, month, trow, tcol)",
)
def regrid_mode_uneven(spark, sf):
    return _uneven(spark, sf, "mode").select(*YMRC, "value")


_FINER = (
    "SELECT t.year, t.month, f.row, f.col, value FROM (SELECT DISTINCT year, month FROM gappy_tas) t CROSS JOIN fine f "
    "LEFT JOIN gappy_tas x ON x.year = t.year AND x.month = t.month AND x.row = f.row // 5 AND x.col = f.col // 4"
)


@query("regrid_average_finer", _FINER)
def regrid_average_finer(spark, sf):
    """Every fine cell takes the mean of the coarse cell that covers it."""
    coarse, fine = cube.grids(spark, sf)
    return regrid.regrid(cube.gappy(spark, sf), cube.fine_cells(spark, sf).select("row", "col"), coarse, fine, "average").select(*YMRC, "value")


@query("regrid_mode_finer", _FINER)
def regrid_mode_finer(spark, sf):
    coarse, fine = cube.grids(spark, sf)
    return regrid.regrid(cube.gappy(spark, sf), cube.fine_cells(spark, sf).select("row", "col"), coarse, fine, "mode").select(*YMRC, "value")


# ---- kernels for a coarser target ----------------------------------------------


def wide_sql(method: str) -> str:
    """The fine baseline on the coarse grid (4 x 5 fine cells each): every fine cell serves the
    coarse cells within the kernel's reach, measured in coarse cells."""
    reach, w = {"bilinear": (1, "greatest(0e0, 1e0 - {d})")}.get(method) or (KERNELS[method][0][1], KERNELS[method][1])
    dx, dy = "round_even(abs(floor(u) + j - u) * 1e9, 0) / 1e9", "round_even(abs(floor(v) + i - v) * 1e9, 0) / 1e9"
    return (
        f"SELECT month, row, col, {R6('value')} AS value FROM (SELECT row, col, month FROM sup CROSS JOIN months) LEFT JOIN ("
        "SELECT month, r AS row, c AS col, CASE WHEN sum(w) > 1e-6 THEN sum(w * value) / sum(w) END AS value FROM ("
        f"SELECT month, CAST(floor(v) + i AS INTEGER) AS r, CAST((floor(u) + j + 4 * nx) % nx AS INTEGER) AS c, ny, value, {w.format(d=dx)} * {w.format(d=dy)} AS w "
        "FROM (SELECT *, (col + 0.5e0) / 4 - 0.5e0 AS u, (row + 0.5e0) / 5 - 0.5e0 AS v FROM base_tas) "
        f"CROSS JOIN range({-reach}, {reach + 2}) a(i) CROSS JOIN range({-reach}, {reach + 2}) b(j) "
        f"WHERE abs(floor(v) + i - v) < {reach} - 1e-9 AND abs(floor(u) + j - u) < {reach} - 1e-9) WHERE r BETWEEN 0 AND ny - 1 GROUP BY ALL) "
        "USING (month, row, col)"
    )


def _wide(method):
    @query(f"regrid_{method}_coarser", wide_sql(method))
    def run(spark, sf):
        coarse, fine = cube.grids(spark, sf)
        r = regrid.regrid(_fine_field(spark, sf), _coarse_target(spark, sf), fine, coarse, method)
        return r.select("month", "row", "col", r6("value").alias("value"))


for _m in ("bilinear", *KERNELS):
    _wide(_m)


# ---- filling gaps --------------------------------------------------------------

FILL = """
WITH dense AS ({src}),
x AS (SELECT *, lag_v, lag_p, lead_v, lead_p FROM (SELECT *,
  last_value(value IGNORE NULLS) OVER bx AS lag_v, last_value(CASE WHEN value IS NOT NULL THEN col END IGNORE NULLS) OVER bx AS lag_p,
  first_value(value IGNORE NULLS) OVER fx AS lead_v, first_value(CASE WHEN value IS NOT NULL THEN col END IGNORE NULLS) OVER fx AS lead_p,
  last_value(value IGNORE NULLS) OVER by_ AS up_v, last_value(CASE WHEN value IS NOT NULL THEN row END IGNORE NULLS) OVER by_ AS up_p,
  first_value(value IGNORE NULLS) OVER fy AS dn_v, first_value(CASE WHEN value IS NOT NULL THEN row END IGNORE NULLS) OVER fy AS dn_p
  FROM dense WINDOW bx AS (PARTITION BY year, month, row ORDER BY col ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  fx AS (PARTITION BY year, month, row ORDER BY col ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),
  by_ AS (PARTITION BY year, month, col ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  fy AS (PARTITION BY year, month, col ORDER BY row ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))),
e AS (SELECT *, lag_v + (lead_v - lag_v) * (col - lag_p) / (lead_p - lag_p) AS ex, 1e0 / (lead_p - lag_p) AS wx,
  up_v + (dn_v - up_v) * (row - up_p) / (dn_p - up_p) AS ey, 1e0 / (dn_p - up_p) AS wy FROM x),
filled AS (SELECT year, month, row, col, coalesce(value, (ex * wx + ey * wy) / (wx + wy), ex, ey) AS value FROM e)
"""


@query("fill_gaps_linear", FILL.format(src="SELECT * FROM gappy_tas") + f"SELECT year, month, row, col, {R6('value')} AS value FROM filled")
def fill_gaps_linear(spark, sf):
    return out(gaps.fill_gaps_linear(cube.gappy(spark, sf).drop("scenario", "variable")))


@query(
    "regrid_points",
    FILL.format(
        src="SELECT year, month, row, col, value FROM "
        "(SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders) "
        "CROSS JOIN (SELECT CAST(unnest(range(0, ny)) AS INTEGER) AS row FROM g) CROSS JOIN (SELECT CAST(unnest(range(0, nx)) AS INTEGER) AS col FROM g) "
        "LEFT JOIN (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, "
        "o_custkey % ny AS row, o_custkey // ny % nx AS col, avg(round(o_totalprice)) AS value FROM orders, g GROUP BY ALL) USING (year, month, row, col)"
    )
    + f"SELECT year, month, row, col, {R6('value')} AS value FROM filled",
)
def regrid_points(spark, sf):
    """Orders as scattered points: place from the customer, value from the price; the grid
    has as many cells as the coarse one."""
    from climgrid.grid import Grid

    coarse, _ = cube.grids(spark, sf)
    grid = Grid(coarse.nx, coarse.ny, 0.0, float(coarse.ny), 1.0, 1.0)
    k = F.col("o_custkey")
    pts = cube.table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        (F.lit(grid.ny - 0.5) - k % grid.ny).alias("lat"), (F.floor(k / grid.ny) % grid.nx + 0.5).alias("lon"),
        F.round("o_totalprice").alias("value"),
    )
    return gaps.regrid_points(pts, grid).select(*YMRC, r6("value").alias("value"))


def hull_sql(points: str, by: str, cells: str, value: str) -> str:
    """SELECT of by, row, col and ``value`` on the cells within the hull of the points (x, y)
    of their group, NULL elsewhere.  Between the lowest and the highest line through any two
    points left and right of a cell lies the hull; it must have an area."""
    line = "CASE WHEN b.x = a.x THEN {0}(a.y, b.y) ELSE a.y + (b.y - a.y) * (c.x - a.x) / (b.x - a.x) END"
    return (
        f"WITH p AS MATERIALIZED ({points}), cells AS MATERIALIZED ({cells}), "
        f"ends AS (SELECT {by}, x, min(y) AS lo, max(y) AS hi FROM p GROUP BY ALL), "
        f"xs AS (SELECT DISTINCT {by}, x FROM cells UNION SELECT DISTINCT {by}, x FROM p), "
        f"reach AS MATERIALIZED (SELECT {by}, x, min(least(lo_line, hi_line)) AS lo, max(greatest(lo_line, hi_line)) AS hi FROM (SELECT {by}, c.x, "
        f"{line.format('least').replace('a.y', 'a.lo').replace('b.y', 'b.lo')} AS lo_line, {line.format('greatest').replace('a.y', 'a.hi').replace('b.y', 'b.hi')} AS hi_line "
        f"FROM xs c JOIN ends a USING ({by}) JOIN ends b USING ({by}) WHERE a.x <= c.x AND c.x <= b.x) GROUP BY ALL), "
        f"flat AS (SELECT {by}, max(hi - lo) > 1e-9 AS area FROM reach GROUP BY ALL) "
        f"SELECT {by}, row, col, CASE WHEN known OR (area AND y BETWEEN lo - 1e-9 AND hi + 1e-9) THEN {value} END AS value "
        f"FROM cells LEFT JOIN reach USING ({by}, x) LEFT JOIN flat USING ({by})"
    )


_PLANE_CELLS = (
    "SELECT year, month, row, col, CAST(col AS DOUBLE) AS x, CAST(row AS DOUBLE) AS y, coalesce(k, false) AS known "
    "FROM (SELECT DISTINCT year, month FROM gappy_tas) CROSS JOIN (SELECT CAST(unnest(range(0, ny)) AS INTEGER) AS row FROM g) "
    "CROSS JOIN (SELECT CAST(unnest(range(0, nx)) AS INTEGER) AS col FROM g) "
    "LEFT JOIN (SELECT year, month, row, col, true AS k FROM gappy_tas WHERE value IS NOT NULL) USING (year, month, row, col)"
)


@query(
    "fill_gaps_triangles",
    "SELECT year, month, row, col, " + R6("value") + " AS value FROM ("
    + hull_sql(
        "SELECT year, month, CAST(col AS DOUBLE) AS x, CAST(row AS DOUBLE) AS y FROM gappy_tas WHERE value IS NOT NULL",
        "year, month", _PLANE_CELLS, "row * 2 - col * 0.25e0 + month",
    ) + ")",
)
def fill_gaps_triangles(spark, sf):
    """A plane over the cells that each month holds: its holes come back exactly, and nothing
    beyond the hull of the cells."""
    coarse, _ = cube.grids(spark, sf)
    plane = F.col("row") * 2 - F.col("col") * 0.25 + F.col("month")
    cells = cube.gappy(spark, sf).withColumn("value", F.when(F.col("value").isNotNull(), plane))
    return out(gaps.fill_gaps(cells.drop("scenario", "variable"), coarse, "triangles"))


@query("fill_gaps_holes")
def fill_gaps_holes(spark, sf):
    """The cells themselves: triangulations have no SQL; the tests hold them against brute force."""
    coarse, _ = cube.grids(spark, sf)
    return out(gaps.fill_gaps(cube.gappy(spark, sf).drop("scenario", "variable"), coarse, "triangles"))


_SPOT = (
    "SELECT 'M' || (s_nationkey % 3) AS model, CAST(s_suppkey * 137 % 359 AS DOUBLE) + s_nationkey / 32e0 AS x, "
    "CAST(floor(s_acctbal) AS DOUBLE) / 64 - 70 AS y FROM supplier"
)


@query(
    "regrid_points_triangles",
    f"SELECT model, row, col, {R6('value')} AS value FROM ("
    + hull_sql(
        _SPOT, "model",
        "SELECT model, row, col, (col + 0.5e0) * 9 AS x, 90 - (row + 0.5e0) * 6 AS y, false AS known FROM (SELECT DISTINCT model FROM "
        f"({_SPOT})) CROSS JOIN (SELECT CAST(unnest(range(0, 30)) AS INTEGER) AS row) CROSS JOIN (SELECT CAST(unnest(range(0, 40)) AS INTEGER) AS col)",
        "3 * y - 0.5e0 * x",
    ) + ")",
)
def regrid_points_triangles(spark, sf):
    """Suppliers as scattered points of three models, with a plane's values."""
    from climgrid.grid import Grid

    x = (F.col("s_suppkey") * 137 % 359).cast("double") + F.col("s_nationkey") / 32
    y = F.floor("s_acctbal").cast("double") / 64 - 70
    model = F.concat(F.lit("M"), (F.col("s_nationkey") % 3).cast("string"))
    points = cube.table(spark, sf, "supplier").select(model.alias("model"), x.alias("lon"), y.alias("lat"), (y * 3 - x * 0.5).alias("value"))
    return gaps.regrid_points(points, Grid(40, 30, 0.0, 90.0, 9.0, 6.0), "triangles").select("model", "row", "col", r6("value").alias("value"))


@query("regrid_bilinear_lambert", f"SELECT year, month, row, col, {R6('rv')} AS value FROM ({bilinear_sql('cells_tas', 'lambert', place=PROJ_PLACE)})")
def regrid_bilinear_lambert(spark, sf):
    """Onto a grid of a conformal conic projection."""
    coarse, _ = cube.grids(spark, sf)
    return out(regrid.regrid(cube.cells(spark, sf), _target(spark, sf), coarse, cube.projected(spark, sf, "EPSG:3347", 4000000.0, 4000000.0), "bilinear"))


@query("regrid_bilinear_projected", f"SELECT year, month, row, col, {R6('rv')} AS value FROM ({bilinear_sql('cells_tas', 'proj', place=PROJ_PLACE)})")
def regrid_bilinear_projected(spark, sf):
    """From longitude and latitude onto a projected grid."""
    coarse, _ = cube.grids(spark, sf)
    return out(regrid.regrid(cube.cells(spark, sf), _target(spark, sf), coarse, cube.projected(spark, sf), "bilinear"))


# ---- pipelines ----------------------------------------------------------------------


def _anoms(variable, expr):
    return (
        f"anoms AS (SELECT year, month, row, col, {expr} AS value FROM cells_{variable} c LEFT JOIN clim_{variable} m USING (row, col, month) {{where}})"
    )


def refine_sql(anoms: str, variable: str, combined: str, target: str = "fine", place: str | None = None) -> str:
    """Bilinear anomalies on the fine cells, joined with the monthly baseline."""
    body = bilinear_sql("anoms", target, place=place)
    return (
        f"WITH {anoms} SELECT r.year, r.month, r.row, r.col, {combined} AS value FROM ({body}) r "
        f"JOIN base_{variable} b ON b.row = r.row AND b.col = r.col AND b.month = r.month"
    )


TAS_ANOMS = _anoms("tas", "c.value - m.clim").format(where="WHERE year >= 2000")


@query("delta_pipeline", refine_sql(TAS_ANOMS, "tas", f"CASE WHEN b.inside = 1 THEN {R('b.value + rv', 1)} + 0e0 END"))
def delta_pipeline(spark, sf):
    """Temperature: climatology 1995-1999, additive anomalies of the later years on the
    fine baseline, rounded to one decimal, masked."""
    coarse, fine = cube.grids(spark, sf)
    past, later = _split(spark, sf)
    refined = delta.delta_pipeline(
        past.drop("variable"), cube.baseline(spark, sf), coarse, fine, future=later.drop("variable"),
        begin=cube.BEGIN, end=cube.END, post=policy.variable_policy("tas").post(), mask=cube.fine_mask(spark, sf),
    )
    return refined.select(*YMRC, (F.col("value") + 0.0).alias("value"))


CLT_ANOMS = _anoms("clt", "CASE WHEN m.clim <> 0 THEN c.value / m.clim END").format(where="")


@query(
    "delta_pipeline_mult",
    refine_sql(CLT_ANOMS, "clt", f"{R6('CASE WHEN b.value * rv < 0 THEN 0 WHEN b.value * rv > 100 THEN 100 ELSE b.value * rv END')}"),
)
def delta_pipeline_mult(spark, sf):
    """Cloud over all years: ratios on the fine baseline, kept in 0..100."""
    coarse, fine = cube.grids(spark, sf)
    c = cube.cells(spark, sf, "clt").drop("variable", "scenario")
    refined = delta.delta_pipeline(
        c, cube.baseline(spark, sf, "clt"), coarse, fine, begin=cube.BEGIN, end=cube.END, operation="mult",
        post=values.clamp_cloud,
    )
    return out(refined)


MINMAX_ANOMS = (
    "anoms AS (SELECT year, month, row, col, x.value - m.value AS value FROM cells_tasmax x JOIN cells_tas m USING (year, month, row, col)), "
    "mean AS (SELECT year, month, row, col, c.value - m.clim AS value FROM cells_tas c LEFT JOIN clim_tas m USING (row, col, month))"
)


@query(
    "delta_pipeline_minmax",
    f"WITH {MINMAX_ANOMS} SELECT d.year, d.month, d.row, d.col, {R6('b.value + m.rv + d.rv')} AS value "
    f"FROM ({bilinear_sql('anoms')}) d JOIN ({bilinear_sql('mean')}) m USING (year, month, row, col) "
    "JOIN base_tas b ON b.row = d.row AND b.col = d.col AND b.month = d.month",
)
def delta_pipeline_minmax(spark, sf):
    """Maximum temperature on the refined mean series of all years."""
    coarse, fine = cube.grids(spark, sf)
    whole = cube.cells(spark, sf).drop("scenario")
    mean = delta.delta_pipeline(
        whole.drop("variable"), cube.baseline(spark, sf), coarse, fine, begin=cube.BEGIN, end=cube.END
    )
    extreme = cube.cells(spark, sf, "tasmax").drop("scenario")
    return out(delta.delta_pipeline_minmax(extreme, whole, mean, coarse, fine))


MIXED = {
    "tas": refine_sql(_anoms("tas", "c.value - m.clim").format(where=""), "tas", f"{R('b.value + rv', 1)} + 0e0"),
    "clt": refine_sql(CLT_ANOMS, "clt", f"{R('CASE WHEN b.value * rv < 0 THEN 0 WHEN b.value * rv > 100 THEN 100 ELSE b.value * rv END', 1)} + 0e0"),
}


@query("delta_pipeline_mixed", " UNION ALL ".join(f"SELECT '{v}' AS variable, * FROM ({sql})" for v, sql in MIXED.items()))
def delta_pipeline_mixed(spark, sf):
    """Temperature and cloud in one table, each by its policy."""
    coarse, fine = cube.grids(spark, sf)
    c = cube.cells(spark, sf, list(MIXED)).drop("scenario")
    named = [cube.baseline(spark, sf, v).withColumn("variable", F.lit(v)) for v in MIXED]
    refined = delta.delta_pipeline_mixed(
        c, named[0].unionByName(named[1]), coarse, fine, list(MIXED), begin=cube.BEGIN, end=cube.END
    )
    return refined.select("variable", *YMRC, (F.col("value") + 0.0).alias("value"))


@query(
    "delta_pipeline_projected",
    refine_sql(TAS_ANOMS, "tas", f"{R('b.value + rv', 1)} + 0e0", "proj", PROJ_PLACE),
)
def delta_pipeline_projected(spark, sf):
    """The fine baseline lies on a projected grid, the coarse series in degrees."""
    coarse, _ = cube.grids(spark, sf)
    past, later = _split(spark, sf)
    refined = delta.delta_pipeline(
        past.drop("variable"), cube.baseline(spark, sf), coarse, cube.projected(spark, sf), future=later.drop("variable"),
        begin=cube.BEGIN, end=cube.END, post=policy.variable_policy("tas").post(),
    )
    return refined.select(*YMRC, (F.col("value") + 0.0).alias("value"))


@query(
    "delta_pipeline_scenarios",
    "WITH own AS (SELECT CASE WHEN year <= 1997 THEN 'historical' WHEN s = 1 THEN 'rcp26' ELSE 'rcp60' END AS scenario, year, month, row, col, "
    "value + CASE WHEN year > 1997 THEN s ELSE 0 END AS value FROM cells_tas, range(1, 3) r(s) WHERE year > 1997 OR s = 1), "
    "clims AS (SELECT f.scenario, row, col, month, avg(value) AS clim FROM own o JOIN (SELECT unnest(['rcp26', 'rcp60']) AS scenario) f "
    "ON o.scenario IN ('historical', f.scenario) WHERE year BETWEEN 1995 AND 1999 GROUP BY ALL), "
    "a1 AS (SELECT year, month, row, col, value - clim AS value FROM own JOIN clims USING (scenario, row, col, month) WHERE scenario = 'rcp26'), "
    "a2 AS (SELECT year, month, row, col, value - clim AS value FROM own JOIN clims USING (scenario, row, col, month) WHERE scenario = 'rcp60') "
    f"SELECT scenario, r.year, r.month, r.row, r.col, {R6('b.value + rv')} AS value FROM (SELECT 'rcp26' AS scenario, * FROM ({bilinear_sql('a1')}) "
    f"UNION ALL SELECT 'rcp60', * FROM ({bilinear_sql('a2')})) r JOIN base_tas b ON b.row = r.row AND b.col = r.col AND b.month = r.month",
)
def delta_pipeline_scenarios(spark, sf):
    """Two scenarios in one table; the base period reaches two years into both."""
    coarse, fine = cube.grids(spark, sf)
    c = cube.cells(spark, sf).drop("scenario", "variable")
    past, later = c.where(F.col("year") <= 1997), c.where(F.col("year") > 1997)
    future = later.withColumn("s", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        F.when(F.col("s") == 1, "rcp26").otherwise("rcp60").alias("scenario"), *YMRC, (F.col("value") + F.col("s")).alias("value")
    )
    refined = delta.delta_pipeline(
        past.withColumn("scenario", F.lit("historical")), cube.baseline(spark, sf), coarse, fine, future=future, begin=cube.BEGIN, end=cube.END
    )
    return out(refined, "scenario")


@query("delta_pipeline_farfuture", refine_sql(TAS_ANOMS, "tas", R6("b.value + rv")))
def delta_pipeline_farfuture(spark, sf):
    coarse, fine = cube.grids(spark, sf)
    past, later = (d.drop("scenario") for d in _split(spark, sf))
    refined = delta.delta_pipeline_farfuture(
        past, later, cube.baseline(spark, sf), coarse, fine, begin=cube.BEGIN, end=cube.END
    )
    return out(refined)


# ---- precipitation -----------------------------------------------------------------

P95 = (
    "p AS (SELECT year, month, quantile_cont(value, 0.95) AS p FROM {src} JOIN sup USING (row, col) WHERE inside = 1 AND value IS NOT NULL GROUP BY year, month), "
    "cap AS (SELECT c.year, c.month, any_value(p.p) AS p, arg_min(c.value, abs(c.value - p.p) * 1e6 + c.value * 1e-3) AS cap "
    "FROM {src} c JOIN sup USING (row, col) JOIN p ON p.year = c.year AND p.month = c.month WHERE inside = 1 AND c.value IS NOT NULL GROUP BY c.year, c.month)"
)


@query("aoi_p95", f"WITH {P95.format(src='cells_pr')} SELECT year, month, {R6('p')} AS quantile, cap AS nearest FROM cap")
def aoi_p95(spark, sf):
    c = cube.cells(spark, sf, "pr").drop("scenario", "variable")
    return precip.aoi_p95(c, cube.mask(spark, sf)).select("year", "month", r6("quantile").alias("quantile"), "nearest")


def _pr(spark, sf):
    return cube.cells(spark, sf, "pr").drop("scenario", "variable")


CORRECT = "CASE WHEN c.value < 0.5 THEN {low} WHEN c.value > cap THEN cap ELSE c.value END"


@query(
    "correct_values",
    f"WITH {P95.format(src='cells_pr')} SELECT c.year, c.month, row, col, {CORRECT.format(low='NULL')} AS value "
    "FROM cells_pr c JOIN cap USING (year, month)",
)
def correct_values(spark, sf):
    return precip.correct_values(_pr(spark, sf), cube.mask(spark, sf)).select(*YMRC, "value")


@query(
    "correct_unmasked",
    "WITH cap AS (SELECT year, month, quantile_cont(value, 0.95) AS cap FROM cells_pr GROUP BY year, month) "
    f"SELECT c.year, c.month, row, col, {R6(CORRECT.format(low='NULL'))} AS value FROM cells_pr c JOIN cap USING (year, month)",
)
def correct_unmasked(spark, sf):
    return out(precip.correct_unmasked(_pr(spark, sf)))


BOUND = (
    "bound AS (SELECT a.row, a.col FROM (SELECT row, col FROM gappy_pr WHERE year = 1995 AND month = 1 AND value IS NOT NULL) a, g "
    "LEFT JOIN (SELECT row, col FROM gappy_pr WHERE year = 1995 AND month = 1 AND value IS NOT NULL) b "
    "ON abs(a.row - b.row) + least(abs(a.col - b.col), nx - abs(a.col - b.col)) = 1 GROUP BY a.row, a.col, nx, ny "
    "HAVING count(b.row) < CASE WHEN a.row > 0 THEN 1 ELSE 0 END + CASE WHEN a.row < ny - 1 THEN 1 ELSE 0 END + 2)"
)


def _gappy_pr(spark, sf):
    return cube.gappy(spark, sf, "pr").drop("scenario", "variable")


def _boundary(spark, sf):
    coarse, _ = cube.grids(spark, sf)
    return neighbors.find_boundary(_gappy_pr(spark, sf), coarse)


@query("find_boundary", f"WITH {BOUND} SELECT row, col FROM bound")
def find_boundary(spark, sf):
    return _boundary(spark, sf).select("row", "col")


EDGE = (
    f"edge AS (SELECT c.year, c.month, c.row, c.col, b.row IS NOT NULL AS is_boundary, CASE WHEN b.row IS NULL THEN c.value "
    f"ELSE {CORRECT.format(low='0.5')} END AS value FROM gappy_pr c JOIN cap USING (year, month) LEFT JOIN bound b ON b.row = c.row AND b.col = c.col)"
)


@query("correct_boundary", f"WITH {BOUND}, {P95.format(src='gappy_pr')}, {EDGE} SELECT year, month, row, col, value FROM edge")
def correct_boundary(spark, sf):
    flagged = precip.with_boundary(_gappy_pr(spark, sf), _boundary(spark, sf))
    return precip.correct_boundary(flagged, cube.mask(spark, sf)).select(*YMRC, "value")


P95_2 = P95.format(src="edge").replace("p AS (", "p2 AS (", 1).replace("cap AS (SELECT", "cap2 AS (SELECT").replace("JOIN p ON", "JOIN p2 p ON")


@query(
    "correct_inner",
    f"WITH {BOUND}, {P95.format(src='gappy_pr')}, {EDGE}, {P95_2} SELECT c.year, c.month, row, col, "
    f"CASE WHEN is_boundary THEN c.value ELSE {CORRECT.format(low='NULL')} END AS value FROM edge c JOIN cap2 USING (year, month)",
)
def correct_inner(spark, sf):
    flagged = precip.with_boundary(_gappy_pr(spark, sf), _boundary(spark, sf))
    m = cube.mask(spark, sf)
    edge = cut_lineage(precip.correct_boundary(flagged, m))
    return precip.correct_inner(edge, m).select(*YMRC, "value")


@query("floor_half", "SELECT year, month, row, col, CASE WHEN value < 0.5 THEN 0.5e0 ELSE value END AS value FROM gappy_pr")
def floor_half(spark, sf):
    return precip.floor_half(_gappy_pr(spark, sf)).select(*YMRC, "value")


@query("fix_precip", FILL.format(
    src="SELECT c.year, c.month, c.row, c.col, " + CORRECT.format(low="NULL") + " AS value FROM cells_pr c JOIN cap USING (year, month)"
).replace("WITH dense", f"WITH {P95.format(src='cells_pr')}, dense", 1)
    + f"SELECT year, month, row, col, {R6('CASE WHEN value < 0.5 THEN 0.5e0 ELSE value END')} AS value FROM filled")
def fix_precip(spark, sf):
    """The corrected series; the climatology goes through the same steps."""
    coarse, _ = cube.grids(spark, sf)
    series, _ = precip.fix_precip(_pr(spark, sf), coarse, cube.BEGIN, cube.END, cube.mask(spark, sf))
    return out(series)


def _twice_corrected(src: str, when: str, first: str, tag: str) -> str:
    """CTEs of the boundary, the two corrections, the filled and floored values of ``src``
    (on a cyclic grid, every cell present)."""
    keys, on = when.split(", "), " AND ".join(f"c.{k} = p.{k}" for k in when.split(", "))
    bound = BOUND.replace("bound AS", f"bound{tag} AS").replace("gappy_pr WHERE year = 1995 AND month = 1", f"{src} WHERE {first}")
    cap = lambda n, of: (
        f"p{n}{tag} AS (SELECT {when}, quantile_cont(value, 0.95) AS p FROM {of} JOIN sup USING (row, col) WHERE inside = 1 AND value IS NOT NULL GROUP BY {when}), "
        f"cap{n}{tag} AS (SELECT {', '.join('c.' + k for k in keys)}, arg_min(c.value, abs(c.value - p.p) * 1e6 + c.value * 1e-3) AS cap "
        f"FROM {of} c JOIN sup USING (row, col) JOIN p{n}{tag} p ON {on} WHERE inside = 1 AND c.value IS NOT NULL GROUP BY {', '.join('c.' + k for k in keys)})"
    )
    named = ", ".join("c." + k for k in keys)
    edge = (
        f"edge{tag} AS (SELECT {named}, c.row, c.col, b.row IS NOT NULL AS is_boundary, CASE WHEN b.row IS NULL THEN c.value "
        f"ELSE {CORRECT.format(low='0.5')} END AS value FROM {src} c LEFT JOIN cap1{tag} USING ({when}) LEFT JOIN bound{tag} b ON b.row = c.row AND b.col = c.col)"
    )
    inner = (
        f"inner{tag} AS (SELECT {named}, row, col, CASE WHEN is_boundary THEN c.value ELSE {CORRECT.format(low='NULL')} END AS value "
        f"FROM edge{tag} c LEFT JOIN cap2{tag} USING ({when}))"
    )
    return f"{bound}, {cap(1, src)}, {edge}, {cap(2, f'edge{tag}')}, {inner}"


def filled_sql(src: str, when: str, tag: str, cyclic: bool = False) -> str:
    """CTEs of the linear fill of ``src`` (``when`` are its keys besides the cell)."""
    body = FILL.replace("year, month", when).format(src=f"SELECT {when}, row, col, value FROM {src}").strip().removeprefix("WITH ")
    for name in ("dense", "x", "e", "filled"):
        body = body.replace(f"{name} AS (SELECT", f"{name}{tag} AS (SELECT").replace(f"FROM {name}", f"FROM {name}{tag}")
    if not cyclic:
        return body
    row = f"PARTITION BY {when}, row ORDER BY col"
    whole = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    last, first = ("{f}({v} IGNORE NULLS) OVER (" + f"{row} {whole})" for _ in range(2))
    col = "CASE WHEN value IS NOT NULL THEN col END"
    for old, fn, shift in (("OVER bx AS lag_", "last_value", "- (SELECT nx FROM g)"), ("OVER fx AS lead_", "first_value", "+ (SELECT nx FROM g)")):
        window = old.split()[1]
        body = body.replace(
            f"{fn}(value IGNORE NULLS) OVER {window} AS {old.split()[-1]}v",
            f"coalesce({fn}(value IGNORE NULLS) OVER {window}, {last.format(f=fn, v='value')}) AS {old.split()[-1]}v",
        ).replace(
            f"{fn}({col} IGNORE NULLS) OVER {window} AS {old.split()[-1]}p",
            f"coalesce({fn}({col} IGNORE NULLS) OVER {window}, {first.format(f=fn, v=col)} {shift}) AS {old.split()[-1]}p",
        )
    return body


CTES["clim_gappy"] = (
    "SELECT month, row, col, avg(value) AS value FROM gappy_pr WHERE year BETWEEN 1995 AND 1999 GROUP BY ALL"
)


@query(
    "fix_precip_climatology",
    f"WITH {_twice_corrected('clim_gappy', 'month', 'month = 1', '_c')}, {filled_sql('inner_c', 'month', '_c')} "
    f"SELECT month, row, col, {R6('CASE WHEN value < 0.5 THEN 0.5e0 ELSE value END')} AS value FROM filled_c",
)
def fix_precip_climatology(spark, sf):
    """The corrected climatology, with the boundary treated apart."""
    coarse, _ = cube.grids(spark, sf)
    _, clim = precip.fix_precip(_gappy_pr(spark, sf), coarse, cube.BEGIN, cube.END, cube.mask(spark, sf), find_bounds=True)
    return clim.select("month", "row", "col", r6("clim").alias("value"))


def whole_sql(src: str, when: str, tag: str) -> str:
    """Every cell of the coarse grid for each time of ``src``."""
    return (
        f"whole{tag} AS (SELECT {when}, row, col, value FROM (SELECT DISTINCT {when} FROM {src}) CROSS JOIN "
        "(SELECT CAST(unnest(range(0, ny)) AS INTEGER) AS row FROM g) CROSS JOIN (SELECT CAST(unnest(range(0, nx)) AS INTEGER) AS col FROM g) "
        f"LEFT JOIN {src} USING ({when}, row, col))"
    )


PRECIP = (
    f"{_twice_corrected('clim_gappy', 'month', 'month = 1', '_c')}, {whole_sql('inner_c', 'month', '_c')}, {filled_sql('whole_c', 'month', '_c', True)}, "
    f"{_twice_corrected('gappy_pr', 'year, month', 'year = 1995 AND month = 1', '_s')}, {whole_sql('inner_s', 'year, month', '_s')}, {filled_sql('whole_s', 'year, month', '_s', True)}, "
    "low AS (SELECT year, month, row, col, CASE WHEN s < 0.5 THEN 0.5e0 ELSE s END / CASE WHEN c < 0.5 THEN 0.5e0 ELSE c END AS value FROM "
    "(SELECT year, month, row, col, value AS s FROM filled_s) LEFT JOIN (SELECT month, row, col, value AS c FROM filled_c) USING (month, row, col)), "
    "anoms AS (SELECT * FROM low WHERE year >= 2000)"
)


@query(
    "delta_pipeline_precip",
    f"WITH {PRECIP} SELECT r.year, r.month, r.row, r.col, CASE WHEN b.inside = 1 THEN round_even(b.value * rv, 0) + 0e0 END AS value "
    f"FROM ({bilinear_sql('anoms')}) r JOIN base_pr b ON b.row = r.row AND b.col = r.col AND b.month = r.month",
)
def delta_pipeline_precip(spark, sf):
    """Corrected precipitation end to end: ratios of the limited, filled and floored series
    to its climatology treated alike, on the fine baseline, whole numbers, masked."""
    coarse, fine = cube.grids(spark, sf)
    c = cube.gappy(spark, sf, "pr").drop("variable")
    past, later = c.where(F.col("scenario") == "historical"), c.where(F.col("scenario") != "historical")
    p = policy.variable_policy("pr", "cru")
    refined = delta.delta_pipeline(
        past.drop("scenario"), cube.baseline(spark, sf, "pr"), coarse, fine, future=later.drop("scenario"), begin=cube.BEGIN, end=cube.END,
        operation=p.operation, post=p.post(), mask=cube.fine_mask(spark, sf), fix_clim=p.fix_clim, find_bounds=p.find_bounds,
        fill=True, aoi_mask=cube.mask(spark, sf),
    )
    return refined.select(*YMRC, (F.col("value") + 0.0).alias("value"))
