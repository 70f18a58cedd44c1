"""Humidity, radiation, freeze and thaw."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import cube
from checks.q_aggregate import DECADE, tas
from checks.registry import CTES, R6, bilinear_sql, query, r6
from climgrid.functions import calendar, freeze_thaw as ft, humidity, projection, radiation, values
from climgrid.operators import aggregate, climate, freeze, radiation as rad
from climgrid.plans import cloud

YMRC = ("year", "month", "row", "col")
PI = "3.141592653589793e0"

ES = "exp(t.value * 17.62e0 / (t.value + 243.12e0)) * 6.112e0"


@query("saturation_vp", f"SELECT year, month, row, col, {R6(ES)} AS value FROM cells_tas t")
def saturation_vp(spark, sf):
    return cube.cells(spark, sf).select(*YMRC, r6(humidity.saturation_vp(F.col("value"))).alias("value"))


def _clamped(alias="h"):
    return f"(CASE WHEN {alias}.value < 0 THEN 0 WHEN {alias}.value > 100 THEN 95 ELSE {alias}.value END)"


@query(
    "vapor_pressure",
    f"SELECT year, month, row, col, round_even({_clamped()} * ({ES}) / 100 * 1e2, 0) / 1e2 AS value FROM cells_hur h JOIN cells_tas t USING (year, month, row, col)",
)
def vapor_pressure(spark, sf):
    j = climate.join_variables(cube.cells(spark, sf, "hur"), cube.cells(spark, sf), ("hur", "tas"))
    vp = humidity.vapor_pressure(F.col("tas"), values.clamp_humidity(F.col("hur")))
    return j.select(*YMRC, vp.alias("value"))


@query("join_variables", "SELECT year, month, row, col, h.value AS hur, t.value AS tas FROM cells_hur h JOIN cells_tas t USING (year, month, row, col)")
def join_variables(spark, sf):
    j = climate.join_variables(cube.cells(spark, sf, "hur"), cube.cells(spark, sf), ("hur", "tas"))
    return j.select(*YMRC, "hur", "tas")


RH = f"v.value / ({ES}) * 100"
RH_CLAMPED = f"CASE WHEN {RH} < 0 THEN 0 WHEN {RH} > 100 THEN 95 ELSE {RH} END"
VAP_TAS = "cells_vap v JOIN cells_tas t USING (year, month, row, col)"


@query("relative_humidity", f"SELECT year, month, row, col, {R6(RH_CLAMPED)} AS value FROM {VAP_TAS}")
def relative_humidity(spark, sf):
    j = climate.join_variables(cube.cells(spark, sf, "vap"), cube.cells(spark, sf), ("vap", "tas"))
    return j.select(*YMRC, r6(humidity.relative_humidity(F.col("tas"), F.col("vap"))).alias("value"))


@query("prepare_humidity", f"SELECT scenario, year, month, row, col, {R6(RH_CLAMPED)} AS value FROM cells_vap v JOIN cells_tas t USING (scenario, year, month, row, col)")
def prepare_humidity(spark, sf):
    h = rad.humidity_series(cube.cells(spark, sf, "vap"), cube.cells(spark, sf))
    return h.select("scenario", *YMRC, r6("value").alias("value"))


@query("sunshine_to_cloud", "SELECT year, month, row, col, round_even((100 - value) * 1e1, 0) / 1e1 + 0e0 AS value FROM cells_clt")
def sunshine_to_cloud(spark, sf):
    """The cloud cube read as sunshine."""
    return cube.cells(spark, sf, "clt").select(*YMRC, (values.sunshine_to_cloud(F.col("value")) + 0.0).alias("value"))


# ---- radiation -----------------------------------------------------------------------

DEC = f"(sin(day * (2 * {PI} / 365) - 1.39e0) * 0.409e0)"
W = f"acos(greatest(-1e0, least(1e0, -tan({DEC}) * tan(phi))))"
RA = (
    f"(cos(day * (2 * {PI} / 365)) * 0.033e0 + 1) * ({W} * sin(phi) * sin({DEC}) + cos(phi) * cos({DEC}) * sin({W})) * (24 * 60 / {PI} * 0.082e0)"
)
LAT = "(90 - (row + 0.5e0) * (180e0 / ny))"
CTES["lats"] = f"SELECT row, radians({LAT}) AS phi FROM (SELECT DISTINCT row FROM sup), g"
CTES["yeardays"] = (
    "SELECT CAST(range AS INTEGER) AS day, CAST(month(DATE '2001-01-01' + CAST(range - 1 AS INTEGER)) AS INTEGER) AS month FROM range(1, 366)"
)
CTES["ra"] = f"SELECT row, month, avg({RA}) AS value FROM lats, yeardays GROUP BY row, month"


def lat_rows(spark, sf):
    """One row per grid row with its latitude: cells of a row share their radiation."""
    coarse, _ = cube.grids(spark, sf)
    return cube.mask(spark, sf).select("row").distinct().withColumn("lat", coarse.y())


@query("extraterrestrial_radiation", f"SELECT row, day, {R6(RA)} AS value FROM lats, yeardays")
def extraterrestrial_radiation(spark, sf):
    days = lat_rows(spark, sf).withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(365))))
    return days.select("row", "day", r6(radiation.extraterrestrial_radiation(F.col("day"), F.radians("lat"))).alias("value"))


@query("ra_monthly", f"SELECT row, month, {R6('value')} AS value FROM ra")
def ra_monthly(spark, sf):
    return rad.ra_monthly(lat_rows(spark, sf)).select("row", "month", r6("value").alias("value"))


NIRR = "r.value * (0.251e0 + 0.509e0 * (1 - c.value / 100))"


@query("surface_radiation", f"SELECT year, month, row, col, {R6(NIRR)} AS value FROM cells_clt c JOIN ra r USING (row, month)")
def surface_radiation(spark, sf):
    s = rad.surface_radiation(cube.cells(spark, sf, "clt"), rad.ra_monthly(lat_rows(spark, sf)))
    return s.select(*YMRC, r6("value").alias("value"))


@query("join_month_lookup", f"SELECT year, month, row, col, c.value, {R6('r.value')} AS ra FROM cells_clt c JOIN ra r USING (row, month)")
def join_month_lookup(spark, sf):
    j = climate.join_month_lookup(cube.cells(spark, sf, "clt"), rad.ra_monthly(lat_rows(spark, sf)), "ra")
    return j.select(*YMRC, "value", r6("ra").alias("ra"))


@query(
    "surface_radiation_guarded",
    f"SELECT year, month, row, col, CASE WHEN c.value > -0.1 THEN {R6(NIRR)} END AS value FROM (SELECT year, month, row, col, "
    "CASE WHEN value < 30 THEN -999.9e0 ELSE value END AS value FROM cells_clt) c JOIN ra r USING (row, month)",
)
def surface_radiation_guarded(spark, sf):
    """Little cloud stands for a missing-data number."""
    c = cube.cells(spark, sf, "clt").withColumn("value", F.when(F.col("value") < 30, -999.9).otherwise(F.col("value")))
    s = rad.surface_radiation(c, rad.ra_monthly(lat_rows(spark, sf)), guarded=True)
    return s.select(*YMRC, r6("value").alias("value"))


@query("par", f"SELECT year, month, row, col, {R6('t.value * (0.2e0 * c.value / 100 + 0.45e0)')} AS value FROM cells_clt c JOIN cells_vap t USING (year, month, row, col)")
def par(spark, sf):
    j = climate.join_variables(cube.cells(spark, sf, "clt"), cube.cells(spark, sf, "vap"), ("clt", "nirr"))
    return j.select(*YMRC, r6(radiation.par(F.col("nirr"), F.col("clt"))).alias("value"))


@query(
    "cloud_from_radiation",
    "SELECT year, month, row, col, CASE WHEN n.value >= 0.71e0 * g.value THEN 0e0 ELSE "
    f"{R6('least((1 - (n.value / nullif(g.value, 0) - 0.23e0) / 0.48e0) * 100, 100)')} END AS value "
    "FROM cells_vap n JOIN cells_clt g USING (year, month, row, col)",
)
def cloud_from_radiation(spark, sf):
    """Two cubes read as net and gross radiation."""
    j = climate.join_variables(cube.cells(spark, sf, "vap"), cube.cells(spark, sf, "clt"), ("nirr", "girr"))
    return j.select(*YMRC, r6(radiation.cloud_from_radiation(F.col("girr"), F.col("nirr"))).alias("value"))


SIG = f"(cos((day + 10) * (2 * {PI}) / 365.25e0) * -23.4856e0 * ({PI} / 180))"
DIST = f"(1 - cos((day - 4) * 0.9856e0 * ({PI} / 180)) * 0.016729e0)"
HOURLY = f"greatest(sin(phi) * sin({SIG}) + cos(phi) * cos({SIG}) * cos((h - 12) * {PI} / 12), 0e0)"


@query(
    "gross_radiation_hourly",
    f"SELECT row, month, {R6('avg(total)')} AS value FROM (SELECT row, month, day, sum({HOURLY}) * (1368e0 * 3600 / 41860) / ({DIST} * {DIST}) AS total "
    "FROM lats, yeardays, range(1, 25) t(h) GROUP BY row, month, day) GROUP BY row, month",
)
def gross_radiation_hourly(spark, sf):
    return rad.gross_radiation_monthly(lat_rows(spark, sf)).select("row", "month", r6("value").alias("value"))


@query(
    "day_length",
    f"SELECT row, month, {R6(f'{W} * (24 / {PI})')} AS value FROM lats, (SELECT month, avg(day) AS day FROM yeardays GROUP BY month)",
)
def day_length(spark, sf):
    return rad.day_length_monthly(lat_rows(spark, sf)).select("row", "month", r6("value").alias("value"))


CLOUDY = (
    "anoms AS (SELECT year, month, row, col, CASE WHEN m.clim <> 0 THEN c.value / m.clim END AS value FROM cells_clt c JOIN clim_clt m USING (row, col, month))"
)
FINE_LAT = "(90 - (row + 0.5e0) * (180e0 / (5 * ny)))"
CTES["fine_lats"] = f"SELECT DISTINCT row, radians({FINE_LAT}) AS phi FROM fine"
CTES["fine_ra"] = f"SELECT row, month, avg({RA}) AS value FROM fine_lats, yeardays GROUP BY row, month"


@query(
    "cloud_radiation_pipeline",
    f"WITH {CLOUDY}, fc AS (SELECT r.year, r.month, r.row, r.col, CASE WHEN b.value * rv < 0 THEN 0 WHEN b.value * rv > 100 THEN 100 ELSE b.value * rv END AS cloud FROM ({bilinear_sql('anoms')}) r "
    "JOIN base_clt b ON b.row = r.row AND b.col = r.col AND b.month = r.month) "
    f"SELECT year, month, row, col, {R6('cloud')} AS cloud, {R6('r.value * (0.251e0 + 0.509e0 * (1 - cloud / 100))')} AS value "
    "FROM fc JOIN fine_ra r USING (row, month)",
)
def cloud_radiation_pipeline(spark, sf):
    coarse, fine = cube.grids(spark, sf)
    ra = rad.ra_monthly(cube.fine_mask(spark, sf).select("row").distinct().withColumn("lat", fine.y()))
    c = cube.cells(spark, sf, "clt").drop("variable", "scenario")
    p = cloud.cloud_radiation_pipeline(c, cube.baseline(spark, sf, "clt"), ra, coarse, fine, cube.BEGIN, cube.END)
    return p.select(*YMRC, r6("cloud").alias("cloud"), r6("value").alias("value"))


ALBERS = projection.Albers()


def _albers_sql() -> str:
    e2, e, n, c, rho0 = (repr(float(v)) for v in ALBERS._constants())
    import math

    ef, e2f = float(e), float(e2)
    pole = 1 - (1 - e2f) / (2 * ef) * math.log((1 - ef) / (1 + ef))
    k2 = e2f / 3 + 31 * e2f**2 / 180 + 517 * e2f**3 / 5040
    k4 = 23 * e2f**2 / 360 + 251 * e2f**3 / 3780
    k6 = 761 * e2f**3 / 45360
    big = lambda v: f"CAST({v!r} AS DOUBLE)"
    rho0, n, c = (f"CAST({v} AS DOUBLE)" for v in (rho0, n, c))
    q = f"(({c} - rho2 * ({n} * {n} / {big(ALBERS.a * ALBERS.a)})) / {n})"
    return (
        f"SELECT row, col, {R6(f'degrees(beta + sin(beta * 2) * {big(k2)} + sin(beta * 4) * {big(k4)} + sin(beta * 6) * {big(k6)})')} AS lat, "
        f"{R6(f'degrees(atan2(x, {rho0} - y)) / {n} + -154')} AS lon FROM (SELECT row, col, x, y, asin(greatest(-1e0, least(1e0, {q} / {big(pole)}))) AS beta "
        f"FROM (SELECT *, x * x + ({rho0} - y) * ({rho0} - y) AS rho2 FROM (SELECT row, col, -2000000 + (col + 0.5e0) * 2000 AS x, "
        "2400000 - (row + 0.5e0) * 2000 AS y FROM fine)))"
    )


@query("project_albers", _albers_sql())
def project_albers(spark, sf):
    """The fine grid laid on a 2 km projected grid."""
    from climgrid.grid import Grid

    grid = Grid(2015, 1320, -2000000.0, 2400000.0, 2000.0, 2000.0, crs="EPSG:3338")
    f = cube.fine_cells(spark, sf)
    return f.select(
        "row", "col", r6(ALBERS.latitude(grid.x(), grid.y())).alias("lat"), r6(ALBERS.longitude(grid.x(), grid.y())).alias("lon")
    )


# ---- freeze and thaw ----------------------------------------------------------------------

M12 = ", ".join(f"max(CASE WHEN month = {m} THEN value END)" for m in range(1, 13))


def freeze_sql(src: str, by: str) -> str:
    """The nine cases over rows: crossings are numbered, the two longest spells ranked."""
    thaw = lambda i: f"({i} * 30 + 15 - round_even(x[({i} + 12) % 12 + 1] / nullif((x[({i} + 13) % 12 + 1] - x[({i} + 12) % 12 + 1]) / 30, 0), 0))"
    freeze = lambda i: f"(350 - (10 - {i}) * 30 - round_even(x[({i} + 13) % 12 + 1] / nullif((x[({i} + 13) % 12 + 1] - x[({i} + 12) % 12 + 1]) / 30, 0), 0))"
    return f"""
WITH v AS (SELECT {by}, row, col, [{M12}] AS x0 FROM {src} GROUP BY ALL),
z AS (SELECT {by}, row, col, [CASE WHEN u = 0 THEN -0.0001e0 ELSE u END FOR u IN x0] AS x,
  list_bool_or([u IS NULL FOR u IN x0]) AS hole FROM v),
crossings AS (SELECT {by}, row, col, CAST(i AS INTEGER) AS i, CAST(row_number() OVER (PARTITION BY {by}, row, col ORDER BY i) AS INTEGER) AS k,
  i + 1 - lag(i + 1, 1, 0) OVER (PARTITION BY {by}, row, col ORDER BY i) AS gap
  FROM z, range(0, 11) t(i) WHERE x[i + 1] * x[i + 2] < 0),
top1 AS (SELECT {by}, row, col, arg_max(k, gap * 100 + k) AS m1, count(*) AS n FROM crossings GROUP BY ALL),
top2 AS (SELECT {by}, row, col, arg_max(CASE WHEN c.k < m1 THEN c.k ELSE c.k - 1 END, gap * 100 + c.k) AS m2
  FROM crossings c JOIN top1 USING ({by}, row, col) WHERE c.k <> m1 GROUP BY ALL),
pick AS (SELECT {by}, row, col, n, least(m1, m2b) AS lo, greatest(m1, m2b) AS hi FROM
  (SELECT {by}, row, col, n, m1, CASE WHEN m1 = m2 THEN m2 - 1 ELSE m2 END AS m2b FROM top1 LEFT JOIN top2 USING ({by}, row, col))),
places AS (SELECT {by}, row, col, any_value(n) AS n, max(CASE WHEN k = 1 THEN i END) AS i0, max(CASE WHEN k = 2 THEN i END) AS i1,
  CASE WHEN any_value(lo) = 0 THEN -1 ELSE max(CASE WHEN k = lo THEN i END) END AS q0, max(CASE WHEN k = hi THEN i END) AS q1
  FROM crossings JOIN pick USING ({by}, row, col) GROUP BY ALL),
cased AS (SELECT {by}, row, col, x, i0, i1, q0, q1, CAST(CASE WHEN hole THEN 1 WHEN coalesce(n, 0) = 0 AND x[1] > 0 THEN 2 WHEN coalesce(n, 0) = 0 THEN 3
  WHEN n = 1 AND x[1] < 0 THEN 4 WHEN n = 1 THEN 5 WHEN n = 2 AND x[1] < 0 THEN 0 WHEN n = 2 AND i0 >= 7 THEN 6 WHEN n = 2 THEN 7 ELSE 8 END AS INTEGER) AS kase
  FROM z LEFT JOIN places USING ({by}, row, col)),
days AS (SELECT {by}, row, col, kase,
  CAST(CASE WHEN kase = 2 THEN 365 WHEN kase = 3 THEN 0 WHEN kase IN (4, 7) THEN 350 WHEN kase IN (5, 6) THEN {freeze('i0')}
    WHEN kase = 0 THEN {freeze('i1')} WHEN kase = 8 THEN {freeze('q1')} END AS DOUBLE) AS dof,
  CAST(CASE WHEN kase = 2 THEN 0 WHEN kase = 3 THEN 365 WHEN kase IN (0, 4) THEN {thaw('i0')} WHEN kase IN (5, 6) THEN 15
    WHEN kase = 7 THEN {thaw('i1')} WHEN kase = 8 THEN {thaw('q0')} END AS DOUBLE) AS dot FROM cased),
final AS (SELECT {by}, row, col, kase, dof, dot, CASE WHEN kase = 3 THEN 0 ELSE dof - dot END AS grow FROM days)
"""


# the frozen/thawed cube: temperatures lifted so that all cases occur
FT_SRC = "(SELECT year, month, row, col, value + 4 AS value FROM cells_tas)"


def ft_cells(spark, sf):
    return tas(spark, sf).withColumn("value", F.col("value") + 4)


@query(
    "sign_transitions",
    "SELECT year, row, col, i AS month FROM (SELECT year, row, col, i, x[i] * x[i + 1] AS p FROM "
    f"(SELECT year, row, col, [CASE WHEN u = 0 THEN -0.0001e0 ELSE u END FOR u IN [{M12}]] AS x FROM {FT_SRC} GROUP BY year, row, col), "
    "(SELECT CAST(range AS INTEGER) AS i FROM range(1, 12))) WHERE p < 0",
)
def sign_transitions(spark, sf):
    """Months after which the sign changes, one row each."""
    v = aggregate.month_vector(ft_cells(spark, sf), ["year", "row", "col"])
    after = F.explode(ft.sign_transitions(ft.zero_as_frozen(F.col("months"))))
    return v.select("year", "row", "col", after.alias("i")).select("year", "row", "col", (F.col("i") + 1).alias("month"))


@query("freeze_thaw_days", freeze_sql(FT_SRC, "year") + "SELECT year, row, col, kase, dof, dot, grow FROM final")
def freeze_thaw_days(spark, sf):
    return freeze.freeze_thaw(ft_cells(spark, sf)).select("year", "row", "col", "kase", "dof", "dot", "grow")


FT_DEC = f"(SELECT {DECADE} AS decade, month, row, col, avg(value) AS value FROM {FT_SRC} GROUP BY ALL)"


@query("freeze_thaw_decadal", freeze_sql(FT_DEC, "decade") + "SELECT decade, row, col, kase, dof, dot, grow FROM final")
def freeze_thaw_decadal(spark, sf):
    return freeze.freeze_thaw_decadal(ft_cells(spark, sf)).select("decade", "row", "col", "kase", "dof", "dot", "grow")


@query(
    "freeze_thaw_split",
    freeze_sql(FT_SRC, "year")
    + "SELECT year, row, col, 'dof' AS product, dof AS value FROM final UNION ALL SELECT year, row, col, 'dot', dot FROM final "
    "UNION ALL SELECT year, row, col, 'logs', grow FROM final",
)
def freeze_thaw_split(spark, sf):
    f = freeze.freeze_thaw(ft_cells(spark, sf))
    return freeze.freeze_thaw_split(f).select("year", "row", "col", "product", "value")


@query(
    "freeze_thaw_diff",
    freeze_sql(FT_SRC, "year") + "SELECT a.year, a.row, a.col, b.dof - a.dof AS diff FROM final a "
    "JOIN (SELECT row, col, dof FROM final WHERE year = 1995) b USING (row, col)",
)
def freeze_thaw_diff(spark, sf):
    """Freeze day of 1995 against that of each year; unknown days carry -9999."""
    f = freeze.freeze_thaw(ft_cells(spark, sf)).withColumn("dof", F.coalesce("dof", F.lit(-9999.0)))
    first = f.where(F.col("year") == 1995).drop("year")
    return (
        f.join(first.select("row", "col", F.col("dof").alias("_d")), ["row", "col"])
        .transform(lambda j: freeze.freeze_thaw_diff(j.select("year", "row", "col", "dof"), j.select("year", "row", "col", F.col("_d").alias("dof"))))
        .select("year", "row", "col", "diff")
    )
