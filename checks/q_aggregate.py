"""Ensembles, calendar aggregates, zonal tables and ordered operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import cube
from checks.q_sources import SEASON
from checks.registry import R, R6, query, r6
from climgrid.operators import aggregate, climate, zonal
from climgrid.schema import present

RC = ("row", "col")
MEMBERS = 5  # the data's only whole decade part has five years


def tas(spark, sf, variable="tas"):
    return cube.cells(spark, sf, variable).drop("scenario", "variable")


def model(spark, sf, variable="tas"):
    return cube.models(spark, sf, variable).drop("variable")


def ensemble(spark, sf, variable="tas"):
    return aggregate.ensemble_mean(model(spark, sf, variable))


def shown(df, *names):
    return df.select(*names, r6("value").alias("value"))


# ---- ensembles ----------------------------------------------------------------


@query(
    "ensemble_mean",
    f"SELECT '5ModelAvg' AS model, scenario, year, month, row, col, {R('value', 1)} + 0e0 AS value FROM ens_tas",
)
def ensemble_mean(spark, sf):
    from climgrid.functions.values import round_by_variable

    e = ensemble(spark, sf)
    return e.select("model", "scenario", "year", "month", *RC, (round_by_variable(F.col("value"), "tas") + 0.0).alias("value"))


MODELS = [f"M{m}" for m in range(5)]


@query(
    "join_models",
    "SELECT scenario, year, month, row, col, " + ", ".join(f"max(CASE WHEN model = '{m}' THEN value END) AS {m}" for m in MODELS) + " FROM model_tas GROUP BY ALL",
)
def join_models(spark, sf):
    return climate.join_models(model(spark, sf), MODELS).select("scenario", "year", "month", *RC, *MODELS)


# ---- calendar -----------------------------------------------------------------


@query(
    "annual_grid",
    f"SELECT 'tas' AS variable, year, row, col, {R6('avg(value)')} AS value, min(value) AS low, max(value) AS high FROM cells_tas GROUP BY year, row, col "
    f"UNION ALL SELECT 'pr', year, row, col, {R6('sum(value)')}, min(value), max(value) FROM cells_pr GROUP BY year, row, col",
)
def annual_grid(spark, sf):
    """Mean of temperature, total of precipitation, and the extremes of both."""
    parts = []
    for v in ("tas", "pr"):
        a = aggregate.annual_grid(tas(spark, sf, v), value=aggregate.default_metric(v), low="min", high="max")
        parts.append(a.select(F.lit(v).alias("variable"), "year", *RC, r6("value").alias("value"), "low", "high"))
    return parts[0].unionByName(parts[1])


def seasonal(src: str, agg: str) -> str:
    return (
        f"SELECT CAST(year + CASE WHEN month = 12 THEN 1 ELSE 0 END AS INTEGER) AS season_year, {SEASON} AS season, row, col, "
        f"{agg} AS value FROM {src} GROUP BY ALL HAVING count(*) = 3"
    )


@query("seasonal_grid", f"SELECT season_year, season, row, col, {R6('value')} AS value FROM ({seasonal('cells_tas', 'avg(value)')})")
def seasonal_grid(spark, sf):
    return shown(aggregate.seasonal_grid(tas(spark, sf)), "season_year", "season", *RC)


@query(
    "seasonal_grid_minmax",
    f"SELECT 'min' AS metric, * FROM ({seasonal('cells_tas', 'min(value)')}) UNION ALL SELECT 'max', * FROM ({seasonal('cells_tas', 'max(value)')})",
)
def seasonal_grid_minmax(spark, sf):
    both = aggregate.seasonal_grid(tas(spark, sf), min="min", max="max")
    return both.unpivot(["season_year", "season", *RC], ["min", "max"], "metric", "value")


@query("season_subset", f"SELECT row, col, {R6('avg(value)')} AS value FROM cells_tas WHERE month IN (6, 7, 8) GROUP BY row, col")
def season_subset(spark, sf):
    return shown(aggregate.season_subset(tas(spark, sf), "JJA"), *RC)


DECADE = "(year // 10 * 10) || 's'"


@query(
    "decadal_monthly",
    f"SELECT {DECADE} AS decade, month, row, col, {R6('avg(value)')} AS value FROM cells_tas GROUP BY ALL HAVING count(*) = {MEMBERS}",
)
def decadal_monthly(spark, sf):
    return shown(aggregate.decadal_monthly(tas(spark, sf), MEMBERS), "decade", "month", *RC)


@query(
    "decadal_monthly_any",
    f"SELECT {DECADE} AS decade, month, row, col, {R6('avg(value)')} AS value, max(value) AS high FROM cells_pr GROUP BY ALL",
)
def decadal_monthly_any(spark, sf):
    both = aggregate.decadal_monthly_any(tas(spark, sf, "pr"), value="total", high="max")
    return both.select("decade", "month", *RC, r6("value").alias("value"), "high")


@query(
    "decadal_seasonal",
    f"SELECT (season_year // 10 * 10) || 's' AS decade, season, row, col, {R6('avg(value)')} AS value "
    f"FROM ({seasonal('cells_tas', 'avg(value)')}) GROUP BY ALL HAVING count(*) = {MEMBERS}",
)
def decadal_seasonal(spark, sf):
    return shown(aggregate.decadal_seasonal(tas(spark, sf), members=MEMBERS), "decade", "season", *RC)


@query(
    "decadal_seasonal_direct",
    f"SELECT {DECADE} AS decade, {SEASON} AS season, row, col, {R6('avg(value)')} AS value FROM cells_tas GROUP BY ALL",
)
def decadal_seasonal_direct(spark, sf):
    return shown(aggregate.decadal_seasonal_direct(tas(spark, sf)), "decade", "season", *RC)


@query(
    "decadal_annual",
    f"SELECT {DECADE} AS decade, row, col, {R6('avg(value)')} AS value FROM (SELECT year, row, col, sum(value) AS value FROM cells_pr "
    f"GROUP BY ALL) GROUP BY ALL HAVING count(*) = {MEMBERS}",
)
def decadal_annual(spark, sf):
    return shown(aggregate.decadal_annual(tas(spark, sf, "pr"), "total", MEMBERS), "decade", *RC)


# ---- zones ---------------------------------------------------------------------


def zonal_sql(src: str, key: str = "") -> str:
    k = f"{key}, " if key else ""
    return (
        f"SELECT {k}decade, month, zone_id, {R6('stddev_pop(value)')} AS stdev, {R6('avg(value)')} AS mean, {R6('min(value)')} AS min, "
        f"{R6('max(value)')} AS max FROM (SELECT {k}{DECADE} AS decade, month, row, col, avg(value) AS value FROM {src} GROUP BY ALL) "
        "JOIN zones USING (row, col) GROUP BY ALL"
    )


METRICS = ("stdev", "mean", "min", "max")


def metrics(df, *names):
    return df.select(*names, *[r6(m).alias(m) for m in METRICS])


@query("zonal_metrics", zonal_sql("cells_tas"))
def zonal_metrics(spark, sf):
    return metrics(zonal.zonal_metrics(tas(spark, sf), cube.zones(spark, sf)), "decade", "month", "zone_id")


@query(
    "zonal_metrics_annual",
    f"SELECT year, month, zone_id, {R6('stddev_pop(value)')} AS stdev, {R6('avg(value)')} AS mean, min(value) AS min, max(value) AS max "
    "FROM cells_tas JOIN zones USING (row, col) GROUP BY ALL",
)
def zonal_metrics_annual(spark, sf):
    return metrics(zonal.zonal_metrics_annual(tas(spark, sf), cube.zones(spark, sf)), "year", "month", "zone_id")


DIFF = "(SELECT m.model, year, month, row, col, m.value - e.value AS value FROM model_tas m JOIN ens_tas e USING (scenario, year, month, row, col))"


@query("zonal_diff_mean", f"SELECT model, year, month, {R6('avg(d.value)')} AS value FROM {DIFF} d JOIN sup USING (row, col) WHERE inside = 1 GROUP BY ALL")
def zonal_diff_mean(spark, sf):
    d = zonal.zonal_diff_mean(model(spark, sf), ensemble(spark, sf), cube.mask(spark, sf))
    return shown(d, "model", "year", "month")


@query("zonal_diff_metrics", zonal_sql(DIFF, "model"))
def zonal_diff_metrics(spark, sf):
    d = zonal.zonal_diff_metrics(model(spark, sf).drop("scenario"), ensemble(spark, sf).drop("scenario"), cube.zones(spark, sf))
    return metrics(d, "model", "decade", "month", "zone_id")


AOI = "SELECT year, month, avg(c.value) AS value FROM cells_tas c JOIN sup USING (row, col) WHERE inside = 1 GROUP BY ALL"


@query("aoi_mean_series", f"SELECT year, month, {R6('value')} AS value FROM ({AOI})")
def aoi_mean_series(spark, sf):
    return shown(zonal.aoi_mean_series(tas(spark, sf), cube.mask(spark, sf)), "year", "month")


@query(
    "aoi_anomaly_mean",
    f"SELECT year, month, {R6('avg(c.value - m.clim)')} AS value FROM cells_tas c JOIN clim_tas m USING (row, col, month) "
    "JOIN sup USING (row, col) WHERE inside = 1 GROUP BY ALL",
)
def aoi_anomaly_mean(spark, sf):
    return shown(zonal.aoi_anomaly_mean(tas(spark, sf), cube.mask(spark, sf), cube.BEGIN, cube.END), "year", "month")


@query("aoi_decadal_mean", f"SELECT {DECADE} AS decade, month, {R6('avg(value)')} AS value FROM ({AOI}) GROUP BY ALL")
def aoi_decadal_mean(spark, sf):
    s = zonal.aoi_mean_series(tas(spark, sf), cube.mask(spark, sf))
    return shown(zonal.aoi_decadal_mean(s, by_month=True), "decade", "month")


MODELS = [f"M{i}" for i in range(5)]


@query(
    "global_mean_wide",
    "SELECT year, month, "
    + ", ".join(R6(f"avg(CASE WHEN model = '{m}' THEN value END)") + f" AS \"{m}\"" for m in MODELS)
    + " FROM model_tas GROUP BY year, month",
)
def global_mean_wide(spark, sf):
    w = zonal.global_mean_wide(model(spark, sf), MODELS)
    return w.select("year", "month", *[r6(m).alias(m) for m in MODELS])


PERIODS = {"p1995_1997": (1995, 1997), "p1996_1999": (1996, 1999), "p1999_2001": (1999, 2001)}


@query(
    "baseline_period_compare",
    " UNION ALL ".join(
        f"SELECT '{v}' AS variable, month, "
        + ", ".join(R6(f"avg(CASE WHEN year BETWEEN {b} AND {e} THEN c.value END)") + f" AS {n}" for n, (b, e) in PERIODS.items())
        + f" FROM cells_{v} c JOIN sup USING (row, col) WHERE inside = 1 GROUP BY month"
        for v in ("tas", "pr")
    ),
)
def baseline_period_compare(spark, sf):
    c = cube.cells(spark, sf, ["tas", "pr"])
    w = zonal.baseline_period_compare(c, PERIODS, cube.mask(spark, sf))
    return w.select("variable", "month", *[r6(n).alias(n) for n in PERIODS])


# ---- ordered ------------------------------------------------------------------------

STEPS = (
    f"(SELECT model, row, col, year, month, d.value, d.value - lag(d.value) OVER (PARTITION BY model, row, col ORDER BY year, month) AS step FROM {DIFF} d)"
)


@query("departure_step", f"SELECT model, row, col, year, month, {R6('value')} AS value, {R6('step')} AS step FROM {STEPS}")
def departure_step(spark, sf):
    d = aggregate.departure_step(model(spark, sf).drop("scenario"), ensemble(spark, sf).drop("scenario"))
    return d.select("model", *RC, "year", "month", r6("value").alias("value"), r6("step").alias("step"))


@query(
    "rolling_series",
    f"SELECT row, col, year, month, CASE WHEN count(*) OVER w = 12 THEN {R6('avg(value) OVER w')} END AS rolling FROM cells_tas "
    "WINDOW w AS (PARTITION BY row, col ORDER BY year, month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)",
)
def rolling_series(spark, sf):
    return aggregate.rolling_series(tas(spark, sf), 12).select(*RC, "year", "month", r6("rolling").alias("rolling"))


@query(
    "first_last_nodata_trim",
    "SELECT year, month, row, col, CASE WHEN year <= 2000 THEN value END AS value FROM cells_tas WHERE year <= 2000",
)
def first_last_nodata_trim(spark, sf):
    """The last year holds no data and is dropped."""
    empty = tas(spark, sf).withColumn("value", F.when(F.col("year") <= 2000, F.col("value")))
    return _with_one_series(aggregate.trim_trailing_nodata, empty).select("year", "month", *RC, "value")


def _with_one_series(fn, df):
    return fn(df.withColumn("variable", F.lit("tas"))).drop("variable")


def summer(src: str, by: str, rounded: str) -> str:
    return (
        f"SELECT {by}, row, col, CASE WHEN count(value) = 5 THEN {rounded} + 0e0 END AS value "
        f"FROM {src} WHERE month BETWEEN 5 AND 9 GROUP BY ALL"
    )


@query("summer_warmth", summer("gappy_tas", "year", R("sum(greatest(value, 0))", 1)))
def summer_warmth(spark, sf):
    g = cube.gappy(spark, sf).drop("scenario", "variable")
    return aggregate.summer_warmth(g).select("year", *RC, (F.col("value") + 0.0).alias("value"))


@query(
    "summer_warmth_decadal",
    summer(
        f"(SELECT {DECADE} AS decade, month, row, col, avg(value) AS value FROM cells_tas GROUP BY ALL HAVING count(*) = {MEMBERS})", "decade", R6("sum(greatest(value, 0))")
    ),
)
def summer_warmth_decadal(spark, sf):
    d = aggregate.decadal_monthly(tas(spark, sf), MEMBERS)
    return shown(aggregate.summer_warmth(d, places=None), "decade", *RC)
