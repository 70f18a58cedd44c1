"""Validation and comparison of versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import cube
from checks.q_aggregate import DECADE
from checks.registry import R6, query, r6
from climgrid.operators import compare, regrid
from climgrid.plans import delta
from climgrid.sources import sinks
from climgrid.storage import work_folder

YMRC = ("year", "month", "row", "col")
JOINED = "old_tas o FULL JOIN new_tas n USING (year, month, row, col)"


def versions(spark, sf, variable="tas"):
    old, new = (cube.version(spark, sf, v, variable).drop("scenario", "variable") for v in ("old", "new"))
    return old, new


@query(
    "join_versions",
    "SELECT year, month, row, col, o.value AS old_value, n.value AS new_value, CASE WHEN o.value IS NULL THEN 'new only' "
    f"WHEN n.value IS NULL THEN 'old only' ELSE 'both' END AS side FROM {JOINED}",
)
def join_versions(spark, sf):
    return compare.join_versions(*versions(spark, sf)).select(*YMRC, "old_value", "new_value", "side")


@query(
    "grid_equal",
    "SELECT year, month, count(*) AS cells, count(*) FILTER (WHERE o.value IS DISTINCT FROM n.value) AS different, "
    f"count(*) FILTER (WHERE o.value IS DISTINCT FROM n.value) = 0 AS equal FROM {JOINED} GROUP BY ALL",
)
def grid_equal(spark, sf):
    return compare.grid_equal(*versions(spark, sf))


@query(
    "schema_consistent",
    "SELECT model, scenario, count(*) AS members, count(DISTINCT e) AS shapes, count(DISTINCT e) = 1 AS consistent FROM "
    "(SELECT model, scenario, year, month, [min(row), max(row), min(col), max(col)] AS e FROM model_tas GROUP BY ALL) GROUP BY ALL",
)
def schema_consistent(spark, sf):
    return compare.schema_consistent(cube.models(spark, sf).drop("variable"))


@query(
    "value_range",
    "SELECT 'tas' AS variable, year, month, min(value) AS min, max(value) AS max FROM cells_tas GROUP BY ALL "
    "UNION ALL SELECT 'pr', year, month, min(value), max(value) FROM cells_pr GROUP BY ALL",
)
def value_range(spark, sf):
    return compare.value_range(cube.cells(spark, sf, ["tas", "pr"]).drop("scenario"))


@query(
    "value_histogram",
    "SELECT scenario, CAST(CASE WHEN value < -20 THEN 0 WHEN value >= 20 THEN 9 ELSE floor((value + 20) / 5) + 1 END AS BIGINT) AS bin, count(*) AS n "
    "FROM cells_tas GROUP BY ALL",
)
def value_histogram(spark, sf):
    return compare.value_histogram(cube.cells(spark, sf).drop("variable"), -20.0, 20.0, 8)


@query("version_diff", f"SELECT year, month, min(o.value - n.value) AS min_diff, max(o.value - n.value) AS max_diff FROM {JOINED} GROUP BY ALL")
def version_diff(spark, sf):
    return compare.version_diff(*versions(spark, sf))


@query(
    "distinct_differences",
    "SELECT DISTINCT year, month, round_even((n.value - o.value) * 1e1, 0) / 1e1 + 0e0 AS diff FROM old_pr o JOIN new_pr n USING (year, month, row, col)",
)
def distinct_differences(spark, sf):
    d = compare.distinct_differences(*versions(spark, sf, "pr"))
    return d.select("year", "month", (F.col("diff") + 0.0).alias("diff")).distinct()


AREA = "SELECT year, month, {} AS {} FROM {} v JOIN sup USING (row, col) WHERE inside = 1 GROUP BY ALL"


@query(
    "version_mean_compare",
    f"SELECT year, month, old_mean, new_mean FROM ({AREA.format(R6('avg(v.value)'), 'old_mean', 'old_hur')}) "
    f"FULL JOIN ({AREA.format(R6('avg(v.value)'), 'new_mean', 'new_hur')}) USING (year, month)",
)
def version_mean_compare(spark, sf):
    w = compare.version_mean_compare(*versions(spark, sf, "hur"), cube.mask(spark, sf))
    return w.select("year", "month", r6("old_mean").alias("old_mean"), r6("new_mean").alias("new_mean"))


@query(
    "minmax_order_check",
    f"SELECT year, month, {R6('a')} AS tasmin, {R6('b')} AS tas, {R6('c')} AS tasmax, a <= b AND b <= c AS ordered FROM "
    f"({AREA.format('avg(v.value)', 'a', 'cells_tasmin')}) JOIN ({AREA.format('avg(v.value)', 'b', 'cells_tas')}) USING (year, month) "
    f"JOIN ({AREA.format('avg(v.value)', 'c', 'cells_tasmax')}) USING (year, month)",
)
def minmax_order_check(spark, sf):
    c = cube.cells(spark, sf, ["tasmin", "tas", "tasmax"]).drop("scenario")
    w = compare.minmax_order_check(c, cube.mask(spark, sf))
    return w.select("year", "month", r6("tasmin").alias("tasmin"), r6("tas").alias("tas"), r6("tasmax").alias("tasmax"), "ordered")


@query(
    "completeness_check",
    "SELECT model, count(DISTINCT year * 12 + month) AS months, 12 * (max(year) - min(year) + 1) AS expected, "
    "12 * (max(year) - min(year) + 1) - count(DISTINCT year * 12 + month) AS missing FROM model_tas GROUP BY model",
)
def completeness_check(spark, sf):
    """The last year of the data lacks a month."""
    return compare.completeness_check(cube.models(spark, sf).drop("scenario", "variable")).select(
        "model", "months", F.col("expected").cast("int").alias("expected"), "missing"
    )


def _table(v):
    return f"(SELECT {DECADE} AS decade, month, avg(value) AS mean, max(value) AS high FROM cells_{v} GROUP BY ALL)"


@query(
    "tabular_diff",
    f"SELECT decade, month, {R6('a.mean - b.mean')} AS mean, {R6('a.high - b.high')} AS high FROM {_table('tasmin')} a JOIN {_table('tas')} b USING (decade, month)",
)
def tabular_diff(spark, sf):
    from climgrid.functions.calendar import decade

    def summary(v):
        c = cube.cells(spark, sf, v).groupBy(decade(F.col("year")).alias("decade"), "month")
        return c.agg(F.avg("value").alias("mean"), F.max("value").alias("high"))

    d = compare.tabular_diff(summary("tasmin"), summary("tas"), ["decade", "month"], ["mean", "high"])
    return d.select("decade", "month", r6("mean").alias("mean"), r6("high").alias("high"))


@query("roundtrip_residual", "SELECT DISTINCT year, month, 0e0 AS residual FROM cells_tas WHERE year >= 2000")
def roundtrip_residual(spark, sf):
    """The stored product less its stored anomaly gives the baseline back."""
    coarse, fine = cube.grids(spark, sf)
    c = cube.cells(spark, sf).drop("variable")
    past, later = c.where(F.col("year") <= cube.END), c.where(F.col("year") > cube.END)
    base = cube.baseline(spark, sf)
    refined = delta.delta_pipeline(past, base, coarse, fine, future=later, begin=cube.BEGIN, end=cube.END).drop("scenario")
    product, side = work_folder(spark, "product"), work_folder(spark, "anomaly")
    sinks.sink_with_anomaly(refined, product, side)
    r = compare.roundtrip_residual(spark.read.parquet(product), spark.read.parquet(side), base)
    return r.select("year", "month", F.rint(F.col("residual") * 1e6).alias("residual"))


@query("anti_scenario", "SELECT year, month, row, col, value FROM cells_tas WHERE (row, col) NOT IN (SELECT row, col FROM sup WHERE inside = 1)")
def anti_scenario(spark, sf):
    """Cells outside the mask, by anti join."""
    inside = cube.mask(spark, sf).where(F.col("inside") == 1)
    return cube.cells(spark, sf).join(inside, ["row", "col"], "left_anti").select(*YMRC, "value")
