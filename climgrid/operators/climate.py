"""Climatology, anomalies and their recombination with a baseline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from climgrid.operators.select import select_years
from climgrid.schema import CELL, SERIES, TIME, cell_cols, present, series_cols, shared
from climgrid.storage import join_dealt

OPERATIONS = ("add", "mult")


def check_operation(operation: str) -> str:
    if operation not in OPERATIONS:
        raise ValueError(f"operation must be one of {OPERATIONS}, not {operation!r}")
    return operation


def concat_series(historical: DataFrame, future: DataFrame) -> DataFrame:
    return historical.unionByName(future, allowMissingColumns=True)


def require_overlap(df: DataFrame, begin: int, end: int) -> None:
    """Raise if no month of the series lies in the base period.  Reads until the
    first match only, and only partitions of those years."""
    if select_years(df, begin, end).isEmpty():
        raise ValueError(f"no data in the climatology period {begin}-{end}")


PAST = "historical"


def climatology(
    df: DataFrame, begin: int, end: int, by: list[str] | None = None, serve: DataFrame | None = None
) -> DataFrame:
    """Mean per calendar month and cell over an inclusive span of years.

    The year filter reaches the scan; sums are combined map-side before the shuffle.  A
    table of several scenarios gives each its own climatology, from its own months and
    those of the historical series it carries on, also where the base period reaches
    past that one.  ``serve`` is the table whose series want a climatology, where it is not
    ``df``; ``by`` names other keys.
    """
    base = select_years(df, begin, end)
    if by is not None or "scenario" not in df.columns:
        keys = by if by is not None else series_cols(df) + cell_cols(df)
        return base.groupBy(*keys, "month").agg(F.avg("value").alias("clim"))
    series = [c for c in series_cols(df) if c != "scenario"]
    keys = series + cell_cols(df) + ["month"]
    sums = base.groupBy("scenario", *keys).agg(F.sum("value").alias("_s"), F.count("value").alias("_n"))
    past = sums.where(F.col("scenario") == PAST).drop("scenario").withColumnsRenamed({"_s": "_ps", "_n": "_pn"})
    names = (df if serve is None else serve).select("scenario", *series, "month").distinct()
    carried = past.join(names, [*series, "month"])
    own = sums.where(F.col("scenario") != PAST)
    both = carried.join(own, ["scenario", *keys], "full")
    total = lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    mean = F.try_divide(total("_ps", "_s"), total("_pn", "_n"))
    return both.select("scenario", *keys, mean.alias("clim"))


def anomaly(df: DataFrame, clim: DataFrame, operation: str) -> DataFrame:
    """Difference from, or ratio to, the climatology of the same cell and month.

    A plain equi-join: Spark broadcasts the climatology when its measured size is
    under the limit, else both sides shuffle on (series, cell, month) and AQE
    splits a hot cell.  A zero climatology and a missing one give NULL.
    """
    check_operation(operation)
    keys = shared(df, clim, SERIES + CELL + ("month",))
    if operation == "add":
        value = F.col("value") - F.col("clim")
    else:
        value = F.try_divide(F.col("value"), F.col("clim"))
    return df.join(clim, keys, "left").withColumn("value", value).drop("clim")


def restrict_times(df: DataFrame, times: DataFrame) -> DataFrame:
    """Keep the timesteps (and scenario, where both sides have it) that occur in ``times``."""
    keys = shared(df, times, ("scenario",) + TIME)
    return df.join(times.select(*keys).distinct(), keys, "left_semi")


def lowres_anomalies(df: DataFrame, begin: int, end: int, ratio_variables=("pr", "pre")) -> DataFrame:
    """Coarse anomalies without resampling; the variable decides the operation."""
    clim = climatology(df, begin, end)
    keys = shared(df, clim, SERIES + CELL + ("month",))
    v, c = F.col("value"), F.col("clim")
    value = F.when(F.col("variable").isin(*ratio_variables), F.try_divide(v, c)).otherwise(v - c)
    return df.join(clim, keys, "left").withColumn("value", value).drop("clim")


def delta_to_mean(extreme: DataFrame, mean: DataFrame, operation: str = "add") -> DataFrame:
    """Minimum or maximum against the mean of the same model, time and cell."""
    check_operation(operation)
    names = ("project", "model", "scenario") + TIME + CELL
    keys = shared(extreme, mean, names)
    right = mean.select(*keys, F.col("value").alias("_mean"))
    if operation == "add":
        value = F.col("value") - F.col("_mean")
    else:
        value = F.try_divide(F.col("value"), F.col("_mean"))
    return extreme.join(right, keys).withColumn("value", value).drop("_mean")


def combine(base: Column, delta: Column, operation: str) -> Column:
    return base + delta if check_operation(operation) == "add" else base * delta


def apply_delta(anomalies: DataFrame, baseline: DataFrame, operation: str) -> DataFrame:
    """Baseline and anomaly of the same cell, joined on month for a climatology
    and on year and month for a full series."""
    names = ("project", "model", "scenario") + TIME + CELL
    keys = shared(anomalies, baseline, names)
    right = baseline.select(*keys, F.col("value").alias("_base"))
    value = combine(F.col("_base"), F.col("value"), operation)
    return join_dealt(anomalies, right, keys).withColumn("value", value).drop("_base")


def post_function(df: DataFrame, fn: Callable[[Column], Column] | None, value: str = "value") -> DataFrame:
    """Apply a user's Column -> Column function to the combined values."""
    return df if fn is None else df.withColumn(value, fn(F.col(value)))


def join_variables(left: DataFrame, right: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Two variables side by side on series, time and cell."""
    keys = shared(left, right, ("project", "model", "scenario") + TIME + CELL)
    a = left.select(*keys, F.col("value").alias(names[0]))
    b = right.select(*keys, F.col("value").alias(names[1]))
    return a.join(b, keys)


def join_models(df: DataFrame, models: list[str]) -> DataFrame:
    """The models of a variable side by side, one column each; NULL where one lacks the cell."""
    by = [c for c in series_cols(df) if c != "model"] + present(df, TIME) + cell_cols(df)
    return df.groupBy(*by).agg(*[F.max(F.when(F.col("model") == m, F.col("value"))).alias(m) for m in models])


def join_month_lookup(df: DataFrame, lookup: DataFrame, name: str) -> DataFrame:
    """Attach a monthly per-cell value (such as potential radiation)."""
    keys = shared(df, lookup, CELL + ("month",))
    return join_dealt(df, lookup.select(*keys, F.col("value").alias(name)), keys)


def join_baseline_time(df: DataFrame, baseline: DataFrame, name: str = "base") -> DataFrame:
    """Attach the value that a full baseline series holds for the same time and cell."""
    keys = shared(df, baseline, ("project", "model", "scenario") + TIME + CELL)
    return join_dealt(df, baseline.select(*keys, F.col("value").alias(name)), keys)


def series_identity(df: DataFrame) -> DataFrame:
    return df.select(*series_cols(df)).distinct()
