"""Ensembles and calendar aggregates.

All are hash aggregations with map-side partials; where a group must be complete,
the count of distinct members is part of the same aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from climgrid.functions import calendar
from climgrid.functions.values import rint_places
from climgrid.schema import cell_cols, month_index, present, series_cols, SERIES, TIME

ENSEMBLE = "5ModelAvg"  # fixed value: name of the five-model mean
METRICS = {"mean": F.avg, "total": F.sum, "min": F.min, "max": F.max}


def metric_column(metric: str, value: str = "value") -> Column:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {sorted(METRICS)}, not {metric!r}")
    return METRICS[metric](value)


def default_metric(variable: str) -> str:
    """Precipitation is summed over a period, everything else averaged."""
    return "total" if variable in ("pr", "pre") else "mean"


def ensemble_mean(df: DataFrame, members: int = 5, name: str = ENSEMBLE) -> DataFrame:
    """Mean over models per time and cell, where all models have a value."""
    keys = [c for c in series_cols(df) if c != "model"] + present(df, TIME) + cell_cols(df)
    return (
        df.where(F.col("value").isNotNull())
        .groupBy(*keys)
        .agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") == members)
        .drop("_n")
        .withColumn("model", F.lit(name))
    )


def _metrics(metric: str, named: dict[str, str]) -> list[Column]:
    """``metric`` as ``value``, or each named column's metric: all in one aggregation."""
    return [metric_column(m).alias(n) for n, m in (named or {"value": metric}).items()]


def annual_grid(df: DataFrame, metric: str = "mean", **named: str) -> DataFrame:
    """One metric as ``value``, or several as named: ``annual_grid(df, value="mean", high="max")``."""
    return df.groupBy(*series_cols(df), "year", *cell_cols(df)).agg(*_metrics(metric, named))


def seasonal_grid(df: DataFrame, metric: str = "mean", **named: str) -> DataFrame:
    """One value (or one per named metric) per season, cell and season year; only seasons with all three months.
    Partial seasons at the ends of a series drop out by that rule."""
    keyed = df.where(F.col("value").isNotNull()).select(
        *series_cols(df),
        calendar.season_year(F.col("year"), F.col("month")).alias("season_year"),
        calendar.season(F.col("month")).alias("season"),
        *cell_cols(df),
        "month",
        "value",
    )
    return (
        keyed.groupBy(*series_cols(df), "season_year", "season", *cell_cols(df))
        .agg(*_metrics(metric, named), F.bit_count(F.bit_or(F.expr("shiftleft(1, month)"))).alias("_n"))
        .where(F.col("_n") == 3)
        .drop("_n")
    )


def season_subset(df: DataFrame, season: str) -> DataFrame:
    """Mean per cell over all months of one season of a series."""
    months = calendar.SEASONS[season]
    return (
        df.where(F.col("month").isin(*months))
        .groupBy(*series_cols(df), *cell_cols(df))
        .agg(F.avg("value").alias("value"))
    )


def decadal_monthly(df: DataFrame, members: int = 10) -> DataFrame:
    """Mean per decade and calendar month, for cells with ``members`` distinct years."""
    out = _decadal_monthly(df, F.avg("value").alias("value"))
    return out.where(F.col("_n") == members).drop("_n")


def decadal_monthly_any(df: DataFrame, metric: str = "mean", **named: str) -> DataFrame:
    """As ``decadal_monthly`` whatever the number of years.  A total is meant as the
    mean of monthly totals; min and max stay what they are."""
    wanted = (named or {"value": metric}).items()
    columns = [(F.avg("value") if m == "total" else metric_column(m)).alias(n) for n, m in wanted]
    return _decadal_monthly(df, *columns).drop("_n")


def _decadal_monthly(df: DataFrame, *agg: Column) -> DataFrame:
    keys = series_cols(df)
    cells = cell_cols(df)
    keyed = df.where(F.col("value").isNotNull()).select(
        *keys, calendar.decade(F.col("year")).alias("decade"), "year", "month", *cells, "value"
    )
    # distinct years, as one bit each: a repeated record does not count twice
    years = F.bit_count(F.bit_or(F.expr("shiftleft(1, pmod(year, 10))")))
    return keyed.groupBy(*keys, "decade", "month", *cells).agg(*agg, years.alias("_n"))


def decadal_seasonal(df: DataFrame, metric: str = "mean", members: int = 10) -> DataFrame:
    """Mean of the season-year grids of a decade, where the decade has them all."""
    s = seasonal_grid(df, metric).withColumn("decade", calendar.decade(F.col("season_year")))
    return _decade_mean(s, "season_year", members, extra=["season"])


def decadal_seasonal_direct(df: DataFrame) -> DataFrame:
    """Mean of all months of a decade's season, December in its own calendar year,
    infinite values left out."""
    v = F.when(F.abs(F.col("value")) != float("inf"), F.col("value"))
    keyed = df.select(
        *series_cols(df),
        calendar.decade(F.col("year")).alias("decade"),
        calendar.season(F.col("month")).alias("season"),
        *cell_cols(df),
        v.alias("value"),
    )
    return keyed.groupBy(*series_cols(df), "decade", "season", *cell_cols(df)).agg(F.avg("value").alias("value"))


def decadal_annual(df: DataFrame, metric: str = "mean", members: int = 10) -> DataFrame:
    """Mean of the annual grids of a decade, where the decade has them all."""
    a = annual_grid(df, metric).withColumn("decade", calendar.decade(F.col("year")))
    return _decade_mean(a, "year", members)


def _decade_mean(df: DataFrame, year: str, members: int, extra: list[str] = []) -> DataFrame:
    return (
        df.where(F.col("value").isNotNull())
        .groupBy(*series_cols(df), "decade", *extra, *cell_cols(df))
        .agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") == members)
        .drop("_n")
    )


def summer_warmth(df: DataFrame, months=(5, 6, 7, 8, 9), places: int | None = 1) -> DataFrame:
    """Sum of the above-zero monthly means of May-September per year (or decade) and
    cell; NULL unless all five months have a value."""
    by = [c for c in ("year", "decade") if c in df.columns]
    warm = F.greatest(F.col("value"), F.lit(0.0))
    return (
        df.where(F.col("month").isin(*months))
        .groupBy(*series_cols(df), *by, *cell_cols(df))
        .agg(F.sum(F.when(F.col("value").isNotNull(), warm)).alias("_s"), F.count("value").alias("_n"))
        .withColumn("value", F.when(F.col("_n") == len(months), F.col("_s") if places is None else rint_places(F.col("_s"), places)))
        .drop("_s", "_n")
    )


def month_vector(df: DataFrame, by: list[str]) -> DataFrame:
    """ARRAY of the twelve monthly values per group, from conditional aggregates: each
    group keeps twelve numbers however many rows feed it."""
    months = [F.max(F.when(F.col("month") == m, F.col("value"))) for m in range(1, 13)]
    return df.groupBy(*by).agg(F.array(*months).alias("months"))


def pack_series(df: DataFrame) -> DataFrame:
    """All timesteps of a cell as one time-ordered array.

    A second value of the same month is averaged first, so an array is no longer
    than the series has months, however often a cell repeats in the input.
    """
    by = series_cols(df) + cell_cols(df)
    once = df.groupBy(*by, "year", "month").agg(F.avg("value").alias("value"))
    step = F.struct("year", "month", "value")
    return once.groupBy(*by).agg(F.array_sort(F.collect_list(step)).alias("steps"))


def unpack_series(df: DataFrame) -> DataFrame:
    return df.select("*", F.explode("steps").alias("_s")).select(
        *[c for c in df.columns if c != "steps"], "_s.year", "_s.month", "_s.value"
    )


def departure_step(df: DataFrame, ensemble: DataFrame) -> DataFrame:
    """Month-to-month change of (model - ensemble) per series and cell."""
    diff = model_difference(df, ensemble)
    w = Window.partitionBy(*series_cols(diff), *cell_cols(diff)).orderBy("year", "month")
    return diff.withColumn("step", F.col("value") - F.lag("value").over(w))


def model_difference(df: DataFrame, ensemble: DataFrame) -> DataFrame:
    """model - ensemble of the same time and cell."""
    names = [c for c in SERIES if c != "model"]
    keys = [c for c in present(df, tuple(names) + TIME + ("grid_id", "row", "col")) if c in ensemble.columns]
    right = ensemble.select(*keys, F.col("value").alias("_e"))
    return df.join(right, keys).withColumn("value", F.col("value") - F.col("_e")).drop("_e")


def rolling_series(df: DataFrame, k: int, metric: str = "mean") -> DataFrame:
    """Aggregate over a sliding window of the last ``k`` timesteps, where there are k."""
    w = (
        Window.partitionBy(*series_cols(df), *cell_cols(df))
        .orderBy("year", "month")
        .rowsBetween(-(k - 1), Window.currentRow)
    )
    full = F.count(F.lit(1)).over(w) == k
    return df.withColumn("rolling", F.when(full, metric_column(metric).over(w)))


def trim_trailing_nodata(df: DataFrame) -> DataFrame:
    """Drop the months of a series after its last one with any data."""
    by = series_cols(df)
    t = month_index("year", "month")
    last = df.where(F.col("value").isNotNull()).groupBy(*by).agg(F.max(t).alias("_last"))
    return df.join(last, by).where(t <= F.col("_last")).drop("_last")
