"""Statistics over zones and areas of interest.

A zone may hold a large part of the cells; all statistics here combine map-side, so
a hot zone costs no more than its partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from climgrid.functions import calendar
from climgrid.operators.aggregate import model_difference
from climgrid.operators.climate import anomaly, climatology
from climgrid.schema import CELL, TIME, cell_cols, present, series_cols, shared


def _stats(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.stddev_pop("value").alias("stdev"),
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def zonal_metrics(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Per series, decade, month and zone: the mean over time of each cell, then
    spread, mean, least and greatest over cells.  The time mean comes first, so
    the join with zones sees one row per cell and month, not one per timestep."""
    by = series_cols(df)
    cells = (
        df.withColumn("decade", calendar.decade(F.col("year")))
        .groupBy(*by, "decade", "month", *cell_cols(df))
        .agg(F.avg("value").alias("value"))
    )
    keys = shared(df, zones, CELL)
    return _stats(cells.join(zones, keys), by + ["decade", "month", "zone_id"])


def zonal_metrics_annual(df: DataFrame, zones: DataFrame) -> DataFrame:
    """The same statistics per single timestep."""
    keys = shared(df, zones, CELL)
    return _stats(df.join(zones, keys), series_cols(df) + present(df, TIME) + ["zone_id"])


def zonal_diff_mean(df: DataFrame, ensemble: DataFrame, zone: DataFrame) -> DataFrame:
    """Mean over one zone of (model - ensemble) per timestep."""
    return aoi_mean_series(model_difference(df, ensemble), zone)


def zonal_diff_metrics(df: DataFrame, ensemble: DataFrame, zones: DataFrame) -> DataFrame:
    return zonal_metrics(model_difference(df, ensemble), zones)


def in_area(df: DataFrame, mask: DataFrame) -> DataFrame:
    keys = shared(df, mask, CELL)
    return df.join(mask.where(F.col("inside") == 1).select(*keys), keys, "left_semi")


def aoi_mean_series(df: DataFrame, mask: DataFrame | None = None) -> DataFrame:
    """Mean over the cells of an area per series and timestep."""
    area = df if mask is None else in_area(df, mask)
    return area.groupBy(*series_cols(df), *present(df, TIME)).agg(F.avg("value").alias("value"))


def aoi_anomaly_mean(df: DataFrame, mask: DataFrame, begin: int, end: int, operation: str = "add") -> DataFrame:
    """Mean anomaly over the area: cells outside are left out before the climatology."""
    area = in_area(df, mask)
    return aoi_mean_series(anomaly(area, climatology(area, begin, end), operation))


def aoi_decadal_mean(series: DataFrame, by_month: bool = False) -> DataFrame:
    """Mean per decade (and month) of an area-mean series."""
    keys = series_cols(series) + ["decade"] + (["month"] if by_month else [])
    keyed = series.withColumn("decade", calendar.decade(F.col("year")))
    return keyed.groupBy(*keys).agg(F.avg("value").alias("value"))


def global_mean_wide(df: DataFrame, models: list[str] | None = None) -> DataFrame:
    """Whole-grid mean per timestep, one column per model."""
    return df.groupBy("year", "month").pivot("model", models).agg(F.avg("value"))


def baseline_period_compare(df: DataFrame, periods: dict[str, tuple[int, int]], mask: DataFrame | None = None) -> DataFrame:
    """Area mean per variable and month over several spans of years side by side.
    One pass: each span is a conditional average."""
    area = df if mask is None else in_area(df, mask)
    aggs = [
        F.avg(F.when(F.col("year").between(b, e), F.col("value"))).alias(name) for name, (b, e) in periods.items()
    ]
    return area.groupBy("variable", "month").agg(*aggs)
