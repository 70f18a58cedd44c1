"""Radiation and day length on cells or latitude rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from climgrid.functions import calendar, radiation
from climgrid.functions.humidity import relative_humidity
from climgrid.operators.climate import join_month_lookup, join_variables


def _monthly_mean(df: DataFrame, daily, lat: str) -> DataFrame:
    """Mean over the days of each month of a daily quantity.  The 365 days are made
    in place and folded to twelve rows before anything is shuffled."""
    keep = [c for c in df.columns if c != lat]
    days = df.select(*keep, lat, F.explode(F.sequence(F.lit(1), F.lit(365))).alias("_day"))
    month = calendar.month_of_day(F.col("_day"))
    value = daily(F.col("_day"), F.radians(F.col(lat)))
    return days.groupBy(*keep, lat, month.alias("month")).agg(F.avg(value).alias("value"))


def ra_monthly(df: DataFrame, lat: str = "lat") -> DataFrame:
    """Monthly mean extraterrestrial radiation.  Pass distinct latitudes where many
    cells share one, and attach the result by join."""
    return _monthly_mean(df, radiation.extraterrestrial_radiation, lat)


def gross_radiation_monthly(df: DataFrame, lat: str = "lat") -> DataFrame:
    return _monthly_mean(df, radiation.gross_radiation_day, lat)


def day_length_monthly(df: DataFrame, lat: str = "lat") -> DataFrame:
    """Day length at the mean day of each month."""
    months = df.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    day = calendar.mean_day_of_month(F.col("month"))
    return months.withColumn("value", radiation.day_length(day, F.radians(F.col(lat))))


def surface_radiation(cloud: DataFrame, ra: DataFrame, guarded: bool = False) -> DataFrame:
    """Radiation at the surface from cloud and the monthly radiation of the cell."""
    fn = radiation.surface_radiation_guarded if guarded else radiation.surface_radiation
    joined = join_month_lookup(cloud, ra, "ra")
    return joined.withColumn("value", fn(F.col("ra"), F.col("value"))).drop("ra")


def humidity_series(vap: DataFrame, tas: DataFrame, cap: float = 95.0) -> DataFrame:
    """Relative humidity from vapour pressure and temperature of the same cell and time."""
    both = join_variables(vap, tas, ("vap", "tas"))
    return both.withColumn("value", relative_humidity(F.col("tas"), F.col("vap"), cap)).drop("vap", "tas")
