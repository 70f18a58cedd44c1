"""Selection, calendar keys and orientation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from climgrid.functions import calendar
from climgrid.grid import Grid
from climgrid.schema import month_index, series_cols, shared


def select_years(df: DataFrame, begin: int | None = None, end: int | None = None) -> DataFrame:
    """Inclusive year slice, applied only when both ends are given."""
    if begin is None or end is None:
        return df
    return df.where(F.col("year").between(begin, end))


def select_level(df: DataFrame, level: float) -> DataFrame:
    return df.where(F.col("level") == float(level))


def select_months(df: DataFrame, months=(5, 6, 7, 8, 9)) -> DataFrame:
    return df.where(F.col("month").isin(*months))


def select_nearest_years(df: DataFrame, begin: int, end: int) -> DataFrame:
    """Slice to the years of each series that lie closest to the wanted span;
    of two equally close years the earlier is taken."""
    by = series_cols(df)
    far = lambda y: F.struct(F.abs(F.col("year") - y), F.col("year"))
    span = df.groupBy(*by).agg(
        F.min(far(begin)).getField("year").alias("_begin"),
        F.min(far(end)).getField("year").alias("_end"),
    )
    return (
        df.join(span, by)
        .where(F.col("year").between(F.col("_begin"), F.col("_end")))
        .drop("_begin", "_end")
    )


def with_month_position(df: DataFrame) -> DataFrame:
    """0-based ``position`` of a month, counted from the first month of its series."""
    by = series_cols(df)
    first = df.groupBy(*by).agg(F.min(month_index("year", "month")).alias("_first"))
    return df.join(first, by).withColumn("position", month_index("year", "month") - F.col("_first")).drop("_first")


def select_years_by_position(df: DataFrame, first_year: int, begin: int, end: int) -> DataFrame:
    """Slice by month position, for series whose dates are only known by the
    year they start in."""
    lo, hi = (begin - first_year) * 12, (end - first_year + 1) * 12 - 1
    return with_month_position(df).where(F.col("position").between(lo, hi))


def trim_partial_seasons(df: DataFrame) -> DataFrame:
    """Drop January and February of the first year and December of the last year."""
    by = series_cols(df)
    span = df.groupBy(*by).agg(F.min("year").alias("_first"), F.max("year").alias("_last"))
    lead = (F.col("year") == F.col("_first")) & F.col("month").isin(1, 2)
    tail = (F.col("year") == F.col("_last")) & (F.col("month") == 12)
    return df.join(span, by).where(~(lead | tail)).drop("_first", "_last")


def with_time_keys(df: DataFrame) -> DataFrame:
    """Add decade, season and season_year."""
    y, m = F.col("year"), F.col("month")
    return df.withColumns(
        {
            "decade": calendar.decade(y),
            "season": calendar.season(m),
            "season_year": calendar.season_year(y, m),
        }
    )


def full_decades_only(df: DataFrame, members: int = 10) -> DataFrame:
    """Keep decades in which a series has exactly ``members`` distinct years."""
    by = series_cols(df)
    keyed = df.withColumn("decade", calendar.decade(F.col("year")))
    full = (
        keyed.groupBy(*by, "decade")
        .agg(F.count_distinct("year").alias("_years"))
        .where(F.col("_years") == members)
        .drop("_years")
    )
    return keyed.join(full, by + ["decade"], "left_semi")


def north_up(df: DataFrame) -> DataFrame:
    """Where the first row of a grid lies south of the equator, reverse its rows.
    The orientation is one small record per grid."""
    facts = df.groupBy("grid_id").agg(
        (F.min_by("lat", "row") < 0).alias("_flip"), F.max("row").alias("_last")
    )
    row = F.when(F.col("_flip"), F.col("_last") - F.col("row")).otherwise(F.col("row"))
    return df.join(facts, "grid_id").withColumn("row", row).drop("_flip", "_last")


def lon_convention(df: DataFrame) -> DataFrame:
    """Per grid: does it run 0-360 (any longitude above 200)?"""
    return df.groupBy("grid_id").agg((F.max("lon") > 200).alias("pacific"))


def rotate_grid(grid: Grid, to_pacific: bool) -> tuple[Grid, int]:
    """The rotated grid and the number of columns its seam moves."""
    x0 = 0.0 if to_pacific else -180.0
    shift = round((grid.x0 - x0) / grid.dx)
    return replace(grid, x0=grid.x0 - shift * grid.dx), shift


def rotate_lon(df: DataFrame, grid: Grid, to_pacific: bool = True) -> tuple[DataFrame, Grid]:
    """Move the seam of a global grid: 0..360 when ``to_pacific``, else -180..180.

    A column that repeats the first one a whole turn later is dropped.  Each row
    is handled by arithmetic alone, so nothing is shuffled.
    """
    repeated = round(grid.nx * grid.dx - 360.0, 6) > 0
    whole = replace(grid, nx=grid.nx - 1) if repeated else grid
    out, shift = rotate_grid(whole, to_pacific)
    if repeated:
        df = df.where(F.col("col") < whole.nx)
    df = df.withColumn("col", F.pmod(F.col("col") + shift, F.lit(whole.nx)))
    return df.withColumn("lon", out.x("col")), out


def grid_affine(df: DataFrame, global_corner: bool = False) -> DataFrame:
    """One row per grid: corner, cell size and shape, from centre coordinates.

    ``global_corner`` puts the corner on latitude 90 and on longitude -180 or 0,
    whichever is closer to the first centre.
    """
    g = df.groupBy("grid_id").agg(
        F.min("lon").alias("x_min"),
        F.max("lon").alias("x_max"),
        F.min("lat").alias("y_min"),
        F.max("lat").alias("y_max"),
        F.count_distinct("lon").alias("nx"),
        F.count_distinct("lat").alias("ny"),
    )
    dx = F.try_divide(F.col("x_max") - F.col("x_min"), F.col("nx") - 1)
    dy = F.try_divide(F.col("y_max") - F.col("y_min"), F.col("ny") - 1)
    g = g.withColumns({"dx": dx, "dy": dy})
    if global_corner:
        x0 = F.when(F.abs(F.col("x_min") + 180) <= F.abs(F.col("x_min")), F.lit(-180.0)).otherwise(F.lit(0.0))
        y0 = F.lit(90.0)
    else:
        x0, y0 = F.col("x_min") - F.col("dx") / 2, F.col("y_max") + F.col("dy") / 2
    return g.select("grid_id", "nx", "ny", x0.alias("x0"), y0.alias("y0"), "dx", "dy")


def with_centers(df: DataFrame, grid: Grid) -> DataFrame:
    """Add centre coordinates ``x`` and ``y`` from row and column."""
    return df.withColumns({"x": grid.x(), "y": grid.y()})


def apply_mask(df: DataFrame, mask: DataFrame, value: str = "value") -> DataFrame:
    """NULL where the mask is 0 or has no row; ``mask`` holds cell columns and ``inside``."""
    keys = shared(df, mask, ("grid_id", "row", "col"))
    flag = mask.select(*keys, (F.col("inside") == 1).alias("_in"))
    return (
        df.join(flag, keys, "left").withColumn(value, F.when(F.col("_in"), F.col(value))).drop("_in")
    )


def head_months(df: DataFrame, n: int = 12) -> DataFrame:
    """The first ``n`` timesteps in time order."""
    return df.select("year", "month").distinct().orderBy("year", "month").limit(n)
