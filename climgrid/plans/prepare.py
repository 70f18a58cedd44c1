"""Preparation of series and baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from climgrid.functions.values import from_tenths, round_by_variable, to_tenths
from climgrid.grid import Grid
from climgrid.operators.compare import completeness_check
from climgrid.operators.neighbors import fill_mask_neighbors, mosaic_first
from climgrid.operators.regrid import regrid
from climgrid.operators.gaps import regrid_points
from climgrid.operators.select import select_years
from climgrid.sources.series import combine_parts


def prepare_series(*parts: DataFrame, begin: int | None = None, end: int | None = None) -> DataFrame:
    """Parts of a series as one, sliced to years; see ``incomplete_series`` for the check."""
    return select_years(combine_parts(*parts), begin, end)


def incomplete_series(df: DataFrame) -> DataFrame:
    """Series that lack a month of their span."""
    return completeness_check(df).where(F.col("missing") != 0)


def prepare_farfuture(*parts: DataFrame) -> DataFrame:
    """Many files of a series as one; time order is carried by year and month."""
    return combine_parts(*parts)


def prepare_point_baseline(
    points: DataFrame, coarse: Grid, template: DataFrame, fine: Grid, variable: str, method: str = "bilinear", spread: str = "axes"
) -> DataFrame:
    """Point climatology -> 0..360 -> regular grid -> template cells, masked and rounded.
    ``spread``: how points come onto the regular grid, a method of ``regrid_points``."""
    lon = F.pmod(F.col("lon"), F.lit(360.0)) if coarse.x0 >= 0 else F.col("lon")
    gridded = regrid_points(points.withColumn("lon", lon), coarse, spread)
    out = regrid(gridded, template, coarse, fine, method)
    value = F.when(F.col("inside") == 1, round_by_variable(F.col("value"), variable))
    return out.withColumn("value", value).drop("inside")


def prepare_mosaic_baseline(first: DataFrame, second: DataFrame, mask: DataFrame, second_in_tenths: bool = False) -> DataFrame:
    """Two regional climatologies: to tenths, merged (the first wins), holes filled from
    neighbours inside the mask, back to units."""
    b = second if second_in_tenths else second.withColumn("value", to_tenths(F.col("value")))
    whole = fill_mask_neighbors(mosaic_first(first, b), mask)
    return whole.withColumn("value", from_tenths(F.col("value")))


def prepare_scaled_baseline(tenths: DataFrame, template: DataFrame, src_grid: Grid, dst_grid: Grid) -> DataFrame:
    """Tenths -> units -> bilinear onto the template -> mask."""
    scaled = tenths.withColumn("value", from_tenths(F.col("value")))
    out = regrid(scaled, template, src_grid, dst_grid, "bilinear")
    return out.withColumn("value", F.when(F.col("inside") == 1, F.col("value"))).drop("inside")
