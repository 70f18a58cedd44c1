"""Cloud anomalies to surface radiation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from climgrid.functions.values import clamp_cloud
from climgrid.grid import Grid
from climgrid.functions.radiation import surface_radiation
from climgrid.operators.climate import join_month_lookup
from climgrid.plans.delta import delta_pipeline


def cloud_radiation_pipeline(
    cloud: DataFrame,
    cloud_baseline: DataFrame,
    ra: DataFrame,
    src_grid: Grid,
    dst_grid: Grid,
    begin: int,
    end: int,
) -> DataFrame:
    """Ratio anomalies of coarse cloud on the fine cloud climatology, kept in 0..100,
    then radiation at the surface from the monthly ``ra`` of the cell (or of its row).
    ``ra`` is laid beside the monthly baseline, before that is repeated over time."""
    both = join_month_lookup(cloud_baseline, ra, "ra")
    refined = delta_pipeline(
        cloud, both, src_grid, dst_grid, begin=begin, end=end, operation="mult", post=clamp_cloud
    )
    named = refined.withColumnRenamed("value", "cloud")
    return named.withColumn("value", surface_radiation(F.col("ra"), F.col("cloud"))).drop("ra")
