"""Validation of series and comparison of versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from climgrid.operators.zonal import aoi_mean_series
from climgrid.schema import SERIES, TIME, key_cols, month_index, present, series_cols
from climgrid.storage import join_dealt


def join_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both versions of each value; a side that is missing is NULL and says so."""
    keys = [c for c in key_cols(old) if c in new.columns]
    a = old.select(*keys, F.col("value").alias("old_value"), F.lit(1).alias("_o"))
    b = new.select(*keys, F.col("value").alias("new_value"), F.lit(1).alias("_n"))
    return (
        a.join(b, keys, "full_outer")
        .withColumn(
            "side",
            F.when(F.col("_o").isNull(), "new only").when(F.col("_n").isNull(), "old only").otherwise("both"),
        )
        .drop("_o", "_n")
    )


def grid_equal(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per timestep: cells compared, cells that differ (a missing side or one NULL
    counts as a difference), and whether the grids are equal."""
    j = join_versions(old, new)
    differs = (F.col("side") != "both") | ~F.col("old_value").eqNullSafe(F.col("new_value"))
    return (
        j.groupBy(*present(j, SERIES + TIME))
        .agg(F.count(F.lit(1)).alias("cells"), F.count_if(differs).alias("different"))
        .withColumn("equal", F.col("different") == 0)
    )


def version_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Least and greatest of old - new per timestep."""
    j = join_versions(old, new)
    d = F.col("old_value") - F.col("new_value")
    return j.groupBy(*present(j, SERIES + TIME)).agg(F.min(d).alias("min_diff"), F.max(d).alias("max_diff"))


def distinct_differences(old: DataFrame, new: DataFrame, places: int = 1) -> DataFrame:
    """Distinct values of new - old per timestep."""
    j = join_versions(old, new).where(F.col("side") == "both")
    p = float(10**places)
    d = F.rint((F.col("new_value") - F.col("old_value")) * p) / p
    return j.select(*present(j, TIME), d.alias("diff")).distinct()


def schema_consistent(df: DataFrame) -> DataFrame:
    """Per series: how many shapes its timesteps have (1 = all alike)."""
    by = present(df, SERIES)
    shapes = df.groupBy(*by, "year", "month").agg(
        F.struct(F.min("row"), F.max("row"), F.min("col"), F.max("col")).alias("extent")
    )
    return (
        shapes.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("members"), F.count_distinct("extent").alias("shapes"))
        .withColumn("consistent", F.col("shapes") == 1)
    )


def value_range(df: DataFrame) -> DataFrame:
    return df.groupBy(*present(df, SERIES + TIME)).agg(F.min("value").alias("min"), F.max("value").alias("max"))


def value_histogram(df: DataFrame, low: float, high: float, bins: int) -> DataFrame:
    """Counts per equal-width bin; 0 and bins + 1 collect what lies outside."""
    return (
        df.where(F.col("value").isNotNull())
        .groupBy(*present(df, SERIES), F.width_bucket("value", F.lit(low), F.lit(high), F.lit(bins)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def version_mean_compare(old: DataFrame, new: DataFrame, mask: DataFrame) -> DataFrame:
    """Area means of both versions side by side."""
    a = aoi_mean_series(old, mask).withColumnRenamed("value", "old_mean")
    b = aoi_mean_series(new, mask).withColumnRenamed("value", "new_mean")
    return a.join(b, present(a, SERIES + TIME), "full_outer")


def minmax_order_check(df: DataFrame, mask: DataFrame | None = None) -> DataFrame:
    """Area means of tasmin, tas and tasmax side by side, with ``ordered``."""
    means = aoi_mean_series(df, mask)
    keys = [c for c in present(means, SERIES + TIME) if c != "variable"]
    wide = means.groupBy(*keys).pivot("variable", ["tasmin", "tas", "tasmax"]).agg(F.avg("value"))
    ok = (F.col("tasmin") <= F.col("tas")) & (F.col("tas") <= F.col("tasmax"))
    return wide.withColumn("ordered", ok)


def completeness_check(df: DataFrame) -> DataFrame:
    """Months present against twelve per year of the span of each series."""
    by = series_cols(df)
    t = month_index("year", "month")
    return (
        df.groupBy(*by)
        .agg(
            F.count_distinct(t).alias("months"),
            (F.lit(12) * (F.max("year") - F.min("year") + 1)).alias("expected"),
        )
        .withColumn("missing", F.col("expected") - F.col("months"))
    )


def tabular_diff(left: DataFrame, right: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """left - right of summary tables on matching keys."""
    r = right.select(*keys, *[F.col(m).alias(f"_r_{m}") for m in metrics])
    return left.join(r, keys).select(*keys, *[(F.col(m) - F.col(f"_r_{m}")).alias(m) for m in metrics])


def roundtrip_residual(output: DataFrame, anomalies: DataFrame, baseline: DataFrame) -> DataFrame:
    """Greatest |output - anomaly - baseline| per timestep: 0 when the refinement added up."""
    keys = [c for c in key_cols(output) if c in anomalies.columns]
    a = join_dealt(output, anomalies.select(*keys, F.col("value").alias("_a")), keys)
    base_keys = [c for c in ("grid_id", "row", "col", "month") if c in a.columns and c in baseline.columns]
    b = join_dealt(a, baseline.select(*base_keys, F.col("value").alias("_b")), base_keys)
    r = F.abs(F.col("value") - F.col("_a") - F.col("_b"))
    return b.groupBy(*present(b, SERIES + TIME)).agg(F.max(r).alias("residual"))
