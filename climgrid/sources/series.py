"""Parquet scans of series and baselines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from climgrid.operators.select import select_level, select_years
from climgrid.schema import CELLS_DDL, key_cols, series_cols, time_cols


def scan_series(
    spark: SparkSession,
    path: str | list[str],
    variable: str | None = None,
    model: str | None = None,
    scenario: str | None = None,
    begin: int | None = None,
    end: int | None = None,
    level: float | None = None,
) -> DataFrame:
    """One gridded series.  The filters are on partition columns or pushed to Parquet;
    only columns used later are read."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.schema(CELLS_DDL).parquet(*paths)
    for name, want in (("variable", variable), ("model", model), ("scenario", scenario)):
        if want is not None:
            df = df.where(F.col(name) == want)
    df = select_years(df, begin, end)
    return df if level is None else select_level(df, level)


def combine_parts(*parts: DataFrame) -> DataFrame:
    """Parts of one series as one; a month and cell that several parts hold is kept
    once: the whole record with the greatest value (then the greatest other columns), so
    that the result does not depend on row order and no record is mixed from two.

    Months of a series that one part alone holds pass as they are: only those that
    several hold, found by counts per month, are shuffled.  There a keyed aggregate folds
    copies map-side, so a hot group of copies never meets in one task."""
    if len(parts) == 1:
        return _folded(parts[0])
    tagged = [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    months = [c for c in series_cols(whole) + time_cols(whole)]
    spread = whole.groupBy(*months).agg(F.min("_part").alias("_lo"), F.max("_part").alias("_hi")).where("_lo < _hi")
    marked = whole.drop("_part").withColumn("_k", F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in months]))
    several = spread.select(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in months]).alias("_k"))
    alone = marked.join(several, "_k", "left_anti").drop("_k")
    return alone.unionByName(_folded(marked.join(several, "_k", "left_semi").drop("_k")))


def _folded(whole: DataFrame) -> DataFrame:
    """One record per key: that of the greatest value."""
    keys = key_cols(whole)
    rest = [c for c in whole.columns if c not in keys and c != "value"]
    best = F.max(F.struct("value", *rest)).alias("_r")
    return whole.groupBy(*keys).agg(best).select(*keys, "_r.*").select(*whole.columns)


def scan_multi(spark: SparkSession, paths: list[str], **select) -> DataFrame:
    """Many tables of one series, overlapping months once.  Each path is a table of its own,
    partitioned or not; files of one table belong in one call of ``scan_series``."""
    return combine_parts(*[scan_series(spark, p, **select) for p in paths])


def scan_baseline(spark: SparkSession, path: str, variable: str | None = None) -> DataFrame:
    """Monthly climatology.  It is never repeated along the series: months meet by join."""
    df = spark.read.parquet(path)
    if variable is not None:
        df = df.where(F.col("variable") == variable)
    return drop_annual_member(df)


def drop_annual_member(df: DataFrame) -> DataFrame:
    """Leave out an annual layer numbered 13 or 14."""
    return df.where(F.col("month").between(1, 12))


def with_identity(df: DataFrame, **identity: str) -> DataFrame:
    """Constant identity columns (project, model, ...) for a series that lacks them."""
    return df.withColumns({k: F.lit(v) for k, v in identity.items()})


def stage_layer(df: DataFrame, layers: list[int]) -> DataFrame:
    """Chosen time indices of a series, counted from its first month."""
    from climgrid.operators.select import with_month_position

    return with_month_position(df).where(F.col("position").isin(*layers)).withColumnRenamed("position", "layer")
