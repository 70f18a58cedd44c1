"""Writers."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from climgrid.functions.values import rint_places
from climgrid.schema import present
from climgrid.storage import remove_folder, work_folder

LAYOUT = ("variable", "model", "scenario", "year")


TILE_BITS = 16  # of a tile's row and of its column


def tile_key(tile: int) -> Column:
    """Number of the square of ``tile`` by ``tile`` cells that holds a cell, along a Z-shaped
    curve: the bits of its row and column in turn, so that squares near each other on the grid
    are near each other in order."""
    spread = lambda c, shift: sum(
        (F.shiftleft(F.shiftright(F.floor(F.col(c) / tile).cast("long"), b).bitwiseAND(1), 2 * b + shift) for b in range(TILE_BITS)), F.lit(0)
    )
    return spread("row", 1) + spread("col", 0)


def sink_tiles(df: DataFrame, path: str, tile: int = 64, group_bytes: int = 8 << 20, files: int | None = None, mode: str = "overwrite", layout=LAYOUT) -> None:
    """As ``sink_grid``, with the cells of a year in the order of their tiles: rows are dealt by
    ranges of folder and tile and sorted so, and row groups are small.  The least and
    greatest row and column of each then lie close together, so a crop, a polygon or a
    point reads the few row groups it needs.  ``files``: ranges in all (default: the session's
    shuffle partitions)."""
    parts = present(df, layout)
    keys = [*[F.col(p) for p in parts], tile_key(tile)]
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inside = present(df, ("month",))
    laid = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys, *inside, "row", "col")
    out = laid.write.mode(mode).option("parquet.block.size", group_bytes)
    (out.partitionBy(*parts) if parts else out).parquet(path)


def sink_grid(df: DataFrame, path: str, mode: str = "overwrite", layout=LAYOUT) -> None:
    """Partitioned Parquet.  ``rebalance`` lets AQE size the files: small partitions are
    merged and a partition that holds most of the rows is split over many tasks."""
    parts = present(df, layout)
    out = df.hint("rebalance", *[F.col(p) for p in parts]) if parts else df
    out.write.mode(mode).partitionBy(*parts).parquet(path)


def sink_prepped(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """The prepared series; an existing target is an error unless ``overwrite``."""
    sink_grid(df, path, "overwrite" if overwrite else "errorifexists")


BUCKET_KEYS = ("month", "row", "col")


def sink_bucketed(df: DataFrame, path: str, buckets: int, keys: tuple[str, ...] = BUCKET_KEYS) -> DataFrame:
    """Parquet in buckets of cells and calendar months, sorted: tables that are laid out alike
    meet on these keys (and more) without a shuffle, month after month.  Returns the table;
    ``scan_bucketed`` reads it again."""
    name = _bucket_table(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    laid = df.repartition(buckets, *keys)  # a file a bucket
    laid.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def scan_bucketed(spark: SparkSession, path: str, schema: str, buckets: int, keys: tuple[str, ...] = BUCKET_KEYS) -> DataFrame:
    """A table of ``sink_bucketed``, in any session; Spark must be told how it is laid out."""
    name, by = _bucket_table(path), ", ".join(keys)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def _bucket_table(path: str) -> str:
    return f"bucketed_{hashlib.sha1(path.encode()).hexdigest()[:16]}"


def sink_with_anomaly(df: DataFrame, path: str, anomaly_path: str | None = None, anomaly: str = "anomaly") -> None:
    """The refined grid and, if wanted, its resampled anomaly.

    Both are columns of one row, so the result is computed once: it is written with
    the anomaly to a shared folder and the two products are cut from there.
    """
    if anomaly_path is None:
        sink_grid(df.drop(anomaly), path)
        return
    spark = df.sparkSession
    both = work_folder(spark, "refined")
    sink_grid(df, both)
    stored, parts = spark.read.parquet(both), present(df, LAYOUT)
    # the stored copy is laid out already: both products keep its files
    for product, to in ((stored.drop(anomaly), path), (stored.drop("value").withColumnRenamed(anomaly, "value"), anomaly_path)):
        product.write.mode("overwrite").partitionBy(*parts).parquet(to)
    remove_folder(spark, both)


def summary_nested(summary: DataFrame, series: list[str], metrics: list[str]) -> DataFrame:
    """Series -> month -> metrics as one MAP column; at most twelve entries a series."""
    once = summary.groupBy(*series, "month").agg(F.max(F.struct(*metrics)).alias("_m"))
    entry = F.struct(F.lpad(F.col("month").cast("string"), 2, "0"), F.col("_m"))
    return once.groupBy(*series).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("months"))


def sink_summary_json(summary: DataFrame, path: str, series: list[str], metrics: list[str]) -> None:
    summary_nested(summary, series, metrics).write.mode("overwrite").json(path)


def summary_wide(summary: DataFrame, series: list[str], metric: str) -> DataFrame:
    """One row per series, months 01-12 as columns; precipitation as whole numbers,
    the rest as text with one decimal."""
    v = F.col(metric)
    text = F.format_string("%2.1f", rint_places(v, 1))
    if "variable" in summary.columns:
        whole = F.format_string("%.0f", F.rint(v))
        text = F.when(F.col("variable").isin("pr", "pre"), whole).otherwise(text)
    months = [
        F.max(F.when(F.col("month") == m, F.when(v.isNotNull(), text))).alias(f"{m:02d}") for m in range(1, 13)
    ]
    return summary.groupBy(*series).agg(*months)


def sink_summary_csv(summary: DataFrame, path: str, series: list[str], metrics: list[str]) -> None:
    """One folder of CSV per metric."""
    for metric in metrics:
        summary_wide(summary, series, metric).write.mode("overwrite").csv(f"{path}/{metric}", header=True)
