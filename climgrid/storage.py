"""Where intermediate results live: the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid
from math import ceil

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, or a folder of its warehouse where none is set:
    both are seen by the driver and all executors."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work").rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a written table."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a work folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


CELLS_A_TASK = 10_000  # cells of a grid, with all their timesteps


def dealt_by(df: DataFrame, *keys: str, cells: int = 0) -> DataFrame:
    """Rows dealt by their keys over all shuffle partitions: for groups of few bytes that
    stand for much work, which Spark would otherwise merge into one task.  ``cells``: of the
    grid that the rows lie on; a larger grid is dealt over more tasks, so that what a task
    holds and sorts does not grow with it."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(parts, ceil(cells / CELLS_A_TASK)), *keys)


def join_dealt(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", cells: int = 0) -> DataFrame:
    """An equi-join for which both sides are dealt by their keys, never collected for a broadcast.

    Spark expects a table to be of the size of its compressed columns, and knows nothing of
    rows that a plan spreads (a baseline over twelve months, anchors over timesteps): it would
    pass tables of a gigabyte through the driver as small ones.  ``cells``: of the grid of the
    result, whose tasks then grow with it; only for keys that no many rows share."""
    if cells:
        left, right = (dealt_by(side, *keys, cells=cells) for side in (left, right))
    return left.join(right.hint("merge"), keys, how)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet and go on from there: the plan stays short, what comes
    before runs once, a lost executor costs no recomputation of it, and later steps read
    the columns they need."""
    path = work_folder(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
