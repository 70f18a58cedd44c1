"""Written intermediate tables in the shared work folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from climgrid.storage import work_folder


_made: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: made once, read by column, and
    safe from lost executors."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    _made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def under_share(key: Column, rows: Column, most: Column) -> Column:
    """True for about twice ``most`` of ``rows`` rows, those of smallest hashed key, and for
    all where they are no more: what a bounded sample is then picked from, so that no task
    has to hand on a whole sample of its own."""
    share = F.least(F.lit(1.0), (most * 2 + 100) / F.greatest(rows, F.lit(1)))
    return (share >= 1) | (F.xxhash64(key) < (F.least(share, F.lit(0.999)) * 2.0**64 - 2.0**63).cast("long"))


def smallest_hashed(df: DataFrame, key: str, most: int, *order: str) -> DataFrame:
    """At most ``most`` rows, those of smallest hashed ``key``; ties go by ``order``."""
    few = df.where(under_share(F.col(key), F.lit(df.count()), F.lit(most)))
    return few.orderBy(F.xxhash64(key), key, *order).limit(most)


def one_a_task(files: DataFrame) -> DataFrame:
    """The rows, a partition each: small rows that stand for much work, such as files to read.
    (Dealt by a key they would be merged again, for they are few bytes.)"""
    turn = F.row_number().over(Window.orderBy(*files.columns)) - 1
    return files.withColumn("_turn", turn).repartitionById(max(1, files.count()), F.col("_turn")).drop("_turn")


def meet(rows: DataFrame, folded: DataFrame, key: str) -> DataFrame:
    """Rows with the one row of their (long) key.  The join is on the key's complement, so
    that the folded side is dealt anew: only then can Spark split the rows of a very
    common key."""
    mate = F.bitwise_not(key).alias("mate")
    return rows.select("*", mate).join(folded.select(mate, *[c for c in folded.columns if c != key]), "mate").drop("mate")


def release(spark: SparkSession, since: int = 0) -> None:
    """Remove the tables written after the first ``since`` of this process: for a caller
    that has stored all results which still read them."""
    while len(_made) > since:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def mark() -> int:
    return len(_made)


def open_folder(folder: str):
    """The file system of a folder, for use inside tasks, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def folder_made(folder: str) -> None:
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
