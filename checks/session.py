"""Local session for checks, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def session(cpus: str | int = "*") -> SparkSession:
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("climgrid")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # a method over 8000 bytes is never JIT-compiled: let such stages use smaller ones
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="climgrid-checkpoint-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
