"""Identity of series from file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _stem(name: Column) -> Column:
    base = F.element_at(F.split(name, "/"), -1)
    return F.regexp_replace(base, r"\.[A-Za-z0-9]+$", "")


def catalog_parse(files: DataFrame, name: str = "name") -> DataFrame:
    """``variable_metric_units[_project]_model_scenario_MM_YYYY`` as columns; the short
    form has no project.  A part that is no number is NULL, so foreign names show by a NULL
    month or year and end no job."""
    p = F.split(_stem(F.col(name)), "_")
    whole = F.size(p) == 8
    back = lambda k: F.try_element_at(p, F.lit(-k))
    return files.withColumns(
        {
            "variable": F.get(p, F.lit(0)),
            "metric": F.get(p, F.lit(1)),
            "units": F.get(p, F.lit(2)),
            "project": F.when(whole, F.get(p, F.lit(3))),
            "model": back(4),
            "scenario": back(3),
            "month": back(2).try_cast("int"),
            "year": back(1).try_cast("int"),
        }
    )


def catalog_parse_raw(files: DataFrame, name: str = "name") -> DataFrame:
    """``variable_table_model_scenario_experiment_YYYYMM-YYYYMM`` as columns."""
    p = F.split(_stem(F.col(name)), "_")
    at = lambda k: F.get(p, F.lit(k))
    span = at(5)
    return files.withColumns(
        {
            "variable": at(0),
            "cmor_table": at(1),
            "model": at(2),
            "scenario": at(3),
            "experiment": at(4),
            "begin_year": F.substring(span, 1, 4).try_cast("int"),
            "begin_month": F.substring(span, 5, 2).try_cast("int"),
            "end_year": F.substring(span, 8, 4).try_cast("int"),
            "end_month": F.substring(span, 12, 2).try_cast("int"),
        }
    )


def catalog_sort(catalog: DataFrame) -> DataFrame:
    """Time order: a range-partitioned sort, not a single task."""
    return catalog.orderBy("year", "month", "name")


def catalog_years(catalog: DataFrame, begin: int, end: int) -> DataFrame:
    return catalog.where(F.col("year").between(begin, end))


def catalog_year_span(raw: DataFrame) -> DataFrame:
    """First and last month of each series over all its files."""
    return raw.groupBy("variable", "model", "scenario").agg(
        F.min(F.col("begin_year") * 100 + F.col("begin_month")).alias("begin"),
        F.max(F.col("end_year") * 100 + F.col("end_month")).alias("end"),
        F.count(F.lit(1)).alias("files"),
    )


def catalog_latest_version(catalog: DataFrame, dataset: list[str], version: str = "version") -> DataFrame:
    """Rows of the newest ``vNNNN`` of each dataset.  The newest version is a map-side
    max, so a dataset with very many files is not ranked in one task."""
    number = F.regexp_extract(version, r"(\d+)$", 1).try_cast("long")
    newest = catalog.groupBy(*dataset).agg(F.max(number).alias("_v"))
    return catalog.join(newest, dataset).where(number == F.col("_v")).drop("_v")


def historical_future_pairs(catalog: DataFrame) -> DataFrame:
    """Each scenario file with the historical file of its model and variable."""
    past = catalog.where(F.col("scenario") == "historical").select(
        "variable", "model", F.col("name").alias("historical_name")
    )
    later = catalog.where(F.col("scenario") != "historical").select(
        "variable", "model", "scenario", F.col("name").alias("future_name")
    )
    return later.join(past, ["variable", "model"])


def anti_derived(catalog: DataFrame, name: str = "name") -> DataFrame:
    """Leave out anomaly files and annual members."""
    return catalog.where(~F.col(name).contains("_anom")).where(F.col("month").between(1, 12))


def output_name() -> Column:
    """File name of a timestep from its identity columns."""
    month = F.lpad(F.col("month").cast("string"), 2, "0")
    return F.concat_ws("_", "variable", "metric", "units", "project", "model", "scenario", month, F.col("year").cast("string"))
