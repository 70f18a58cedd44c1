"""Freeze and thaw products on cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from climgrid.functions.freeze_thaw import with_freeze_thaw
from climgrid.operators.aggregate import decadal_monthly_any, month_vector
from climgrid.schema import SERIES, TIME, cell_cols, present, series_cols


def freeze_thaw(df: DataFrame, r_compat: bool = False) -> DataFrame:
    """dof, dot, grow and kase per series, year (or decade) and cell."""
    by = series_cols(df) + [c for c in ("year", "decade") if c in df.columns] + cell_cols(df)
    return with_freeze_thaw(month_vector(df, by), "months", r_compat).drop("months")


def freeze_thaw_decadal(df: DataFrame) -> DataFrame:
    """On decade means of each month; a cell without January gives NULL."""
    return freeze_thaw(decadal_monthly_any(df))


def freeze_thaw_split(df: DataFrame) -> DataFrame:
    """One row per product instead of three columns."""
    keep = [c for c in df.columns if c not in ("dof", "dot", "grow", "kase")]
    return df.select(*keep, F.expr("stack(3, 'dof', dof, 'dot', dot, 'logs', grow) as (product, value)"))


def freeze_thaw_diff(old: DataFrame, new: DataFrame, product: str = "dof") -> DataFrame:
    """new - old of one product; -9999 counts as missing on both sides."""
    keys = [c for c in present(old, SERIES + TIME + ("decade", "row", "col")) if c in new.columns]
    clean = lambda c: F.when(F.col(c) != -9999, F.col(c))
    a = old.select(*keys, clean(product).alias("_o"))
    b = new.select(*keys, clean(product).alias("_n"))
    return a.join(b, keys).select(*keys, (F.col("_n") - F.col("_o")).alias("diff"))
