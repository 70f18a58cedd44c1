"""Column conventions of the long ``cells`` layout.

One row is one (series, year, month, cell).  Row 0 is the northernmost row.
Missing data is NULL, never NaN or a nodata number.  Grids and levels of one table are
told apart by ``grid_id`` and ``level`` where it has those columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SERIES = ("project", "model", "scenario", "variable")
TIME = ("year", "month")
PLANE = ("grid_id", "level")  # what a slice belongs to besides series and time
CELL = PLANE + ("row", "col")

CELLS_DDL = (
    "project string, model string, scenario string, variable string, "
    "metric string, units string, level double, year int, month int, "
    "grid_id string, row int, col int, lat double, lon double, value double"
)


def present(df: DataFrame, names) -> list[str]:
    """The names that are columns of ``df``, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def series_cols(df: DataFrame) -> list[str]:
    return present(df, SERIES)


def time_cols(df: DataFrame) -> list[str]:
    return present(df, TIME)


def cell_cols(df: DataFrame) -> list[str]:
    return present(df, CELL)


def key_cols(df: DataFrame) -> list[str]:
    """Series, time and cell columns: the identity of one value."""
    return series_cols(df) + time_cols(df) + cell_cols(df)


def slice_cols(df: DataFrame) -> list[str]:
    """Series, time, grid and level: the columns that name one slice of cells."""
    return present(df, SERIES + TIME + PLANE)


def shared(left: DataFrame, right: DataFrame, names) -> list[str]:
    """The names that both sides carry: the natural join key among ``names``."""
    return [n for n in present(left, names) if n in right.columns]


def month_index(year, month) -> Column:
    """Months since year 0: orders (year, month) as one integer."""
    return F.col(year) * 12 + F.col(month) - 1 if isinstance(year, str) else year * 12 + month - 1
