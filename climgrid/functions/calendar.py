"""Calendar keys from year, month and day of year."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Days per month of a year without leap day, and the season of each month.
NO_LEAP_DAYS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
SEASONS = {"DJF": (12, 1, 2), "MAM": (3, 4, 5), "JJA": (6, 7, 8), "SON": (9, 10, 11)}


def month_days(month: Column) -> Column:
    """Days in a month, February always 28."""
    return F.element_at(F.array(*[F.lit(d) for d in NO_LEAP_DAYS]), month.cast("int"))


def first_day_of_year(month: int) -> int:
    """Day of year on which a month starts (1-based, no leap day)."""
    return sum(NO_LEAP_DAYS[: month - 1]) + 1


def month_of_day(doy: Column) -> Column:
    """Month that holds a day of year (1-365)."""
    month = F.lit(12)
    for m in range(11, 0, -1):
        month = F.when(doy < first_day_of_year(m + 1), m).otherwise(month)
    return month


def mean_day_of_month(month: Column) -> Column:
    """Mean day of year of the days of a month."""
    return F.element_at(
        F.array(*[F.lit(first_day_of_year(m) + (NO_LEAP_DAYS[m - 1] - 1) / 2.0) for m in range(1, 13)]),
        month.cast("int"),
    )


def season(month: Column) -> Column:
    out = F.lit("DJF")
    for name in ("MAM", "JJA", "SON"):
        out = F.when(month.isin(*SEASONS[name]), name).otherwise(out)
    return out


def season_year(year: Column, month: Column) -> Column:
    """December belongs to the winter of the following year."""
    return year + F.when(month == 12, 1).otherwise(0)


def decade_start(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def decade(year: Column) -> Column:
    """Decade label such as ``1990s``."""
    return F.concat(decade_start(year).cast("string"), F.lit("s"))


def pad_month(month: Column) -> Column:
    """Two-digit month text."""
    return F.lpad(month.cast("string"), 2, "0")
