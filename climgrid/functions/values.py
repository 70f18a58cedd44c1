"""Units, nodata, rounding and clamping of single values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from climgrid.functions.calendar import month_days

# Nodata numbers met on disk, rounding places and model names.
NODATA = -9999.0
FLOAT_NODATA = 3.39999995e38
ROUND_PLACES = {"pr": 0, "pre": 0, "ppt": 0}
ROUND_DEFAULT = 1
DECADAL_PLACES = {"pr": 0, "clt": 1, "hurs": 1, "tas": 1, "tasmin": 1, "tasmax": 1, "vap": 4, "rsds": 4}
MODEL_NAMES = {"CCSM4": "NCAR-CCSM4", "cru_ts323": "CRU_TS323", "5MODELAVG": "5ModelAvg"}


def kelvin_to_celsius(x: Column) -> Column:
    return x - 273.15


def flux_to_monthly_mm(x: Column, month: Column) -> Column:
    """kg m-2 s-1 to mm per month on a no-leap calendar."""
    return x * 86400 * month_days(month)


def to_tenths(x: Column) -> Column:
    return F.rint(x * 10.0)


def from_tenths(x: Column) -> Column:
    return x / 10.0


def normalize_nodata(x: Column, sentinels=(NODATA,)) -> Column:
    """NULL for NaN, for the given nodata numbers and for anything of the size
    of the float32 nodata number."""
    bad = F.isnan(x) | (F.abs(x) >= FLOAT_NODATA * 0.999)
    for s in sentinels:
        bad = bad | (x == F.lit(float(s)))
    return F.when(~bad, x)


def inf_to_null(x: Column) -> Column:
    return F.when(F.abs(x) != F.lit(float("inf")), x)


def rint_places(x: Column, places: int) -> Column:
    """Half-even rounding to decimal places."""
    if places == 0:
        return F.rint(x)
    return F.rint(x * float(10**places)) / float(10**places)


def _by_variable(x: Column, variable, table: dict, default: int) -> Column:
    if isinstance(variable, str):
        return rint_places(x, table.get(variable, default))
    out = rint_places(x, default)
    for places in sorted(set(table.values()) - {default}):
        names = [k for k, v in table.items() if v == places]
        out = F.when(variable.isin(*names), rint_places(x, places)).otherwise(out)
    return out


def round_by_variable(x: Column, variable) -> Column:
    """Precipitation to whole numbers, everything else to one decimal.
    ``variable`` is a name or a column of names."""
    return _by_variable(x, variable, ROUND_PLACES, ROUND_DEFAULT)


def round_decadal(x: Column, variable) -> Column:
    return _by_variable(x, variable, DECADAL_PLACES, ROUND_DEFAULT)


def clamp_humidity(x: Column, cap: float = 95.0) -> Column:
    """Below 0 becomes 0, above 100 becomes ``cap``."""
    return F.when(x < 0, F.lit(0.0)).when(x > 100, F.lit(float(cap))).otherwise(x)


def clamp_cloud(x: Column) -> Column:
    return F.when(x < 0, F.lit(0.0)).when(x > 100, F.lit(100.0)).otherwise(x)


def clamp_legacy(x: Column) -> Column:
    """Only values between 100 and 500 are pulled to 95."""
    return F.when((x > 100) & (x < 500), F.lit(95.0)).otherwise(x)


def sunshine_to_cloud(sunshine: Column) -> Column:
    return rint_places(100 - sunshine, 1)


def rename_model(model: Column) -> Column:
    out = model
    for old, new in MODEL_NAMES.items():
        out = F.when(model == old, F.lit(new)).otherwise(out)
    return out
