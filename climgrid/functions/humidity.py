"""Vapour pressure and relative humidity."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from climgrid.functions.values import clamp_humidity, rint_places


def saturation_vp(t: Column) -> Column:
    """Saturation vapour pressure (hPa) over water at ``t`` degrees C."""
    return F.exp(t * 17.62 / (t + 243.12)) * 6.112


def vapor_pressure(t: Column, rh: Column, places: int | None = 2) -> Column:
    vp = rh * saturation_vp(t) / 100.0
    return vp if places is None else rint_places(vp, places)


def relative_humidity(t: Column, vap: Column, cap: float = 95.0) -> Column:
    return clamp_humidity(vap / saturation_vp(t) * 100.0, cap)
