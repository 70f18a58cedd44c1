"""Solar radiation and day length from latitude, day of year and cloud."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Fixed values of the published formulas.
SOLAR_CONSTANT_DAILY = 0.082  # MJ m-2 min-1
CLEAR, CLOUDED = 0.251, 0.509
BEAM_CONSTANT = 1368.0 * 3600.0 / 41860.0


def declination(day: Column) -> Column:
    return F.sin(day * (2 * math.pi / 365) - 1.39) * 0.409


def sunset_angle(day: Column, lat_rad: Column) -> Column:
    """Sunset hour angle; 0 where the sun never rises, pi where it never sets."""
    a = -F.tan(declination(day)) * F.tan(lat_rad)
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), a)))


def extraterrestrial_radiation(day: Column, lat_rad: Column) -> Column:
    """Radiation at the top of the atmosphere, MJ m-2 per day (Allen et al. 1998)."""
    dec, w = declination(day), sunset_angle(day, lat_rad)
    distance = F.cos(day * (2 * math.pi / 365)) * 0.033 + 1.0
    beam = w * F.sin(lat_rad) * F.sin(dec) + F.cos(lat_rad) * F.cos(dec) * F.sin(w)
    return distance * beam * (24 * 60 / math.pi * SOLAR_CONSTANT_DAILY)


def day_length(day: Column, lat_rad: Column) -> Column:
    """Hours between sunrise and sunset."""
    return sunset_angle(day, lat_rad) * (24 / math.pi)


def surface_radiation(ra: Column, cloud: Column) -> Column:
    return ra * (CLEAR + CLOUDED * (1.0 - cloud / 100.0))


def surface_radiation_guarded(ra: Column, cloud: Column) -> Column:
    """NULL where the cloud value is a missing-data number (at most -0.1)."""
    return F.when(cloud > -0.1, surface_radiation(ra, cloud))


def par(nirr: Column, cloud: Column) -> Column:
    """Photosynthetically active radiation."""
    return F.when(cloud > -0.1, nirr * (cloud * 0.2 / 100.0 + 0.45))


def cloud_from_radiation(girr: Column, nirr: Column) -> Column:
    """Cloud percentage that explains the loss from ``girr`` to ``nirr``."""
    cloud = (1.0 - (F.try_divide(nirr, girr) - 0.23) / 0.48) * 100.0
    return F.when(nirr >= girr * 0.71, F.lit(0.0)).otherwise(F.least(cloud, F.lit(100.0)))


def gross_radiation_day(day: Column, lat_rad: Column) -> Column:
    """Sum over 24 hours of the positive direct beam on a day of the year."""
    pi = math.pi
    dec = F.cos((day + 10.0) * (2 * pi) / 365.25) * -23.4856 * (pi / 180.0)
    distance = F.lit(1.0) - F.cos((day - 4.0) * 0.9856 * (pi / 180.0)) * 0.016729
    up, side = F.sin(lat_rad) * F.sin(dec), F.cos(lat_rad) * F.cos(dec)
    total = F.lit(0.0)
    for hour in range(1, 25):
        total = total + F.greatest(up + side * math.cos((hour - 12) * pi / 12.0), F.lit(0.0))
    return total * BEAM_CONSTANT / (distance * distance)
