"""Projections of an ellipsoid as column arithmetic, both ways (Snyder 1987, Map Projections:
A Working Manual): Albers equal-area conic (section 14), Lambert conformal conic (15) and polar
stereographic (21)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Albers:
    # The Alaska Albers projection on GRS80.
    lat_1: float = 55.0
    lat_2: float = 65.0
    lat_0: float = 50.0
    lon_0: float = -154.0
    a: float = 6378137.0
    inv_f: float = 298.257222101

    def _constants(self):
        f = 1 / self.inv_f
        e2 = f * (2 - f)
        e = math.sqrt(e2)

        def q(phi):
            s = math.sin(phi)
            return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

        def m(phi):
            return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

        p1, p2, p0 = (math.radians(v) for v in (self.lat_1, self.lat_2, self.lat_0))
        n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
        big_c = m(p1) ** 2 + n * q(p1)
        rho0 = self.a * math.sqrt(big_c - n * q(p0)) / n
        return e2, e, n, big_c, rho0

    def latitude(self, x: Column, y: Column) -> Column:
        """Latitude in degrees of projected coordinates in metres."""
        e2, e, n, big_c, rho0 = self._constants()
        rho = F.sqrt(x * x + (F.lit(rho0) - y) * (F.lit(rho0) - y))
        q = (F.lit(big_c) - rho * rho * (n * n / (self.a * self.a))) / n
        pole_q = 1 - (1 - e2) / (2 * e) * math.log((1 - e) / (1 + e))
        beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q / pole_q)))
        phi = (
            beta
            + F.sin(beta * 2) * (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040)
            + F.sin(beta * 4) * (23 * e2**2 / 360 + 251 * e2**3 / 3780)
            + F.sin(beta * 6) * (761 * e2**3 / 45360)
        )
        return F.degrees(phi)

    def longitude(self, x: Column, y: Column) -> Column:
        _, _, n, _, rho0 = self._constants()
        return F.degrees(F.atan2(x, F.lit(rho0) - y)) / n + self.lon_0

    def xy(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """Projected coordinates in metres of degrees."""
        e2, e, n, big_c, rho0 = self._constants()
        s = F.sin(F.radians(lat))
        q = (s / (1 - s * s * e2) - F.log((1 - s * e) / (1 + s * e)) / (2 * e)) * (1 - e2)
        rho = F.sqrt(F.greatest(F.lit(0.0), F.lit(big_c) - q * n)) * (self.a / n)
        # the shorter way round to the central meridian
        off = F.pmod(lon - self.lon_0 + 180, F.lit(360.0)) - 180
        theta = F.radians(off) * n
        return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)


def _isometric(e: float, phi: float) -> float:
    """tan(pi/4 - chi/2) of the conformal latitude chi."""
    s = e * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (e / 2)


def _isometric_column(e: float, phi: Column) -> Column:
    s = F.sin(phi) * e
    return F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(e / 2))


def _from_conformal(e2: float, t: Column) -> Column:
    """Latitude in radians of tan(pi/4 - chi/2), by the series of the conformal latitude."""
    chi = F.lit(math.pi / 2) - F.atan(t) * 2
    e4, e6, e8 = e2**2, e2**3, e2**4
    return (
        chi
        + F.sin(chi * 2) * (e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360)
        + F.sin(chi * 4) * (7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520)
        + F.sin(chi * 6) * (7 * e6 / 120 + 81 * e8 / 1120)
        + F.sin(chi * 8) * (4279 * e8 / 161280)
    )


def _off(lon: Column, lon_0: float) -> Column:
    """Degrees east of the central meridian, the shorter way round."""
    return F.pmod(lon - lon_0 + 180, F.lit(360.0)) - 180


@dataclass(frozen=True)
class LambertConformal:
    """Conic with one (``lat_1 == lat_2``) or two standard parallels."""

    lat_1: float
    lat_2: float
    lat_0: float
    lon_0: float
    x_0: float = 0.0
    y_0: float = 0.0
    a: float = 6378137.0
    inv_f: float = 298.257222101

    def _constants(self):
        f = 1 / self.inv_f
        e2 = f * (2 - f)
        e = math.sqrt(e2)
        m = lambda p: math.cos(p) / math.sqrt(1 - e2 * math.sin(p) ** 2)
        p1, p2, p0 = (math.radians(v) for v in (self.lat_1, self.lat_2, self.lat_0))
        t1, t2 = _isometric(e, p1), _isometric(e, p2)
        n = math.sin(p1) if abs(p1 - p2) < 1e-12 else (math.log(m(p1)) - math.log(m(p2))) / (math.log(t1) - math.log(t2))
        big_f = m(p1) / (n * t1**n)
        return e2, e, n, big_f, self.a * big_f * _isometric(e, p0) ** n

    def _polar(self, x: Column, y: Column) -> tuple[Column, Column]:
        _, _, n, big_f, rho0 = self._constants()
        dx, dy = (x - self.x_0) * math.copysign(1, n), (F.lit(rho0) - (y - self.y_0)) * math.copysign(1, n)
        t = F.pow(F.sqrt(dx * dx + dy * dy) / (self.a * abs(big_f)), F.lit(1 / abs(n)))
        return t if n > 0 else 1 / t, F.atan2(dx, dy)

    def latitude(self, x: Column, y: Column) -> Column:
        e2 = self._constants()[0]
        return F.degrees(_from_conformal(e2, self._polar(x, y)[0]))

    def longitude(self, x: Column, y: Column) -> Column:
        n = self._constants()[2]
        return F.degrees(self._polar(x, y)[1]) / n + self.lon_0

    def xy(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        _, e, n, big_f, rho0 = self._constants()
        rho = F.pow(_isometric_column(e, F.radians(lat)), F.lit(n)) * (self.a * big_f)
        theta = F.radians(_off(lon, self.lon_0)) * n
        return rho * F.sin(theta) + self.x_0, F.lit(rho0 + self.y_0) - rho * F.cos(theta)


@dataclass(frozen=True)
class PolarStereographic:
    """True to scale at ``lat_ts``; its sign chooses the pole."""

    lat_ts: float
    lon_0: float
    x_0: float = 0.0
    y_0: float = 0.0
    a: float = 6378137.0
    inv_f: float = 298.257223563

    def _constants(self):
        f = 1 / self.inv_f
        e2 = f * (2 - f)
        e, side = math.sqrt(e2), math.copysign(1.0, self.lat_ts)
        p = math.radians(abs(self.lat_ts))
        if abs(self.lat_ts) > 90 - 1e-9:
            scale = 2 * self.a / math.sqrt((1 + e) ** (1 + e) * (1 - e) ** (1 - e))
        else:
            scale = self.a * math.cos(p) / math.sqrt(1 - e2 * math.sin(p) ** 2) / _isometric(e, p)
        return e2, e, side, scale

    def latitude(self, x: Column, y: Column) -> Column:
        e2, _, side, scale = self._constants()
        dx, dy = x - self.x_0, y - self.y_0
        return F.degrees(_from_conformal(e2, F.sqrt(dx * dx + dy * dy) / scale)) * side

    def longitude(self, x: Column, y: Column) -> Column:
        side = self._constants()[2]
        return F.degrees(F.atan2((x - self.x_0) * side, (y - self.y_0) * -side)) * side + self.lon_0

    def xy(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        _, e, side, scale = self._constants()
        rho = _isometric_column(e, F.radians(lat * side)) * scale
        theta = F.radians(_off(lon, self.lon_0))
        return rho * F.sin(theta) + self.x_0, rho * F.cos(theta) * -side + self.y_0


# Parameters of registered projections.
PROJECTIONS: dict = {
    "EPSG:3338": Albers(),  # Alaska
    "EPSG:5070": Albers(29.5, 45.5, 23.0, -96.0),  # contiguous United States
    "EPSG:3347": LambertConformal(49.0, 77.0, 63.390675, -91.0 - 52.0 / 60, 6200000.0, 3000000.0),  # Canada
    "EPSG:3413": PolarStereographic(70.0, -45.0),  # sea ice, north
    "EPSG:3995": PolarStereographic(71.0, 0.0),  # Arctic
    "EPSG:3031": PolarStereographic(-71.0, 0.0),  # Antarctic
}


def register_projection(crs: str, projection) -> None:
    """Make a projection known by a name of its own, for grids with that ``crs``."""
    PROJECTIONS[crs] = projection



def lonlat(crs: str, x: Column, y: Column) -> tuple[Column, Column]:
    """Degrees of the coordinates of a grid."""
    if crs == "EPSG:4326":
        return x, y
    if crs not in PROJECTIONS:
        raise ValueError(f"no projection for {crs!r}; give the target columns lon and lat")
    return PROJECTIONS[crs].longitude(x, y), PROJECTIONS[crs].latitude(x, y)


def project(crs: str, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Coordinates of a grid of degrees."""
    if crs == "EPSG:4326":
        return lon, lat
    if crs not in PROJECTIONS:
        raise ValueError(f"no projection for {crs!r}")
    return PROJECTIONS[crs].xy(lon, lat)
