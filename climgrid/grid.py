"""Geometry of a regular grid: a few numbers, kept on the driver.

A grid is metadata, like the affine transform of a raster.  Everything per cell
is derived from it by column arithmetic, so no table of cells is ever joined
just to learn a coordinate.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, functions as F


def denoise(c: Column) -> Column:
    """Remove float noise below 1e-9 of a cell, so a point that lies on a cell
    centre or edge is not pushed to the wrong side of it."""
    return F.rint(c * 1e9) / 1e9


@dataclass(frozen=True)
class Grid:
    """``x0``/``y0`` is the upper left corner; ``dy`` is positive downwards."""

    nx: int
    ny: int
    x0: float
    y0: float
    dx: float
    dy: float
    cyclic: bool = False
    grid_id: str = "grid"
    crs: str = "EPSG:4326"

    @classmethod
    def global_latlon(cls, nx: int, ny: int, grid_id: str = "grid", x0: float = 0.0) -> "Grid":
        return cls(nx, ny, float(x0), 90.0, 360.0 / nx, 180.0 / ny, True, grid_id)

    def x(self, col="col") -> Column:
        """Centre x (longitude) of a column index."""
        return F.lit(self.x0) + (_c(col) + 0.5) * F.lit(self.dx)

    def y(self, row="row") -> Column:
        """Centre y (latitude) of a row index."""
        return F.lit(self.y0) - (_c(row) + 0.5) * F.lit(self.dy)

    def fx(self, x) -> Column:
        """Fractional column of an x, 0 on the centre of column 0."""
        return denoise((_c(x) - F.lit(self.x0)) / F.lit(self.dx) - 0.5)

    def fy(self, y) -> Column:
        """Fractional row of a y, 0 on the centre of row 0."""
        return denoise((F.lit(self.y0) - _c(y)) / F.lit(self.dy) - 0.5)

    def wrap(self, col: Column) -> Column:
        """Column index folded round the globe on a cyclic grid."""
        return F.pmod(col, F.lit(self.nx)) if self.cyclic else col

    def col_of(self, x) -> Column:
        """Index of the column that contains an x."""
        return self.wrap(F.floor(self.fx(x) + 0.5).cast("int"))

    def row_of(self, y) -> Column:
        """Index of the row that contains a y."""
        return F.floor(self.fy(y) + 0.5).cast("int")

    def holds(self, row="row", col="col") -> Column:
        return _c(row).between(0, self.ny - 1) & _c(col).between(0, self.nx - 1)

    def window(self, xmin: float, ymin: float, xmax: float, ymax: float, pad: int = 0) -> tuple["Grid", int, int]:
        """The sub-grid whose cell centres lie in a box (grown by ``pad`` cells),
        with the row and column offset of its corner."""
        import math

        c0 = max(0, math.ceil((xmin - self.x0) / self.dx - 0.5 - 1e-9) - pad)
        c1 = min(self.nx - 1, math.floor((xmax - self.x0) / self.dx - 0.5 + 1e-9) + pad)
        r0 = max(0, math.ceil((self.y0 - ymax) / self.dy - 0.5 - 1e-9) - pad)
        r1 = min(self.ny - 1, math.floor((self.y0 - ymin) / self.dy - 0.5 + 1e-9) + pad)
        sub = replace(
            self,
            nx=max(0, c1 - c0 + 1),
            ny=max(0, r1 - r0 + 1),
            x0=self.x0 + c0 * self.dx,
            y0=self.y0 - r0 * self.dy,
            cyclic=False,
        )
        return sub, r0, c0


def _c(v) -> Column:
    return F.col(v) if isinstance(v, str) else v
