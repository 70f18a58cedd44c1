"""Linear filling of missing cells between valid ones.

``fill_gaps`` has two methods: ``axes``, along rows and columns, by windows alone; and
``triangles``, on the Delaunay triangles of the valid cells (see ``operators.triangles``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from climgrid.grid import Grid
from climgrid.operators.triangles import fill_gaps_triangles, regrid_points_triangles
from climgrid.schema import slice_cols
from climgrid.storage import dealt_by, join_dealt


def _bracket(df: DataFrame, by: list[str], line: str, pos: str, tag: str, around: int | None = None) -> DataFrame:
    """Nearest valid position and value on both sides, along one grid line.  A
    window holds one line of one timestep, so it is no larger than the grid is
    wide or high.  ``around``: the line closes after so many positions."""
    w = Window.partitionBy(*by, line).orderBy(pos)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    back = w.rowsBetween(Window.unboundedPreceding, -1)
    # looking ahead is looking back along the line turned round: a frame that runs on from each
    # row to the end would be read anew for each row
    ahead = Window.partitionBy(*by, line).orderBy(F.col(pos).desc()).rowsBetween(Window.unboundedPreceding, -1)
    known = lambda move=0: F.when(F.col("value").isNotNull(), F.struct((F.col(pos) + move).alias("p"), F.col("value").alias("v")))
    before, after = F.last(known(), ignorenulls=True).over(back), F.last(known(), ignorenulls=True).over(ahead)
    if around:
        before = F.coalesce(before, F.last(known(-around), ignorenulls=True).over(whole))
        after = F.coalesce(after, F.first(known(around), ignorenulls=True).over(whole))
    return df.withColumns({f"_{tag}0": before, f"_{tag}1": after})


def _estimate(pos: str, tag: str) -> tuple[Column, Column]:
    a, b = F.col(f"_{tag}0"), F.col(f"_{tag}1")
    span = b["p"] - a["p"]
    value = a["v"] + (b["v"] - a["v"]) * (F.col(pos) - a["p"]) / span
    return value, F.lit(1.0) / span


def fill_gaps_linear(df: DataFrame, grid: Grid | None = None) -> DataFrame:
    """Fill NULL cells that lie between valid cells of their row, their column or both.

    Each axis gives the straight line between its two bracketing cells; where both
    do, they are averaged with weight one over the distance of the bracketing
    cells.  A cell without a bracket on either axis stays NULL, so nothing is
    extrapolated.  Valid cells are not touched.  With ``grid``, cells that a timestep
    does not hold are added and filled too, and rows of a cyclic grid close at the seam;
    columns other than series, time, grid, level and value are left out then.
    """
    by = slice_cols(df)
    whole = df if grid is None else complete_cells(df, grid)
    out = _bracket(whole, by, "row", "col", "x", grid.nx if grid is not None and grid.cyclic else None)
    out = _bracket(out, by, "col", "row", "y")
    (vx, wx), (vy, wy) = _estimate("col", "x"), _estimate("row", "y")
    both = (vx * wx + vy * wy) / (wx + wy)
    filled = F.coalesce(F.col("value"), both, vx, vy)
    return out.withColumn("value", filled).drop("_x0", "_x1", "_y0", "_y1")


FILL_METHODS = ("axes", "triangles")


def fill_gaps(df: DataFrame, grid: Grid, method: str = "axes", absent: bool = True) -> DataFrame:
    """Missing cells by one of ``FILL_METHODS``.  ``absent``: also cells that a timestep does
    not hold (triangles always fill those)."""
    if method not in FILL_METHODS:
        raise ValueError(f"method must be one of {FILL_METHODS}, not {method!r}")
    if method == "triangles":
        return fill_gaps_triangles(df, grid)
    return fill_gaps_linear(df, grid if absent else None)


def frame(df: DataFrame, by: list[str], rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """Every row and column of the ranges (ends included) for each slice of ``df``.  Slices
    are few, so their rows are dealt over all tasks before columns are spread."""
    slices = df.select(*by).distinct() if by else df.select(F.lit(0).alias("_one")).distinct()
    spread = slices.withColumn("row", F.explode(F.sequence(F.lit(rows[0]), F.lit(rows[1]))))
    return dealt_by(spread, *by, "row").withColumn("col", F.explode(F.sequence(F.lit(cols[0]), F.lit(cols[1])))).drop("_one")


def complete_cells(df: DataFrame, grid: Grid) -> DataFrame:
    """Add a NULL row for each cell of the grid that a timestep does not hold."""
    by = slice_cols(df)
    all_cells = frame(df, by, (0, grid.ny - 1), (0, grid.nx - 1))
    return join_dealt(all_cells, df.select(*by, "row", "col", "value"), by + ["row", "col"], "left")


def regrid_points(points: DataFrame, grid: Grid, method: str = "axes") -> DataFrame:
    """Scattered points onto a regular grid.  ``axes``: the mean of the points of each cell,
    then gaps filled.  ``triangles``: linear interpolation of the points themselves.

    ``points`` holds lat, lon, value and any series or time columns.
    """
    if method not in FILL_METHODS:
        raise ValueError(f"method must be one of {FILL_METHODS}, not {method!r}")
    if method == "triangles":
        return regrid_points_triangles(points, grid)
    by = slice_cols(points)
    binned = (
        points.withColumns({"row": grid.row_of("lat"), "col": grid.col_of("lon")})
        .where(grid.holds())
        .groupBy(*by, "row", "col")
        .agg(F.avg("value").alias("value"))
    )
    return fill_gaps_linear(complete_cells(binned, grid))
