"""Polygons, zones, points and windows of a grid.

Polygons come as an edge table: zone_id, x1, y1, x2, y2.  Rasterising is a scan
along grid rows: each edge yields the rows it crosses and where, crossings pair up
into spans, spans yield cells.  The work is edges times rows plus cells inside;
cells and polygons are never compared all with all.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window, functions as F

from climgrid.functions.projection import project
from climgrid.grid import Grid
from climgrid.schema import CELL, SERIES, TIME, present, shared
from climgrid.storage import cut_lineage, join_dealt

FEW_CELLS = 100_000  # cells with points; Spark may collect so many for a broadcast (a few MB)


def ring_edges(polygons: DataFrame) -> DataFrame:
    """Edges of closed rings; ``ring`` is ARRAY<STRUCT<x, y>>, first point repeated last."""
    keep = [c for c in polygons.columns if c != "ring"]
    i = F.explode(F.sequence(F.lit(0), F.size("ring") - 2)).alias("i")
    at = lambda k: F.get(F.col("ring"), k)
    e = polygons.select(*keep, "ring", i)
    return e.select(
        *keep,
        at(F.col("i"))["x"].alias("x1"),
        at(F.col("i"))["y"].alias("y1"),
        at(F.col("i") + 1)["x"].alias("x2"),
        at(F.col("i") + 1)["y"].alias("y2"),
    )


def _rows_between(grid: Grid, y_top, y_bottom, reach: int):
    lo = F.greatest(F.lit(0), F.floor(grid.fy(y_top)).cast("int") - reach + 1)
    hi = F.least(F.lit(grid.ny - 1), F.floor(grid.fy(y_bottom)).cast("int") + reach)
    return F.explode(F.when(lo <= hi, F.sequence(lo, hi)))


def rasterize_zones(edges: DataFrame, grid: Grid, all_touched: bool = False) -> DataFrame:
    """Cells of each zone: (zone_id, row, col) where the centre is inside, and with
    ``all_touched`` also where the outline passes through the cell."""
    y1, y2, py = F.col("y1"), F.col("y2"), grid.y("row")
    rows = _rows_between(grid, F.greatest("y1", "y2"), F.least("y1", "y2"), 1)
    hits = (
        edges.select("zone_id", "x1", "y1", "x2", "y2", rows.alias("row"))
        .where((y1 > py) != (y2 > py))
        .select("zone_id", "row", (F.col("x1") + (py - y1) * (F.col("x2") - F.col("x1")) / (y2 - y1)).alias("xc"))
    )
    w = Window.partitionBy("zone_id", "row").orderBy("xc")
    spans = hits.select(
        "zone_id", "row", "xc", F.lead("xc").over(w).alias("xe"), F.row_number().over(w).alias("k")
    ).where((F.col("k") % 2 == 1) & F.col("xe").isNotNull())
    lo = F.greatest(F.lit(0), F.floor(grid.fx("xc")).cast("int"))
    hi = F.least(F.lit(grid.nx - 1), F.ceil(grid.fx("xe")).cast("int"))
    px = grid.x("col")
    inside = (
        spans.select("zone_id", "row", "xc", "xe", F.explode(F.when(lo <= hi, F.sequence(lo, hi))).alias("col"))
        .where((px >= F.col("xc")) & (px < F.col("xe")))
        .select("zone_id", "row", "col")
    )
    if not all_touched:
        return inside
    return inside.unionByName(_outline_cells(edges, grid)).distinct()


def _outline_cells(edges: DataFrame, grid: Grid) -> DataFrame:
    """Cells that an edge passes through: the edge is cut at the row borders, and each
    piece covers the columns between its two ends."""
    top, bottom = F.greatest("y1", "y2"), F.least("y1", "y2")
    first = F.greatest(F.lit(0), grid.row_of(top))
    last = F.least(F.lit(grid.ny - 1), grid.row_of(bottom))
    pieces = edges.withColumn("row", F.explode(F.when(first <= last, F.sequence(first, last))))
    y_hi = F.least(top, F.lit(grid.y0) - F.col("row") * F.lit(grid.dy))
    y_lo = F.greatest(bottom, F.lit(grid.y0) - (F.col("row") + 1) * F.lit(grid.dy))
    flat = F.col("y1") == F.col("y2")
    at = lambda y: F.col("x1") + F.try_divide((y - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1"))
    a = F.when(flat, F.col("x1")).otherwise(at(y_hi))
    b = F.when(flat, F.col("x2")).otherwise(at(y_lo))
    open_grid = replace(grid, cyclic=False)
    c0 = F.greatest(F.lit(0), open_grid.col_of(F.least(a, b)))
    c1 = F.least(F.lit(grid.nx - 1), open_grid.col_of(F.greatest(a, b)))
    return pieces.select("zone_id", "row", F.explode(F.when(c0 <= c1, F.sequence(c0, c1))).alias("col"))


def rasterize_polygon(edges: DataFrame, grid: Grid, all_touched: bool = False) -> DataFrame:
    """Mask of all given polygons: (row, col, inside = 1)."""
    return rasterize_zones(edges, grid, all_touched).select("row", "col").distinct().withColumn("inside", F.lit(1))


def join_zone(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Cells with the zones they lie in, by equi-join on the rasterised zones."""
    keys = shared(df, zones, CELL)
    return df.join(zones, keys)


def mask_intersect_nodata(zones: DataFrame, cells: DataFrame) -> DataFrame:
    """Zone cells that hold data."""
    keys = shared(zones, cells, CELL)
    valid = cells.where(F.col("value").isNotNull()).select(*keys).distinct()
    return zones.join(valid, keys, "left_semi")


def mask_to_extent(mask: DataFrame, grid: Grid) -> DataFrame:
    """Bounding box of the true cells per zone, at the outer cell edges."""
    g = mask.where(F.col("inside") == 1).groupBy(*present(mask, ("zone_id",))).agg(
        F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1")
    )
    return g.select(
        *present(mask, ("zone_id",)),
        (F.lit(grid.x0) + F.col("c0") * grid.dx).alias("xmin"),
        (F.lit(grid.y0) - (F.col("r1") + 1) * grid.dy).alias("ymin"),
        (F.lit(grid.x0) + (F.col("c1") + 1) * grid.dx).alias("xmax"),
        (F.lit(grid.y0) - F.col("r0") * grid.dy).alias("ymax"),
    )


def crop_to_bounds(
    df: DataFrame, grid: Grid, xmin: float, ymin: float, xmax: float, ymax: float, pad: int = 0
) -> tuple[DataFrame, Grid]:
    """Cells whose centre lies in a box, grown by ``pad`` cells, counted from its corner."""
    sub, r0, c0 = grid.window(xmin, ymin, xmax, ymax, pad)
    kept = df.where(F.col("row").between(r0, r0 + sub.ny - 1) & F.col("col").between(c0, c0 + sub.nx - 1))
    return kept.withColumns({"row": F.col("row") - r0, "col": F.col("col") - c0}), sub


def crop_to_polygon(df: DataFrame, edges: DataFrame, grid: Grid, all_touched: bool = False) -> DataFrame:
    """Cells inside a polygon, counted from the corner of its bounding box.  The corner
    is a scalar subquery; no data reaches the driver."""
    mask = rasterize_polygon(edges, grid, all_touched).drop("inside")
    r0, c0 = mask.select(F.min("row")).scalar(), mask.select(F.min("col")).scalar()
    out = df.join(mask, ["row", "col"], "left_semi")
    return out.withColumns({"row": F.col("row") - r0, "col": F.col("col") - c0})


def point_cells(points: DataFrame, grid: Grid) -> DataFrame:
    """Row and column of named points (name, lat, lon), NULL beyond the grid; a projected
    grid is reached by its ``crs``."""
    x, y = project(grid.crs, F.col("lon"), F.col("lat"))
    here = points.withColumns({"row": grid.row_of(y), "col": grid.col_of(x)})
    return here.withColumns({c: F.when(grid.holds(), F.col(c)) for c in ("row", "col")})
def point_profile(df: DataFrame, points: DataFrame, grid: Grid, columns: list[str] | None = None) -> DataFrame:
    """Time series at points, one column per model_scenario_variable.

    Only cells that hold a point go on; they are made wide first, so a cell with very
    many points is widened once and each point then takes its finished row.  Both sides are
    dealt by cells; only a few cells (not their values) may pass through the driver.
    ``columns`` names the wanted columns: only those series are read on, and Spark needs
    no pass to find them.  A point beyond the grid, or on a cell without data, keeps one
    row with NULL for the time and all columns.
    """
    # points beyond the grid get rows beyond it: as NULL all of them would be dealt to one task
    beyond = (-1 - F.pmod(F.xxhash64("name", "lat", "lon"), F.lit(10_000))).cast("int")
    placed = point_cells(points, grid).select(
        "name", F.coalesce("row", beyond).alias("row"), F.coalesce("col", F.lit(-1)).alias("col")
    )
    # stored: each condition on row and col would repeat the long expression of a projection
    at = cut_lineage(placed)
    held = cut_lineage(at.where(grid.holds()).select("row", "col").distinct())
    name = F.concat_ws("_", *[F.col(c) for c in ("model", "scenario", "variable") if c in df.columns])
    series = df if columns is None else df.where(name.isin(*columns))
    if held.count() <= FEW_CELLS:
        hit = series.join(held, ["row", "col"], "left_semi")
    else:
        hit = join_dealt(series, held, ["row", "col"], "left_semi", cells=grid.nx * grid.ny)
    hit = hit.withColumn("_series", name)
    by = hit.groupBy("row", "col", *present(df, TIME))
    if columns is None:
        wide = by.pivot("_series").agg(F.avg("value"))
    else:
        wide = by.agg(*[F.avg(F.when(F.col("_series") == c, F.col("value"))).alias(c) for c in columns])
    return join_dealt(at, wide, ["row", "col"], "left").drop("row", "col")


def resample_to_template(df, template: DataFrame, src_grid: Grid, dst_grid: Grid, variable) -> DataFrame:
    """Nearest source value on the template's cells, masked and rounded by variable.
    ``template`` holds row, col and inside."""
    from climgrid.functions.values import round_by_variable
    from climgrid.operators.regrid import regrid

    out = regrid(df, template, src_grid, dst_grid, "nearest")
    value = F.when(F.col("inside") == 1, round_by_variable(F.col("value"), variable))
    return out.withColumn("value", value).drop("inside")


def crop_resample(df: DataFrame, edges: DataFrame, src_grid: Grid, dst_grid: Grid) -> DataFrame:
    """Nearest source value on the cells of a coarser grid that a polygon touches."""
    from climgrid.operators.regrid import regrid

    target = rasterize_polygon(edges, dst_grid, all_touched=True).drop("inside")
    return regrid(df, target, src_grid, dst_grid, "nearest")
