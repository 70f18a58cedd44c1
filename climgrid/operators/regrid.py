"""Resampling from a source grid onto target cells.

Each target cell works out, by arithmetic, the source cell its kernel is anchored
to.  The source side gathers the values of every anchor's neighbourhood into one
row (a *stencil*): a shuffle of the small, coarse side only.  Source and target
then meet in a single equi-join on the anchor, and the weighted mean is plain
column arithmetic on the joined row.  The fine side is never exploded by kernel
size nor aggregated.
"""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window, functions as F

from climgrid.functions.projection import lonlat
from climgrid.grid import Grid, denoise
from climgrid.operators.gaps import frame
from climgrid.schema import slice_cols
from climgrid.storage import cut_lineage, dealt_by, join_dealt

REGRID_METHODS = ("nearest", "bilinear", "cubic", "cubic_spline", "lanczos", "average", "mode")
_SPAN = {"bilinear": (0, 1), "cubic": (-1, 2), "cubic_spline": (-1, 2), "lanczos": (-2, 3)}


def _weight(method: str, t: str, k: int) -> str:
    """SQL of the weight of the source cell ``k`` cells after the anchor, for a target
    ``t`` (0..1) of a cell past the anchor."""
    if method == "bilinear":
        return f"1D - {t}" if k == 0 else t
    return _kernel(method, f"abs({t} - {k}D)")


def _kernel(method: str, d: str) -> str:
    """SQL of a kernel at distance ``d`` in cells."""
    if method == "bilinear":
        return f"greatest(0D, 1D - {d})"
    if method == "cubic":
        near, far = f"(1.5D * {d} - 2.5D) * {d} * {d} + 1D", f"((2.5D - 0.5D * {d}) * {d} - 4D) * {d} + 2D"
    elif method == "cubic_spline":
        near, far = f"(0.5D * {d} - 1D) * {d} * {d} + 2D / 3D", f"(2D - {d}) * (2D - {d}) * (2D - {d}) / 6D"
    else:
        sinc = f"3D * sin(pi() * {d}) * sin(pi() * {d} / 3D) / (pi() * pi() * {d} * {d})"
        return f"CASE WHEN {d} < 1e-9D THEN 1D WHEN {d} < 3D THEN {sinc} ELSE 0D END"
    return f"CASE WHEN {d} <= 1D THEN {near} WHEN {d} < 2D THEN {far} ELSE 0D END"


NOWHERE = -9  # row of the anchors of target cells that lie beyond the source grid
SPREAD = 64  # such anchors of a slice, so that no key is that of all those cells


def _source(src: DataFrame, grid: Grid) -> tuple[DataFrame, list[str]]:
    """Cells of the source grid, where the table tells grids apart, and the slice keys."""
    here = src.where(F.col("grid_id") == grid.grid_id).drop("grid_id") if "grid_id" in src.columns else src
    return here, slice_cols(here)


def _read_once(src: DataFrame, grid: Grid) -> DataFrame:
    """The source's cells from storage: its timesteps and its values are read apart, and what
    makes the series (sums, climatologies) would run for each."""
    here, keys = _source(src, grid)
    return cut_lineage(here.select(*keys, "row", "col", "value"))


def _anchors(src: DataFrame, keys: list[str], rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """All anchors of each slice, and those of nowhere: with them every target cell is met."""
    all_anchors = frame(src, keys, rows, cols).unionByName(frame(src, keys, (NOWHERE, NOWHERE), (0, SPREAD - 1)))
    return all_anchors.withColumnsRenamed({"row": "r0", "col": "c0"})


def _anchored(target: DataFrame, r0: Column, c0: Column, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    inside = r0.between(*rows) & c0.between(*cols)
    any_of = F.pmod(F.xxhash64("row", "col"), F.lit(SPREAD))
    return target.withColumns({"r0": F.when(inside, r0).otherwise(NOWHERE).cast("int"), "c0": F.when(inside, c0).otherwise(any_of).cast("int")})


def stencils(src: DataFrame, grid: Grid, method: str, nowhere: int = 1) -> DataFrame:
    """One row per slice and anchor with the values around the anchor, 0 where
    there is none, and the bits of ``_seen`` telling which are there.

    Every slice is made whole, with NULL where it has no cell and a margin as wide as the
    kernel, so that a place of the neighbourhood is so many rows of a window away: first
    along the row, then along the column.  Source values are never multiplied by the kernel
    size, and no task holds more than grid lines.  Anchors that nothing serves have a row
    too, so that target cells without a source value around them are kept; ``nowhere``: how
    many anchors there are for those beyond the grid.
    """
    lo, hi = _SPAN[method]
    span = range(lo, hi + 1)
    places = [(i, j) for i in span for j in span]
    src, keys = _source(src, grid)
    (r0, r1), (c0, c1) = _reach(grid, lo, hi)
    rows, cols = (r0 + lo, r1 + hi), (c0 + lo, c1 + hi)
    cells = src.where(F.col("value").isNotNull() & F.col("row").between(*rows)).select(*keys, "row", "col", "value")
    if grid.cyclic:  # columns of the margin are those of the other side
        first = F.lit(cols[0]) + F.pmod(F.col("col") - cols[0], F.lit(grid.nx))
        cells = cells.withColumn("col", F.explode(F.sequence(first, F.lit(cols[1]), F.lit(grid.nx))))
    cells = cells.where(F.col("col").between(*cols)).unionByName(frame(src, keys, rows, cols), allowMissingColumns=True)
    many = grid.nx * grid.ny
    whole = dealt_by(cells, *keys, "row", cells=many).groupBy(*keys, "row", "col").agg(F.max("value").alias("value"))
    along, across = Window.partitionBy(*keys, "row").orderBy("col"), Window.partitionBy(*keys, "col").orderBy("row")
    lines = whole.select(*keys, "row", "col", *[F.lead("value", j).over(along).alias(f"_x{j - lo}") for j in span])
    lines = dealt_by(lines.where(F.col("col").between(c0, c1)), *keys, "col", cells=many)
    gathered = lines.select(
        *keys, F.col("row").alias("r0"), F.col("col").alias("c0"),
        *[F.lead(f"_x{j - lo}", i).over(across).alias(_place(i, j)) for i, j in places],
    ).where(F.col("r0").between(r0, r1))
    beyond = frame(src, keys, (NOWHERE, NOWHERE), (0, nowhere - 1)).withColumnsRenamed({"row": "r0", "col": "c0"})
    gathered = gathered.unionByName(beyond, allowMissingColumns=True)
    seen = " + ".join(f"CASE WHEN {_place(i, j)} IS NOT NULL THEN {1 << k}L ELSE 0L END" for k, (i, j) in enumerate(places))
    filled = [f"coalesce({_place(i, j)}, 0D) AS {_place(i, j)}" for i, j in places]
    return gathered.selectExpr(*keys, "r0", "c0", f"{seen} AS _seen", *filled)


def _reach(grid: Grid, lo: int, hi: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """Rows and columns of the anchors that a cell of the grid can serve."""
    return (-hi, grid.ny - 1 - lo), (0, grid.nx - 1) if grid.cyclic else (-hi, grid.nx - 1 - lo)


def _place(i: int, j: int) -> str:
    return f"_v{i + 2}{j + 2}"


def _weighted_mean(places: list[tuple[int, int]], lo: int) -> Column:
    """Sum of w*v over sum of w, over the source values that are there.

    All inputs are non-NULL columns (absent values are 0 and marked in ``_seen``), so
    the generated code is short arithmetic even for 36 places.
    """
    w = [f"_wy{i - lo} * _wx{j - lo}" for i, j in places]
    num = " + ".join(f"{w[k]} * {_place(i, j)}" for k, (i, j) in enumerate(places))
    den = " + ".join(f"{w[k]} * CAST((shiftright(_seen, {k}) & 1) AS DOUBLE)" for k in range(len(places)))
    return F.expr(f"CASE WHEN {den} > 1e-6D THEN ({num}) / ({den}) END")


def target_lonlat(target: DataFrame, dst_grid: Grid) -> tuple[Column, Column]:
    """Longitude and latitude of target cells: its columns ``lon`` and ``lat`` where it has
    them, else by the projection of its grid."""
    if {"lon", "lat"} <= set(target.columns):
        return F.col("lon"), F.col("lat")
    return lonlat(dst_grid.crs, dst_grid.x("col"), dst_grid.y("row"))


def regrid(
    src: DataFrame,
    target: DataFrame,
    src_grid: Grid,
    dst_grid: Grid,
    method: str = "bilinear",
    on: tuple[str, ...] = (),
    widen: bool = True,
) -> DataFrame:
    """Source values on target cells.

    Where the target is coarser along an axis, the kernel is as wide as the target's cells
    there, so that every source cell has its say (``widen``; not for targets of another
    projection or given by longitudes and latitudes).

    ``target`` holds ``row``, ``col`` of the target grid and any other columns,
    which are kept; a projected grid is found by its ``crs``, any other by the columns
    ``lon`` and ``lat`` of its cells.  ``on`` names further equi-join keys (``("month",)``
    joins a monthly baseline in the same step).  Every target cell is returned for every
    timestep of the source, NULL where no source value is around it or those there weigh
    (almost) nothing together.  Both sides may be large: Spark picks broadcast or
    shuffle by size, and the number of target cells per anchor is fixed by the
    ratio of the grids, so anchors carry even loads.
    """
    if method in ("average", "mode"):
        return _regrid_area(src, target, src_grid, dst_grid, method, on)
    if method not in REGRID_METHODS:
        raise ValueError(f"method must be one of {REGRID_METHODS}, not {method!r}")
    if widen and method != "nearest" and _coarser(src_grid, dst_grid, target):
        return _regrid_wide(src, target, src_grid, dst_grid, method, on)
    lon, lat = target_lonlat(target, dst_grid)
    fx, fy = src_grid.fx(lon), src_grid.fy(lat)
    target = target.drop("grid_id")
    src, many = _read_once(src, src_grid), dst_grid.nx * dst_grid.ny
    keys = ["r0", "c0", *on]
    if method == "nearest":
        placed = _anchored(target, F.floor(fy + 0.5), src_grid.wrap(F.floor(fx + 0.5)), *_reach(src_grid, 0, 0))
        return join_dealt(_by_anchor(src, src_grid, src), placed, keys, cells=many).drop("r0", "c0")
    # the weights are columns of the target, made before it is joined with the time axis
    lo, hi = _SPAN[method]
    places = [(i, j) for i in range(lo, hi + 1) for j in range(lo, hi + 1)]
    weights = {f"_w{t}{k - lo}": F.expr(_weight(method, f"_t{t}", k)) for t in "yx" for k in range(lo, hi + 1)}
    placed = target.withColumns({"_fy": fy, "_fx": fx})
    placed = _anchored(placed, F.floor("_fy"), src_grid.wrap(F.floor("_fx")), *_reach(src_grid, lo, hi))
    placed = placed.withColumns({"_ty": denoise(F.col("_fy") - F.floor("_fy")), "_tx": denoise(F.col("_fx") - F.floor("_fx"))})
    placed = placed.withColumns(weights).drop("_ty", "_tx", "_fy", "_fx")
    joined = join_dealt(stencils(src, src_grid, method, SPREAD), placed, keys, cells=many)
    out = joined.withColumn("value", _weighted_mean(places, lo))
    return out.drop("r0", "c0", "_seen", *weights, *[_place(i, j) for i, j in places])


def _by_anchor(src: DataFrame, grid: Grid, cells: DataFrame) -> DataFrame:
    """Each anchor of each slice of ``src`` with the value that ``cells`` hold for it, or NULL."""
    rows, cols = _reach(grid, 0, 0)
    _, by = _source(src, grid)
    cells = cells.select(*by, F.col("row").alias("r0"), F.col("col").alias("c0"), "value")
    return join_dealt(_anchors(src, by, rows, cols), cells, [*by, "r0", "c0"], "left")


def to_parent(df: DataFrame, src_grid: Grid, dst_grid: Grid) -> DataFrame:
    """Replace row and column by those of the ``dst_grid`` cell that holds the centre."""
    row = dst_grid.row_of(src_grid.y("row"))
    col = dst_grid.col_of(src_grid.x("col"))
    return df.withColumns({"row": row, "col": col}).where(dst_grid.holds())


def _overlaps(start: Column, size: float, n: int, period: float | None) -> Column:
    """Target cells of one axis that an interval meets, with the length of the overlap (in
    target cells): an array of ``(at, w)``.  ``start`` and ``size`` are in target cells; with a
    ``period`` the axis closes after so many."""

    def meets(begin: Column) -> Column:
        # an overlap of less than a billionth of a cell is noise
        lo = F.greatest(F.lit(0), F.floor(begin + 1e-9)).cast("int")
        hi = F.least(F.lit(n - 1), F.ceil(begin + size - 1e-9) - 1).cast("int")
        each = lambda k: F.struct(
            k.alias("at"), (F.least(begin + size, k + F.lit(1.0)) - F.greatest(begin, k.cast("double"))).alias("w")
        )
        none = F.array().cast("array<struct<at:int,w:double>>")
        return F.when(lo <= hi, F.transform(F.sequence(lo, hi), each)).otherwise(none)

    if period is None:
        return meets(start)
    return F.flatten(F.array(*[meets(start + k * period) for k in (-2, -1, 0, 1, 2)]))


def overlap_weights(src: DataFrame, src_grid: Grid, dst_grid: Grid) -> DataFrame:
    """Each source value with every target cell it overlaps, and the shared area ``w`` in
    target cells.  The two axes are independent, so a weight is the product of two lengths;
    on cyclic grids columns meet round the globe."""
    period = 360.0 / dst_grid.dx if src_grid.cyclic or dst_grid.cyclic else None
    x = (F.lit(src_grid.x0 - dst_grid.x0) + F.col("col") * F.lit(src_grid.dx)) / dst_grid.dx
    y = (F.lit(dst_grid.y0 - src_grid.y0) + F.col("row") * F.lit(src_grid.dy)) / dst_grid.dy
    rows = _overlaps(y, src_grid.dy / dst_grid.dy, dst_grid.ny, None)
    cols = _overlaps(x, src_grid.dx / dst_grid.dx, dst_grid.nx, period)
    met = src.withColumns({"_r": rows, "_c": cols}).withColumn("_r", F.explode("_r")).withColumn("_c", F.explode("_c"))
    w = F.col("_r.w") * F.col("_c.w")
    return met.withColumns({"row": F.col("_r.at"), "col": F.col("_c.at"), "w": w}).drop("_r", "_c")


def _same_axes(src_grid: Grid, dst_grid: Grid, target: DataFrame) -> bool:
    return src_grid.crs == dst_grid.crs and not {"lon", "lat"} <= set(target.columns)


def _coarser(src_grid: Grid, dst_grid: Grid, target: DataFrame) -> bool:
    wider = dst_grid.dx > src_grid.dx * (1 + 1e-9) or dst_grid.dy > src_grid.dy * (1 + 1e-9)
    return wider and _same_axes(src_grid, dst_grid, target)


def _served(place: Column, ratio: float, method: str, n: int, period: float | None) -> Column:
    """Target cells of one axis that a source cell serves, with their weights: an array of
    ``(at, w)``.  ``place``: the source cell's centre in target cells, 0 on the centre of the
    first; ``ratio``: the size of a target cell in source cells."""
    reach = {"bilinear": 1, "cubic": 2, "cubic_spline": 2, "lanczos": 3}[method] * max(1.0, 1 / ratio)
    scale = min(1.0, ratio)  # distances count in the larger of both cells

    def serves(at: Column) -> Column:
        lo = F.greatest(F.lit(0), F.ceil(at - reach + 1e-9)).cast("int")
        hi = F.least(F.lit(n - 1), F.floor(at + reach - 1e-9)).cast("int")
        none = F.array().cast("array<struct<at:int,d:double>>")
        each = lambda k: F.struct(k.alias("at"), denoise(F.abs(k - at) * scale).alias("d"))
        return F.when(lo <= hi, F.transform(F.sequence(lo, hi), each)).otherwise(none)

    if period is None:
        return serves(place)
    return F.flatten(F.array(*[serves(place + k * period) for k in (-2, -1, 0, 1, 2)]))


def _regrid_wide(src, target, src_grid, dst_grid, method, on):
    """Kernels for a coarser target: each source cell is sent, with its weight, to the few
    targets it serves, and sums fold map-side.  On a cyclic grid the kernel goes round the globe."""
    src, keys = _source(src, src_grid)
    period = 360.0 / dst_grid.dx if src_grid.cyclic or dst_grid.cyclic else None
    rx, ry = dst_grid.dx / src_grid.dx, dst_grid.dy / src_grid.dy
    rows = _served(dst_grid.fy(src_grid.y("row")), ry, method, dst_grid.ny, None)
    cols = _served(dst_grid.fx(src_grid.x("col")), rx, method, dst_grid.nx, period)
    met = src.where(F.col("value").isNotNull()).withColumns({"_r": rows, "_c": cols})
    met = met.withColumn("_r", F.explode("_r")).withColumn("_c", F.explode("_c"))
    weight = f"({_kernel(method, '_r.d')}) * ({_kernel(method, '_c.d')})"
    met = met.select(*keys, F.col("_r.at").alias("row"), F.col("_c.at").alias("col"), "value", F.expr(weight).alias("_w"))
    folded = met.groupBy(*keys, "row", "col").agg(F.sum(F.col("value") * F.col("_w")).alias("_n"), F.sum("_w").alias("_d"))
    mean = F.when(F.col("_d") > 1e-6, F.col("_n") / F.col("_d"))
    whole = frame(src, keys, (0, dst_grid.ny - 1), (0, dst_grid.nx - 1))
    whole = join_dealt(whole, folded.select(*keys, "row", "col", mean.alias("value")), [*keys, "row", "col"], "left")
    return join_dealt(whole, target.drop("grid_id"), ["row", "col", *on])


def _first_last(begin, ratio: float, down=F.floor, up=F.ceil):
    """First and last source cell of one axis that a target cell meets.  ``begin``: where it
    begins, ``ratio``: its size, both in source cells; an overlap of less than a billionth of a
    target cell is noise."""
    return down(begin + 1e-9 * ratio), up(begin + ratio - 1e-9 * ratio) - 1


def _one_source_cell(src_grid: Grid, dst_grid: Grid, target: DataFrame) -> tuple[Column, Column, Column, bool] | None:
    """For a target no coarser along either axis: row and column of the source cell that a
    target cell begins in, whether it lies in that cell alone, and whether all cells do."""
    rx, ry = dst_grid.dx / src_grid.dx, dst_grid.dy / src_grid.dy
    if not _same_axes(src_grid, dst_grid, target) or _coarser(src_grid, dst_grid, target) or dst_grid.cyclic and not src_grid.cyclic:
        return None
    x0, y0 = (dst_grid.x0 - src_grid.x0) / src_grid.dx, (src_grid.y0 - dst_grid.y0) / src_grid.dy
    (c0, c1), (r0, r1) = _first_last(F.lit(x0) + F.col("col") * rx, rx), _first_last(F.lit(y0) + F.col("row") * ry, ry)
    alone = lambda start, ratio, n: all(len({*_first_last(start + k * ratio, ratio, floor, ceil)}) == 1 for k in range(n))
    return r0, src_grid.wrap(c0), (r0 == r1) & (c0 == c1), alone(x0, rx, dst_grid.nx) and alone(y0, ry, dst_grid.ny)


def _regrid_area(src, target, src_grid, dst_grid, method, on):
    """Area-weighted mean, or the value that covers the largest area (of equal ones the
    smaller), of the source cells that a target cell overlaps, at any ratio of the grids.

    Sums fold map-side, so a coarser target shuffles about one row a target cell and task.
    Cells of a finer target that lie in one source cell take its value by an equi-join, as with
    ``nearest``; only those across the edge of source cells are added up.
    Where the target is given by longitudes and latitudes or another projection, source
    cells cannot be cut by its edges: those count whose centre it holds.
    """
    src, keys = _source(src, src_grid)
    target, inside = target.drop("grid_id"), F.col("row").between(0, dst_grid.ny - 1) & F.col("col").between(0, dst_grid.nx - 1)
    one, rest = _one_source_cell(src_grid, dst_grid, target), F.lit(True)
    if one is not None:
        r0, c0, alone, all_alone = one
        rest, src = ~alone, _read_once(src, src_grid)
        valid = src.where("value IS NOT NULL AND row IS NOT NULL AND col IS NOT NULL")
        served = _area(valid.withColumn("w", F.lit(1.0)), keys, method)
        placed = target.where(inside & alone).withColumns({"row": F.col("row").cast("int"), "col": F.col("col").cast("int")})
        placed = _anchored(placed, r0, c0, *_reach(src_grid, 0, 0))
        out = join_dealt(_by_anchor(src, src_grid, served), placed, ["r0", "c0", *on], cells=dst_grid.nx * dst_grid.ny)
        order = ["row", "col", *on, *[k for k in keys if k not in on], "value"]
        out = out.select(*order, *[c for c in target.columns if c not in order])
        if all_alone:
            return out
    else:
        valid = src.where(F.col("value").isNotNull())
    if _same_axes(src_grid, dst_grid, target):
        met = overlap_weights(valid, src_grid, dst_grid).where(rest)
    else:
        met = to_parent(valid, src_grid, dst_grid).withColumn("w", F.lit(1.0))
    whole = frame(src, keys, (0, dst_grid.ny - 1), (0, dst_grid.nx - 1)).where(rest)
    whole = join_dealt(whole, _area(met, keys, method), [*keys, "row", "col"], "left")
    shared_cells = join_dealt(whole, target, ["row", "col", *on])
    return shared_cells if one is None else out.unionByName(shared_cells)


def _area(met: DataFrame, keys: list[str], method: str) -> DataFrame:
    """Mean by ``w``, or the value of the greatest ``w`` (of equal ones the smaller), of each cell."""
    if method == "average":
        mean = F.sum(F.col("value") * F.col("w")) / F.sum("w")
        return met.groupBy(*keys, "row", "col").agg(mean.alias("value"))
    counted = met.groupBy(*keys, "row", "col", "value").agg(F.sum("w").alias("n"))
    # the greatest area first, then the smaller value
    best = F.max_by("value", F.struct(denoise(F.col("n")), -F.col("value")))
    return counted.groupBy(*keys, "row", "col").agg(best.alias("value"))
