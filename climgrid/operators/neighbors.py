"""Cell neighbourhoods: boundaries, fills and mosaics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from climgrid.grid import Grid
from climgrid.schema import PLANE, SERIES, TIME, present, shared, slice_cols
from climgrid.storage import cut_lineage, dealt_by

ROOK = ((-1, 0), (0, -1), (0, 1), (1, 0))
QUEEN = ROOK + ((-1, -1), (-1, 1), (1, -1), (1, 1))


def _around(df: DataFrame, steps, keep: list[str], grid: Grid | None = None) -> DataFrame:
    """One row per neighbour position of each cell, as ``nrow``, ``ncol``; round the globe
    on a cyclic ``grid``."""
    wrap = grid.wrap if grid is not None else lambda c: c
    o = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps]))
    return df.select(*keep, "row", "col", o.alias("o")).select(
        *keep,
        "row",
        "col",
        (F.col("row") + F.col("o.i")).alias("nrow"),
        wrap(F.col("col") + F.col("o.j")).alias("ncol"),
    )


def join_neighbors(df: DataFrame, steps=QUEEN, grid: Grid | None = None) -> DataFrame:
    """Each cell with the value of each neighbour that has one."""
    by = slice_cols(df)
    values = df.where(F.col("value").isNotNull()).select(
        *by, F.col("row").alias("nrow"), F.col("col").alias("ncol"), F.col("value").alias("nvalue")
    )
    return _around(df, steps, by, grid).join(values, by + ["nrow", "ncol"])


def neighbor_mean(cells: DataFrame, holes: DataFrame, steps=QUEEN, grid: Grid | None = None) -> DataFrame:
    """Mean of the valid neighbours of each hole.

    Only the holes ask: the exploded side has eight rows per missing cell, not per
    cell, and the fixed fan-in of eight keeps every group small.
    """
    by = slice_cols(cells)
    values = cells.where(F.col("value").isNotNull()).select(
        *by, F.col("row").alias("nrow"), F.col("col").alias("ncol"), F.col("value").alias("nvalue")
    )
    asked = _around(holes, steps, by, grid).join(values, by + ["nrow", "ncol"])
    return asked.groupBy(*by, "row", "col").agg(F.avg("nvalue").alias("fill"))


def fill_mask_neighbors(df: DataFrame, mask: DataFrame, grid: Grid | None = None) -> DataFrame:
    """Missing cells inside the mask take the mean of their valid queen neighbours;
    data outside the mask becomes missing.  All cells are filled at once from the
    values as given."""
    by = slice_cols(df)
    keys = shared(df, mask, ("grid_id", "row", "col"))
    flagged = df.join(mask.select(*keys, "inside"), keys, "left")
    holes = flagged.where((F.col("inside") == 1) & F.col("value").isNull())
    fills = neighbor_mean(df, holes, grid=grid)
    value = F.when(F.col("inside") == 1, F.coalesce("value", "fill"))
    return flagged.join(fills, by + ["row", "col"], "left").withColumn("value", value).drop("fill", "inside")


def fill_negative_neighbors(df: DataFrame, mask: DataFrame, grid: Grid | None = None) -> DataFrame:
    """Negative cells inside the mask take the mean of their non-negative queen
    neighbours, or 0 where there is none."""
    by = slice_cols(df)
    keys = shared(df, mask, ("grid_id", "row", "col"))
    flagged = df.join(mask.select(*keys, "inside"), keys, "left")
    bad = (F.col("inside") == 1) & (F.col("value") < 0)
    fills = neighbor_mean(df.where(F.col("value") >= 0), flagged.where(bad), grid=grid)
    value = F.when(bad, F.coalesce("fill", F.lit(0.0))).otherwise(F.col("value"))
    return flagged.join(fills, by + ["row", "col"], "left").withColumn("value", value).drop("fill", "inside")


TILE = 64  # cells of a tile's side, and rings that it runs by itself


def _rings(tile: int, by: list[str]):
    """``tile`` rings of the queen fill on one tile, from its cells and those within a tile's
    width around it: as far as a ring's work can travel in so many rings, so the tile's own
    cells come out as they would on the whole grid."""

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        first = cells.iloc[0]
        r0, c0 = (int(first["trow"]) - 1) * tile, (int(first["tcol"]) - 1) * tile
        wide = 3 * tile + 2
        value, open_ = np.full((wide, wide), np.nan), np.zeros((wide, wide), bool)
        r, c = cells["row"].to_numpy() - r0 + 1, cells["ncol"].to_numpy() - c0 + 1
        v = cells["value"].to_numpy(float)
        value[r, c], open_[r, c] = v, np.isnan(v)
        own = np.zeros((wide, wide), bool)
        own[tile + 1 : 2 * tile + 1, tile + 1 : 2 * tile + 1] = True
        start = open_ & own
        for _ in range(tile):
            there = ~np.isnan(value)
            total, count = np.zeros_like(value), np.zeros(value.shape, int)
            known = np.where(there, value, 0.0)
            for i, j in QUEEN:
                total += np.roll(known, (i, j), (0, 1))
                count += np.roll(there, (i, j), (0, 1))
            new = open_ & (count > 0)
            if not new.any():
                break
            value[new] = np.trunc(total[new] / count[new])
            open_ &= ~new
        rows, cols = np.nonzero(start)
        out = pd.DataFrame({"row": rows + r0 - 1, "col": cols + c0 - 1, "value": value[rows, cols]})
        for k in by:
            out[k] = first[k]
        return out

    return run


def fill_mask_iterative(df: DataFrame, mask: DataFrame, grid: Grid | None = None, tile: int = TILE) -> DataFrame:
    """Repeat the queen fill inside the mask, with means cut to whole numbers,
    until a round fills nothing; cells that nothing reaches stay NULL.

    Tiles that have holes run ``tile`` rings by themselves, on their cells and those of the
    tiles around, and then hand on what they filled: a lake of any depth takes as many jobs
    as it is tiles deep.  A round reads and writes only the holes that are left and their rim,
    the valid cells beside them; what it fills is added to a stored table and met with the
    rest once, at the end.  All of it lies in the shared folder, so it survives the loss of
    executors.
    """
    spark, names, by = df.sparkSession, df.columns, slice_cols(df)
    place = by + ["row", "col"]
    keys = shared(df, mask, ("grid_id", "row", "col"))
    around = grid.nx if grid is not None and grid.cyclic else None
    tile = min(tile, around) if around else tile
    flagged = df.join(mask.select(*keys, "inside"), keys, "left").where(F.col("inside") == 1)
    inside = cut_lineage(flagged.select(*place, F.col("value").cast("double").alias("value")))
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inside.schema if f.name in by)
    schema = "row int, col int, value double" + (f", {shape}" if by else "")
    holes = inside.where(F.col("value").isNull()).select(*place)
    valid, done = inside.where(F.col("value").isNotNull()), []
    while not holes.isEmpty():
        near = _around(holes, QUEEN, by, grid).select(*by, F.col("nrow").alias("row"), F.col("ncol").alias("col")).distinct()
        # null-safe keys: a series column may be missing
        rim = valid.join(near, _same(valid, near, place), "left_semi")
        cells = rim.unionByName(holes.withColumn("value", F.lit(None).cast("double")))
        turns = F.explode(F.array(*[F.col("col") + k for k in ((-around, 0, around) if around else (0,))]))
        steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
        sent = cells.withColumn("ncol", turns).withColumn("o", steps)
        at = lambda c: F.floor(F.col(c) / tile).cast("int")
        sent = sent.withColumns({"trow": at("row") + F.col("o.i"), "tcol": at("ncol") + F.col("o.j")}).drop("o")
        asks = holes.select(*by, at("row").alias("trow"), at("col").alias("tcol")).distinct()
        sent = sent.join(asks, _same(sent, asks, [*by, "trow", "tcol"]), "left_semi")
        ran = cut_lineage(dealt_by(sent, *by, "trow", "tcol").groupBy(*by, "trow", "tcol").applyInPandas(_rings(tile, by), schema).select(*place, "value"))
        new = ran.where(F.col("value").isNotNull())
        if new.isEmpty():
            break
        done.append(new)
        holes, valid = ran.where(F.col("value").isNull()).select(*place), rim.unionByName(new)
    filled = inside.limit(0)
    for new in done:
        filled = filled.unionByName(new)
    filled = filled.withColumnRenamed("value", "_fill")
    known = df.join(mask.select(*keys, "inside"), keys, "left")
    right = filled.withColumnsRenamed({c: f"_{c}" for c in place})
    known = known.join(right, _same(known, right, place, "_"), "left")
    return known.withColumn("value", F.when(F.col("inside") == 1, F.coalesce("value", "_fill"))).select(*names)


def _same(left: DataFrame, right: DataFrame, names: list[str], mark: str = "") -> Column:
    """Equal in all of the names, NULL being equal to NULL."""
    on = F.lit(True)
    for c in names:
        on = on & left[c].eqNullSafe(right[mark + c])
    return on


def find_boundary(df: DataFrame, grid: Grid) -> DataFrame:
    """Data cells that touch a missing cell by an edge, in the first timestep of
    each series: the scenarios that carry on a historical series share its boundary.
    The rim of the grid itself is no boundary."""
    by = present(df, [c for c in SERIES + PLANE if c != "scenario"])
    first = df.groupBy(*by).agg(F.min(F.struct("year", "month")).alias("_t"))
    stamp = first.select(*by, F.col("_t.year").alias("year"), F.col("_t.month").alias("month"))
    start = df.join(stamp, by + ["year", "month"], "left_semi")
    return boundary_of(start.select(*by, "row", "col", "value"), by, grid)


def boundary_of(df: DataFrame, by: list[str], grid: Grid) -> DataFrame:
    """Boundary cells of one slice per ``by``: valid cells with fewer valid edge
    neighbours than the grid gives them."""
    valid = df.where(F.col("value").isNotNull()).select(*by, "row", "col").distinct()
    here = F.col("row").between(1, grid.ny - 1).cast("int") + F.col("row").between(0, grid.ny - 2).cast("int")
    side = F.col("col").between(1, grid.nx - 1).cast("int") + F.col("col").between(0, grid.nx - 2).cast("int")
    touched = (
        _around(valid, ROOK, by, grid)
        .groupBy(*by, F.col("nrow").alias("row"), F.col("ncol").alias("col"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        valid.join(touched, by + ["row", "col"], "left")
        .where(F.coalesce("_n", F.lit(0)) < here + (F.lit(2) if grid.cyclic else side))
        .drop("_n")
    )


def mosaic_first(*layers: DataFrame) -> DataFrame:
    """Merge overlapping grids: of the values of a cell the first listed layer that
    has one wins."""
    merged = None
    for rank, layer in enumerate(layers):
        part = layer.withColumn("_rank", F.lit(rank))
        merged = part if merged is None else merged.unionByName(part)
    keys = present(merged, SERIES + TIME + PLANE + ("row", "col"))
    rank = F.when(F.col("value").isNotNull(), F.col("_rank"))
    return merged.groupBy(*keys).agg(F.min_by("value", rank).alias("value"))
