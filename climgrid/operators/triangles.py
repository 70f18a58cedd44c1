"""Linear interpolation on Delaunay triangles: of the holes of a grid, and of scattered points.

**Holes.**  All valid cells of a slice have one triangulation, but only triangles over holes
matter, and their corners are *rim* cells: valid cells with a missing edge neighbour in the
hole.  (The circle of such a triangle holds missing cells only; those are connected by edges,
and one of them is next to each corner.)  So each hole is triangulated by itself, from its
rim, and gets the triangles that the whole slice would have given it: a group grows with the
rim of a hole, not with a slice.

**Geometry once.**  Slices with the same valid cells share a *pattern* (the sea mask of a
series, as a rule).  Holes, triangles and weights are found once a pattern; then the values of
each rim cell travel as one array over a chunk of the pattern's slices, so that filling
shuffles three short rows per missing cell and chunk, not per timestep.

**Points** are triangulated in tiles, each from its own points and those of the tiles around.
A triangle whose circle stays within that block is one of the whole triangulation.  A point
whose triangles are all known so is done with; the others, those along gaps and the hull, go
on to tiles of twice the size, until a block holds all that is left.  The result is the
triangulation of all points, though no task sees them all.

**Where a triangle ends.**  Nothing is extrapolated beyond the hull of the valid cells.  Where
four corners lie on one circle, one of the two possible diagonals is taken.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from climgrid.functions.triangulate import delaunay
from climgrid.grid import Grid
from climgrid.schema import slice_cols
from climgrid.storage import cut_lineage, dealt_by

CHUNK = 512  # slices of a pattern whose values travel in one array
SMALL = 24  # rim cells of a hole whose triangles are kept for others of its shape
BUSIEST = 1500  # points that a tile may hold at the start
FINE = 1 << 20  # whole-number steps of a cell, in which points are placed for comparisons

_CORNERS = "row1 {k}, col1 {k}, row2 {k}, col2 {k}, row3 {k}, col3 {k}"


# -- patterns --------------------------------------------------------------------------------


def _patterns(df: DataFrame, by: list[str], at: tuple[str, ...], valid: Column) -> DataFrame:
    """Slices with their pattern, and their place in a chunk of its slices: by columns,
    pattern, chunk, pos.  Equal patterns have as many valid places, and the sums of two
    64-bit hashes of them agree."""
    h = lambda seed: F.sum(F.when(valid, F.xxhash64(*at, F.lit(seed)).cast("decimal(20,0)")))
    marks = [F.count(F.when(valid, 1)), h(1), h(2)]
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *[m.alias(f"_m{i}") for i, m in enumerate(marks)])
    text = F.concat_ws(":", *[F.coalesce(F.col(f"_m{i}").cast("string"), F.lit("0")) for i in range(len(marks))])
    order = Window.partitionBy("pattern").orderBy(*by)
    number = (F.row_number().over(order) - 1) if by else F.lit(0)
    numbered = sizes.where("_rows > 0").select(*by, text.alias("pattern")).withColumn("_n", number)
    return numbered.select(*by, "pattern", F.floor(F.col("_n") / CHUNK).cast("int").alias("chunk"), (F.col("_n") % CHUNK).cast("int").alias("pos"))


def _meet(df: DataFrame, slices: DataFrame, by: list[str]) -> DataFrame:
    """Rows of slices with their pattern; null-safe, since a series column may be NULL."""
    if not by:  # one slice
        one = F.lit(0).alias("_one")
        return df.select("*", one).join(slices.select("*", one), "_one").drop("_one")
    right = slices.withColumnsRenamed({c: f"_{c}" for c in by})
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(right, on).drop(*[f"_{c}" for c in by])


# -- holes -----------------------------------------------------------------------------------


def _gap_runs(valid: DataFrame, patterns: DataFrame, grid: Grid) -> DataFrame:
    """(pattern, row, c0, c1): maximal runs of missing cells along the rows of each pattern."""
    w = Window.partitionBy("pattern", "row").orderBy("col")
    ends = valid.select("pattern", "row", "col", F.lag("col").over(w).alias("_before"), F.lead("col").over(w).alias("_after"))
    after = ends.select("pattern", "row", (F.col("col") + 1).alias("c0"), (F.coalesce("_after", F.lit(grid.nx)) - 1).alias("c1"))
    first = ends.where(F.col("_before").isNull()).select("pattern", "row", F.lit(0).alias("c0"), (F.col("col") - 1).alias("c1"))
    rows = patterns.select("pattern", F.explode(F.sequence(F.lit(0), F.lit(grid.ny - 1))).alias("row"))
    bare = rows.join(valid.select("pattern", "row").distinct(), ["pattern", "row"], "left_anti")
    whole = bare.select("pattern", "row", F.lit(0).alias("c0"), F.lit(grid.nx - 1).alias("c1"))
    return after.unionByName(first).unionByName(whole).where("c0 <= c1")


def _label(grid: Grid):
    """Holes of one pattern as connected runs.  A task holds the runs of one pattern, which
    grow with the rims, and gives each run its hole's number, and the rim cells of each hole."""

    def holes(runs: pd.DataFrame) -> pd.DataFrame:
        runs = runs.sort_values(["row", "c0"], ignore_index=True)
        row, c0, c1 = (runs[c].to_numpy(np.int64) for c in ("row", "c0", "c1"))
        n, wide = len(runs), grid.nx + 2
        parent = np.arange(n)

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        start, end = row * wide + c0, row * wide + c1
        # runs of the next row that reach a run: those that end at or after its begin
        lo = np.searchsorted(end, start + wide)
        hi = np.searchsorted(start, end + wide, side="right")
        for i in np.flatnonzero(hi > lo):
            for j in range(lo[i], hi[i]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        hole = np.array([root(i) for i in range(n)], np.int64)
        # rim: the cells beside a run, and those above and below it that no run holds
        sides = [(row, c0 - 1, c0 - 1, hole), (row, c1 + 1, c1 + 1, hole)]
        for step in (-1, 1):
            lo = np.searchsorted(end, start + step * wide)
            hi = np.searchsorted(start, end + step * wide, side="right")
            at, left, right, own = [], [], [], []
            for i in range(n):
                c = int(c0[i])
                for j in range(lo[i], hi[i]):
                    if c < c0[j]:
                        at.append(row[i] + step), left.append(c), right.append(int(c0[j]) - 1), own.append(hole[i])
                    c = int(c1[j]) + 1
                if c <= c1[i]:
                    at.append(row[i] + step), left.append(c), right.append(int(c1[i])), own.append(hole[i])
            sides.append(tuple(np.array(x, np.int64) for x in (at, left, right, own)))
        r, a, b, h = (np.concatenate(x) for x in zip(*sides))
        there = (r >= 0) & (r < grid.ny) & (a >= 0) & (b < grid.nx)
        pattern = runs["pattern"].iloc[0]
        parts = [(True, row, c0, c1, hole), (False, r[there], a[there], b[there], h[there])]
        return pd.concat(
            [pd.DataFrame({"pattern": pattern, "missing": m, "row": x, "c0": p, "c1": q, "hole": k}) for m, x, p, q, k in parts]
        )

    return holes


@lru_cache(maxsize=10_000)
def _small(points: tuple[tuple[int, int], ...]) -> list[tuple[int, int, int]]:
    """Triangles of a small rim moved to the origin: most small holes are of a few shapes."""
    return delaunay(list(points))


def _rim_triangles(cells: set[tuple[int, int]]) -> list[list[int]]:
    """Triangles of the rim of one hole: row and column of the three corners."""
    points = sorted((c, -r) for r, c in cells)
    x0, y0 = points[0]
    moved = tuple((x - x0, y - y0) for x, y in points)
    found = _small(moved) if len(moved) <= SMALL else delaunay(list(moved))
    return [[v for i in t for v in (-points[i][1], points[i][0])] for t in found]


def _triangulate(cells: pd.DataFrame) -> pd.DataFrame:
    """Triangles of the rim of one hole."""
    corners = _rim_triangles(set(zip(cells["row"].tolist(), cells["col"].tolist())))
    out = pd.DataFrame(corners, columns=_CORNERS.format(k="").replace(" ", "").split(","), dtype="int64")
    return out.assign(pattern=cells["pattern"].iloc[0], hole=cells["hole"].iloc[0])


def _triangulate_rims(batches):
    """The same of many holes, whose rims come as lists: holes are many and small as a rule, and
    a data frame each costs far more than its triangles."""
    for part in batches:
        rims = zip(part.column("rows").to_pylist(), part.column("cols").to_pylist())
        found = [_rim_triangles(set(zip(rows, cols))) for rows, cols in rims]
        own = pa.array(np.repeat(np.arange(len(found)), [len(t) for t in found]))
        corners = np.array([t for hole in found for t in hole], np.int64).reshape(-1, 6)
        columns = [*(pa.array(c) for c in corners.T), part.column("pattern").take(own), part.column("hole").take(own)]
        yield pa.RecordBatch.from_arrays(columns, names=[*_CORNERS.format(k="").replace(" ", "").split(","), "pattern", "hole"])


def _covered(triangles: DataFrame, keys: list[str], grid: Grid) -> DataFrame:
    """Cells whose centre a triangle holds, edges included: a scan along grid rows.  A
    triangle's corners are in (fractional) rows and columns."""
    x, y = [F.col(f"col{i}") for i in (1, 2, 3)], [F.col(f"row{i}") for i in (1, 2, 3)]
    eps = 1e-9
    top = F.greatest(F.lit(0), F.ceil(F.least(*y) - eps).cast("int"))
    low = F.least(F.lit(grid.ny - 1), F.floor(F.greatest(*y) + eps).cast("int"))
    lines = triangles.withColumn("row", F.explode(F.when(top <= low, F.sequence(top, low))))
    at = F.col("row")
    crossed = []
    for i, j in ((0, 1), (1, 2), (2, 0)):
        between = (F.least(y[i], y[j]) <= at + eps) & (F.greatest(y[i], y[j]) >= at - eps)
        part = F.try_divide(at - y[i], y[j] - y[i])  # NULL along a level edge: its ends count for the other two
        crossed.append(F.when(between, x[i] + (x[j] - x[i]) * F.least(F.lit(1.0), F.greatest(F.lit(0.0), part))))
    lines = lines.withColumns({"_x0": F.least(*crossed), "_x1": F.greatest(*crossed)})
    lo = F.greatest(F.lit(0), F.ceil(F.col("_x0") - eps).cast("int"))
    hi = F.least(F.lit(grid.nx - 1), F.floor(F.col("_x1") + eps).cast("int"))
    cells = lines.withColumn("col", F.explode(F.when(lo <= hi, F.sequence(lo, hi))))
    px = F.col("col")
    double = (x[1] - x[0]) * (y[2] - y[0]) - (x[2] - x[0]) * (y[1] - y[0])
    w2 = ((px - x[0]) * (y[2] - y[0]) - (x[2] - x[0]) * (at - y[0])) / double
    w3 = ((x[1] - x[0]) * (at - y[0]) - (px - x[0]) * (y[1] - y[0])) / double
    return cells.withColumns({"w2": w2, "w3": w3}).withColumn("w1", 1 - F.col("w2") - F.col("w3")).drop("_x0", "_x1")


def _one_triangle(cells: DataFrame, keys: list[str], rest: list[str]) -> DataFrame:
    """Of several triangles that meet on a cell, always the same one."""
    return cells.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_t")).select(*keys, "_t.*")


# -- values ----------------------------------------------------------------------------------


def _spread(weights: DataFrame, corners: DataFrame, slices: DataFrame, by: list[str]) -> DataFrame:
    """Values of every slice on the cells of its pattern.

    ``weights``: pattern, row, col and three times key and weight (k1 w1 k2 w2 k3 w3), NULL
    for cells without a triangle; ``corners``: pattern, chunk, key, and ``series``, the values
    of a corner in the chunk's slices, by their place.
    """
    asked = weights.where(F.col("k1").isNotNull()).select(
        "pattern", "row", "col",
        F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"k{i}").alias("key"), F.col(f"w{i}").alias("w")) for i in (1, 2, 3)])).alias("a"),
    )
    met = asked.select("pattern", "row", "col", "a.*").join(corners, ["pattern", "key"])
    of = lambda i, c: F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}{i}")
    wide = met.groupBy("pattern", "chunk", "row", "col").agg(*[of(i, c) for i in (1, 2, 3) for c in ("w", "series")])
    term = lambda i: F.transform(f"series{i}", lambda v: v * F.col(f"w{i}"))
    plus = lambda a, b: F.zip_with(a, b, lambda p, q: p + q)
    filled = wide.select("pattern", "chunk", "row", "col", F.posexplode(plus(plus(term(1), term(2)), term(3))).alias("pos", "value"))
    bare = weights.where(F.col("k1").isNull()).select("pattern", "row", "col").join(slices.select("pattern", "chunk", "pos"), "pattern")
    every = filled.unionByName(bare.withColumn("value", F.lit(None).cast("double")))
    return every.join(slices, ["pattern", "chunk", "pos"]).select(*by, "row", "col", "value")


def _series(values: DataFrame) -> DataFrame:
    """(pattern, chunk, key, series): the values of each corner over the slices of a chunk."""
    packed = values.groupBy("pattern", "chunk", "key").agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("_s"))
    return packed.select("pattern", "chunk", "key", F.transform("_s", lambda s: s["value"]).alias("series"))


def fill_gaps_triangles(df: DataFrame, grid: Grid) -> DataFrame:
    """Missing cells of each timestep, those that the table does not hold included, by linear
    interpolation on the Delaunay triangles of the valid cells; NULL outside their hull.

    A cell may occur once in a timestep.  Columns other than series, time, grid, level and
    value are left out.  The seam of a cyclic grid is an edge like the others.  The valid
    cells pass as they are, without a shuffle.  Cells beyond the grid are left out.
    """
    by = slice_cols(df)
    here = df.where(grid.holds()).select(*by, F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col("value").cast("double").alias("value"))
    here = cut_lineage(here)  # read four times
    valid = here.where(F.col("value").isNotNull())
    slices = cut_lineage(_patterns(here, by, ("row", "col"), F.col("value").isNotNull()))
    model = slices.where((F.col("chunk") == 0) & (F.col("pos") == 0))  # one slice of each pattern
    example = _meet(valid, model, by).select("pattern", "row", "col")
    shape = "pattern string, missing boolean, row int, c0 int, c1 int, hole long"
    spans = cut_lineage(dealt_by(_gap_runs(example, model, grid), "pattern").groupBy("pattern").applyInPandas(_label(grid), shape))
    cells = lambda missing: spans.where(F.col("missing") == missing).select(
        "pattern", "hole", "row", F.explode(F.sequence("c0", "c1")).alias("col")
    )
    rim = cells(False).distinct()
    corner = _CORNERS.format(k="long")
    holes = dealt_by(rim, "pattern", "hole", cells=grid.nx * grid.ny).groupBy("pattern", "hole")
    rims = holes.agg(F.collect_list("row").alias("rows"), F.collect_list("col").alias("cols"))
    triangles = rims.mapInArrow(_triangulate_rims, f"{corner}, pattern string, hole long")
    covered = _covered(triangles, ["pattern", "hole"], grid)
    key = lambda i: F.col(f"row{i}") * grid.nx + F.col(f"col{i}")
    covered = covered.withColumns({f"k{i}": key(i) for i in (1, 2, 3)})
    own = ["k1", "k2", "k3", "w1", "w2", "w3"]
    # a triangle may reach over cells of another hole: only those of its own count
    weights = _one_triangle(covered, ["pattern", "hole", "row", "col"], own)
    weights = cut_lineage(cells(True).join(weights, ["pattern", "hole", "row", "col"], "left").drop("hole"))
    wanted = rim.select("pattern", "row", "col").distinct()
    values = _meet(valid, slices, by).join(wanted, ["pattern", "row", "col"], "left_semi")
    values = values.withColumn("key", F.col("row").cast("long") * grid.nx + F.col("col"))
    return valid.unionByName(_spread(weights, _series(values), slices, by))


# -- scattered points ------------------------------------------------------------------------


def _tile_triangles(step_x: float, step_y: float, side: float):
    """Triangles of the points of one tile and those around it.  ``mine`` marks the tile's own.

    Gives the triangles with a corner in the tile that are certain (or all, where the block
    holds every point), and the tile's points that are not done with."""

    def solve(points: pd.DataFrame) -> pd.DataFrame:
        points = points.sort_values(["gx", "gy"], ignore_index=True)
        first = points.iloc[0]
        gx, gy, x, y = (points[c].to_numpy() for c in ("gx", "gy", "x", "y"))
        tri = np.array(delaunay(list(zip(gx.tolist(), (-gy).tolist()))), np.int64).reshape(-1, 3)
        # the block in steps, open where it reaches past the last point
        lo = lambda t, least: -np.inf if (t - 1) * side <= least else (t - 1) * side
        hi = lambda t, most: np.inf if (t + 2) * side > most else (t + 2) * side
        box = (
            lo(first["tx"], first["least_x"]) * step_x, hi(first["tx"], first["most_x"]) * step_x,
            lo(first["ty"], first["least_y"]) * step_y, hi(first["ty"], first["most_y"]) * step_y,
        )
        px, py = x * step_x, y * step_y
        (ax, bx, cx), (ay, by, cy) = px[tri].T, py[tri].T
        ux, uy, vx, vy = bx - ax, by - ay, cx - ax, cy - ay
        with np.errstate(divide="ignore", invalid="ignore"):
            d = 2 * (ux * vy - uy * vx)
            ox = (vy * (ux * ux + uy * uy) - uy * (vx * vx + vy * vy)) / d
            oy = (ux * (vx * vx + vy * vy) - vx * (ux * ux + uy * uy)) / d
            r = np.sqrt(ox * ox + oy * oy) * (1 + 1e-6)
            sure = (ax + ox - r >= box[0]) & (ax + ox + r <= box[1]) & (ay + oy - r >= box[2]) & (ay + oy + r <= box[3])
        if all(map(np.isinf, box)):
            sure[:] = True
        mine = points["mine"].to_numpy()
        out = tri[sure & mine[tri].any(axis=1)]
        # done: every triangle round the point is certain, and they close round it
        corners, spokes = np.zeros(len(points), int), np.zeros(len(points), int)
        np.add.at(corners, tri[sure].ravel(), 1)
        edges = np.sort(np.concatenate([tri[:, [0, 1]], tri[:, [1, 2]], tri[:, [2, 0]]]), axis=1) if len(tri) else np.empty((0, 2), int)
        np.add.at(spokes, np.unique(edges, axis=0).ravel(), 1)
        left = mine & ~((corners == spokes) & (corners > 0)) & ~np.full(len(points), all(map(np.isinf, box)))
        table = {"pattern": first["pattern"]}
        for i in range(3):
            table |= {f"gx{i + 1}": gx[out[:, i]], f"gy{i + 1}": gy[out[:, i]], f"col{i + 1}": x[out[:, i]], f"row{i + 1}": y[out[:, i]]}
        known = pd.DataFrame(table, index=range(len(out)))
        rest = pd.DataFrame({"pattern": first["pattern"], "gx1": gx[left], "gy1": gy[left], "col1": x[left], "row1": y[left]})
        return pd.concat([known, rest], ignore_index=True).astype({f"g{a}{i}": "Int64" for a in "xy" for i in (1, 2, 3)})

    return solve


def _point_triangles(points: DataFrame, grid: Grid, side: float) -> DataFrame:
    """Triangles over the points (pattern, gx, gy, x, y) of each pattern; those of an earlier
    round come first where rounds overlap."""
    least = min(grid.dx, grid.dy)
    bounds = points.groupBy("pattern").agg(
        F.min("x").alias("least_x"), F.max("x").alias("most_x"), F.min("y").alias("least_y"), F.max("y").alias("most_y")
    )
    ends = bounds.agg(F.max(F.greatest(F.col("most_x") - F.col("least_x"), F.col("most_y") - F.col("least_y")))).first()[0]
    shape = "pattern string, " + ", ".join(f"gx{i} long, gy{i} long, col{i} double, row{i} double" for i in (1, 2, 3))
    rounds, at, last = [], 0, False
    while ends is not None and not last:
        last = side > ends
        tile = lambda c: F.floor(F.col(c) / side)  # noqa: E731, B023
        around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
        sent = points.join(bounds, "pattern").select("*", around.alias("o"), tile("x").alias("_tx"), tile("y").alias("_ty"))
        sent = sent.withColumns({"tx": F.col("_tx") + F.col("o.i"), "ty": F.col("_ty") + F.col("o.j"), "mine": (F.col("o.i") == 0) & (F.col("o.j") == 0)})
        # a tile without points of its own has nothing to give
        own = points.select("pattern", tile("x").alias("tx"), tile("y").alias("ty")).distinct()
        sent = sent.drop("o", "_tx", "_ty").join(own, ["pattern", "tx", "ty"], "left_semi")
        solve = _tile_triangles(grid.dx / least, grid.dy / least, side)
        found = cut_lineage(dealt_by(sent, "pattern", "tx", "ty").groupBy("pattern", "tx", "ty").applyInPandas(solve, shape))
        rounds.append(found.where(F.col("gx2").isNotNull()).distinct().withColumn("round", F.lit(at)))
        points = found.where(F.col("gx2").isNull()).select(
            "pattern", F.col("gx1").alias("gx"), F.col("gy1").alias("gy"), F.col("col1").alias("x"), F.col("row1").alias("y")
        )
        side, at = side * 2, at + 1
        last = last or points.isEmpty()
    if not rounds:
        return points.sparkSession.createDataFrame([], shape + ", round int")
    whole = rounds[0]
    for r in rounds[1:]:
        whole = whole.unionByName(r)
    return whole


def _start_side(points: DataFrame) -> float:
    """The largest tile, in cells, whose busiest one holds few enough points."""
    side = 32.0
    while side > 2.0**-12:
        tile = [F.floor(F.col(c) / side) for c in ("x", "y")]
        if (points.groupBy("pattern", *tile).count().agg(F.max("count")).first()[0] or 0) <= BUSIEST:
            break
        side /= 2
    return side


def regrid_points_triangles(points: DataFrame, grid: Grid) -> DataFrame:
    """Scattered points (lat, lon, value, series and time columns) onto the cells of a grid by
    linear interpolation on their Delaunay triangles; every cell of every timestep, NULL
    outside the hull.

    Points without a place or value are left out; points of one place (to a millionth of a
    cell) count as one with their mean.  Points beyond the grid serve as corners.  On a
    cyclic grid longitudes are taken round the globe; its seam is an edge.
    """
    by = slice_cols(points)
    number = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    has = number("lat") & number("lon") & number("value")
    fx = (F.col("lon") - grid.x0) / grid.dx - 0.5
    fx = F.pmod(fx + 0.5, F.lit(float(grid.nx))) - 0.5 if grid.cyclic else fx
    least = min(grid.dx, grid.dy)
    whole = lambda c, d: F.when(F.col("has"), F.rint(c * (FINE * d / least))).try_cast("long")
    put = points.select(*by, fx.alias("x"), ((F.lit(grid.y0) - F.col("lat")) / grid.dy - 0.5).alias("y"), F.col("value").cast("double").alias("value"), has.alias("has"))
    put = put.withColumns({"gx": whole(F.col("x"), grid.dx), "gy": whole(F.col("y"), grid.dy)})
    placed = put.groupBy(*by, "has", "gx", "gy").agg(F.avg("value").alias("value"), F.min("x").alias("x"), F.min("y").alias("y"))
    placed = cut_lineage(placed)
    valid = placed.where("has")
    slices = cut_lineage(_patterns(placed, by, ("gx", "gy"), F.col("has")))
    model = slices.where((F.col("chunk") == 0) & (F.col("pos") == 0))
    example = cut_lineage(_meet(valid, model, by).select("pattern", "gx", "gy", "x", "y"))
    triangles = _point_triangles(example, grid, _start_side(example))
    covered = _covered(triangles, ["pattern"], grid)
    covered = covered.withColumns({f"k{i}": F.struct(F.col(f"gx{i}").alias("gx"), F.col(f"gy{i}").alias("gy")) for i in (1, 2, 3)})
    chosen = _one_triangle(covered, ["pattern", "row", "col"], ["round", "k1", "k2", "k3", "w1", "w2", "w3"])
    rows, cols = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (grid.ny, grid.nx))
    cells = model.select("pattern", rows.alias("row")).select("pattern", "row", cols.alias("col"))
    weights = cut_lineage(cells.join(chosen, ["pattern", "row", "col"], "left").drop("round"))
    values = _meet(valid, slices, by).withColumn("key", F.struct("gx", "gy"))
    return _spread(weights, _series(values), slices, by)
