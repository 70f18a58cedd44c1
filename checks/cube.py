"""Climate-like tables derived by Spark from the given tables.

One coarse cell is one supplier, one fine cell one part, a month is a ship month, so
the grids grow with the tables (20 fine cells per coarse one) at an even density.
Values are averages over line items plus a seasonal term, kept to sixteenths so that
sums of them are exact in any order.
"""

from __future__ import annotations

from functools import lru_cache
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from climgrid.grid import Grid
from climgrid.storage import dealt_by

BEGIN, END = 1995, 1999  # base period: the historical years of the data


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@lru_cache(maxsize=32)
def _shape(sf: str, n: int) -> tuple[Grid, Grid]:
    nx = ceil(sqrt(n))
    ny = ceil(n / nx)
    return Grid.global_latlon(nx, ny, "coarse"), Grid.global_latlon(4 * nx, 5 * ny, "fine")


_COUNTS: dict[str, int] = {}


def grids(spark: SparkSession, sf: str) -> tuple[Grid, Grid]:
    """Coarse and fine grid.  The count comes from Parquet footers."""
    if sf not in _COUNTS:
        _COUNTS[sf] = table(spark, sf, "supplier").count()
    return _shape(sf, _COUNTS[sf])


def projected(spark: SparkSession, sf: str, crs: str = "EPSG:3338", x0: float = -2000000.0, y0: float = 2400000.0) -> Grid:
    """The fine cells laid on a projected grid of 4000 by 4000 km."""
    _, fine = grids(spark, sf)
    return Grid(fine.nx, fine.ny, x0, y0, 4000000.0 / fine.nx, 4000000.0 / fine.ny, grid_id="projected", crs=crs)


def q16(c: Column) -> Column:
    return F.floor(c * 16 + 0.5) / 16


def _seasonal() -> Column:
    return F.abs(F.col("month") - 7) * 5


def _value(variable: str) -> Column:
    n, q, d, t = (F.col(c) for c in "nqdt")
    return {
        "tas": lambda: q16(q / n - 10.5 - _seasonal()),
        "tasmin": lambda: q16(F.col("mn") - 10.5 - _seasonal()),
        "tasmax": lambda: q16(F.col("mx") - 10.5 - _seasonal()),
        "pr": lambda: q16(F.greatest(F.lit(0.0), t / n - 2) * 10),
        "clt": lambda: q16(d / n * 10),
        "hur": lambda: q16(d / n * 20 - 20),
        "vap": lambda: q16(q / n / 5),
    }[variable]()


def _cell(key: str, nx: int) -> dict[str, Column]:
    return {"row": F.floor(F.col(key) / nx).cast("int"), "col": (F.col(key) % nx).cast("int")}


def monthly_sums(spark: SparkSession, sf: str, **by: Column) -> DataFrame:
    """Sums of line items per supplier and ship month (and ``by``): folded map-side."""
    li = table(spark, sf, "lineitem")
    day = F.col("l_shipdate")
    return li.groupBy(
        F.col("l_suppkey").alias("k"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        *[c.alias(name) for name, c in by.items()],
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("q"),
        F.min("l_quantity").alias("mn"),
        F.max("l_quantity").alias("mx"),
        F.sum(F.round(F.col("l_discount") * 100)).alias("d"),
        F.sum(F.round(F.col("l_tax") * 100)).alias("t"),
    )


def scenario() -> Column:
    return F.when(F.col("year") <= END, "historical").otherwise("rcp60")


def cells(spark: SparkSession, sf: str, variable: str | list[str] = "tas", **by: Column) -> DataFrame:
    """Coarse cells of one variable, or of several in long form."""
    coarse, _ = grids(spark, sf)
    names = [variable] if isinstance(variable, str) else variable
    sums = monthly_sums(spark, sf, **by)
    at = _cell("k", coarse.nx)
    base = sums.select(
        *by, scenario().alias("scenario"), "year", "month", at["row"].alias("row"), at["col"].alias("col"),
        *[_value(v).alias(v) for v in names],
    )
    keep = [*by, "scenario", "year", "month", "row", "col"]
    if len(names) == 1:
        return base.select(*keep, F.lit(names[0]).alias("variable"), F.col(names[0]).alias("value"))
    return base.unpivot(keep, names, "variable", "value")


def models(spark: SparkSession, sf: str, variable="tas") -> DataFrame:
    """Five models: line items split by order."""
    model = F.concat(F.lit("M"), (F.col("l_orderkey") % 5).cast("string"))
    return cells(spark, sf, variable, model=model)


def version(spark: SparkSession, sf: str, name: str, variable="tas") -> DataFrame:
    """Two versions of a series: open and closed lines."""
    status = {"old": "O", "new": "F"}[name]
    both = cells(spark, sf, variable, version=F.col("l_linestatus"))
    return both.where(F.col("version") == status).drop("version")


def mask(spark: SparkSession, sf: str) -> DataFrame:
    """Land mask of the coarse grid: suppliers without debt."""
    coarse, _ = grids(spark, sf)
    sup = table(spark, sf, "supplier")
    inside = F.when(F.col("s_acctbal") >= 0, 1).otherwise(0)
    at = _cell("s_suppkey", coarse.nx)
    return sup.select(at["row"].alias("row"), at["col"].alias("col"), inside.alias("inside"))


def gappy(spark: SparkSession, sf: str, variable="tas") -> DataFrame:
    """Cells with NULL at sea."""
    c = cells(spark, sf, variable).join(mask(spark, sf), ["row", "col"])
    return c.withColumn("value", F.when(F.col("inside") == 1, F.col("value"))).drop("inside")


def zones(spark: SparkSession, sf: str) -> DataFrame:
    """Zone of each coarse cell: the nation of the supplier."""
    coarse, _ = grids(spark, sf)
    at = _cell("s_suppkey", coarse.nx)
    sup = table(spark, sf, "supplier").select(
        at["row"].alias("row"), at["col"].alias("col"), F.col("s_nationkey").alias("zone_id")
    )
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("zone_name"))
    return sup.join(nation, "zone_id")


def fine_cells(spark: SparkSession, sf: str) -> DataFrame:
    _, fine = grids(spark, sf)
    at = _cell("p_partkey", fine.nx)
    inside = F.when(F.col("p_size") > 10, 1).otherwise(0)
    return table(spark, sf, "part").select(
        at["row"].alias("row"), at["col"].alias("col"), "p_size", inside.alias("inside")
    )


def fine_mask(spark: SparkSession, sf: str) -> DataFrame:
    return fine_cells(spark, sf).select("row", "col", "inside")


def baseline(spark: SparkSession, sf: str, variable="tas") -> DataFrame:
    """Monthly climatology of the fine grid."""
    size = F.col("p_size")
    value = {
        "tas": q16(size / 5 + 10 - _seasonal()),
        "pr": (size + F.col("month") * 3).cast("double"),
        "clt": (size * 2).cast("double"),
    }[variable]
    months = F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")
    # cells are few bytes, so that Spark reads them in one task: dealt before they are spread
    cells = dealt_by(fine_cells(spark, sf).select("row", "col", "p_size"), "row", "col")
    return cells.select("row", "col", "p_size", months).select("row", "col", "month", value.alias("value"))


def polygons(spark: SparkSession, sf: str) -> DataFrame:
    """One polygon per nation: boxes, triangles and boxes with a notch."""
    nation = table(spark, sf, "nation")
    a = F.col("n_nationkey") * 14.4 + 1.7
    b = F.col("n_nationkey") * 5.1 - 80.3
    pt = lambda x, y: F.struct((a + x).alias("x"), (b + y).alias("y"))
    box = F.array(pt(0.0, 0.0), pt(61.3, 0.0), pt(61.3, 47.9), pt(0.0, 47.9), pt(0.0, 0.0))
    tri = F.array(pt(0.0, 0.0), pt(61.3, 0.0), pt(20.3, 47.9), pt(0.0, 0.0))
    notch = F.array(pt(0.0, 0.0), pt(61.3, 0.0), pt(61.3, 47.9), pt(30.1, 11.3), pt(0.0, 47.9), pt(0.0, 0.0))
    ring = F.when(F.col("n_regionkey") < 2, box).when(F.col("n_regionkey") == 2, tri).otherwise(notch)
    return nation.select(F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("zone_name"), ring.alias("ring"))
