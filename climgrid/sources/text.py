"""Text formats: point climatologies and ASCII rasters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from climgrid.storage import cut_lineage

# Header fields of an ASCII raster and the number of the annual file.
ASCII_HEADER = ("ncols", "nrows", "xllcorner", "yllcorner", "cellsize", "NODATA_value")
ANNUAL_FILE = 14


def _strip(c) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def parse_point_climatology(lines: DataFrame, months: int = 12) -> DataFrame:
    """Lines ``lat lon m1..m12 [cv1..cv12]`` as long rows lat, lon, month, value.
    Further columns are ignored, and a field that is no number is NULL.  ``months = 1`` reads a single value column, month NULL."""
    parts = F.split(_strip("value"), r"\s+")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("double")
    base = lines.where(F.length(_strip("value")) > 0)
    if months == 1:
        return base.select(
            number(0).alias("lat"), number(1).alias("lon"), F.lit(None).cast("int").alias("month"), number(2).alias("value")
        )
    cells = F.array(*[F.struct(F.lit(m).alias("month"), number(m + 1).alias("value")) for m in range(1, months + 1)])
    return base.select(number(0).alias("lat"), number(1).alias("lon"), F.explode(cells).alias("m")).select(
        "lat", "lon", "m.month", "m.value"
    )


def scan_point_climatology(spark: SparkSession, path: str, months: int = 12) -> DataFrame:
    """Plain or gzipped text; a gzipped file is one task, so keep files moderate."""
    return parse_point_climatology(spark.read.text(path), months)


def parse_ascii_grid(files: DataFrame) -> DataFrame:
    """Whole ASCII rasters (``value`` = text, other columns are kept) as cells.  The
    nodata number of the header becomes NULL.  One file is one grid of one month, so
    its text is bounded by the grid (2 GB, one task a file); files spread over tasks."""
    keep = [c for c in files.columns if c != "value"]
    field = lambda name, kind: F.regexp_extract("value", rf"(?i){name}\s+(\S+)", 1).try_cast(kind)
    body = F.regexp_replace("value", r"(?is)^.*?nodata_value\s+\S+", "")
    heads = files.select(
        *keep,
        field("ncols", "int").alias("_nc"),
        field("nrows", "int").alias("_nr"),
        field("xllcorner", "double").alias("_x"),
        field("yllcorner", "double").alias("_y"),
        field("cellsize", "double").alias("_d"),
        field("NODATA_value", "double").alias("_nd"),
        F.split(_strip(body), r"\s+").alias("_v"),
    )
    cells = heads.select("*", F.posexplode("_v").alias("_i", "_s"))
    v = F.col("_s").try_cast("double")
    row = F.floor(F.col("_i") / F.col("_nc")).cast("int")
    col = (F.col("_i") % F.col("_nc")).cast("int")
    return cells.select(
        *keep,
        row.alias("row"),
        col.alias("col"),
        (F.col("_y") + (F.col("_nr") - row - 0.5) * F.col("_d")).alias("lat"),
        (F.col("_x") + (col + 0.5) * F.col("_d")).alias("lon"),
        F.when(v != F.col("_nd"), v).alias("value"),
    )


def ascii_month(path) -> Column:
    """Month number that ends the file stem, or that of a folder ``month=MM``."""
    folder = F.regexp_extract(path, r"month=(\d+)/[^/]*$", 1).try_cast("int")
    return F.coalesce(folder, F.regexp_extract(path, r"(\d+)\.[A-Za-z]+$", 1).try_cast("int"))


# The header fields that a line of its own may hold.
_FIELDS = ("ncols", "nrows", "xllcorner", "yllcorner", "xllcenter", "yllcenter", "cellsize", "nodata_value")
_HEADER = rf"(?i)^\s*({'|'.join(_FIELDS)})\s+(\S+)\s*$"


def parse_ascii_lines(lines: DataFrame) -> DataFrame:
    """Lines of ASCII rasters as cells.  ``value`` is a line, ``path`` its raster, ``block``
    where its part of the file begins, ``line`` its order within that part; other columns
    that are constant in a raster are kept.

    A cell's place is the number of values before it: those of earlier parts, by one running
    sum over the parts of a file, and those of earlier lines of its part.  These sums hold
    numbers of values, no texts; a line's place then joins its text by path, block and line (no
    two lines share them), so a raster of any size is parsed by many tasks, however its lines
    are broken.  Every header field stands on a line of its own.  The lines are read several
    times and must come alike each time (a stored table does).
    """
    keep = [c for c in lines.columns if c not in ("value", "path", "block", "line")]
    field = F.lower(F.regexp_extract("value", _HEADER, 1))
    held = F.regexp_extract("value", _HEADER, 2)
    of = lambda name, kind: F.max(F.when(field == name, held)).try_cast(kind)
    numbers = {n: "int" if n in ("ncols", "nrows") else "double" for n in _FIELDS}
    heads = lines.where(field != "").groupBy("path").agg(*[of(n, kind).alias(f"_{n}") for n, kind in numbers.items()])
    size, half = F.col("_cellsize"), F.col("_cellsize") / 2
    heads = heads.select(
        "path", F.col("_ncols").alias("_nc"), F.col("_nrows").alias("_nr"), size.alias("_d"), F.col("_nodata_value").alias("_nd"),
        F.coalesce("_xllcorner", F.col("_xllcenter") - half).alias("_x"), F.coalesce("_yllcorner", F.col("_yllcenter") - half).alias("_y"),
    )
    text, id_ = _strip("value"), ["path", "block", "line"]
    body = lines.where((field == "") & (text != ""))
    counts = body.select(*id_, F.size(F.split(text, r"\s+")).alias("_n"))
    parts = counts.groupBy("path", "block").agg(F.sum("_n").alias("_n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("path", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    above = Window.partitionBy("path", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*id_, F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_before"))
    # windows and joins of a whole part see a few numbers a line; texts only meet their line's
    placed = counts.join(parts, ["path", "block"]).join(heads, "path")
    cells = body.select(*id_, *keep, text.alias("_text")).join(placed, id_)
    cells = cells.select("*", F.posexplode(F.split("_text", r"\s+")).alias("_i", "_s"))
    v, at = F.col("_s").try_cast("double"), F.col("_start") + F.col("_before") + F.col("_i")
    cells = cells.withColumns({"row": F.floor(at / F.col("_nc")).cast("int"), "col": (at % F.col("_nc")).cast("int")})
    return cells.select(
        *keep,
        "path",
        "row",
        "col",
        (F.col("_y") + (F.col("_nr") - F.col("row") - 0.5) * F.col("_d")).alias("lat"),
        (F.col("_x") + (F.col("col") + 0.5) * F.col("_d")).alias("lon"),
        F.when(F.col("_nd").isNull() | (v != F.col("_nd")), v).alias("value"),
    )


def scan_ascii_grid(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """ASCII rasters with the month taken from the file name (or a folder ``month=MM``); the
    annual file is left out.  Plain files are split like any text; a compressed one is one task.
    The lines are stored once: two scans might cut the files in different places."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),  # a part is read by one task, in order
    )
    lines = lines.withColumn("month", ascii_month("path")).where(F.col("month") != ANNUAL_FILE)
    return parse_ascii_lines(cut_lineage(lines))
