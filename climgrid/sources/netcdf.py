"""Gridded series in classic NetCDF files (versions 1, 2 and 5): a data source and a writer.

``spark.read.format("climgrid_netcdf")`` reads a variable of dimensions (time, [level,] lat,
lon) as cells.  Only the header is read for planning; a file is cut into hyperslabs, runs of
timesteps (or of rows, where one timestep is very large), each an input partition that reads
its own byte ranges.  Filters on year and month prune timesteps before anything is read.

Files are opened by pyarrow's file systems (local, ``file:``, ``s3:``, ``gs:``, ``hdfs:``).
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)

from climgrid.grid import Grid
from climgrid.schema import present

FORMAT = "climgrid_netcdf"
SLAB_BYTES = 16 << 20

# The format's numbers of types and list tags.
TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: "u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12
DEFAULT_FILL = {"i1": -127, ">i2": -32767, ">i4": -2147483647, ">f4": 9.9692099683868690e36, ">f8": 9.9692099683868690e36}


def open_file(path: str):
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system, at


# -- header ----------------------------------------------------------------------------------


@dataclass
class Variable:
    name: str
    dims: list[int]
    attrs: dict
    kind: str
    begin: int
    shape: list[int] = field(default_factory=list)
    step: int = 0  # bytes from one record to the next, 0 where the variable has no record dimension


@dataclass
class Header:
    dims: list[tuple[str, int]]
    attrs: dict
    variables: dict[str, Variable]
    records: int

    def names(self, v: Variable) -> list[str]:
        return [self.dims[d][0] for d in v.dims]


class _Need(Exception):
    """The header is longer than what has been read."""


class _Reader:
    def __init__(self, raw: bytes):
        self.raw, self.at = raw, 0

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.raw):
            raise _Need
        self.at += n
        return self.raw[self.at - n : self.at]

    def number(self, size: int) -> int:
        return int.from_bytes(self.take(size), "big")

    def padded(self, n: int) -> bytes:
        out = self.take(n)
        self.take(-n % 4)
        return out


def parse_header(raw: bytes, size: int | None = None) -> Header:
    """The header at the start of a file of ``size`` bytes; raises ``_Need`` if ``raw`` is too short."""
    r = _Reader(raw)
    magic, version = r.take(3), r.take(1)[0]
    if magic != b"CDF" or version not in (1, 2, 5):
        raise ValueError("not a classic NetCDF file")
    wide = 8 if version == 5 else 4
    place = 4 if version == 1 else 8
    count = r.number(wide)
    streaming = count == (1 << 8 * wide) - 1
    text = lambda: r.padded(r.number(wide)).decode()

    def listed(tag: int):
        found, n = r.number(4), r.number(wide)
        if found not in (0, tag) or (found == 0 and n):
            raise ValueError("broken NetCDF header")
        return range(n)

    def attributes() -> dict:
        out = {}
        for _ in listed(ATTRIBUTE):
            name, kind = text(), TYPES[r.number(4)]
            n = r.number(wide)
            body = r.padded(n * np.dtype(kind).itemsize)
            out[name] = body.decode(errors="replace").rstrip("\0") if kind == "S1" else np.frombuffer(body, kind)
        return out

    dims = [(text(), r.number(wide)) for _ in listed(DIMENSION)]
    attrs = attributes()
    variables: dict[str, Variable] = {}
    sizes: dict[str, int] = {}
    for _ in listed(VARIABLE):
        name = text()
        own = [r.number(wide) for _ in range(r.number(wide))]
        about, kind = attributes(), TYPES[r.number(4)]
        r.number(wide)  # vsize: it may not hold large values, so it is worked out below
        variables[name] = Variable(name, own, about, kind, r.number(place))
    recorded = [v for v in variables.values() if v.dims and dims[v.dims[0]][1] == 0]
    for v in recorded:
        sizes[v.name] = np.dtype(v.kind).itemsize * prod(dims[d][1] for d in v.dims[1:])
    # a single record variable is not padded
    step = sum(sizes.values()) if len(recorded) == 1 else sum(s + -s % 4 for s in sizes.values())
    if streaming:
        first = min((v.begin for v in recorded), default=0)
        count = (size - first) // step if size and step else 0
    for v in variables.values():
        v.shape = [dims[d][1] or count for d in v.dims]
        v.step = step if v in recorded else 0
    return Header(dims, attrs, variables, count)


def read_header(path: str) -> Header:
    system, at = open_file(path)
    size = system.get_file_info(at).size
    want = 1 << 16
    with system.open_input_file(at) as f:
        while True:
            raw = f.read_at(min(want, size), 0)
            try:
                return parse_header(raw, size)
            except _Need:
                if want >= size:
                    raise ValueError(f"{path}: the header is cut off") from None
                want *= 8


# -- time ------------------------------------------------------------------------------------

# Days of the months of a year without a leap day.
NO_LEAP = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
_SECONDS = {"day": 86400, "hour": 3600, "minute": 60, "second": 1}


def year_months(values: np.ndarray, units: str, calendar: str = "standard") -> list[tuple[int, int]]:
    """Year and month of times such as ``days since 1850-01-01``."""
    unit, _, since = units.partition(" since ")
    unit = unit.strip().lower().rstrip("s")
    date, _, clock = since.strip().replace("T", " ").partition(" ")
    y, m, d = (int(p) for p in date.split("-")[:3])
    if unit == "month":
        months = np.floor(values.astype(float) + 1e-9).astype(int) + y * 12 + m - 1
        return [(int(k // 12), int(k % 12) + 1) for k in months]
    hms = [float(p) for p in clock.split()[0].rstrip("Z").split(":")] if clock.strip() else [0.0]
    shift = sum(p * s for p, s in zip(hms, (3600, 60, 1))) / 86400
    days = np.floor(values.astype(float) * _SECONDS[unit] / 86400 + shift + 1e-9).astype(np.int64)
    calendar = calendar.lower()
    if calendar == "360_day":
        whole = days + (y * 360 + (m - 1) * 30 + d - 1)
        return [(int(k // 360), int(k % 360) // 30 + 1) for k in whole]
    if calendar in ("noleap", "365_day", "all_leap", "366_day"):
        long_year = calendar in ("all_leap", "366_day")
        ends = np.cumsum([n + (1 if long_year and i == 1 else 0) for i, n in enumerate(NO_LEAP)])
        whole = days + y * int(ends[-1]) + (int(ends[m - 2]) if m > 1 else 0) + d - 1
        return [(int(k // ends[-1]), int(np.searchsorted(ends, k % ends[-1], side="right")) + 1) for k in whole]
    if calendar not in ("standard", "gregorian", "proleptic_gregorian"):
        raise ValueError(f"calendar {calendar!r} is not known")
    at = np.datetime64(f"{y:04d}-{m:02d}-{d:02d}") + days.astype("timedelta64[D]")
    months = at.astype("datetime64[M]").astype(int)
    return [(int(k // 12) + 1970, int(k % 12) + 1) for k in months]


# -- reading ---------------------------------------------------------------------------------


@dataclass
class Slab(InputPartition):
    """Some timesteps of one file, and a run of its rows."""

    path: str
    steps: list[tuple[int, int, int]]  # index, year, month
    rows: tuple[int, int]  # of the file's latitudes
    level: int | None


def _values(f, v: Variable, first: int, count: int, offset: int = 0, step_index: int = 0) -> np.ndarray:
    size = np.dtype(v.kind).itemsize
    return np.frombuffer(f.read_at(count * size, v.begin + step_index * v.step + (offset + first) * size), v.kind)


def read_whole(path: str, v: Variable) -> np.ndarray:
    """All values of a small variable, such as a coordinate."""
    system, at = open_file(path)
    with system.open_input_file(at) as f:
        if not v.step:
            return _values(f, v, 0, prod(v.shape)).reshape(v.shape)
        return np.stack([_values(f, v, 0, prod(v.shape[1:]), step_index=i) for i in range(v.shape[0])]).reshape(v.shape)


class NetCDFReader(DataSourceReader):
    def __init__(self, schema, options):
        self.options = options
        self.years: list[tuple[float, float]] = []
        self.months: list[tuple[float, float]] = []
        for name in ("begin", "end"):
            if options.get(name) is not None:
                bound = float(options[name])
                self.years.append((bound, np.inf) if name == "begin" else (-np.inf, bound))
        self.lists: list[tuple[str, set]] = []

    def _wanted(self, year: int, month: int) -> bool:
        inside = all(a <= year <= b for a, b in self.years) and all(a <= month <= b for a, b in self.months)
        return inside and all((year if name == "year" else month) in some for name, some in self.lists)

    def _files(self) -> list[str]:
        from pyarrow import fs

        path = self.options["path"]
        system, at = open_file(path)
        if system.get_file_info(at).type == fs.FileType.File:
            return [path]
        found = system.get_file_info(fs.FileSelector(at, recursive=True))
        head = path[: len(path) - len(at)] if path.endswith(at) else path.split("://")[0] + "://"
        return sorted(head + i.path for i in found if i.type == fs.FileType.File and i.path.endswith(".nc"))

    def _variable(self, header: Header) -> Variable:
        name = self.options.get("variable")
        if name is None:
            fields = [v for v in header.variables.values() if len(v.dims) >= 3]
            if len(fields) != 1:
                raise ValueError(f"name one variable of {[v.name for v in fields]}")
            return fields[0]
        return header.variables[name]

    def partitions(self):
        out = []
        most = int(self.options.get("slab_bytes", SLAB_BYTES))
        for path in self._files():
            header = read_header(path)
            v = self._variable(header)
            names = header.names(v)
            time = header.variables[names[0]]
            units, calendar = time.attrs["units"], time.attrs.get("calendar", "standard")
            when = year_months(read_whole(path, time), units, calendar)
            steps = [(i, y, m) for i, (y, m) in enumerate(when) if self._wanted(y, m)]
            level = None
            if len(v.dims) == 4:
                levels = read_whole(path, header.variables[names[1]]).astype(float)
                wanted = self.options.get("level")
                if wanted is None:
                    raise ValueError(f"{v.name} has levels; choose one of {levels.tolist()}")
                level = int(np.abs(levels - float(wanted)).argmin())
            ny, nx = v.shape[-2:]
            line = nx * np.dtype(v.kind).itemsize
            tall = max(1, min(ny, most // max(1, line)))
            some = max(1, most // max(1, line * tall)) if tall == ny else 1
            for at in range(0, len(steps), some):
                for r in range(0, ny, tall):
                    out.append(Slab(path, steps[at : at + some], (r, min(ny, r + tall)), level))
        return out

    def read(self, slab: Slab) -> Iterator[pa.RecordBatch]:
        header = read_header(slab.path)
        v = self._variable(header)
        names = header.names(v)
        lat, lon = (read_whole(slab.path, header.variables[n]).astype(float) for n in names[-2:])
        ny, nx = v.shape[-2:]
        r0, r1 = slab.rows
        flip = ny > 1 and lat[0] < lat[-1]
        file_rows = np.arange(r0, r1)
        row = np.repeat(((ny - 1 - file_rows) if flip else file_rows).astype(np.int32), nx)
        col = np.tile(np.arange(nx, dtype=np.int32), r1 - r0)
        lats, lons = np.repeat(lat[r0:r1], nx), np.tile(lon, r1 - r0)
        number = lambda key: float(np.ravel(v.attrs[key])[0]) if key in v.attrs and not isinstance(v.attrs[key], str) else None
        missing = {x for x in (number("_FillValue"), number("missing_value")) if x is not None}
        if "_FillValue" not in v.attrs and v.kind in DEFAULT_FILL:
            missing.add(float(np.dtype(v.kind).type(DEFAULT_FILL[v.kind])))
        scale, shift = number("scale_factor"), number("add_offset")
        plane = nx * ny
        system, at = open_file(slab.path)
        with system.open_input_file(at) as f:
            for index, year, month in slab.steps:
                before = (slab.level or 0) * plane + r0 * nx + (0 if v.step else index * prod(v.shape[1:]))
                raw = _values(f, v, 0, (r1 - r0) * nx, before, index if v.step else 0).astype(np.float64)
                bad = ~np.isfinite(raw)
                for m in missing:
                    bad |= raw == m
                x = raw if scale is None and shift is None else raw * (1.0 if scale is None else scale) + (shift or 0.0)
                n = len(raw)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, year, np.int32)), pa.array(np.full(n, month, np.int32)), pa.array(row), pa.array(col),
                        pa.array(lats), pa.array(lons), pa.array(x, mask=bad),
                    ],
                    names=["year", "month", "row", "col", "lat", "lon", "value"],
                )


class FilteringReader(NetCDFReader):
    """A reader that also takes filters: only where the session lets Python sources do so."""

    def pushFilters(self, filters):
        """Bounds on year and month prune timesteps; every filter goes back to Spark as well."""
        for x in filters:
            name = x.attribute[0] if len(getattr(x, "attribute", ())) == 1 else None
            if name not in ("year", "month"):
                yield x
                continue
            bounds = self.years if name == "year" else self.months
            if isinstance(x, EqualTo) and x.value is not None:
                bounds.append((x.value, x.value))
            elif isinstance(x, (GreaterThan, GreaterThanOrEqual)):
                bounds.append((x.value, np.inf))
            elif isinstance(x, (LessThan, LessThanOrEqual)):
                bounds.append((-np.inf, x.value))
            elif isinstance(x, In):
                self.lists.append((name, {v for v in x.value if v is not None}))
            yield x


class NetCDFSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "year int, month int, row int, col int, lat double, lon double, value double"

    def reader(self, schema):
        kind = FilteringReader if self.options.get("filters") == "true" else NetCDFReader
        return kind(schema, self.options)


def scan_netcdf(
    spark: SparkSession,
    path: str,
    variable: str | None = None,
    begin: int | None = None,
    end: int | None = None,
    level: float | None = None,
    slab_bytes: int = SLAB_BYTES,
    **identity: str,
) -> DataFrame:
    """Cells of a variable of a file, or of all ``.nc`` files below a folder; row 0 is the
    northernmost.  ``begin`` and ``end`` (years, inclusive) prune timesteps; filters on year
    and month do too where the session lets Python sources take filters
    (``spark.sql.python.filterPushdown.enabled``).  ``level``: of a fourth dimension, the
    nearest value.  ``identity`` adds constant columns (model, scenario, ...)."""
    spark.dataSource.register(NetCDFSource)
    takes = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    read = spark.read.format(FORMAT).option("slab_bytes", slab_bytes).option("filters", takes)
    for name, v in (("variable", variable), ("begin", begin), ("end", end), ("level", level)):
        if v is not None:
            read = read.option(name, v)
    return read.load(path).withColumns({k: F.lit(v) for k, v in identity.items()})


# -- writing ---------------------------------------------------------------------------------


def _text(s: str) -> bytes:
    raw = s.encode()
    return struct.pack(">i", len(raw)) + raw + b"\0" * (-len(raw) % 4)


def _attributes(attrs: dict) -> bytes:
    out = struct.pack(">ii", ATTRIBUTE if attrs else 0, len(attrs))
    for k, v in attrs.items():
        body, kind, n = (v.encode(), 2, len(v.encode())) if isinstance(v, str) else (struct.pack(">f", v), 5, 1)
        out += _text(k) + struct.pack(">ii", kind, n) + body + b"\0" * (-len(body) % 4)
    return out


def classic_header(grid: Grid, variable: str, units: str, records: int, begin_year: int) -> bytes:
    """Header of a file of one variable over (time, lat, lon), with its coordinates behind it."""
    dims = [("time", 0), ("lat", grid.ny), ("lon", grid.nx)]
    about = [
        ("lat", [1], {"units": "degrees_north"}, 6, 8 * grid.ny), ("lon", [2], {"units": "degrees_east"}, 6, 8 * grid.nx),
        ("time", [0], {"units": f"months since {begin_year:04d}-01-01", "calendar": "standard"}, 6, 8),
        (variable, [0, 1, 2], {"units": units, "_FillValue": FILL}, 5, 4 * grid.nx * grid.ny),
    ]

    def build(places: list[int]) -> bytes:
        out = b"CDF\x02" + struct.pack(">i", records) + struct.pack(">ii", DIMENSION, len(dims))
        out += b"".join(_text(n) + struct.pack(">i", k) for n, k in dims) + _attributes({}) + struct.pack(">ii", VARIABLE, len(about))
        for (name, own, attrs, kind, size), at in zip(about, places):
            out += _text(name) + struct.pack(f">i{len(own)}i", len(own), *own) + _attributes(attrs)
            out += struct.pack(">iIq", kind, min(size + -size % 4, (1 << 32) - 4), at)
        return out

    lat = len(build([0] * 4))
    lon = lat + about[0][4]
    time = lon + about[1][4]
    return build([lat, lon, time, time + 8])


FILL = -9999.0


def sink_netcdf(df: DataFrame, folder: str, grid: Grid, units: str = "1") -> None:
    """One file per series and year below ``folder``, ``<series>_<year>.nc``: float32 cells of
    one grid, NULL and absent cells as the fill value.  A task holds one timestep; a file is
    put in place when it is whole, so a task that is run again does no harm."""
    ids = present(df, ("variable", "model", "scenario"))
    stem = F.concat_ws("_", *[F.col(c) for c in ids], F.col("year").cast("string"))
    name = F.col("variable") if "variable" in ids else F.lit("value")
    rows = df.where(grid.holds()).select(stem.alias("stem"), name.alias("variable"), "year", "month", "row", "col", F.col("value").cast("float").alias("value"))
    rows = rows.repartition("stem").sortWithinPartitions("stem", "month")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = open_file(folder)
        system.create_dir(at, recursive=True)
        lat = grid.y0 - (np.arange(grid.ny) + 0.5) * grid.dy
        lon = grid.x0 + (np.arange(grid.nx) + 0.5) * grid.dx
        out = None  # stem, temporary path, stream, months

        def close(file):
            stem, path, stream, head, months, plane = file
            record(file)
            stream.close()
            # the number of records is known now: the header comes first in the file put in place
            with system.open_input_file(path) as body, system.open_output_stream(f"{path}.whole") as whole:
                whole.write(classic_header(grid, *head[:2], len(months), head[2]))
                whole.write(lat.astype(">f8").tobytes() + lon.astype(">f8").tobytes())
                for _ in range(len(months)):
                    whole.write(body.read(8 + plane.nbytes))
            system.delete_file(path)
            system.move(f"{path}.whole", f"{at}/{stem}.nc")

        def record(file):
            file[2].write(np.array([file[4][-1] - 1], ">f8").tobytes() + file[5].astype(">f4").tobytes())
            file[5][:] = FILL

        for batch in batches:
            table = batch.to_pandas()
            for (stem, month), part in table.groupby(["stem", "month"], sort=False):
                if out is None or out[0] != stem:
                    if out is not None:
                        close(out)
                    path = f"{at}/.{uuid.uuid4().hex}"
                    head = (part["variable"].iloc[0], units, int(part["year"].iloc[0]))
                    out = (stem, path, system.open_output_stream(path), head, [int(month)], np.full((grid.ny, grid.nx), FILL, np.float32))
                elif out[4][-1] != month:
                    record(out)
                    out[4].append(int(month))
                out[5][part["row"], part["col"]] = np.where(part["value"].isna(), FILL, part["value"])
        if out is not None:
            close(out)
        yield from ()

    rows.mapInArrow(write, "stem string").write.format("noop").mode("overwrite").save()
