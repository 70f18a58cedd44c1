"""NetCDF files written here, byte by byte and by the sink, read back cell for cell."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from climgrid.grid import Grid
from climgrid.sources import netcdf


def name(s):
    return struct.pack(">i", len(s)) + s.encode() + b"\0" * (-len(s) % 4)


def attribute(k, v):
    if isinstance(v, str):
        return name(k) + struct.pack(">ii", 2, len(v)) + v.encode() + b"\0" * (-len(v) % 4)
    return name(k) + struct.pack(">iid", 6, 1, v)


def attributes(attrs):
    return struct.pack(">ii", 12 if attrs else 0, len(attrs)) + b"".join(attribute(k, v) for k, v in attrs.items())


def classic(dims, variables, records, version=1):
    """A whole file: dims (name, length; 0 for records), variables (name, dims, attrs, type
    number, big-endian array)."""
    wide = ">i" if version < 5 else ">q"
    place = ">i" if version == 1 else ">q"
    sizes = dict(dims)

    def build(places):
        out = b"CDF" + bytes([version]) + struct.pack(wide, records)
        if version == 5:
            fix = lambda b: b
        out += struct.pack(">i", 10) + struct.pack(wide, len(dims))
        out += b"".join((name(n) if version < 5 else struct.pack(">q", len(n)) + n.encode() + b"\0" * (-len(n) % 4)) + struct.pack(wide, k) for n, k in dims)
        out += struct.pack(">i", 0) + struct.pack(wide, 0) + struct.pack(">i", 11) + struct.pack(wide, len(variables))
        for (n, own, attrs, kind, data), at in zip(variables, places):
            if version < 5:
                out += name(n) + struct.pack(f">i{len(own)}i", len(own), *[[d for d, _ in dims].index(d) for d in own]) + attributes(attrs)
            else:
                out += struct.pack(">q", len(n)) + n.encode() + b"\0" * (-len(n) % 4)
                out += struct.pack(f">q{len(own)}q", len(own), *[[d for d, _ in dims].index(d) for d in own])
                out += struct.pack(">i", 12 if attrs else 0) + struct.pack(">q", len(attrs))
                for k, v in attrs.items():
                    out += struct.pack(">q", len(k)) + k.encode() + b"\0" * (-len(k) % 4) + struct.pack(">iq", 2, len(v)) + v.encode() + b"\0" * (-len(v) % 4)
            out += struct.pack(">i", kind) + struct.pack(wide, 0) + struct.pack(place, at)
        return out

    recorded = [bool(own and sizes[own[0]] == 0) for _, own, *_ in variables]
    alone = sum(recorded) == 1
    size = [(len(d[:1].tobytes()) if r else len(d.tobytes())) for (*_, d), r in zip(variables, recorded)]
    padded = [s if r and alone else s + -s % 4 for s, r in zip(size, recorded)]
    at, places = len(build([0] * len(variables))), [0] * len(variables)
    for i, r in enumerate(recorded):
        if not r:
            places[i], at = at, at + padded[i]
    for i, r in enumerate(recorded):
        if r:
            places[i], at = at, at + padded[i]
    out = build(places)
    for (*_, d), r, p in zip(variables, recorded, padded):
        if not r:
            out += d.tobytes().ljust(p, b"\0")
    for k in range(records):
        for (*_, d), r, p in zip(variables, recorded, padded):
            if r:
                out += d[k : k + 1].tobytes().ljust(p, b"\0")
    return out


def cells(df, *names):
    return {(r.year, r.month, r.row, r.col): tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("version", [1, 2, 5])
def test_records_from_south_to_north(spark, tmp_path, version):
    data = np.arange(5 * 3 * 4, dtype=">f4").reshape(5, 3, 4)
    data[1, 2, 3] = -9999
    data[2, 0, 0] = np.nan
    time = np.array([15, 45, 74, 700, 730], ">f8")
    attrs = {"units": "days since 1999-01-01", "calendar": "noleap"}
    fill = {"_FillValue": -9999.0} if version < 5 else {}
    raw = classic(
        [("time", 0), ("lat", 3), ("lon", 4)],
        [("lat", ["lat"], {}, 6, np.array([10, 20, 30], ">f8")), ("lon", ["lon"], {}, 5, np.array([0, 1, 2, 3], ">f4")),
         ("time", ["time"], attrs, 6, time), ("odd", ["time"], {}, 3, np.arange(5, dtype=">i2")), ("tas", ["time", "lat", "lon"], fill, 5, data)],
        5, version,
    )
    (tmp_path / "a.nc").write_bytes(raw)
    got = cells(netcdf.scan_netcdf(spark, str(tmp_path / "a.nc")), "lat", "lon", "value")
    when = [(1999, 1), (1999, 2), (1999, 3), (2000, 12), (2001, 1)]
    assert len(got) == 60
    for k, (y, m) in enumerate(when):
        for r in range(3):
            for c in range(4):
                v = float(data[k, 2 - r, c])
                missing = v != v or (v == -9999 and version < 5)
                assert got[y, m, r, c] == (30.0 - 10 * r, float(c), None if missing else v)


def test_packed_values_levels_and_a_file_without_records(spark, tmp_path):
    data = np.arange(2 * 2 * 2 * 3, dtype=">i2").reshape(2, 2, 2, 3)
    data[0, 1, 0, 0] = -32767
    raw = classic(
        [("time", 2), ("plev", 2), ("lat", 2), ("lon", 3)],
        [("time", ["time"], {"units": "months since 2299-12-01"}, 4, np.array([0, 1], ">i4")), ("plev", ["plev"], {}, 6, np.array([1000, 850], ">f8")),
         ("lat", ["lat"], {}, 6, np.array([60, 50], ">f8")), ("lon", ["lon"], {}, 6, np.array([0, 1, 2], ">f8")),
         ("hus", ["time", "plev", "lat", "lon"], {"scale_factor": 0.5, "add_offset": 10.0}, 3, data)],
        0, 2,
    )
    (tmp_path / "b.nc").write_bytes(raw)
    got = cells(netcdf.scan_netcdf(spark, str(tmp_path / "b.nc"), "hus", level=840.0, model="M"), "value", "model")
    assert got[2299, 12, 0, 0] == (None, "M") and got[2300, 1, 1, 2] == (23 * 0.5 + 10, "M")
    with pytest.raises(Exception, match="levels"):
        netcdf.scan_netcdf(spark, str(tmp_path / "b.nc")).count()


@pytest.fixture(scope="module")
def series(spark, tmp_path_factory):
    grid = Grid(6, 4, 0.0, 4.0, 1.0, 1.0)
    rows = [
        ("tas", "M1", y, m, r, c, None if (r, c) == (1, 1) else float(y * 100 + m * 10 + r + c / 8))
        for y in range(2000, 2005) for m in range(1, 13) for r in range(4) for c in range(6) if (r, c) != (3, 5)
    ]
    df = spark.createDataFrame(rows, "variable string, model string, year int, month int, row int, col int, value double").repartition(5)
    folder = str(tmp_path_factory.mktemp("nc") / "out")
    netcdf.sink_netcdf(df, folder, grid, "C")
    return df, folder


def test_written_files_come_back(spark, series):
    df, folder = series
    got = netcdf.scan_netcdf(spark, folder, "tas")
    names = ["year", "month", "row", "col", "value"]
    assert got.count() == 5 * 12 * 24
    a, b = df.where("value is not null").select(names), got.where("value is not null").select(names)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert got.where("row = 0 and col = 0").select("lat", "lon").distinct().collect() == [(3.5, 0.5)]


def test_a_file_is_many_tasks_and_years_are_pruned(spark, series):
    _, folder = series
    tasks = lambda df: df.rdd.getNumPartitions()
    assert tasks(netcdf.scan_netcdf(spark, folder)) == 5
    assert tasks(netcdf.scan_netcdf(spark, folder, slab_bytes=4 * 24)) == 60
    rows = netcdf.scan_netcdf(spark, folder, slab_bytes=4 * 6 * 2)
    assert tasks(rows) == 120 and rows.count() == 5 * 12 * 24
    few = netcdf.scan_netcdf(spark, folder, begin=2001, end=2002)
    assert tasks(few) == 2 and few.select("year").distinct().count() == 2
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        found = netcdf.scan_netcdf(spark, folder).where((F.col("year") >= 2003) & F.col("month").isin(1, 2) & (F.col("row") == 0))
        assert tasks(found) == 2 and found.count() == 2 * 2 * 6
        assert netcdf.scan_netcdf(spark, folder).where("year = 2001 and value > 0").count() == 12 * 22
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_calendars():
    at = lambda v, units, cal="standard": netcdf.year_months(np.array(v, float), units, cal)
    assert at([0, 31, 59, 60, 366], "days since 2000-01-01") == [(2000, 1), (2000, 2), (2000, 2), (2000, 3), (2001, 1)]
    assert at([59, 60], "days since 2000-01-01 00:00:00", "365_day") == [(2000, 3), (2000, 3)]
    assert at([59, 60, 360], "days since 2000-01-01", "360_day") == [(2000, 2), (2000, 3), (2001, 1)]
    assert at([24 * 31, 24 * 31 - 1], "hours since 1850-01-01 00:00") == [(1850, 2), (1850, 1)]
    assert at([0, 11, 12], "months since 1850-02-01") == [(1850, 2), (1851, 1), (1851, 2)]
    with pytest.raises(ValueError):
        at([0], "days since 2000-01-01", "julian")


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        netcdf.parse_header(b"\x89HDF\r\n\x1a\n" + b"\0" * 100)
