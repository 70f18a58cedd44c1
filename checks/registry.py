"""Query registry and the shared part of the comparison SQL."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, functions as F

from climgrid.functions.projection import PROJECTIONS, Albers

QUERIES: dict = {}
SQL: dict[str, str] = {}
ALBERS = Albers()
LAMBERT = PROJECTIONS["EPSG:3347"]


def query(name: str, sql: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` and, where SQL can say it, its SQL."""

    def add(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_ctes(sql)
        return fn

    return add


# Six decimals for comparison.  Averages of sixteenths often end exactly on half of the
# last place, where engines that add in another order part; the small offset moves the
# borders away from short fractions.  No negative zero.
_OFF = 0.1372913


def r6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c * 1e6 + _OFF) / 1e6 + 0.0


def R6(x: str) -> str:
    return f"(round_even(({x}) * 1e6 + {_OFF}e0, 0) / 1e6 + 0e0)"


def R(x: str, places: int = 0) -> str:
    """Half-even rounding to places."""
    p = f"1e{places}"
    return f"round_even(({x}) * {p}, 0) / {p}" if places else f"round_even(({x}), 0)"


def q16(x: str) -> str:
    return f"floor(({x}) * 16 + 0.5e0) / 16"


_SEASONAL = "5 * abs(month - 7)"
_VARIABLES = {
    "tas": q16(f"q / n - 10.5e0 - {_SEASONAL}"),
    "tasmin": q16(f"mn - 10.5e0 - {_SEASONAL}"),
    "tasmax": q16(f"mx - 10.5e0 - {_SEASONAL}"),
    "pr": q16("greatest(0e0, t / n - 2) * 10"),
    "clt": q16("d / n * 10"),
    "hur": q16("d / n * 20 - 20"),
    "vap": q16("q / n / 5"),
}
_BASE = {
    "tas": q16(f"p_size / 5e0 + 10 - {_SEASONAL}"),
    "pr": "CAST(p_size + 3 * month AS DOUBLE)",
    "clt": "CAST(p_size * 2 AS DOUBLE)",
}

_SUMS = (
    "CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS n, "
    "sum(l_quantity) AS q, min(l_quantity) AS mn, max(l_quantity) AS mx, "
    "sum(round(l_discount * 100)) AS d, sum(round(l_tax * 100)) AS t FROM lineitem"
)
_CELL = "CAST(k // nx AS INTEGER) AS row, CAST(k % nx AS INTEGER) AS col"
_SCENARIO = "CASE WHEN year <= 1999 THEN 'historical' ELSE 'rcp60' END AS scenario"

CTES: dict[str, str] = {
    "g": "SELECT CAST(ceil(sqrt(count(*))) AS INTEGER) AS nx, "
    "CAST(ceil(count(*) / ceil(sqrt(count(*)))) AS INTEGER) AS ny FROM supplier",
    "sup": f"SELECT {_CELL}, s_nationkey, CASE WHEN s_acctbal >= 0 THEN 1 ELSE 0 END AS inside "
    "FROM (SELECT s_suppkey AS k, * FROM supplier), g",
    "raw": f"SELECT l_suppkey AS k, {_SUMS} GROUP BY ALL",
    "rawm": f"SELECT l_suppkey AS k, 'M' || (l_orderkey % 5) AS model, {_SUMS} GROUP BY ALL",
    "rawv": f"SELECT l_suppkey AS k, l_linestatus AS version, {_SUMS} GROUP BY ALL",
    "zones": "SELECT row, col, s_nationkey AS zone_id, n_name AS zone_name FROM sup JOIN nation ON n_nationkey = s_nationkey",
    "months": "SELECT CAST(range AS INTEGER) AS month FROM range(1, 13)",
    "fine": "SELECT CAST(p_partkey // (4 * nx) AS INTEGER) AS row, CAST(p_partkey % (4 * nx) AS INTEGER) AS col, p_size, "
    "CASE WHEN p_size > 10 THEN 1 ELSE 0 END AS inside, nx, ny FROM part, g",
    "rings": "SELECT n_nationkey AS zone_id, n_name AS zone_name, "
    "CASE WHEN n_regionkey < 2 THEN [a, a + 61.3e0, a + 61.3e0, a, a] "
    "WHEN n_regionkey = 2 THEN [a, a + 61.3e0, a + 20.3e0, a] "
    "ELSE [a, a + 61.3e0, a + 61.3e0, a + 30.1e0, a, a] END AS xs, "
    "CASE WHEN n_regionkey < 2 THEN [b, b, b + 47.9e0, b + 47.9e0, b] "
    "WHEN n_regionkey = 2 THEN [b, b, b + 47.9e0, b] "
    "ELSE [b, b, b + 47.9e0, b + 11.3e0, b + 47.9e0, b] END AS ys "
    "FROM (SELECT *, 14.4e0 * n_nationkey + 1.7e0 AS a, 5.1e0 * n_nationkey - 80.3e0 AS b FROM nation)",
    "edges": "SELECT zone_id, xs[i] AS x1, ys[i] AS y1, xs[i + 1] AS x2, ys[i + 1] AS y2 "
    "FROM (SELECT *, unnest(range(1, len(xs))) AS i FROM rings)",
    "inzone": "SELECT zone_id, row, col FROM (SELECT row, col, (col + 0.5e0) * (360e0 / nx) AS px, "
    "90 - (row + 0.5e0) * (180e0 / ny) AS py FROM g, "
    "(SELECT unnest(range(0, ny)) AS row FROM g), (SELECT unnest(range(0, nx)) AS col FROM g)) "
    "JOIN edges ON ((y1 > py) <> (y2 > py)) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1) "
    "GROUP BY zone_id, row, col HAVING count(*) % 2 = 1",
}
for _v, _e in _VARIABLES.items():
    CTES[f"cells_{_v}"] = f"SELECT year, month, {_SCENARIO}, {_CELL}, {_e} AS value FROM raw, g"
    CTES[f"gappy_{_v}"] = (
        f"SELECT c.year, c.month, c.scenario, c.row, c.col, CASE WHEN inside = 1 THEN value END AS value "
        f"FROM cells_{_v} c JOIN sup USING (row, col)"
    )
    CTES[f"model_{_v}"] = f"SELECT model, year, month, {_SCENARIO}, {_CELL}, {_e} AS value FROM rawm, g"
    CTES[f"ens_{_v}"] = (
        f"SELECT year, month, scenario, row, col, avg(value) AS value FROM model_{_v} "
        "GROUP BY ALL HAVING count(*) = 5"
    )
    for _name, _status in (("old", "O"), ("new", "F")):
        CTES[f"{_name}_{_v}"] = (
            f"SELECT year, month, {_CELL}, {_e} AS value FROM rawv, g WHERE version = '{_status}'"
        )
    CTES[f"clim_{_v}"] = (
        f"SELECT row, col, month, avg(value) AS clim FROM cells_{_v} WHERE year BETWEEN 1995 AND 1999 GROUP BY ALL"
    )
for _v, _e in _BASE.items():
    CTES[f"base_{_v}"] = f"SELECT row, col, month, inside, nx, ny, {_e} AS value FROM fine, months"


def fine_place(extra: str = "") -> str:
    """Fractional source position of fine cells, float noise removed."""
    denoise = lambda e: f"round_even(({e}) * 1e9, 0) / 1e9"
    fx = denoise("((0e0 + (col + 0.5e0) * (360e0 / (4 * nx))) - 0e0) / (360e0 / nx) - 0.5e0")
    fy = denoise("(90e0 - (90e0 - (row + 0.5e0) * (180e0 / (5 * ny)))) / (180e0 / ny) - 0.5e0")
    return f"{fx} AS fx, {fy} AS fy{extra}"


def bilinear_sql(anoms: str, target: str = "fine", cols: str = "", on: str = "", place: str | None = None) -> str:
    """SELECT of bilinear values of the coarse relation ``anoms`` (year, month, row, col,
    value) on the fine cells ``target``; ``cols`` are kept columns of the target."""
    denoise = lambda e: f"round_even(({e}) * 1e9, 0) / 1e9"
    keep = f", {cols}" if cols else ""
    cond = f"AND {on}" if on else ""
    w = {"00": "(1 - ty) * (1 - tx)", "01": "(1 - ty) * tx", "10": "ty * (1 - tx)", "11": "ty * tx"}
    num = "0e0" + "".join(f" + coalesce({e} * v{k}, 0e0)" for k, e in w.items())
    den = "0e0" + "".join(f" + CASE WHEN v{k} IS NOT NULL THEN {e} ELSE 0e0 END" for k, e in w.items())
    joins = " ".join(
        f"LEFT JOIN (SELECT year, month, row, col, value AS v{i}{j} FROM {anoms}) a{i}{j} "
        f"ON a{i}{j}.year = p.year AND a{i}{j}.month = p.month AND a{i}{j}.row = p.r0 + {i} AND a{i}{j}.col = (p.c0 + {j}) % p.nx"
        for i in (0, 1)
        for j in (0, 1)
    )
    return (
        f"SELECT p.* EXCLUDE (tx, ty, r0, c0, nx), CASE WHEN {den} > 1e-6 THEN ({num}) / ({den}) END AS rv FROM "
        f"(SELECT t.year, t.month, f.row, f.col{keep}, f.nx, CAST(floor(fy) AS INTEGER) AS r0, "
        f"CAST(((floor(fx) % f.nx) + f.nx) % f.nx AS INTEGER) AS c0, {denoise('fx - floor(fx)')} AS tx, {denoise('fy - floor(fy)')} AS ty "
        f"FROM (SELECT *, {place or fine_place()} FROM {target}) f JOIN (SELECT DISTINCT year, month FROM {anoms}) t ON true {cond}) p {joins}"
    )


def albers_lonlat(x: str, y: str, columns: str, source: str) -> str:
    """SELECT of ``columns``, lat and lon of projected coordinates."""
    e2, e, n, c, rho0 = ALBERS._constants()
    pole = 1 - (1 - e2) / (2 * e) * math.log((1 - e) / (1 + e))
    k2, k4, k6 = e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040, 23 * e2**2 / 360 + 251 * e2**3 / 3780, 761 * e2**3 / 45360
    d = lambda v: f"CAST({v!r} AS DOUBLE)"
    q = f"(({d(c)} - rho2 * {d(n * n / (ALBERS.a * ALBERS.a))}) / {d(n)})"
    return (
        f"SELECT {columns}, degrees(beta + sin(beta * 2) * {d(k2)} + sin(beta * 4) * {d(k4)} + sin(beta * 6) * {d(k6)}) AS lat, "
        f"degrees(atan2(x, {d(rho0)} - y)) / {d(n)} + -154 AS lon FROM (SELECT *, asin(greatest(-1e0, least(1e0, {q} / {d(pole)}))) AS beta "
        f"FROM (SELECT *, x * x + ({d(rho0)} - y) * ({d(rho0)} - y) AS rho2 FROM (SELECT *, {x} AS x, {y} AS y FROM {source})))"
    )


def lambert_lonlat(x: str, y: str, columns: str, source: str) -> str:
    """SELECT of ``columns``, lat and lon of coordinates of a conformal conic (n > 0)."""
    e2, _, n, big_f, rho0 = LAMBERT._constants()
    d = lambda v: f"CAST({v!r} AS DOUBLE)"
    k = (
        e2 / 2 + 5 * e2**2 / 24 + e2**3 / 12 + 13 * e2**4 / 360, 7 * e2**2 / 48 + 29 * e2**3 / 240 + 811 * e2**4 / 11520,
        7 * e2**3 / 120 + 81 * e2**4 / 1120, 4279 * e2**4 / 161280,
    )
    series = " + ".join(f"sin(chi * {2 * i + 2}) * {d(c)}" for i, c in enumerate(k))
    return (
        f"SELECT {columns}, degrees(chi + {series}) AS lat, degrees(atan2(dx, dy)) / {d(n)} + {d(LAMBERT.lon_0)} AS lon FROM (SELECT *, "
        f"{d(math.pi / 2)} - atan(pow(sqrt(dx * dx + dy * dy) / {d(LAMBERT.a * big_f)}, {d(1 / n)})) * 2 AS chi "
        f"FROM (SELECT *, {x} - {d(LAMBERT.x_0)} AS dx, {d(rho0)} - ({y} - {d(LAMBERT.y_0)}) AS dy FROM {source}))"
    )


CTES["lambert"] = lambert_lonlat(
    "(4000000e0 + (col + 0.5e0) * (4000000e0 / (4 * nx)))", "(4000000e0 - (row + 0.5e0) * (4000000e0 / (5 * ny)))",
    "row, col, p_size, inside, nx, ny", "fine",
)
# the fine cells on a projected grid of 4000 by 4000 km
CTES["proj"] = albers_lonlat(
    "-2000000e0 + (col + 0.5e0) * (4000000e0 / (4 * nx))", "2400000e0 - (row + 0.5e0) * (4000000e0 / (5 * ny))",
    "row, col, p_size, inside, nx, ny", "fine",
)
PROJ_PLACE = (
    "round_even((lon / (360e0 / nx) - 0.5e0) * 1e9, 0) / 1e9 AS fx, round_even(((90 - lat) / (180e0 / ny) - 0.5e0) * 1e9, 0) / 1e9 AS fy"
)


def with_ctes(sql: str) -> str:
    """Prefix the statement with the CTEs it uses, in order of definition."""
    need: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in need and re.search(rf"(?<![\w.]){name}(?![\w(])", text):
                need.add(name)
                visit(CTES[name])

    visit(sql)
    if not need:
        return sql
    ordered: list[str] = []

    def place(name: str) -> None:
        if name in ordered:
            return
        for other in CTES:
            if other in need and other != name and re.search(rf"(?<![\w.]){other}(?![\w(])", CTES[name]):
                place(other)
        ordered.append(name)

    for name in CTES:
        if name in need:
            place(name)
    head = ", ".join(f"{n} AS ({CTES[n]})" for n in ordered)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {head}, {body[5:]}"
    return f"WITH {head} {body}"
