"""Known values: freeze/thaw vectors and physical formulas."""

import math

import pytest
from pyspark.sql import functions as F

from climgrid.functions import humidity, radiation
from climgrid.functions.freeze_thaw import with_freeze_thaw
from climgrid.functions.projection import Albers

VECTORS = [
    ([-16, -5, -1, 3, 5, 10, 12, 16, 11, -3, -15, -16], 284, 83, 201, 0),
    ([-16, -5, -1, 3, 5, 10, 12, 16, 11, None, -15, -16], None, None, None, 1),
    ([1, 3, 4, 6, 7, 12, 15, 12, 8, 9, 4, 2], 365, 0, 365, 2),
    ([-16, -15, -13, -11, -10, -5, 0, -2, -4, -12, -13, -16], 0, 365, 0, 3),
    ([-16, -13, -8, -6, 1, 4, 7, 11, 8, 4, 2, 1], 350, 131, 219, 4),
    ([1, 3, 1, 5, 8, 10, 14, 11, 7, -2, -5, -2], 283, 15, 268, 5),
    ([1, 3, 1, 5, 8, 10, 14, 10, 4, -1, -4, 1], 284, 15, 269, 6),
    ([1, -5, -4, -2, 3, 5, 10, 8, 6, 4, 4, 1], 350, 117, 233, 7),
    ([-11, 1, -7, -3, 2, 6, 11, 10, 8, -1, -5, -10], 287, 123, 164, 8),
]


def test_freeze_thaw_vectors(spark):
    rows = [(i, [None if v is None else float(v) for v in m]) for i, (m, *_) in enumerate(VECTORS)]
    df = spark.createDataFrame(rows, "id int, months array<double>")
    got = {r["id"]: (r["dof"], r["dot"], r["grow"], r["kase"]) for r in with_freeze_thaw(df).collect()}
    for i, (_, dof, dot, grow, kase) in enumerate(VECTORS):
        assert got[i] == (dof, dot, grow, kase)


def test_r_compat_moves_the_split(spark):
    months = [1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, -1.0, -1.0, 1.0, 1.0, 1.0]
    df = spark.createDataFrame([(months,)], "months array<double>")
    assert with_freeze_thaw(df).first()["kase"] == 7
    assert with_freeze_thaw(df, r_compat=True).first()["kase"] == 6


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "make, want",
    [
        (lambda: humidity.saturation_vp(F.lit(20.0)), 23.325960220978),
        (lambda: humidity.vapor_pressure(F.lit(20.0), F.lit(50.0), None), 11.662980110489),
        (lambda: humidity.vapor_pressure(F.lit(20.0), F.lit(50.0)), 11.66),
        (lambda: humidity.relative_humidity(F.lit(-10.0), F.lit(2.0)), 69.678877284777),
        (lambda: radiation.surface_radiation(F.lit(30.0), F.lit(50.0)), 15.165),
        (lambda: radiation.par(F.lit(15.0), F.lit(50.0)), 8.25),
        (lambda: radiation.cloud_from_radiation(F.lit(30.0), F.lit(15.0)), 43.75),
        (lambda: radiation.extraterrestrial_radiation(F.lit(172), F.lit(math.radians(60))), 41.330695719907),
        (lambda: radiation.extraterrestrial_radiation(F.lit(172), F.lit(math.radians(75))), 43.886892821173),
        (lambda: radiation.extraterrestrial_radiation(F.lit(355), F.lit(math.radians(75))), 0.0),
        (lambda: radiation.extraterrestrial_radiation(F.lit(80), F.lit(0.0)), 37.824213107626),
        (lambda: radiation.day_length(F.lit(172), F.lit(math.radians(60))), 18.487326875085),
        (lambda: radiation.day_length(F.lit(355), F.lit(math.radians(60))), 5.513037527772),
        (lambda: radiation.day_length(F.lit(172), F.lit(math.radians(75))), 24.0),
        (lambda: radiation.day_length(F.lit(355), F.lit(math.radians(75))), 0.0),
    ],
)
def test_formulas(spark, make, want):
    assert value(spark, make()) == pytest.approx(want, abs=1e-9)


def test_albers_origin(spark):
    a = Albers()
    assert value(spark, a.latitude(F.lit(0.0), F.lit(0.0))) == pytest.approx(50.0, abs=1e-7)
    assert value(spark, a.longitude(F.lit(0.0), F.lit(0.0))) == pytest.approx(-154.0, abs=1e-9)
