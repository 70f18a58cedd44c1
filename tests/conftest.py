import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.session import session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = session(8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def grid_df(spark):
    """2-D list(s) of values as cells of one or more months."""

    def make(*slices, month=1, year=2000):
        rows = [
            (year, month + k, r, c, None if v is None else float(v))
            for k, cells in enumerate(slices)
            for r, line in enumerate(cells)
            for c, v in enumerate(line)
        ]
        return spark.createDataFrame(rows, "year int, month int, row int, col int, value double")

    return make


def as_array(df, ny, nx):
    import numpy as np

    out = np.full((ny, nx), np.nan)
    for r in df.collect():
        if r["value"] is not None:
            out[r["row"], r["col"]] = r["value"]
    return out
