"""What each variable needs: operation, rounding, clamp and correction."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession

from climgrid.functions.values import clamp_cloud, clamp_humidity, rint_places


@dataclass(frozen=True)
class Policy:
    operation: str
    places: int
    clamp: str | None = None
    fix_clim: bool = False
    find_bounds: bool = False
    cap: float = 95.0

    def post(self) -> Callable[[Column], Column]:
        """Clamp, then round."""
        clamps = {None: lambda x: x, "humidity": lambda x: clamp_humidity(x, self.cap), "cloud": clamp_cloud}
        return lambda x: rint_places(clamps[self.clamp](x), self.places)


# The treatment of each variable.
POLICIES = {
    "pr": Policy("mult", 0, None, True, True),
    "pre": Policy("mult", 0, None, True, True),
    "hur": Policy("mult", 1, "humidity"),
    "hurs": Policy("mult", 1, "humidity"),
    "reh": Policy("mult", 1),
    "cld": Policy("mult", 1),
    "clt": Policy("mult", 1, "cloud"),
    "tas": Policy("add", 1),
    "tasmin": Policy("add", 1),
    "tasmax": Policy("add", 1),
}


# Sources whose precipitation is corrected without a boundary of its own.
UNBOUNDED_SOURCES = ("cmip5",)


def variable_policy(variable: str, source: str | None = None, cap: float = 95.0) -> Policy:
    """The treatment of a variable; ``source`` is the project it comes from, ``cap`` what
    takes the place of a humidity over 100."""
    if variable not in POLICIES:
        raise ValueError(f"no policy for variable {variable!r}")
    found = POLICIES[variable]
    bounded = found.find_bounds and (source or "").lower() not in UNBOUNDED_SOURCES
    return replace(found, find_bounds=bounded, cap=cap)


def policy_table(spark: SparkSession) -> DataFrame:
    """The policies as a table of ten rows, for joins over mixed variables."""
    rows = [(v, p.operation, p.places, p.clamp, p.fix_clim, p.find_bounds) for v, p in POLICIES.items()]
    return spark.createDataFrame(
        rows, "variable string, operation string, places int, clamp string, fix_clim boolean, find_bounds boolean"
    )
