"""The delta method end to end.

coarse cells -> climatology -> anomaly -> stencil -> one join with the fine baseline
-> combine -> post function -> mask.  Everything before that join is of coarse size.
The join attaches resampled anomaly and monthly baseline at once, and what follows
it is row by row, so the fine grid is shuffled at most once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from climgrid.grid import Grid
from climgrid.operators.climate import (
    anomaly,
    check_operation,
    climatology,
    combine,
    concat_series,
    delta_to_mean,
    require_overlap,
    restrict_times,
)
from climgrid.operators.gaps import fill_gaps
from climgrid.operators.precip import fix_precip
from climgrid.operators.regrid import regrid
from climgrid.operators.select import select_years
from climgrid.plans.policy import Policy, variable_policy
from climgrid.schema import CELL, TIME, shared
from climgrid.storage import join_dealt

Post = Callable[[Column], Column]


def fill_method(fill: bool | str) -> str:
    return fill if isinstance(fill, str) else "axes"


def refine_anomalies(
    anomalies: DataFrame,
    baseline: DataFrame,
    src_grid: Grid,
    dst_grid: Grid,
    operation: str,
    method: str = "bilinear",
    post: Post | None = None,
    mask: DataFrame | None = None,
) -> DataFrame:
    """Coarse anomalies on the baseline's cells, combined with it.

    ``baseline`` holds row, col, value, inside (optional) and the keys it shares with
    the series: ``month`` for a climatology, ``year`` and ``month`` for a full series.
    The result keeps the resampled ``anomaly`` next to ``value``.  A mask on the fine
    grid is joined to the baseline, before that is repeated over time.
    """
    check_operation(operation)
    on = tuple(shared(anomalies, baseline, ("project", "model", "scenario", "variable") + TIME))
    target = baseline.withColumnRenamed("value", "_base")
    if mask is not None:
        keys = shared(target, mask, CELL)
        target = join_dealt(target, mask.select(*keys, "inside"), keys, "left")
    out = regrid(anomalies, target, src_grid, dst_grid, method, on).withColumnRenamed("value", "anomaly")
    value = combine(F.col("_base"), F.col("anomaly"), operation)
    if post is not None:
        value = post(value)
    if mask is not None:
        value = F.when(F.col("inside") == 1, value)
    return out.withColumn("value", value).drop("_base", "inside")


def coarse_anomalies(
    historical: DataFrame,
    future: DataFrame | None,
    begin: int,
    end: int,
    operation: str,
    src_grid: Grid | None = None,
    fix_clim: bool = False,
    fill: bool | str = False,
    find_bounds: bool = False,
    aoi_mask: DataFrame | None = None,
) -> DataFrame:
    """Anomalies of the future series where there is one, else of the historical.

    The climatology may draw on both.  Filling works within a timestep, so it is done on
    each side by itself and the future never has to be cut out of the whole again; only
    the precipitation correction, whose boundary is that of the first timestep of the
    whole series, needs that.
    """
    whole = historical if future is None else concat_series(historical, future)
    if fix_clim:
        series, clim = fix_precip(whole, src_grid, begin, end, aoi_mask, find_bounds, src_grid if fill else None, fill_method(fill))
        if future is not None:
            series = restrict_times(series, future)
        return anomaly(series, clim, operation)
    wanted = historical if future is None else future
    if fill:
        # the base period is cut before filling: other years need not be filled for it
        filled = lambda df: fill_gaps(df, src_grid, fill_method(fill))
        base = filled(select_years(whole, begin, end))
        return anomaly(filled(wanted), climatology(base, begin, end, serve=wanted), operation)
    return anomaly(wanted, climatology(whole, begin, end, serve=wanted), operation)


def delta_pipeline(
    historical: DataFrame,
    baseline: DataFrame,
    src_grid: Grid,
    dst_grid: Grid,
    *,
    future: DataFrame | None = None,
    begin: int = 1961,
    end: int = 1990,
    operation: str = "add",
    method: str = "bilinear",
    post: Post | None = None,
    mask: DataFrame | None = None,
    fix_clim: bool = False,
    fill: bool | str = False,
    find_bounds: bool = False,
    aoi_mask: DataFrame | None = None,
    check: bool = True,
) -> DataFrame:
    """Refine a monthly series onto the grid of a baseline climatology.

    ``fill`` fills gaps of the coarse series first, by a method of ``fill_gaps`` (True: axes).
    ``check`` raises at once if no month of either series lies in the base period.
    """
    if check:
        require_overlap(historical if future is None else concat_series(historical, future), begin, end)
    anoms = coarse_anomalies(
        historical, future, begin, end, operation, src_grid, fix_clim, fill, find_bounds, aoi_mask
    )
    return refine_anomalies(anoms, baseline, src_grid, dst_grid, operation, method, post, mask)


def delta_pipeline_mixed(
    historical: DataFrame,
    baseline: DataFrame,
    src_grid: Grid,
    dst_grid: Grid,
    variables: list[str],
    *,
    future: DataFrame | None = None,
    source: str | None = None,
    **options,
) -> DataFrame:
    """Several variables (models, scenarios) of one table by their policies, as one plan.

    Series and ``baseline`` have a ``variable`` column.  Variables of equal treatment run
    together, so there are as many refinements as treatments, not as variables.
    ``options`` are those of ``delta_pipeline``.
    """
    groups: dict[Policy, list[str]] = {}
    for name in variables:
        groups.setdefault(variable_policy(name, source), []).append(name)
    parts = []
    for p, names in groups.items():
        own = lambda df: df.where(F.col("variable").isin(*names))  # noqa: B023, E731
        parts.append(
            delta_pipeline(
                own(historical), own(baseline), src_grid, dst_grid, future=None if future is None else own(future),
                operation=p.operation, post=p.post(), fix_clim=p.fix_clim, find_bounds=p.find_bounds, **options,
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def delta_pipeline_minmax(
    extreme: DataFrame,
    mean: DataFrame,
    fine_mean: DataFrame,
    src_grid: Grid,
    dst_grid: Grid,
    *,
    operation: str = "add",
    method: str = "bilinear",
    fill: bool | str = False,
    post: Post | None = None,
    mask: DataFrame | None = None,
) -> DataFrame:
    """Refine a minimum or maximum: its delta to the coarse mean is laid on the already
    refined mean series of the same time.  Gaps are filled in the deltas."""
    deltas = delta_to_mean(extreme, mean, operation)
    if fill:
        deltas = fill_gaps(deltas, src_grid, fill_method(fill))
    base = fine_mean.drop("variable", "anomaly")
    return refine_anomalies(deltas, base, src_grid, dst_grid, operation, method, post, mask)


def delta_pipeline_farfuture(
    historical: DataFrame,
    future: DataFrame,
    baseline: DataFrame,
    src_grid: Grid,
    dst_grid: Grid,
    *,
    begin: int = 1961,
    end: int = 1990,
    operation: str = "add",
    method: str = "bilinear",
    post: Post | None = None,
    mask: DataFrame | None = None,
) -> DataFrame:
    """Climatology from the historical series only, values from the future only; years
    are integers, so nothing limits how far it runs."""
    anoms = anomaly_farfuture(historical, future, begin, end, operation)
    return refine_anomalies(anoms, baseline, src_grid, dst_grid, operation, method, post, mask)


def anomaly_farfuture(historical: DataFrame, future: DataFrame, begin: int, end: int, operation: str) -> DataFrame:
    return anomaly(future, climatology(historical.drop("scenario"), begin, end), operation)
