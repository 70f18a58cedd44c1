"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder of the Parquet tables (default /root/testdata/sf0.1)
    BENCH_CPUS     cores of the local session (default 8)
"""

from __future__ import annotations

import json
import os
import time

from checks import load
from checks.session import session

HEADLINE = (
    "scan_series climatology anomaly_add anomaly_mult regrid_nearest regrid_bilinear regrid_average fill_gaps_linear "
    "delta_pipeline delta_pipeline_mult delta_pipeline_minmax delta_pipeline_farfuture aoi_p95 fix_precip "
    "ensemble_mean annual_grid seasonal_grid decadal_monthly zonal_metrics zonal_diff_metrics summer_warmth "
    "freeze_thaw_days departure_step ra_monthly cloud_radiation_pipeline prepare_humidity rasterize_zones "
    "point_profile fill_mask_neighbors mosaic_first join_versions pack_series sink_grid "
    "regrid_cubic regrid_lanczos fill_mask_iterative prepare_scaled_baseline prepare_mosaic_baseline join_neighbors"
).split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    queries, _ = load()
    spark = session(cpus)
    run = lambda name: queries[name](spark, sf).write.format("noop").mode("overwrite").save()
    run("climatology")  # start-up of the JVM is not part of the measurement
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
