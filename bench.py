"""Benchmark: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full with the ``noop`` sink (no driver collect).
All run on one reading per event (one series per user): the hourly table holds
only 5 series and stops growing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from thermolens.session import get_session
    spark = get_session(f"local[{cpus}]", app="thermolens-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})
    from pyspark.sql import functions as F

    from thermolens.session import ship_package
    ship_package(spark)

    from thermolens.operators.clean import prepare_readings
    from thermolens.operators.detect.zscore import zscore_any
    from thermolens.operators.features import feature_matrix
    from thermolens.plans import catalog as C
    from thermolens.sources.fixtures import readings_per_event

    def per_event(spark, sf):
        return prepare_readings(readings_per_event(spark, sf))

    # every entry works on one reading per event: none on the hourly table, which stops growing
    queries = {
        "d2_periods_per_event": C.d2_periods_per_event,
        "x1_prepare_per_event": per_event,
        "x2_feature_matrix_per_event": lambda s, sf: feature_matrix(per_event(s, sf)),
        "d3_zscore_per_event": lambda s, sf: zscore_any(per_event(s, sf)),
        **{k: q for k, q in C.PER_EVENT.items() if not k.startswith(("x2_", "d3_"))},
        "t1_stream_rollup": C.t1_stream_rollup,
        "t7_stream_periods": C.t7_stream_periods,
    }
    only = [a for a in sys.argv[1:] if not a.startswith("-")]
    times = {}
    # warm-up: JIT and first-session costs are not query time
    spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.count("*")).collect()
    for name, q in queries.items():
        if only and name not in only:
            continue
        t0 = time.time()
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
