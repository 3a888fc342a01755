"""Time every query key at one scale factor; print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
8), BENCH_KEYS (optional comma list). Each query is fully executed with the
``noop`` sink, which runs the whole plan without collecting rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkfit.plans.queries import QUERIES  # noqa: E402
from sparkfit.plans.tables import INPUT_PARTITIONS  # noqa: E402
from sparkfit.session import build_session, clear_scratch  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="sparkfit-bench",
                          extra={"spark.driver.memory": "16g", INPUT_PARTITIONS: str(cpus)})
    # Warm the JVM outside the timings (class loading, JIT, the code
    # generator; Parquet read and write paths) on the 5-row region table, so
    # the first keys are not charged for JVM start-up. No result is reused.
    from pyspark.sql import Window, functions as F
    warm = spark.read.parquet(f"{sf_dir}/region.parquet")
    text = warm.select("*", F.split(F.regexp_replace(F.concat_ws(",", *warm.columns), "[^a-z]+", " "),
                                    " ").alias("w"))
    joined = text.join(warm.groupBy(warm.columns[0]).count(), warm.columns[0])
    joined.select("*", F.row_number().over(Window.orderBy(warm.columns[0])).alias("r")) \
        .write.format("noop").mode("overwrite").save()
    times, errors = {}, {}
    for key, fn in QUERIES.items():
        if only and key not in only:
            continue
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[key] = round(time.perf_counter() - t0, 3)
        except Exception as exc:          # report and keep timing the other keys
            errors[key] = f"{type(exc).__name__}: {str(exc)[:200]}"
        clear_scratch(spark)
    spark.stop()
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
