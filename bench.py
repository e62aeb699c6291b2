"""Benchmark: run the registered queries on ``$BENCH_SF_DIR`` and print one
JSON line with per-query wall seconds.

Each query is fully executed with the ``noop`` sink (all rows computed, none
collected). A warm-up query runs first so JVM start-up is not charged to q1.
Each query first runs ``$BENCH_WARMUP`` unmeasured times (default 1: code
generation and JIT), then ``$BENCH_REPEAT`` measured times (default 3); the
median is reported. Plan construction is inside the measured time. Stream
replays, which run a whole streaming query, are measured once, reported under
``replays`` and not part of the total; ``$BENCH_REPLAYS=0`` leaves them out.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlens.plans import BATCH_QUERIES, QUERIES, REPLAYS  # noqa: E402
from fleetlens.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    replays = list(REPLAYS) if os.environ.get("BENCH_REPLAYS", "1") != "0" else []
    names = sys.argv[1:] or [*BATCH_QUERIES, *replays]
    spark = build_session(
        f"local[{cpus}]",
        app_name="fleetlens-bench",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(cpus, 8))),
        extra={"spark.driver.memory": "16g"},
    )
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    warmup = int(os.environ.get("BENCH_WARMUP", "1"))
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        try:
            once = name in REPLAYS
            for _ in range(0 if once else warmup):
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs = []
            for _ in range(1 if once else repeat):
                t0 = time.perf_counter()  # plan construction included (some cut lineage eagerly)
                df = QUERIES[name](spark, sf_dir)
                df.write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(runs), 3)
        except Exception as exc:  # noqa: BLE001 - report and keep measuring the rest
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(t for n, t in times.items() if t is not None and n not in REPLAYS), 3),
        "unit": "sec",
        "queries": {n: t for n, t in times.items() if n not in REPLAYS},
        "replays": {n: t for n, t in times.items() if n in REPLAYS},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }
    if errors:
        result["errors"] = errors
    print(json.dumps(result))


if __name__ == "__main__":
    main()
