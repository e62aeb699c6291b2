"""Streaming throughput: replay the pings/fares of a scale factor as N JSON
files (one micro-batch each) through the main flows; print events/s.

Usage: python tools/stream_bench.py [sf_dir] [n_files]
Writes its input files and checkpoints under a fresh scratch folder.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time
import uuid

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from fleetlens.session import build_session  # noqa: E402
from fleetlens.sources.fixtures import load_fares, load_locations  # noqa: E402
from fleetlens.streaming import jobs, sinks, sources  # noqa: E402
from streamkit import split_frames, write_batches  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    root = tempfile.mkdtemp(prefix="stream-bench-")
    spark = build_session("local[8]", shuffle_partitions=8, checkpoint_dir=os.path.join(root, "ckpt"))
    locs = load_locations(spark, sf).toPandas()
    fares = load_fares(spark, sf).toPandas().drop(columns=["arrivalTs"])
    write_batches(os.path.join(root, "loc"), split_frames(locs, n))
    write_batches(os.path.join(root, "fares"), split_frames(fares, n))
    run = uuid.uuid4().hex[:6]

    def loc():
        return sources.location_file_stream(spark, os.path.join(root, "loc"), max_files_per_trigger=1)

    flows = {
        "speed_alerts": (lambda: jobs.speed_alert_flow(loc()), len(locs)),
        "revenue": (lambda: jobs.revenue_flow(sources.fare_file_stream(spark, os.path.join(root, "fares"), max_files_per_trigger=1)), len(fares)),
        "occupancy_coalesced": (lambda: jobs.occupancy_flow(jobs.delta_flow(loc()), every_update=False), len(locs)),
        "occupancy_changelog": (lambda: jobs.occupancy_flow(jobs.delta_flow(loc())), len(locs)),
    }
    # two rounds (each query replays all files from scratch); the first warms
    # up Python workers and state stores, the second is reported
    for rnd in range(2):
        for name, (build, events) in flows.items():
            t0 = time.perf_counter()
            q = sinks.start(build(), f"sb_{name}_{run}_{rnd}", fmt="noop")
            q.awaitTermination()
            dt = time.perf_counter() - t0
            if rnd == 1:
                print(f"{name:22s} {events:8d} events in {dt:6.1f}s over {n} micro-batches = {events / dt:10,.0f} events/s")
    spark.stop()


if __name__ == "__main__":
    main()
