"""Run every streaming flow over JSON record folders (or Kafka topics).

    python -m fleetlens --locations DIR --fares DIR --out DIR [--once]
    python -m fleetlens --kafka HOST:PORT --out DIR

Each flow is its own query with its own checkpoint under the session's
``spark.checkpoint.dir``; restarting with the same ``--name-prefix`` resumes.
"""

from __future__ import annotations

import argparse
import sys

from fleetlens.session import build_session
from fleetlens.settings import JobSettings
from fleetlens.streaming import jobs, sources


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="fleetlens")
    ap.add_argument("--locations", help="folder of location JSON files")
    ap.add_argument("--fares", help="folder of fare JSON files")
    ap.add_argument("--kafka", help="bootstrap servers; reads the location and fare topics")
    ap.add_argument("--location-topic", default=sources.LOCATION_TOPIC)
    ap.add_argument("--fare-topic", default=sources.FARE_TOPIC)
    ap.add_argument("--out", required=True, help="output root (one folder per flow)")
    ap.add_argument("--name-prefix", default="fleetlens_")
    ap.add_argument("--once", action="store_true", help="process what is there, then stop")
    ap.add_argument("--speed-threshold", type=float, default=JobSettings.speed_threshold_kmh)
    ap.add_argument("--key-mode", choices=["route", "sacco"], default="route")
    ap.add_argument("--profile", choices=["local", "cluster"], default="cluster")
    ap.add_argument(
        "--checkpoint-dir",
        help="shared folder for checkpoints; used only when spark.checkpoint.dir is unset",
    )
    ap.add_argument("--max-files-per-trigger", type=int, default=100, help="file input: files a micro-batch")
    ap.add_argument("--max-offsets-per-trigger", type=int, help="Kafka input: records a micro-batch (required)")
    ap.add_argument("--state-partitions", type=int, default=64,
                    help="state stores of each stateful step; fixed by its first checkpoint")
    ap.add_argument("--offgrid-clock", choices=["processing", "event"], default="processing",
                    help="event: silence is judged on event time, also with --once")
    args = ap.parse_args(argv)
    if args.kafka and not args.max_offsets_per_trigger:
        ap.error("--kafka needs --max-offsets-per-trigger: it bounds the rows a stateful step gathers")
    if not args.kafka and not (args.locations and args.fares):
        ap.error("give --kafka, or both --locations and --fares")

    spark = build_session(
        app_name="fleetlens-streams",
        profile=args.profile,
        checkpoint_dir=args.checkpoint_dir,
        shuffle_partitions=args.state_partitions,
    )
    settings = JobSettings(speed_threshold_kmh=args.speed_threshold, revenue_key_mode=args.key_mode)
    if args.kafka:
        from fleetlens.schemas import FARE_EVENT, LOCATION_EVENT

        locs = sources.kafka_stream(spark, args.kafka, args.location_topic, LOCATION_EVENT, args.max_offsets_per_trigger)
        fares = sources.kafka_stream(spark, args.kafka, args.fare_topic, FARE_EVENT, args.max_offsets_per_trigger)
    else:
        locs = sources.location_file_stream(
            spark, args.locations, max_files_per_trigger=args.max_files_per_trigger
        )
        fares = sources.fare_file_stream(
            spark, args.fares, max_files_per_trigger=args.max_files_per_trigger
        )
    trigger = {"availableNow": True} if args.once else {"processingTime": "1 second"}
    queries = jobs.start_all(
        locs, fares, args.out, settings, trigger=trigger, name_prefix=args.name_prefix, kafka_bootstrap=args.kafka,
        offgrid_clock=args.offgrid_clock,
    )
    if args.once and args.offgrid_clock == "processing":
        print(
            "fleetlens: off-grid alerts on the wall clock need running ticks and are left out with --once; "
            "--offgrid-clock event raises them on event time",
            file=sys.stderr,
        )
    for q in queries.values():
        q.awaitTermination()


if __name__ == "__main__":
    main()
