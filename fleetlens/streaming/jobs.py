"""One function per streaming flow (transform), plus starters that wire a
flow to a sink with its own checkpoint.

Flows take a streaming DataFrame of decoded records (see ``sources``) and
return a streaming DataFrame; the same batch transforms are reused wherever
the flow is stateless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from fleetlens.functions.scalar import to_kes
from fleetlens.operators import revenue, routing, scan, stateless
from fleetlens.schemas import OFFGRID_ALERT, ROUTE_OCCUPANCY, SACCO_REVENUE_WINDOW
from fleetlens.settings import DEFAULT_SETTINGS, JobSettings
from fleetlens.sources import codec
from fleetlens.sources.dimension import sacco_dim
from fleetlens.streaming import event_offgrid, fanout, sinks, stream_time
from fleetlens.streaming.sources import OUTPUT_TOPICS
from fleetlens.streaming.processors import (
    CHUNK_SUMMARY_OUT,
    DELTA_OUT,
    OCCUPANCY_OUT,
    OFFGRID_OUT,
    GROUP,
    SNAPSHOT_STATE,
    OffGridProcessor,
    RouteChunkSummarizer,
    RouteOccupancyFromChunks,
    RouteOccupancyProcessor,
    in_groups,
    passenger_deltas_with_state,
)

# Fields of the published records.
OCCUPANCY_FIELDS = ROUTE_OCCUPANCY.fieldNames()
OFFGRID_FIELDS = OFFGRID_ALERT.fieldNames()
REVENUE_FIELDS = [*SACCO_REVENUE_WINDOW.fieldNames(), "computedAt"]
ENRICHED_FIELDS = [
    "matatuId", "routeId", "routeName", "saccoName", "saccoId", "terminus", "latitude", "longitude",
    "speedKmh", "passengersOnboard", "isSpeeding", "originalTimestamp", "enrichedAt",
]

ALLOW_MULTIPLE = "spark.sql.streaming.statefulOperator.allowMultiple"


def validated(records: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) records; ``kind`` is ``location`` or ``fare``."""
    return codec.split_valid(records, kind)


def speed_alert_flow(locations: DataFrame, settings: JobSettings = DEFAULT_SETTINGS) -> DataFrame:
    return stateless.speed_alerts(locations, settings)


def enrichment_flow(locations: DataFrame, settings: JobSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Stream-static lookup join; ``enrichedAt`` is processing time."""
    spark = locations.sparkSession
    return stateless.enrich_locations(
        locations,
        sacco_dim(spark),
        settings,
        small_dim=True,
        clock=F.current_timestamp(),
    )


def fare_branch_flow(fares: DataFrame) -> DataFrame:
    return routing.label_branches(fares)


def display_board_flow(locations: DataFrame) -> DataFrame:
    """Display-board lines: payload plus the record metadata the source has.
    Kafka supplies partition, offset and record time; file records have no
    partition, their key is the route, offset the event id, record time the
    event time."""
    cols = set(locations.columns)
    records = locations.select(
        "*",
        *([] if "key" in cols else [F.col("routeId").alias("key")]),
        *([] if "offset" in cols else [F.col("eventId").alias("offset")]),
        *([] if "recordTimestamp" in cols else [F.col("timestamp").alias("recordTimestamp")]),
    )
    return stateless.display_board(records)


def fare_log_flow(fares: DataFrame) -> DataFrame:
    """Fare consumer lines: status icon, the six fields, the log line."""
    return stateless.fare_log(fares)


def revenue_flow(
    fares: DataFrame, settings: JobSettings = DEFAULT_SETTINGS, dedupe: bool = False
) -> DataFrame:
    """Tumbling-window revenue per operator, emitted once when the window
    closes (append mode): a window [s, e) closes when the watermark (max event
    time - grace) reaches e; fares for a closed window are dropped as late."""
    grace = f"{settings.revenue_grace_minutes} minutes"
    keyed = revenue.assign_operator(revenue.successful(fares), settings).withWatermark(
        "timestamp", grace
    )
    if dedupe:
        keyed = keyed.dropDuplicatesWithinWatermark(["transactionId"])
    agg = keyed.groupBy(
        F.window("timestamp", f"{settings.revenue_window_minutes} minutes").alias("w"), "saccoId"
    ).agg(F.sum("amountKes").alias("_total"), F.count(F.lit(1)).alias("transactionCount"))
    return agg.select(
        "saccoId",
        revenue.operator_name(F.col("saccoId"), settings).alias("saccoName"),
        to_kes(F.col("_total")).alias("totalRevenueKes"),
        "transactionCount",
        F.col("w.start").alias("windowStart"),
        F.col("w.end").alias("windowEnd"),
        F.current_timestamp().alias("computedAt"),
    )


def delta_flow(locations: DataFrame, settings: JobSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Per-vehicle passenger deltas (state: last count per vehicle, held in
    groups of vehicles)."""
    cols = ["matatuId", "routeId", "routeName", "passengersOnboard", "timestamp", "eventId"]
    return (
        in_groups(locations.select(*cols), ["matatuId"], settings.key_groups)
        .groupBy(GROUP)
        .applyInPandasWithState(
            passenger_deltas_with_state, DELTA_OUT, SNAPSHOT_STATE, "append", GroupStateTimeout.NoTimeout
        )
    )


def occupancy_flow(
    deltas: DataFrame,
    every_update: bool = True,
    settings: JobSettings = DEFAULT_SETTINGS,
    split_routes: bool = False,
) -> DataFrame:
    """Per-route clamped occupancy (state: occupancy per route).

    ``every_update=True``: one row per delta (the full changelog).
    ``every_update=False``: one row per changed route per micro-batch (what a
    commit interval emits). With ``split_routes`` the micro-batch's deltas are
    first folded per (route, time chunk of ``scan_chunk_seconds``) in
    parallel into composable summaries, so a route holding most of the
    traffic is not folded in one task; worthwhile when a micro-batch spans
    many chunks of event time (replays, backfills).
    Deltas without a value are skipped (the processor always emits one).
    """
    deltas = deltas.filter(F.col("passengerDelta").isNotNull())
    if every_update or not split_routes:
        return deltas.groupBy("routeId").transformWithStateInPandas(
            statefulProcessor=RouteOccupancyProcessor(every_update),
            outputStructType=OCCUPANCY_OUT,
            outputMode="Append",
            timeMode="None",
        )
    chunked = scan.with_chunk(deltas, "routeId", "timestamp", settings.scan_chunk_seconds)
    chunked = in_groups(chunked.drop(scan.KEY).withColumnRenamed(scan.CHUNK, "chunk"), ["routeId", "chunk"], settings.key_groups)
    summaries = chunked.groupBy(GROUP).transformWithStateInPandas(
        statefulProcessor=RouteChunkSummarizer(),
        outputStructType=CHUNK_SUMMARY_OUT,
        outputMode="Append",
        timeMode="None",
    )
    return summaries.groupBy("routeId").transformWithStateInPandas(
        statefulProcessor=RouteOccupancyFromChunks(),
        outputStructType=OCCUPANCY_OUT,
        outputMode="Append",
        timeMode="None",
    )


def offgrid_flow(
    locations: DataFrame, settings: JobSettings = DEFAULT_SETTINGS, ttl_ms: int | None = None
) -> DataFrame:
    """Silent-vehicle alerts on processing-time ticks."""
    cols = ["matatuId", "routeId", "routeName", "latitude", "longitude", "timestamp", "eventId"]
    return (
        locations.select(*cols)
        .groupBy("matatuId")
        .transformWithStateInPandas(
            statefulProcessor=OffGridProcessor(settings, ttl_ms),
            outputStructType=OFFGRID_OUT,
            outputMode="Append",
            timeMode="ProcessingTime",
        )
    )


def start_revenue(
    fares: DataFrame,
    name: str,
    settings: JobSettings = DEFAULT_SETTINGS,
    key: str | None = None,
    dedupe: bool = False,
    **kw,
) -> StreamingQuery:
    """Starts the revenue query with the late-row filter evaluated against
    the watermark of the current batch (single stateful operator).
    ``key`` publishes keyed JSON records instead of columns; ``dedupe`` drops
    re-delivered fares (same ``transactionId``) within the watermark."""
    spark = fares.sparkSession
    before = spark.conf.get(ALLOW_MULTIPLE, None)
    spark.conf.set(ALLOW_MULTIPLE, "false")
    try:
        flow = revenue_flow(fares, settings, dedupe=dedupe)
        if key:
            flow = sinks.keyed_records(flow, key, REVENUE_FIELDS)
        return sinks.start(flow, name, **kw)
    finally:
        if before is None:
            spark.conf.unset(ALLOW_MULTIPLE)
        else:
            spark.conf.set(ALLOW_MULTIPLE, before)


def keyed_sink(flow: str, out: str, fmt: str, kafka_bootstrap: str | None) -> dict:
    """Where a keyed output goes: its topic, or a folder of JSON records."""
    if kafka_bootstrap:
        return dict(fmt="kafka", options={"kafka.bootstrap.servers": kafka_bootstrap, "topic": OUTPUT_TOPICS[flow]})
    return dict(fmt=fmt, path=f"{out}/{flow}")


def _writer(flow: str, out: str, fmt: str, kafka_bootstrap: str | None):
    if kafka_bootstrap:
        return fanout.to_topic(kafka_bootstrap, OUTPUT_TOPICS[flow])
    return fanout.to_folder(f"{out}/{flow}", fmt)


def location_readers(out: str, settings: JobSettings, fmt: str = "json", kafka_bootstrap: str | None = None) -> list[fanout.Reader]:
    """The narrow flows over pings; every one sees the records parsed once."""

    def keyed(flow: str, rows, key: str, fields: list[str]) -> fanout.Reader:
        published = lambda b: sinks.keyed_records(rows(validated(b, "location")[0]), key, fields)
        return fanout.Reader(flow, published, _writer(flow, out, fmt, kafka_bootstrap))

    valid = lambda rows: lambda b: rows(validated(b, "location")[0])
    return [
        keyed("speed_alerts", lambda v: speed_alert_flow(v, settings), "routeId", codec.LOCATION_FIELDS),
        keyed("location_enriched", lambda v: enrichment_flow(v, settings), "routeId", ENRICHED_FIELDS),
        fanout.Reader("location_quarantine", lambda b: validated(b, "location")[1], fanout.to_folder(f"{out}/location_quarantine", fmt)),
        fanout.Reader("location_audit", valid(stateless.location_audit), fanout.to_folder(f"{out}/location_audit", "parquet", ("eventDate",))),
        fanout.Reader("display_board", valid(display_board_flow), fanout.to_folder(f"{out}/display_board", fmt)),
    ]


def fare_readers(out: str, fmt: str = "json", kafka_bootstrap: str | None = None) -> list[fanout.Reader]:
    """The narrow flows over fares."""
    failed = lambda b: sinks.keyed_records(routing.failed_fares(validated(b, "fare")[0]), "matatuId", codec.FARE_FIELDS)
    return [
        fanout.Reader("fares_failed", failed, _writer("fares_failed", out, fmt, kafka_bootstrap)),
        fanout.Reader("fare_quarantine", lambda b: validated(b, "fare")[1], fanout.to_folder(f"{out}/fare_quarantine", fmt)),
        fanout.Reader("fare_log", lambda b: fare_log_flow(validated(b, "fare")[0]), fanout.to_folder(f"{out}/fare_log", fmt)),
    ]


def revenue_readers(out: str, settings: JobSettings, fmt: str = "json", kafka_bootstrap: str | None = None) -> list[fanout.Reader]:
    """The outputs of the stream-time revenue flow: windows that closed, as
    published records, and the fares dropped as late."""

    def closed(tagged: DataFrame) -> DataFrame:
        rows = stream_time.closed_windows(tagged, settings).withColumn("computedAt", F.current_timestamp())
        return sinks.keyed_records(rows, "saccoId", REVENUE_FIELDS)

    return [
        fanout.Reader("sacco_revenue", closed, _writer("sacco_revenue", out, fmt, kafka_bootstrap)),
        fanout.Reader("late_fares", lambda b: stream_time.late_fares(b, settings), fanout.to_folder(f"{out}/late_fares", fmt)),
    ]


def start_all(
    locations: DataFrame,
    fares: DataFrame,
    out_root: str,
    settings: JobSettings = DEFAULT_SETTINGS,
    trigger: dict | None = None,
    fmt: str = "json",
    name_prefix: str = "",
    kafka_bootstrap: str | None = None,
    offgrid_clock: str = "processing",
) -> dict[str, StreamingQuery]:
    """Every flow over the two inputs.

    The narrow flows of an input share one query and one parse
    (``streaming.fanout``), each with its own place in the ledger; the stateful
    flows are queries of their own. Query names (and so checkpoint folders) are
    ``name_prefix + flow``; keep the prefix stable across restarts to resume,
    change it for a fresh run. Keyed outputs go to ``out_root/<flow>`` as JSON
    records, or to the flow's topic when ``kafka_bootstrap`` is given; the
    outputs of shared queries stand in ``batch_id=`` folders. The wall-clock
    off-grid detector needs processing-time ticks and runs only under a
    ``processingTime`` trigger; ``offgrid_clock="event"`` runs the event-time
    detector under any.
    """
    out = out_root.rstrip("/")
    common = dict(trigger=trigger)

    def keyed(flow: str, df: DataFrame, key: str, fields: list[str]) -> StreamingQuery:
        sink = keyed_sink(flow, out, fmt, kafka_bootstrap)
        return sinks.start_keyed(df, key, fields, name_prefix + flow, **sink, **common)

    locs, _ = validated(locations, "location")
    fs, _ = validated(fares, "fare")
    q = {
        "location_readers": fanout.start(
            locations, location_readers(out, settings, fmt, kafka_bootstrap), name_prefix + "location_readers", **common
        ),
        "fare_readers": fanout.start(fares, fare_readers(out, fmt, kafka_bootstrap), name_prefix + "fare_readers", **common),
        "sacco_revenue": fanout.start(
            stream_time.revenue_flow(fs, settings),
            revenue_readers(out, settings, fmt, kafka_bootstrap),
            name_prefix + "sacco_revenue",
            **common,
        ),
        "route_occupancy": keyed(
            "route_occupancy",
            occupancy_flow(delta_flow(locs, settings), every_update=False, settings=settings, split_routes=True),
            "routeId",
            OCCUPANCY_FIELDS,
        ),
    }
    if offgrid_clock == "event":
        alerts = event_offgrid.alerts(event_offgrid.offgrid_flow(locs, settings), settings)
        q["offgrid_alerts"] = keyed("offgrid_alerts", alerts, "matatuId", OFFGRID_FIELDS)
    elif trigger and "processingTime" in trigger:
        q["offgrid_alerts"] = keyed("offgrid_alerts", offgrid_flow(locs, settings), "matatuId", OFFGRID_FIELDS)
    return q
