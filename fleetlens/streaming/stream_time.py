"""Operator revenue on a stream time of its own.

Each operator's clock is the latest event time among its own fares so far, in
arrival order: a fare is late when its window's end plus grace is at or before
that clock, and a window is emitted once when the clock reaches its end plus
grace. Spark's watermark can do neither, it moves once a micro-batch and for
the whole query. Here the clock and the open windows are keyed state
(``transformWithStateInPandas``), and fares that come too late are a second
output instead of vanishing.

The step works on whole numbers (epoch microseconds, hundredths of the
currency): no rounding, no session time zone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetlens.functions.scalar import epoch_micros, from_epoch_micros, to_kes
from fleetlens.operators import revenue
from fleetlens.settings import DEFAULT_SETTINGS, JobSettings

WINDOW, LATE = "window", "late"

TAGGED = (
    "kind string, saccoId string, transactionId string, matatuId string, cents long, fares long, "
    "t long, arrival long, eventId long, windowStart long, streamTime long"
)


class StreamTimeRevenue(StatefulProcessor):
    """Per operator: judges every fare of a micro-batch in arrival order.

    Vectorised: the clock after each fare is a running maximum from the stored
    one. Windows that open and close within a micro-batch never touch the
    state, so a replay costs one state access for each window left open.
    """

    def __init__(self, window_us: int, grace_us: int) -> None:
        self.window_us, self.grace_us = window_us, grace_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.clock = handle.getValueState("streamTime", "t long")
        self.open = handle.getMapState("openWindows", "start long", "cents long, fares long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        df = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
        df = df.sort_values(["arrival", "eventId"], kind="stable", na_position="first")
        t = df["t"].to_numpy(np.int64)
        start = t // self.window_us * self.window_us
        close = start + (self.window_us + self.grace_us)
        before = [self.clock.get()[0]] if self.clock.exists() else []
        clock = np.maximum.accumulate(np.concatenate([np.array(before, np.int64), t]))[len(before) :]
        late = close <= clock
        now = int(clock[-1])
        self.clock.update((now,))
        if late.any():
            lost = df[late]
            yield pd.DataFrame(
                {
                    "kind": LATE, "saccoId": key[0], "transactionId": lost["transactionId"], "matatuId": lost["matatuId"],
                    "cents": lost["cents"], "fares": 1, "t": lost["t"], "arrival": lost["arrival"],
                    "eventId": lost["eventId"], "windowStart": start[late], "streamTime": clock[late],
                }
            )
        counted = pd.DataFrame({"start": start[~late], "cents": df["cents"].to_numpy(np.int64)[~late]})
        sums = counted.groupby("start")["cents"].agg(["sum", "size"])
        done = {}
        for s, cents, n in zip(sums.index.tolist(), sums["sum"].tolist(), sums["size"].tolist()):
            if self.open.containsKey((s,)):
                had = self.open.getValue((s,))
                cents, n = cents + had[0], n + had[1]
            if s + self.window_us + self.grace_us <= now:
                done[s] = (cents, n)
            else:
                self.open.updateValue((s,), (cents, n))
        for (s,) in list(self.open.keys()):
            if s + self.window_us + self.grace_us <= now:
                done.setdefault(s, self.open.getValue((s,)))
                self.open.removeKey((s,))
        if done:
            starts = sorted(done)
            none = pd.array([None] * len(starts), dtype="Int64")
            yield pd.DataFrame(
                {
                    "kind": WINDOW, "saccoId": key[0], "transactionId": None, "matatuId": None,
                    "cents": [done[s][0] for s in starts], "fares": [done[s][1] for s in starts],
                    "t": none, "arrival": none, "eventId": none, "windowStart": starts, "streamTime": now,
                }
            )

    def close(self) -> None:
        pass


def arrival_micros(fares: DataFrame) -> Column:
    """When a fare reached the stream: ``arrivalTs`` where the records carry
    it, else the record's own time at the source (Kafka), else the order of
    ``eventId`` alone."""
    for name in ("arrivalTs", "recordTimestamp"):
        if name in fares.columns:
            return epoch_micros(fares, name)
    return F.lit(0).cast("bigint")


def revenue_flow(fares: DataFrame, settings: JobSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Closed windows and late fares as one tagged stream; split it with
    :func:`closed_windows` and :func:`late_fares`."""
    paid = revenue.assign_operator(revenue.successful(fares), settings)
    rows = paid.select(
        "saccoId", "transactionId", "matatuId", (F.col("amountKes") * 100).cast("bigint").alias("cents"),
        epoch_micros(paid, "timestamp").alias("t"), arrival_micros(paid).alias("arrival"), "eventId",
    ).filter("t IS NOT NULL")
    step = StreamTimeRevenue(settings.revenue_window_ms * 1000, settings.revenue_grace_ms * 1000)
    return rows.groupBy("saccoId").transformWithStateInPandas(
        statefulProcessor=step, outputStructType=TAGGED, outputMode="Append", timeMode="None"
    )


def _amount() -> Column:
    return to_kes(F.col("cents").cast("decimal(20,0)") / F.lit(100))


def _end(settings: JobSettings) -> Column:
    return F.col("windowStart") + F.lit(settings.revenue_window_ms * 1000)


def closed_windows(tagged: DataFrame, settings: JobSettings = DEFAULT_SETTINGS, ntz: bool = False) -> DataFrame:
    """The revenue records: one row for each window, when it closed."""
    return tagged.filter(F.col("kind") == WINDOW).select(
        "saccoId",
        revenue.operator_name(F.col("saccoId"), settings).alias("saccoName"),
        _amount().alias("totalRevenueKes"),
        F.col("fares").alias("transactionCount"),
        from_epoch_micros(F.col("windowStart"), ntz).alias("windowStart"),
        from_epoch_micros(_end(settings), ntz).alias("windowEnd"),
    )


def late_fares(tagged: DataFrame, settings: JobSettings = DEFAULT_SETTINGS, ntz: bool = False) -> DataFrame:
    """The fares that were dropped, with the clock that judged them."""
    us = lambda c: from_epoch_micros(F.col(c), ntz)
    return tagged.filter(F.col("kind") == LATE).select(
        "transactionId", "matatuId", "saccoId", _amount().alias("amountKes"), us("t").alias("timestamp"),
        us("arrival").alias("arrivalTs"), "eventId", us("windowStart").alias("windowStart"),
        from_epoch_micros(_end(settings), ntz).alias("windowEnd"), us("streamTime").alias("streamTime"),
    )
