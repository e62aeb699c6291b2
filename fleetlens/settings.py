"""Job settings: one frozen dataclass holding every tunable of the flows."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class JobSettings:
    # Defaults of the transit application this engine mirrors.
    speed_threshold_kmh: float = 80.0
    revenue_window_minutes: int = 60
    revenue_grace_minutes: int = 5
    offgrid_silence_ms: int = 300_000
    offgrid_check_interval_ms: int = 60_000

    # Operator key used by the revenue flow: "route" reproduces the keys the
    # application actually emits (route ids), "sacco" the documented sacco ids.
    revenue_key_mode: str = "route"

    # Width of the time chunks that ordered per-key scans are split into. A key
    # may hold a large share of all rows; the scans run per (key, chunk) and
    # stitch chunk boundaries with one edge row per non-empty (key, chunk), so
    # no task ever sorts a whole key. Size a width so the densest (key, chunk)
    # holds at most a few million rows and most chunks hold many.
    scan_chunk_seconds: int = 60  # routes and operators: all vehicles' events
    vehicle_chunk_seconds: int = 86_400  # one vehicle pings every few seconds

    # Instead of clock time: ranges of about so many rows, for keys whose rows
    # crowd in time. Costs one more shuffle of the rows, and a table.
    scan_rows_per_range: int | None = None

    # Groups that the stateful stream steps over many keys (vehicles, chunks of
    # routes) gather a micro-batch's rows into. A group folds all its keys in
    # one call and holds their state as one value, so a micro-batch costs calls
    # by the group, not by the key. Fixed by a checkpoint's first micro-batch;
    # size it so that a group holds some thousand keys.
    key_groups: int = 256

    @property
    def revenue_window_ms(self) -> int:
        return self.revenue_window_minutes * 60_000

    @property
    def revenue_grace_ms(self) -> int:
        return self.revenue_grace_minutes * 60_000

    def with_(self, **changes) -> "JobSettings":
        return replace(self, **changes)


DEFAULT_SETTINGS = JobSettings()
