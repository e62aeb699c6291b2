"""Helpers for stream tests: numbered JSON record files, one micro-batch each."""

from __future__ import annotations

import json
import os
import time

import pandas as pd


def _iso(v) -> str:
    return pd.Timestamp(v).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def write_batches(folder: str, frames: list[pd.DataFrame], ts_cols=("timestamp",)) -> None:
    """Each frame becomes ``NNNNN.json`` (JSON lines), written under a dot
    name and renamed, with increasing modification times."""
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 10_000
    for i, frame in enumerate(frames):
        final = os.path.join(folder, f"{i:05d}.json")
        tmp = os.path.join(folder, f".{i:05d}.json.tmp")
        with open(tmp, "w") as fh:
            for rec in frame.to_dict(orient="records"):
                out = {}
                for k, v in rec.items():
                    if k in ts_cols or isinstance(v, pd.Timestamp):
                        out[k] = _iso(v)
                    elif hasattr(v, "item"):
                        out[k] = v.item()
                    elif v is not None and type(v).__name__ == "Decimal":
                        out[k] = float(v)
                    else:
                        out[k] = v
                fh.write(json.dumps(out) + "\n")
        os.replace(tmp, final)
        os.utime(final, (base + i, base + i))


def split_frames(df: pd.DataFrame, n: int, order=("timestamp", "eventId")) -> list[pd.DataFrame]:
    df = df.sort_values(list(order)).reset_index(drop=True)
    size = -(-len(df) // n)
    return [df.iloc[i : i + size] for i in range(0, len(df), size)]


def location_files(spark, folder):
    """The location stream with one file a micro-batch."""
    from fleetlens.streaming import sources

    return sources.location_file_stream(spark, folder, max_files_per_trigger=1)


def fare_files(spark, folder):
    from fleetlens.streaming import sources

    return sources.fare_file_stream(spark, folder, max_files_per_trigger=1)
