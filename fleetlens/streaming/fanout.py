"""One read, many readers.

The narrow flows over one input (alerts, enrichment, quarantine, audit,
display board ...) do not each read and parse it: one query parses a
micro-batch once and hands it to every reader. Each reader keeps its own place
in a ledger, the last batch it has written, as if it read alone:

* a batch that Spark tries again is skipped by the readers that had it;
* a reader that fails does not stop the others. The batch is journalled, and
  the reader catches up from the journal, in order, before it takes a newer
  batch, or alone through :func:`catch_up`;
* what every reader has written leaves the journal.

A reader writes to ``<path>/batch_id=<id>``, replaced on a second try, so
trying again never doubles rows.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fleetlens.session import checkpoint_path
from fleetlens.streaming.shared_files import Folder
from fleetlens.streaming.sinks import ensure_rocksdb_state

log = logging.getLogger(__name__)
NONE_YET = -1


@dataclass(frozen=True)
class Reader:
    """``rows`` makes the reader's rows of a parsed micro-batch, ``write``
    stores them for a batch id (a second time: instead of the first)."""

    name: str
    rows: Callable[[DataFrame], DataFrame]
    write: Callable[[DataFrame, int], None]


def to_folder(path: str, fmt: str = "json", partition_by: tuple[str, ...] = ()) -> Callable[[DataFrame, int], None]:
    def write(rows: DataFrame, batch_id: int) -> None:
        writer = rows.write.mode("overwrite").format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def to_topic(bootstrap: str, topic: str) -> Callable[[DataFrame, int], None]:
    """Keyed records to a topic: at least once, a topic cannot be overwritten."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save()

    return write


class FanOut:
    """The readers of one input, their ledger and journal below ``root``."""

    def __init__(self, spark: SparkSession, readers: list[Reader], root: str) -> None:
        self.spark, self.readers, self.root = spark, readers, root.rstrip("/")
        self.ledger = Folder(spark, f"{self.root}/ledger")
        self.journal = Folder(spark, f"{self.root}/journal")

    def place(self, reader: str) -> int:
        """The last batch the reader has written, in full."""
        return self.ledger.get(reader, NONE_YET)

    def journalled(self) -> list[int]:
        return sorted(int(n.removeprefix("batch_id=")) for n in self.journal.names() if n.startswith("batch_id="))

    def lag(self) -> dict[str, int]:
        """Journalled batches each reader has still to write."""
        return {r.name: sum(b > self.place(r.name) for b in self.journalled()) for r in self.readers}

    def _take(self, reader: Reader, batch: DataFrame, batch_id: int) -> bool:
        try:
            reader.write(reader.rows(batch), batch_id)
        except Exception:  # noqa: BLE001 - one reader's failure is its own
            log.exception("reader %s failed on batch %s", reader.name, batch_id)
            return False
        self.ledger.put(reader.name, batch_id)
        return True

    def _behind(self, reader: Reader, before: int | None = None) -> bool:
        """Whether journalled batches remain after trying them in order."""
        for b in self.journalled():
            if b > self.place(reader.name) and (before is None or b < before):
                stored = self.spark.read.parquet(f"{self.root}/journal/batch_id={b}")
                if not self._take(reader, stored, b):
                    return True
        return False

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` step."""
        batch = batch.persist()
        try:
            late = []
            for r in self.readers:
                if self.place(r.name) >= batch_id:
                    continue
                if self._behind(r, batch_id) or not self._take(r, batch, batch_id):
                    late.append(r.name)
            if late and batch_id not in self.journalled():
                staged = f"{self.root}/journal/.batch_id={batch_id}"
                batch.write.mode("overwrite").parquet(staged)
                self.journal.fs.rename(self.journal._path(f".batch_id={batch_id}"), self.journal._path(f"batch_id={batch_id}"))
        finally:
            batch.unpersist()
        self._trim()

    def catch_up(self) -> dict[str, int]:
        """Let every reader take what it missed, without the stream; the lag
        that remains."""
        for r in self.readers:
            self._behind(r)
        self._trim()
        return self.lag()

    def _trim(self) -> None:
        done = min((self.place(r.name) for r in self.readers), default=NONE_YET)
        for b in self.journalled():
            if b <= done:
                self.journal.delete(f"batch_id={b}")


def start(source: DataFrame, readers: list[Reader], name: str, trigger: dict | None = None) -> StreamingQuery:
    """One query over ``source`` for all ``readers``; ledger and journal stand
    beside its checkpoint."""
    spark = source.sparkSession
    ensure_rocksdb_state(spark)
    fan = FanOut(spark, readers, checkpoint_path(spark, f"{name}_readers"))
    writer = source.writeStream.queryName(name).option("checkpointLocation", checkpoint_path(spark, name))
    return writer.foreachBatch(fan.write).trigger(**(trigger or {"availableNow": True})).start()
