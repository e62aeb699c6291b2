"""Route occupancy kept up to date part by part, without reading history again.

History stands in two small tables, one folder a part (a day, say):

* ``routes``: the composable summaries of the part's (route, chunk) groups;
* ``vehicles``: the last ping of every vehicle that pinged in the part, which
  the first delta of a later part needs.

:meth:`OccupancyParts.extend` reads the pings of one part and the vehicle rows
of earlier parts, and writes that part's folders, whole or not at all as far as
readers can see. The occupancy is composed from the summaries alone. A part may
be extended again, with more pings: its folders are replaced. Parts after it
then hold deltas to counts that may have changed, so they are dropped and have
to be extended again, in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators import occupancy
from fleetlens.operators.latest_row import latest_rows
from fleetlens.settings import DEFAULT_SETTINGS, JobSettings


class OccupancyParts:
    """The tables below ``path``; parts are numbered in the order of time."""

    def __init__(self, spark: SparkSession, path: str, settings: JobSettings = DEFAULT_SETTINGS) -> None:
        self.spark, self.path, self.settings = spark, path.rstrip("/"), settings
        self.jvm = spark.sparkContext._jvm

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def parts(self) -> list[int]:
        """Parts whose both folders are complete."""
        fs, found = self._fs(), []
        if fs.exists(self._path("routes")):
            for s in fs.listStatus(self._path("routes")):
                name = s.getPath().getName()
                if name.startswith("part=") and fs.exists(self._path(f"vehicles/{name}/_SUCCESS")):
                    found.append(int(name.removeprefix("part=")))
        return sorted(found)

    def _table(self, name: str, parts: list[int]) -> DataFrame:
        paths = [f"{self.path}/{name}/part={p}" for p in parts]
        return self.spark.read.option("basePath", f"{self.path}/{name}").parquet(*paths)

    def counts(self, before: int) -> DataFrame | None:
        """Last count of every vehicle in the parts before ``before``."""
        parts = [p for p in self.parts() if p < before]
        if not parts:
            return None
        rows = self._table("vehicles", parts)
        return latest_rows(rows, "matatuId", ["routeId"], ["lastPassengerCount"]).select("matatuId", "lastPassengerCount")

    def extend(self, part: int, locations: DataFrame) -> None:
        """Take the pings of one part, all of them."""
        fs = self._fs()
        for later in [p for p in self.parts() if p >= part]:
            for table in ("routes", "vehicles"):
                fs.delete(self._path(f"{table}/part={later}"), True)
        deltas = occupancy.passenger_deltas(locations, self.settings, self.counts(part))
        fresh = {
            "vehicles": latest_rows(locations, "matatuId", ["routeId"], ["passengersOnboard", "eventId"]).select(
                "matatuId", "routeId", F.col("passengersOnboard").alias("lastPassengerCount"), "timestamp", "eventId"
            ),
            "routes": occupancy.chunk_summaries(deltas, self.settings),
        }
        for table, rows in fresh.items():  # routes last: they make the part visible
            staged = f"{table}/.part={part}"
            rows.write.mode("overwrite").parquet(f"{self.path}/{staged}")
            if not fs.rename(self._path(staged), self._path(f"{table}/part={part}")):
                raise OSError(f"cannot put {table} of part {part} into {self.path}")

    def occupancy(self) -> DataFrame:
        """Occupancy of every route after all parts."""
        return occupancy.composed(self._table("routes", self.parts()), ["part", "chunk"])
