"""One read for many readers, and the latest-value table."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from fleetlens.operators import occupancy, stateless
from fleetlens.sources.fixtures import load_locations
from fleetlens.streaming import fanout, jobs, latest, sinks
from fleetlens.streaming.shared_files import Folder
from streamkit import location_files, split_frames, write_batches


def readers(base, broken=()):
    """Three readers; those in ``broken`` fail while their flag file stands."""

    def write(name):
        inner = fanout.to_folder(os.path.join(base, name), "parquet")

        def run(rows, batch_id):
            if name in broken and batch_id in broken[name] and os.path.exists(os.path.join(base, f"{name}.down")):
                raise RuntimeError(f"{name} is down")
            inner(rows, batch_id)

        return run

    return [
        fanout.Reader("alerts", lambda b: stateless.speed_alerts(b), write("alerts")),
        fanout.Reader("board", lambda b: b.select("matatuId", "eventId"), write("board")),
        fanout.Reader("audit", lambda b: b, write("audit")),
    ]


@pytest.fixture
def landing(spark, scratch, run_id):
    base = os.path.join(scratch, run_id)
    write_batches(os.path.join(base, "loc"), split_frames(load_locations(spark, SMALL).toPandas(), 4))
    return base


def ids(spark, base, name):
    return sorted(r.eventId for r in spark.read.parquet(os.path.join(base, name)).collect())


def test_every_reader_sees_every_record_of_one_read(spark, landing, run_id):
    q = fanout.start(location_files(spark, os.path.join(landing, "loc")), readers(landing), run_id)
    q.awaitTermination()
    every = sorted(r.eventId for r in load_locations(spark, SMALL).collect())
    fast = sorted(r.eventId for r in stateless.speed_alerts(load_locations(spark, SMALL)).collect())
    assert ids(spark, landing, "audit") == ids(spark, landing, "board") == every
    assert ids(spark, landing, "alerts") == fast
    assert q.lastProgress["sources"][0]["description"].startswith("FileStreamSource")
    assert sum(len(p["sources"]) for p in q.recentProgress) == len(q.recentProgress)  # one source


def test_a_failed_reader_catches_up_alone(spark, landing, run_id):
    """``board`` is down for batches 1 and 2: the others go on, the batches
    are journalled, and it takes them in order when it is back."""
    open(os.path.join(landing, "board.down"), "w").close()
    group = readers(landing, {"board": (1, 2)})
    q = fanout.start(location_files(spark, os.path.join(landing, "loc")), group, run_id)
    q.awaitTermination()
    assert q.exception() is None
    every = sorted(r.eventId for r in load_locations(spark, SMALL).collect())
    assert ids(spark, landing, "audit") == every
    from fleetlens.session import checkpoint_path

    fan = fanout.FanOut(spark, group, checkpoint_path(spark, f"{run_id}_readers"))
    assert fan.place("audit") == 3 and fan.place("board") == 0
    assert fan.lag() == {"alerts": 0, "board": 3, "audit": 0} and fan.journalled() == [1, 2, 3]
    assert len(ids(spark, landing, "board")) < len(every)
    assert fan.catch_up()["board"] == 3  # still down
    os.replace(os.path.join(landing, "board.down"), os.path.join(landing, "board.up"))
    assert fan.catch_up() == {"alerts": 0, "board": 0, "audit": 0}
    assert ids(spark, landing, "board") == every and fan.journalled() == []


def test_a_reader_killed_between_write_and_ledger_writes_the_batch_again(spark, landing):
    """The batch is tried again as Spark does after a crash: no row doubles,
    and readers that had it do not write it a second time."""
    batch = load_locations(spark, SMALL).limit(100)
    written = []
    group = readers(landing)
    counted = fanout.Reader("audit", group[2].rows, lambda rows, b: (written.append(b), group[2].write(rows, b)))
    fan = fanout.FanOut(spark, [group[1], counted], os.path.join(landing, "fan"))
    fan.write(batch, 0)
    fan.ledger.delete("board")  # as if killed before the ledger was put
    fan.write(batch, 0)
    assert len(ids(spark, landing, "board")) == 100 and written == [0]


def test_ledger_survives_a_broken_off_put(spark, scratch, run_id):
    folder = Folder(spark, os.path.join(scratch, run_id, "f"))
    folder.put("a", {"n": 1})
    folder.put("a", {"n": 2})
    assert folder.get("a") == {"n": 2} and folder.get("b", 7) == 7
    folder.fs.rename(folder._path("a"), folder._path(".a.new"))  # deleted, not yet renamed
    assert folder.get("a") == {"n": 2}


def test_latest_table_follows_the_changelog_over_restarts(spark, landing, run_id):
    want = occupancy.route_occupancy(occupancy.passenger_deltas(load_locations(spark, SMALL)))
    cols = ["routeId", "routeName", "currentPassengers", "totalBoardings", "totalAlightings"]
    table = latest.LatestTable(spark, os.path.join(landing, "table"), "routeId", ["timestamp", "eventId"], buckets=4)
    late = os.path.join(landing, "later")
    os.makedirs(late)
    for f in ("00002.json", "00003.json"):
        os.replace(os.path.join(landing, "loc", f), os.path.join(late, f))

    def run():
        stream = location_files(spark, os.path.join(landing, "loc"))
        flow = jobs.occupancy_flow(jobs.delta_flow(stream), every_update=False)
        q = latest.start(flow, table, f"latest_{run_id}")
        q.awaitTermination()
        assert q.exception() is None

    run()
    assert table.read().count() <= want.count()
    for f in ("00002.json", "00003.json"):
        os.replace(os.path.join(late, f), os.path.join(landing, "loc", f))
    run()
    run()  # nothing new
    got = table.read().select(cols)
    assert got.count() == want.count() == 6 and got.exceptAll(want.select(cols)).count() == 0
    assert len(table.data.names()) <= 8  # files of batches that no table needs are gone


def test_merge_is_idempotent_and_ignores_older_rows(spark, scratch, run_id):
    table = latest.LatestTable(spark, os.path.join(scratch, run_id, "t"), "k", ["at"], buckets=3)
    with pytest.raises(FileNotFoundError):
        table.read()
    frame = lambda rows: spark.createDataFrame(rows, "k string, at long, v long")
    assert table.merge(frame([("a", 1, 10), ("b", 1, 20), ("a", 2, 11)]), 0, "w")
    assert table.merge(frame([("a", 1, 99), ("c", 5, 30), (None, 1, 40)]), 1, "w")
    assert not table.merge(frame([("a", 9, 0)]), 1, "w")  # tried again
    assert table.merge(frame([]), 2, "w")
    assert table.merge(frame([("b", 7, 21)]), 0, "other")
    rows = {r.k: r.v for r in table.read().collect()}
    assert rows == {"a": 11, "b": 21, "c": 30, None: 40}


def test_sinks_outputs_replace_a_batch(spark, landing, run_id):
    root = os.path.join(landing, "out")
    outputs = {"ids": lambda b: b.select("eventId"), "fast": lambda b: stateless.speed_alerts(b).select("eventId")}
    q = sinks.start_outputs(location_files(spark, os.path.join(landing, "loc")), outputs, root, run_id)
    q.awaitTermination()
    assert spark.read.parquet(f"{root}/ids").count() == 599
    assert spark.read.parquet(f"{root}/fast").filter(F.col("eventId").isNotNull()).count() == 118
