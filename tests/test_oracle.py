"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as ep
from compare import duck_frame, same
from conftest import SMALL

NAMES = sorted(ep.QUERIES)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(ep.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = ep.queries()[name](spark, SMALL).toPandas()
    want = duck_frame(duck, ep.oracle_sql()[name])
    ok, why = same(got, want)
    assert ok, why


def test_entry_smoke(spark):
    df = ep.entry(spark)
    from fleetlens.schemas import SACCO_REVENUE_WINDOW

    assert [f.name for f in df.schema.fields] == SACCO_REVENUE_WINDOW.fieldNames()
    assert df.count() > 0


def test_fixture_counts(spark):
    """Counts of the fixture views quoted for sf0.001."""
    from pyspark.sql import functions as F

    from fleetlens.sources.fixtures import load_fares, load_locations

    locs = load_locations(spark, SMALL)
    assert locs.count() == 599
    assert locs.filter(F.col("routeId") == "route_99").count() == 98
    assert locs.filter(F.col("speedKmh") > 80).count() == 118
    by_status = dict(load_fares(spark, SMALL).groupBy("status").count().collect())
    assert by_status == {"SUCCESS": 319, "FAILED": 43, "PENDING": 39}


ZONE_SENSITIVE = [
    "location_decode", "fare_decode", "location_audit", "sacco_revenue", "sacco_revenue_messages",
    "late_fares", "offgrid_as_of", "offgrid_gaps", "passenger_deltas",
]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = ep.queries()[name](spark, SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    ok, why = same(got, duck_frame(duck, ep.oracle_sql()[name]))
    assert ok, why
