"""Plans of the ingest queries: what keeps them in proportion to the input."""

import re

import pytest

from gridloom.plans import catalog
from gridloom.sources import adapter

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcasts(spark):
    """Nothing is small enough to be broadcast by itself, as where tables are large or sizes unknown."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["flatten_clean", "json_roundtrip", "validate_rules", "validate_precedence"])
def test_events_are_dealt_out_by_keys_that_grow(spark, no_broadcasts, name):
    """Four tariffs or 25 nations as a key send all events to as many tasks: only stations and sessions may be one."""
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    joined = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin)(?:\(skew=\w+\))? \[([^\]]*)\]", plan)
    assert joined and all("station_id" in keys for keys in joined), joined


def test_stations_are_those_of_the_events(spark):
    columns = ["station_id", "operator_id", "city", "country", "lat", "lon"]
    of_events = adapter.raw_events(spark, SF).select(columns).distinct().collect()
    found = adapter.stations(spark, SF)
    assert found.columns == [*columns, "num_connectors"]
    assert sorted(tuple(r)[:6] for r in found.collect()) == sorted(map(tuple, of_events))


def test_messages_are_read_apart_from_where_they_are_written(spark, no_broadcasts):
    plan = catalog.QUERIES["json_roundtrip"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(value#\d+", plan)
