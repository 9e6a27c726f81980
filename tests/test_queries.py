"""Every registered query against its SQL counterpart, and again where joins may not broadcast or the zone differs."""

import pytest
from compare import connect, differences
from conftest import SMALL

import __spark_entry__ as entry_module

from weirgate.plans.oracles import ORACLES
from weirgate.plans.queries import QUERIES

TIMED = [
    "source_month_inventory",
    "landing_inventory",
    "month_delta",
    "month_windows",
    "month_range_scan",
    "limited_scan",
    "json_ingest",
    "derive_datetime",
    "safe_file_name",
    "parse_file_name",
    "warehouse_projection",
    "warehouse_merge",
    "create_or_insert",
    "ridership_rejected",
    "ridership_warehouse",
]
JOINED = [
    "limited_scan",
    "rule_in_dimension",
    "rule_in_dimension_pair",
    "validation_summary_ridership",
    "anti_join_new",
    "insert_new",
    "insert_new_null_keys",
    "insert_new_null_safe",
    "round_robin_shards",
    "ridership_rejected",
    "ridership_overlap",
    "insert_new_one_per_key_nulls",
]


@pytest.fixture(scope="module")
def oracle():
    return connect(SMALL)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    assert differences(QUERIES[name](spark, SMALL), oracle, ORACLES[name]) == ""


@pytest.mark.parametrize("name", TIMED)
def test_query_in_another_zone(spark, oracle, with_conf, name):
    with_conf({"spark.sql.session.timeZone": "America/New_York"})
    assert differences(QUERIES[name](spark, SMALL), oracle, ORACLES[name]) == ""


@pytest.mark.parametrize("name", JOINED)
def test_query_without_broadcast(spark, oracle, shuffled_joins, name):
    assert differences(QUERIES[name](spark, SMALL), oracle, ORACLES[name]) == ""


def test_entry(spark):
    new = entry_module.entry(spark)
    assert new.count() > 0
    assert new.columns == ["event_id", "ts", "et", "v"]
