import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weirgate.operators.dedup import dedup_rows
from weirgate.operators.rules import between, check, evaluate, in_dimension, in_set, matches_regex, not_null, parses_as
from weirgate.operators.schema import cast_failures, cast_schema, project_columns, warehouse_projection
from weirgate.operators.split import bad_rows, batch_counts, good_rows, limbo_rows, quarantine, read_quarantine
from weirgate.operators.summary import unexpected_samples, validation_gate, validation_summary, violation_counts
from weirgate.plans.feed import Feed
from weirgate.plans.ridership import RIDERSHIP, SCHEMA, TIMESTAMP_PATTERN

VALID = {
    "transit_timestamp": "2024-01-05T10:00:00.000",
    "transit_mode": "subway",
    "station_complex_id": "7",
    "station_complex": "First St (2,5)",
    "borough": "Queens",
    "payment_method": "omny",
    "fare_class_category": "OMNY - Other",
    "ridership": 10,
    "transfers": 0,
    "latitude": 40.7,
    "longitude": -73.9,
}


@pytest.fixture(scope="module")
def stations(spark):
    rows = [("7", "First St (2,5)"), ("8", "Second St"), ("TRAM1", "Tramway")]
    return spark.createDataFrame(rows, "station_complex_id string, station_complex string")


def feed_rows(spark, *changes):
    rows = [tuple({**VALID, **change}[c] for c in SCHEMA) for change in changes]
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in SCHEMA.items()))


CASES = [
    ({}, "good"),
    ({"borough": "Yonkers"}, "bad"),
    ({"borough": None}, "unknown"),
    ({"borough": None, "ridership": 0}, "bad"),
    ({"ridership": 1}, "good"),
    ({"ridership": 16217}, "good"),
    ({"ridership": 16218}, "bad"),
    ({"transfers": 1450}, "good"),
    ({"transfers": 1451}, "bad"),
    ({"transfers": -1}, "bad"),
    ({"latitude": 40.576126, "longitude": -74.07484}, "good"),
    ({"latitude": 40.903126, "longitude": -73.7554}, "good"),
    ({"latitude": math.nan}, "bad"),
    ({"longitude": -73.7}, "bad"),
    ({"transit_timestamp": "2020-99-99T99:99:99.999"}, "good"),
    ({"transit_timestamp": "2024-01-05 10:00:00"}, "bad"),
    ({"transit_mode": "bus"}, "bad"),
    ({"payment_method": "cash"}, "bad"),
    ({"fare_class_category": "Token"}, "bad"),
    ({"station_complex_id": "TRAM1"}, "good"),
    ({"station_complex_id": "999"}, "bad"),
    ({"station_complex": "Nowhere"}, "bad"),
    ({"station_complex_id": None}, "unknown"),
    ({"station_complex_id": "8"}, "good"),
]


@pytest.mark.parametrize("policy", ["pass", "fail", "drop"])
def test_feed_rules(spark, stations, policy):
    rules = RIDERSHIP.rules(stations)
    changes = [change for change, _ in CASES]
    rows = feed_rows(spark, *changes).withColumn("n", F.monotonically_increasing_id())
    numbered = [r["n"] for r in rows.select("n").collect()]
    flagged = evaluate(rows, rules)
    good = {r["n"] for r in good_rows(flagged, rules, policy).collect()}
    bad = {r["n"] for r in bad_rows(flagged, rules, policy).collect()}
    unknown_part = {"pass": "good", "fail": "bad", "drop": "neither"}[policy]
    for n, (change, kind) in zip(numbered, CASES):
        expected = unknown_part if kind == "unknown" else kind
        assert ("good" if n in good else "bad" if n in bad else "neither") == expected, change
    assert not good & bad
    counts = batch_counts(flagged, rules, policy).first()
    assert (counts["n_good"], counts["n_bad"], counts["n_all"]) == (len(good), len(bad), len(CASES))
    assert limbo_rows(flagged, rules).count() == 2


def test_wrong_pair_of_id_and_name(spark, stations):
    rule = in_dimension(["station_complex_id", "station_complex"], stations)
    rows = feed_rows(spark, {}, {"station_complex_id": "8"}, {"station_complex_id": None})
    found = [r[0] for r in evaluate(rows, [rule]).select(check(0)).collect()]
    assert sorted(found, key=str) == [False, None, True]


def test_strict_rules(spark):
    rows = feed_rows(spark, {"transit_timestamp": "2020-99-99T99:99:99.999"}, {"transit_timestamp": None}, {})
    rules = [matches_regex("transit_timestamp", TIMESTAMP_PATTERN), parses_as("transit_timestamp", "timestamp_ntz")]
    rules.append(not_null("transit_timestamp"))
    flags = evaluate(rows, rules).select(*[check(i).alias(f"c{i}") for i in range(3)]).collect()
    assert sorted([tuple(r) for r in flags], key=str) == [(False, False, False), (False, True, False), (None, None, True)]


def test_repeated_members_do_not_multiply_rows(spark, stations):
    rules = RIDERSHIP.rules(stations.unionAll(stations))
    rows = feed_rows(spark, {}, {"station_complex_id": "nope"})
    assert evaluate(rows, rules).count() == 2


def test_large_dimension_joins_without_broadcast(spark, stations, shuffled_joins):
    rules = RIDERSHIP.rules(stations)
    rows = feed_rows(spark, *[change for change, _ in CASES])
    plan = evaluate(rows, rules)._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert bad_rows(evaluate(rows, rules), rules).count() == sum(kind == "bad" for _, kind in CASES)


def test_summary_agrees_with_the_split(spark, stations):
    rules = RIDERSHIP.rules(stations)
    flagged = evaluate(feed_rows(spark, *[change for change, _ in CASES]), rules)
    summary = validation_summary(flagged, rules).collect()
    assert [r["column"] for r in summary] == [r.column for r in rules]
    by_column = {r["column"]: r for r in summary}
    assert by_column["borough"]["unexpected_count"] == 1
    assert by_column["borough"]["unexpected_percent"] == pytest.approx(100 / (len(CASES) - 2))
    assert by_column["borough"]["partial_unexpected_list"] == ["Yonkers"]
    assert by_column["transfers"]["partial_unexpected_list"] == ["-1", "1451"]
    assert by_column["ridership"]["partial_unexpected_list"] == ["0", "16218"]
    assert by_column["latitude"]["partial_unexpected_list"] == ["NaN"]
    assert by_column["payment_method"]["success"] is False
    assert validation_gate(flagged, rules).first()["success"] is False
    clean = evaluate(feed_rows(spark, {}, {"borough": None}), rules)
    assert validation_gate(clean, rules).first()["success"] is True
    assert bad_rows(clean, rules).isEmpty()
    assert {tuple(r["partial_unexpected_list"]) for r in validation_summary(clean, rules).collect()} == {()}


def test_summary_of_nothing(spark):
    rules = [in_set("a", ["x"]), between("b", 1, 2)]
    empty = evaluate(spark.createDataFrame([], "a string, b int"), rules)
    rows = violation_counts(empty, rules).collect()
    assert [(r["success"], r["unexpected_count"], r["unexpected_percent"]) for r in rows] == [(True, 0, 0.0)] * 2
    only_null = evaluate(spark.createDataFrame([(None, None)], "a string, b int"), rules)
    assert [r["unexpected_percent"] for r in violation_counts(only_null, rules).collect()] == [0.0, 0.0]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(-30, 30), max_size=60), st.integers(1, 6))
def test_samples_are_the_smallest_with_repeats(spark, values, k):
    rules = [between("v", 0, 5), in_set("t", ["1", "2"])]
    rows = spark.createDataFrame([(v, str(v)) for v in values], "v int, t string")
    found = {r["rule_no"]: r["samples"] for r in unexpected_samples(evaluate(rows, rules), rules, k).collect()}
    numbers = [str(v) for v in sorted(v for v in values if not 0 <= v <= 5)][:k]
    texts = sorted(str(v) for v in values if str(v) not in ("1", "2"))[:k]
    assert found.get(0, []) == numbers
    assert found.get(1, []) == texts


def test_samples_of_missing_and_combined_values(spark, stations):
    rules = [not_null("borough"), in_dimension(["station_complex_id", "station_complex"], stations)]
    rows = feed_rows(spark, {"borough": None}, {"borough": None}, {"station_complex_id": "8"})
    found = {r["rule_no"]: r["samples"] for r in unexpected_samples(evaluate(rows, rules), rules).collect()}
    assert found == {0: [None, None], 1: ["8,First St (2,5)"]}


def test_quarantine_replaces_its_own_batch(spark, stations, tmp_path):
    rules = RIDERSHIP.rules(stations)
    path = str(tmp_path / "quarantine")
    flagged = evaluate(feed_rows(spark, *[change for change, _ in CASES]), rules)
    for _ in range(2):
        kept = quarantine(flagged, rules, path, "b1")
    quarantine(flagged, rules, path, "b2")
    assert kept.n_good == kept.good.count() and kept.n_bad == kept.bad.count()
    assert (kept.n_good + kept.n_bad, kept.n_limbo) == (len(CASES), 0)
    schema = flagged.drop("checks").schema
    counts = {r["verdict"]: r["count"] for r in read_quarantine(spark, path, schema).groupBy("verdict").count().collect()}
    assert counts == {"good": 2 * kept.n_good, "bad": 2 * kept.n_bad}
    clean = quarantine(evaluate(feed_rows(spark, {}), rules), rules, path, "b1")
    assert (clean.n_good, clean.n_bad, clean.bad.count()) == (1, 0, 0)
    assert read_quarantine(spark, path, schema).where("batch_id = 'b1'").count() == 1
    dropped = quarantine(flagged, rules, path, "b3", "drop")
    assert dropped.n_limbo == dropped.limbo.count() > 0
    assert dropped.n_good + dropped.n_bad + dropped.n_limbo == len(CASES)


def test_samples_are_cut_before_the_shuffle(spark, with_conf):
    """Every row offends with a value of its own; only the first few of each task are shuffled."""
    rules = [between("v", 0, 5), in_set("t", ["x"])]
    rows = spark.range(10, 50_010, 1, 4).selectExpr("CAST(id AS INT) AS v", "CAST(id AS STRING) AS t")
    samples = unexpected_samples(evaluate(rows, rules), rules, 20)
    text = samples._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert {r["rule_no"]: len(r["samples"]) for r in samples.collect()} == {0: 20, 1: 20}


def test_casts(spark):
    rows = spark.createDataFrame([("abc",), ("",), ("1.7",), ("1e12",), ("12",), (None,), ("NaN",), (" 5 ",)], "v string")
    assert [r["v"] for r in cast_schema(rows, {"v": "int"}).collect()] == [None, None, 1, None, 12, None, None, 5]
    assert cast_failures(rows, {"v": "int"}).first()["cast_failures"] == 4
    big = spark.createDataFrame([("9007199254740993",), ("7.9",)], "v string")
    for spelling in ("bigint", "BIGINT", "long", "Long"):
        assert [r["v"] for r in cast_schema(big, {"v": spelling}).collect()] == [9007199254740993, 7]
    for spelling in ("INT", "integer", "short", "SMALLINT", "byte"):
        assert cast_schema(big, {"v": spelling}).collect()[1]["v"] == 7


def test_projection(spark):
    rows = spark.createDataFrame([(1, 2, 3)], "a int, b int, extra int")
    assert project_columns(rows, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError, match="missing columns: c"):
        project_columns(rows, ["a", "c"])


def test_warehouse_projection_types(spark):
    types = {"transit_timestamp": "timestamp_ntz", "ridership": "bigint", "latitude": "double"}
    wide = warehouse_projection(feed_rows(spark, {}, {"transit_timestamp": "?"}), "transit_timestamp", types)
    assert dict(wide.dtypes) == types
    assert sorted(r["transit_timestamp"] is None for r in wide.collect()) == [False, True]


def test_whole_row_dedup_treats_nulls_alike(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, "a")], "a int, b string")
    assert dedup_rows(rows).count() == 3


def test_feed_from_a_rule_file(spark, stations):
    config = {
        "expected_columns": ["day", "kind", "place", "n"],
        "schema": {"day": "string", "kind": "string", "place": "string", "n": "int"},
        "key_columns": ["day", "place"],
        "regex_patterns": {"day": r"^\d{4}-\d{2}-\d{2}$"},
        "allowed_values": {"kind": ["a", "b"]},
        "range_constraints": {"n": {"min": 1, "max": 9}},
    }
    feed = Feed.from_config(config, "day", "day_text", {"day": "timestamp_ntz"}, ["place"])
    places = stations.withColumnRenamed("station_complex_id", "place")
    rows = spark.createDataFrame(
        [("2024-01-01", "a", "7", 5), ("x", "c", "?", 0)], "day string, kind string, place string, n int"
    )
    counts = violation_counts(evaluate(rows, feed.rules(places)), feed.rules(places)).collect()
    assert [(r["column"], r["unexpected_count"]) for r in counts] == [("day", 1), ("kind", 1), ("place", 1), ("n", 1)]
    with pytest.raises(ValueError, match="not expected: extra"):
        Feed.from_config({**config, "schema": {"extra": "int"}}, "day", "day_text", {})


def test_hot_values_and_nulls_are_split(spark, shuffled_joins, with_conf, tmp_path):
    """A third of the batch holds one member and a third holds NULL; the dimension may not be broadcast."""
    with_conf(
        {
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16",
        }
    )
    path, n = str(tmp_path / "rows"), 60_000
    value = "CASE id % 3 WHEN 0 THEN -1 WHEN 1 THEN NULL ELSE id END AS v"
    spark.range(n, numPartitions=8).selectExpr(value, "uuid() AS note").write.parquet(path)
    members = spark.range(-1, n // 2).withColumnRenamed("id", "v")
    rules = [in_dimension("v", members)]
    flagged = evaluate(spark.read.parquet(path), rules)
    found = flagged.withColumn("bad", check(0))
    rows = found.collect()
    assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString()
    assert sum(r["bad"] is None for r in rows) == n // 3
    assert sum(r["bad"] is True for r in rows) == sum(v >= n // 2 for v in range(2, n, 3))
    assert len(rows) == n
