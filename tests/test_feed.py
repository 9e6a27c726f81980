from dataclasses import replace
from datetime import datetime

import pytest

from weirgate.operators.months import collect_listed
from weirgate.operators.split import read_quarantine
from weirgate.plans.bronze import land_missing_months
from weirgate.plans.feed import Places
from weirgate.plans.ridership import RIDERSHIP
from weirgate.plans.silver import BatchRejected, load_batch, load_worklist
from weirgate.plans.status import read_status
from weirgate.plans.warehouse import merge_warehouse, read_warehouse, unmerged_batches
from weirgate.sources import read_json_pages, read_worklist, write_worklist
from weirgate.streaming.landed import load_landed_files

STATIONS = [("7", "First St"), ("8", "Second St")]


@pytest.fixture
def places(tmp_path):
    return Places.below(str(tmp_path))


@pytest.fixture
def stations(spark):
    return spark.createDataFrame(STATIONS, "station_complex_id string, station_complex string")


def source(spark, *rows):
    """Raw text rows from (time, station, riders)."""
    columns = [*RIDERSHIP.types, "extra"]
    full = [
        (t, "subway", s, "First St", "Bronx", "omny", "OMNY - Other", r, "0", "40.7", "-73.9", "x") for t, s, r in rows
    ]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in columns))


JAN = ("2024-01-31T23:00:00.000", "7", "5.0")
FEB = ("2024-02-01T00:00:00.000", "7", "6.0")
MAR = ("2024-03-10T02:30:00.000", "8", "7.0")


JAN_1, FEB_1 = datetime(2024, 1, 1), datetime(2024, 2, 1)


def months(frame):
    return collect_listed(frame)


def stored(spark, places):
    return sorted((r["transit_timestamp"], r["ridership"]) for r in read_warehouse(spark, RIDERSHIP, places).collect())


def test_two_runs(spark, stations, places, zone):
    listed = land_missing_months(spark, source(spark, JAN, JAN, FEB), RIDERSHIP, places)
    assert months(listed) == [datetime(2024, 1, 1), datetime(2024, 2, 1)]
    outcome = load_worklist(spark, stations, RIDERSHIP, places, "run1")
    assert (outcome.state, outcome.n_new) == ("loaded", 2)
    assert {r["transit_datetime"] for r in outcome.new_rows.collect()} == {"2024-01-31 23:00:00", "2024-02-01 00:00:00"}
    assert outcome.summary().where("NOT success").isEmpty()
    assert merge_warehouse(spark, RIDERSHIP, places) == 2

    late = ("2024-01-02T00:00:00.000", "7", "9.0")
    whole = source(spark, JAN, FEB, MAR, late)
    assert months(land_missing_months(spark, whole, RIDERSHIP, places)) == [datetime(2024, 3, 1)]
    assert load_worklist(spark, stations, RIDERSHIP, places, "run2").n_new == 1
    assert merge_warehouse(spark, RIDERSHIP, places) == 1
    assert merge_warehouse(spark, RIDERSHIP, places) == 0
    assert stored(spark, places) == [
        (datetime(2024, 1, 31, 23), 5),
        (datetime(2024, 2, 1), 6),
        (datetime(2024, 3, 10, 2, 30), 7),
    ]

    # Nothing missing: an empty list, and silver has nothing to do.
    assert months(land_missing_months(spark, whole, RIDERSHIP, places)) == []
    assert load_worklist(spark, stations, RIDERSHIP, places, "run3").state == "empty"

    # The last three months again, for the late row.
    again = land_missing_months(spark, whole, RIDERSHIP, places, reopen_last=3)
    assert len(months(again)) == 3
    assert load_worklist(spark, stations, RIDERSHIP, places, "run4").n_new == 1
    assert merge_warehouse(spark, RIDERSHIP, places) == 1


def test_staged_batches_wait_for_the_warehouse(spark, stations, places):
    for batch_id, rows in (("b1", [JAN]), ("b2", [JAN, FEB]), ("b3", [FEB])):
        load_batch(spark, source(spark, *rows), stations, RIDERSHIP, places, batch_id)
    assert merge_warehouse(spark, RIDERSHIP, places) == 2
    assert len(stored(spark, places)) == 2


def test_months_stay_listed_until_silver_settles_them(spark, stations, places):
    land_missing_months(spark, source(spark, JAN), RIDERSHIP, places)
    listed = land_missing_months(spark, source(spark, JAN, FEB), RIDERSHIP, places)
    assert months(listed) == [datetime(2024, 1, 1), datetime(2024, 2, 1)]


def test_rejected_batch(spark, stations, places):
    raw = source(spark, JAN, FEB, ("2024-02-02T00:00:00.000", "99", "1.0"), ("2024-02-03T00:00:00.000", "7", "0"))
    with pytest.raises(BatchRejected) as rejected:
        load_batch(spark, raw, stations, RIDERSHIP, places, "b1")
    outcome = rejected.value.outcome
    assert (outcome.n_good, outcome.n_bad) == (2, 2)
    failed = {r["column"]: r["partial_unexpected_list"] for r in outcome.summary().where("NOT success").collect()}
    assert failed == {"station_complex_id": ["99"], "ridership": ["0"]}
    assert quarantined(spark, places, outcome) == [("bad", 2), ("good", 2)]
    assert {r["state"] for r in read_status(spark, places.status).collect()} == {"rejected"}
    merge_warehouse(spark, RIDERSHIP, places)
    assert stored(spark, places) == []
    # The same batch again leaves one copy in quarantine.
    load_batch(spark, raw, stations, RIDERSHIP, places, "b1", on_reject="record")
    assert quarantined(spark, places, outcome) == [("bad", 2), ("good", 2)]


def test_cast_failures_pass_the_rules_but_are_told(spark, stations, places):
    raw = source(spark, JAN, ("2024-01-07T00:00:00.000", "7", "abc"))
    outcome = load_batch(spark, raw, stations, RIDERSHIP, places, "b1")
    assert outcome.n_new == 2
    assert {c: n for c, n in outcome.cast_failures.items() if n} == {"ridership": 1}
    noted = read_status(spark, places.status).where("stage = 'casts'").collect()
    assert [(r["state"], r["n_rows"]) for r in noted] == [("ridership", 1)]


def test_the_id_of_a_loaded_batch_is_refused(spark, stations, places):
    load_batch(spark, source(spark, JAN), stations, RIDERSHIP, places, "b1")
    with pytest.raises(ValueError, match="loaded already"):
        load_batch(spark, source(spark, FEB), stations, RIDERSHIP, places, "b1")
    assert merge_warehouse(spark, RIDERSHIP, places) == 1


def test_missing_column(spark, stations, places):
    with pytest.raises(ValueError, match="missing columns: borough"):
        load_batch(spark, source(spark, JAN).drop("borough"), stations, RIDERSHIP, places, "b1")


def test_every_row_is_landed_and_judged(spark, stations, places):
    """Rows whose time is no time go through gate and quarantine like the others."""
    rows = [JAN, ("someday", "7", "1"), (None, "7", "2"), FEB]
    assert months(land_missing_months(spark, source(spark, *rows), RIDERSHIP, places)) == [None, JAN_1, FEB_1]
    outcome = load_worklist(spark, stations, RIDERSHIP, places, "b1", on_reject="record")
    assert (outcome.state, outcome.n_good, outcome.n_bad) == ("rejected", 3, 1)
    undated = read_status(spark, places.status).where("stage = 'undated'").collect()
    assert [r["n_rows"] for r in undated] == [2]
    assert months(land_missing_months(spark, source(spark, *rows), RIDERSHIP, places)) == []


def test_reopened_months_stay_listed_until_loaded(spark, stations, places):
    land_missing_months(spark, source(spark, JAN), RIDERSHIP, places)
    load_worklist(spark, stations, RIDERSHIP, places, "b1")
    whole = source(spark, JAN, ("2024-01-03T00:00:00.000", "7", "4"))
    assert months(land_missing_months(spark, whole, RIDERSHIP, places, reopen_last=1)) == [JAN_1]
    assert months(land_missing_months(spark, whole, RIDERSHIP, places)) == [JAN_1]
    assert load_worklist(spark, stations, RIDERSHIP, places, "b2").n_new == 1
    assert months(land_missing_months(spark, whole, RIDERSHIP, places)) == []


def test_rejected_months_on_request(spark, stations, places):
    rows = source(spark, JAN, ("2024-02-03T00:00:00.000", "9", "4"))
    land_missing_months(spark, rows, RIDERSHIP, places)
    assert load_worklist(spark, stations, RIDERSHIP, places, "b1", on_reject="record").state == "rejected"
    assert months(land_missing_months(spark, rows, RIDERSHIP, places)) == []
    assert months(land_missing_months(spark, rows, RIDERSHIP, places, reopen_rejected=True)) == [JAN_1, FEB_1]
    more = stations.union(spark.createDataFrame([("9", "Ninth St")], stations.schema))
    assert load_worklist(spark, more, RIDERSHIP, places, "b2").n_new == 2


def test_listed_but_absent_months_are_named(spark, stations, places):
    land_missing_months(spark, source(spark, JAN), RIDERSHIP, places)
    listed = spark.createDataFrame([(JAN_1,), (FEB_1,)], "month timestamp_ntz")
    write_worklist(listed, places.worklist)
    outcome = load_worklist(spark, stations, RIDERSHIP, places, "b1")
    assert outcome.n_new == 1 and outcome.absent_months == [FEB_1]
    write_worklist(listed.where("month > TIMESTAMP_NTZ '2024-01-15'"), places.worklist)
    assert load_worklist(spark, stations, RIDERSHIP, places, "b2").state == "empty"


def quarantined(spark, places, outcome):
    kept = read_quarantine(spark, places.quarantine, outcome.flagged.drop("checks").schema)
    return sorted((r["verdict"], r["count"]) for r in kept.groupBy("verdict").count().collect())


def test_a_batch_again_replaces_all_it_left_in_quarantine(spark, stations, places):
    def load(*rows, **options):
        return load_batch(spark, source(spark, *rows), stations, RIDERSHIP, places, "b1", on_reject="record", **options)

    bad = ("2024-02-02T00:00:00.000", "99", "1.0")
    first = load(JAN, FEB, bad)
    assert quarantined(spark, places, first) == [("bad", 1), ("good", 2)]
    load(bad)
    assert quarantined(spark, places, first) == [("bad", 1)]
    unknown = load(bad, (JAN[0], None, "3"), null_policy="drop")
    assert (unknown.n_good, unknown.n_bad, unknown.n_limbo) == (0, 1, 1)
    assert quarantined(spark, places, first) == [("bad", 1), ("limbo", 1)]
    assert load(JAN).state == "loaded"
    assert quarantined(spark, places, first) == []


@pytest.mark.parametrize(
    "wrong",
    [
        {"patterns": {"burough": "x"}},
        {"accepted": {"burough": ["x"]}},
        {"ranges": {"burough": (0, 1)}},
        {"dimension_columns": ("no_such_column",)},
        {"keys": ("burough",)},
        {"required": ("burough",)},
        {"parseable": {"burough": "int"}},
        {"dimension_groups": (("station_complex_id", "burough"),)},
        {"time_column": "burough"},
    ],
)
def test_rules_on_unknown_columns_are_refused(wrong):
    with pytest.raises(ValueError, match="does not have"):
        replace(RIDERSHIP, **wrong)


def test_declared_rules(spark, stations, places):
    strict = replace(
        RIDERSHIP, required=("ridership",), parseable={"transit_timestamp": "timestamp_ntz"},
        dimension_groups=(("station_complex_id", "station_complex"),),
    )
    rows = source(spark, JAN, ("2024-99-99T00:00:00.000", "7", "1"), (FEB[0], "8", "1"), (FEB[0], "7", "abc"))
    outcome = load_batch(spark, rows, stations, strict, places, "b1", on_reject="record")
    failed = {(r["expectation_type"].removeprefix("expect_column_values_to_"), r["column"]) for r in outcome.summary().where("NOT success").collect()}
    pair = "station_complex_id,station_complex"
    assert failed == {("be_of_type", "transit_timestamp"), ("be_in_set", pair), ("not_be_null", "ridership")}


def test_reading_makes_nothing(spark, places, tmp_path):
    for read in (lambda: read_warehouse(spark, RIDERSHIP, places), lambda: read_status(spark, places.status)):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read().collect()
    assert list(tmp_path.iterdir()) == []


def test_many_waiting_batches(spark, stations, places):
    for k in range(3):
        load_batch(spark, source(spark, (f"2024-01-0{k + 1}T00:00:00.000", "7", "1")), stations, RIDERSHIP, places, f"b{k}")
    assert unmerged_batches(spark, places).count() == 3
    assert merge_warehouse(spark, RIDERSHIP, places) == 3
    assert unmerged_batches(spark, places).count() == 0 and merge_warehouse(spark, RIDERSHIP, places) == 0


def test_from_json_pages(spark, stations, places, tmp_path):
    source(spark, JAN, MAR).write.json(str(tmp_path / "pages"))
    pages = read_json_pages(spark, str(tmp_path / "pages"), list(RIDERSHIP.types))
    land_missing_months(spark, pages, RIDERSHIP, places)
    assert load_worklist(spark, stations, RIDERSHIP, places, "b1").n_new == 2
    assert months(read_worklist(spark, places.worklist)) == [datetime(2024, 1, 1), datetime(2024, 3, 1)]


def test_landed_files_as_a_stream(spark, stations, places, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    for rows in ([JAN, FEB], [JAN, FEB, MAR]):
        land_missing_months(spark, source(spark, *rows), RIDERSHIP, places)
        load_landed_files(spark, stations, RIDERSHIP, places, checkpoint).awaitTermination()
        merge_warehouse(spark, RIDERSHIP, places)
    assert len(stored(spark, places)) == 3
    batches = {r["batch_id"] for r in read_status(spark, places.status).where("stage = 'silver'").collect()}
    assert batches == {"stream-000000000", "stream-000000001"}
