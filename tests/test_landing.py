"""Landing and reading months that change, differ in schema, or wait for the warehouse."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_feed import FEB, FEB_1, JAN, JAN_1, MAR, months, places, source, stations, stored  # noqa: F401

from weirgate.plans import bronze
from weirgate.plans.bronze import land_missing_months
from weirgate.plans.ridership import RIDERSHIP
from weirgate.plans.silver import load_batch, load_worklist
from weirgate.plans.status import read_status
from weirgate.plans.warehouse import merge_warehouse, waiting_rows
from weirgate.sources import land_by_month, month_prints, read_landed_columns, read_landed_months, read_worklist, worklist_entries

LATE = ("2024-01-03T00:00:00.000", "7", "4")
NO_TIME = ("someday", "7", "1")
MAR_1 = datetime(2024, 3, 1)


def landings(spark, places):  # noqa: F811
    rows = read_status(spark, places.status).where("stage = 'landing' AND state = 'landed'").collect()
    return sorted((r["month"] is not None, r["month"]) for r in rows)


def landed(spark, places, *listed):  # noqa: F811
    rows = read_landed_months(spark, places.landing, listed).collect()
    return sorted(str((r["transit_timestamp"], r["ridership"])) for r in rows)


def test_changed_months_land_again(spark, stations, places):  # noqa: F811
    land_missing_months(spark, source(spark, JAN, FEB, FEB), RIDERSHIP, places, changed=True)
    load_worklist(spark, stations, RIDERSHIP, places, "b1")
    # The same rows in another order are no change, one of two equal rows less is one.
    assert months(land_missing_months(spark, source(spark, FEB, JAN, FEB), RIDERSHIP, places, changed=True)) == []
    assert months(land_missing_months(spark, source(spark, JAN, FEB), RIDERSHIP, places, changed=True)) == [FEB_1]
    assert months(land_missing_months(spark, source(spark, JAN, LATE, FEB), RIDERSHIP, places, changed=True)) == [JAN_1, FEB_1]
    assert load_worklist(spark, stations, RIDERSHIP, places, "b2").n_new == 1
    assert len(landings(spark, places)) == 4 and merge_warehouse(spark, RIDERSHIP, places) == 3


def test_undated_rows_land_whenever_they_change(spark, stations, places):  # noqa: F811
    land_missing_months(spark, source(spark, JAN, NO_TIME), RIDERSHIP, places)
    load_worklist(spark, stations, RIDERSHIP, places, "b1", on_reject="record")
    more = source(spark, JAN, FEB, NO_TIME, NO_TIME, (None, "7", "2"))
    assert months(land_missing_months(spark, more, RIDERSHIP, places)) == [None, FEB_1]
    assert len(landed(spark, places, None)) == 3
    load_worklist(spark, stations, RIDERSHIP, places, "b2", on_reject="record")
    assert months(land_missing_months(spark, more, RIDERSHIP, places)) == []


def test_months_without_a_note_are_compared_with_what_is_landed(spark, stations, places):  # noqa: F811
    land_missing_months(spark, source(spark, JAN, FEB), RIDERSHIP, places)
    load_worklist(spark, stations, RIDERSHIP, places, "b1")
    assert months(land_missing_months(spark, source(spark, JAN, LATE, FEB), RIDERSHIP, places, changed=True)) == [JAN_1]
    assert landed(spark, places, JAN_1) == sorted([str((JAN[0], JAN[2])), str((LATE[0], LATE[2]))])


def test_a_landing_that_was_cut_off_is_done_again(spark, stations, places, monkeypatch):  # noqa: F811
    def killed(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(bronze, "note_landed", killed)
        with pytest.raises(RuntimeError, match="killed"):
            land_missing_months(spark, source(spark, JAN), RIDERSHIP, places)
    assert months(land_missing_months(spark, source(spark, JAN, LATE), RIDERSHIP, places)) == [JAN_1]
    assert len(landed(spark, places, JAN_1)) == 2
    assert months(land_missing_months(spark, source(spark, JAN, LATE, FEB), RIDERSHIP, places)) == [JAN_1, FEB_1]
    assert landings(spark, places) == [(True, JAN_1), (True, FEB_1)]


def test_prints_tell_nulls_and_copies(spark):
    def told(*rows):
        found = month_prints(spark.createDataFrame(list(rows), "t string, a string, b string"), F.col("t").try_cast("timestamp_ntz"))
        return {r["month"]: r["print"] for r in found.collect()}

    day = "2024-01-05 00:00:00"
    base = told((day, "x", None))
    assert base == told((day, "x", None)) and set(base) == {JAN_1}
    others = [told((day, None, "x")), told((day, "x", None), (day, "x", None)), told((day, "x", ""))]
    assert all(base != other for other in others)
    assert set(told((None, "x", "y"), (day, "x", "y"))) == {None, JAN_1}


def test_months_of_another_schema(spark, tmp_path):
    root, time = str(tmp_path), F.col("t")

    def land(month, **columns):
        row = spark.range(1).select(F.lit(f"2024-0{month}-02 03:04:05").alias("t"), *[F.expr(v).alias(k) for k, v in columns.items()])
        land_by_month(row.select("t", *sorted(columns)[:: 1 if month % 2 else -1]), time, root)

    land(1, a="'1'", b="2.5D")
    land(2, a="1", b="'2.5'", more="'x'")
    listed = [JAN_1, FEB_1]
    rows = read_landed_columns(spark, root, listed, ["a", "b", "t"])
    assert rows.dtypes == [("a", "string"), ("b", "string"), ("t", "string")]
    assert sorted((r.a, r.b, r.t[:10]) for r in rows.collect()) == [("1", "2.5", "2024-01-02"), ("1", "2.5", "2024-02-02")]
    land(3, a="'1'")
    for order in ([JAN_1, FEB_1, MAR_1], [MAR_1, FEB_1, JAN_1]):
        with pytest.raises(ValueError, match=r"^missing columns: b in 2024-03$"):
            read_landed_columns(spark, root, order, ["a", "b"])
    assert read_landed_columns(spark, root, [MAR_1], ["a"]).count() == 1


def test_a_month_that_lacks_a_column_is_an_error_wherever_it_stands(spark, stations, places):  # noqa: F811
    land_missing_months(spark, source(spark, JAN), RIDERSHIP, places)
    land_missing_months(spark, source(spark, JAN, FEB).drop("borough"), RIDERSHIP, places)
    with pytest.raises(ValueError, match="missing columns: borough in 2024-02"):
        load_worklist(spark, stations, RIDERSHIP, places, "b1")


def test_refused_entries_of_the_work_list(spark, tmp_path):
    path = str(tmp_path / "list")
    entries = ["2024-01-01T00:00:00.000", "undated", "2024-1-1", None]
    spark.createDataFrame([(e,) for e in entries], "new_timestamps string").write.parquet(path)
    found = {r["entry"]: (r["month"], r["refused"]) for r in worklist_entries(spark, path).collect()}
    assert found == {entries[0]: (JAN_1, False), "undated": (None, False), "2024-1-1": (None, True), None: (None, True)}
    with pytest.raises(Exception, match="no month on the work list: (2024-1-1|NULL)"):
        read_worklist(spark, path).collect()


def test_a_merge_lists_only_what_waits(spark, stations, places):  # noqa: F811
    for k, row in enumerate((JAN, FEB, MAR)):
        load_batch(spark, source(spark, row), stations, RIDERSHIP, places, f"b{k}")
    assert merge_warehouse(spark, RIDERSHIP, places, wave=2) == 3
    load_batch(spark, source(spark, LATE), stations, RIDERSHIP, places, "b3")
    files = waiting_rows(spark, RIDERSHIP, places, ["b3"]).inputFiles()
    assert files and all("/batch_id=b3/" in f for f in files)
    assert merge_warehouse(spark, RIDERSHIP, places, retire=True) == 1 and len(stored(spark, places)) == 4
    assert waiting_rows(spark, RIDERSHIP, places, ["b3"]).isEmpty() and not waiting_rows(spark, RIDERSHIP, places, ["b2"]).isEmpty()
    assert merge_warehouse(spark, RIDERSHIP, places) == 0
