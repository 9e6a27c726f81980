from datetime import datetime

import pytest
from pyspark.sql import functions as F

from weirgate.functions import (
    add_month,
    datetime_text,
    file_name_to_iso,
    iso_text,
    month_start,
    parse_iso,
    safe_file_name,
)
from weirgate.operators.months import collect_listed, collect_months, in_months, month_delta
from weirgate.sources import (
    create_landing,
    land_by_month,
    landed_files,
    landed_months,
    landing_inventory,
    read_dimension,
    read_json_pages,
    read_landed_months,
    read_worklist,
    write_worklist,
)


def times(spark, *values, name="month"):
    return spark.createDataFrame([(v,) for v in values], f"{name} timestamp_ntz")


def one(spark, expression, value):
    return spark.range(1).select(expression(F.lit(value)).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "start, end",
    [
        ("2024-01-31T00:00:00.000", datetime(2024, 2, 29)),
        ("2024-02-29T00:00:00.000", datetime(2024, 3, 29)),
        ("2023-12-01T00:00:00.000", datetime(2024, 1, 1)),
        ("2023-02-10T01:30:00.250", datetime(2023, 3, 10, 1, 30, 0, 250000)),
        ("2023-02-12T02:30:00.000", datetime(2023, 3, 12, 2, 30)),
        ("2024-02-30T00:00:00.000", None),
        ("2024-02-01", None),
        ("soon", None),
    ],
)
def test_add_month(spark, zone, start, end):
    assert one(spark, lambda c: add_month(parse_iso(c)), start) == end


def test_time_in_the_missing_hour(spark, zone):
    text = "2023-03-12T02:30:00.000"
    assert one(spark, datetime_text, text) == "2023-03-12 02:30:00"
    assert one(spark, lambda c: iso_text(parse_iso(c)), text) == text
    assert one(spark, lambda c: month_start(parse_iso(c)), text) == datetime(2023, 3, 1)


@pytest.mark.parametrize("text", ["2020-07-01T00:00:00.000", "2023-03-12T02:30:00.007", "1999-12-31T23:59:59.990"])
def test_file_name_round_trip(spark, zone, text):
    name = one(spark, lambda c: safe_file_name(parse_iso(c)), text)
    assert name == "ridership_" + text.replace(":", "-").replace(".", "-") + ".parquet"
    assert one(spark, lambda c: file_name_to_iso(F.concat(F.lit("gs://bucket/folder/"), c)), name) == text


@pytest.mark.parametrize(
    "path, iso",
    [
        ("a/ridership_2020-07-01T00-00-00-000.parquet", "2020-07-01T00:00:00.000"),
        ("a/month_file=ridership_2020-07-01T00-00-00-000.parquet/part-0.snappy.parquet", "2020-07-01T00:00:00.000"),
        ("ridership_2020-07-01T00-00-00-000.parquet", "2020-07-01T00:00:00.000"),
        ("a/other.parquet", None),
        ("a/old_ridership_2020-07-01T00-00-00-000.parquet", None),
        ("a/ridership_2020-07-01T00-00-00-000.parquet.bak", None),
        ("a/ridership_2020-07-01T00-00-00-000.parquet/other.parquet", None),
        ("a/ridership_2020-07-01T00-00-00.parquet", None),
    ],
)
def test_landed_paths(spark, path, iso):
    assert one(spark, file_name_to_iso, path) == iso


def test_month_delta(spark):
    source = times(spark, datetime(2024, 3, 1), datetime(2024, 1, 1), datetime(2024, 2, 1))
    landed = times(spark, datetime(2024, 1, 1), datetime(2023, 1, 1))
    found = [r["month"] for r in month_delta(source, landed).collect()]
    assert found == [datetime(2024, 2, 1), datetime(2024, 3, 1)]
    assert month_delta(source, source).isEmpty()
    again = [r["month"] for r in month_delta(source, source, reopen_last=1).collect()]
    assert again == [datetime(2024, 3, 1)]


def test_in_months_merges_neighbours(spark):
    months = [datetime(2024, 1, 1), datetime(2023, 12, 1), datetime(2024, 5, 1)]
    rows = times(
        spark,
        datetime(2023, 11, 30, 23, 59),
        datetime(2023, 12, 1),
        datetime(2024, 1, 31, 23, 59, 59),
        datetime(2024, 2, 1),
        datetime(2024, 5, 31),
        None,
        name="ts",
    )
    condition = in_months(F.col("ts"), months)
    assert str(condition._jc).count(">=") == 2
    assert rows.where(condition).count() == 3
    assert rows.where(in_months(F.col("ts"), [])).count() == 0


def test_landing_and_worklist(spark, tmp_path, zone):
    root, listed = str(tmp_path / "landing"), str(tmp_path / "list.parquet")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):  # reading makes no folder
        landed_months(spark, root).isEmpty()
    create_landing(spark, root)
    assert landed_months(spark, root).isEmpty()
    rows = spark.createDataFrame(
        [(1, datetime(2024, 1, 5)), (2, datetime(2024, 1, 6)), (3, datetime(2024, 3, 31, 23, 59))],
        "id int, ts timestamp_ntz",
    )
    land_by_month(rows, F.col("ts"), root)
    assert collect_months(landed_months(spark, root)) == [datetime(2024, 1, 1), datetime(2024, 3, 1)]
    assert [r["iso_time"] for r in landing_inventory(spark, root).orderBy("iso_time").collect()] == [
        "2024-01-01T00:00:00.000",
        "2024-03-01T00:00:00.000",
    ]
    # A month landed again is replaced; others stay.
    land_by_month(rows.where("id = 2"), F.col("ts"), root)
    write_worklist(times(spark, datetime(2024, 1, 1)), listed)
    assert spark.read.parquet(listed).collect()[0]["new_timestamps"] == "2024-01-01T00:00:00.000"
    months = collect_listed(read_worklist(spark, listed))
    assert [r["id"] for r in read_landed_months(spark, root, months).collect()] == [2]
    assert spark.read.parquet(root).count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_landed_months(spark, root, [datetime(2024, 2, 1)])
    write_worklist(times(spark), listed)
    assert read_worklist(spark, listed).isEmpty()


def test_flat_landed_files_are_found(spark, tmp_path):
    spark.range(1).coalesce(1).write.parquet(str(tmp_path / "made"))
    part = next((tmp_path / "made").glob("part-*"))
    root = tmp_path / "landing"
    root.mkdir()
    (root / "ridership_2020-07-01T00-00-00-000.parquet").write_bytes(part.read_bytes())
    spark.range(1).write.parquet(str(root / "other.parquet"))
    found = landed_files(spark, str(root)).collect()
    assert [(r["iso_time"], r["flat"]) for r in found] == [("2020-07-01T00:00:00.000", True)]
    assert collect_months(landed_months(spark, str(root))) == [datetime(2020, 7, 1)]
    assert read_landed_months(spark, str(root), [datetime(2020, 7, 1)], flat=[datetime(2020, 7, 1)]).count() == 1


def test_rows_without_a_month_land_and_are_listed(spark, tmp_path):
    root, listed = str(tmp_path / "landing"), str(tmp_path / "list")
    rows = spark.createDataFrame([(1, "2024-01-05"), (2, "someday"), (3, None)], "id int, day string")
    done = land_by_month(rows, F.col("day"), root)
    assert (done.n_rows, done.n_undated, list(done.months)) == (3, 2, [datetime(2024, 1, 1)])
    assert collect_listed(landed_months(spark, root, undated=True)) == [None, datetime(2024, 1, 1)]
    assert collect_listed(landed_months(spark, root)) == [datetime(2024, 1, 1)]
    write_worklist(landed_months(spark, root, undated=True), listed)
    months = collect_listed(read_worklist(spark, listed))
    assert months == [None, datetime(2024, 1, 1)]
    assert sorted(r["id"] for r in read_landed_months(spark, root, months).collect()) == [1, 2, 3]
    assert [r["id"] for r in read_landed_months(spark, root, months[1:]).collect()] == [1]


def test_another_feed_names_its_files(spark, tmp_path):
    root = str(tmp_path / "landing")
    land_by_month(spark.createDataFrame([(1, "2024-01-05")], "id int, day string"), F.col("day"), root, "a.b")
    assert collect_months(landed_months(spark, root, "a.b")) == [datetime(2024, 1, 1)]
    assert landed_months(spark, root, "axb").isEmpty() and landed_months(spark, root).isEmpty()
    assert read_landed_months(spark, root, [datetime(2024, 1, 1)], "a.b").count() == 1


def test_json_pages(spark, tmp_path):
    (tmp_path / "page1.json").write_text('[{"id": 1, "v": "1.0", "x": true}, {"id": "2", "v": 2.50}]\n{"id": 3}\n')
    pages = read_json_pages(spark, str(tmp_path), ["id", "v"])
    assert sorted((r["id"], r["v"]) for r in pages.collect()) == [("1", "1.0"), ("2", "2.50"), ("3", None)]
    (tmp_path / "page2.json").write_text('[{"id": 4,')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_json_pages(spark, str(tmp_path), ["id", "v"]).collect()


def test_dimension_with_quoted_commas(spark, tmp_path):
    file = tmp_path / "stations.csv"
    file.write_text('index,id,name\n0,7,"First St (2,5)"\n1,TRAM1,"The ""Loop"""\n')
    rows = read_dimension(spark, str(file), "index int, id string, name string").collect()
    assert [(r["id"], r["name"]) for r in rows] == [("7", "First St (2,5)"), ("TRAM1", 'The "Loop"')]
    with pytest.raises(Exception, match="header"):
        read_dimension(spark, str(file), "index int, other string, name string").collect()
