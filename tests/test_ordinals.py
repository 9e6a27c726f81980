import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weirgate.operators.ordinals import capped_scan, round_robin_shards, with_ordinal


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), max_size=80))
def test_against_a_plain_sort(spark, rows):
    frame = spark.createDataFrame(rows, "a int, b int").repartition(3)
    numbered = sorted((r["ordinal"], r["a"], r["b"]) for r in with_ordinal(frame, ["a"]).collect())
    assert numbered == [(i, a, b) for i, (a, b) in enumerate(sorted(rows))]


def test_within_groups_and_nulls(spark):
    rows = [("x", 3), ("x", 1), (None, 5), ("y", 2), (None, 4), ("x", 2)]
    frame = spark.createDataFrame(rows, "g string, v int")
    found = {(r["g"], r["v"]): r["ordinal"] for r in with_ordinal(frame, ["v"], within=["g"]).collect()}
    assert found == {("x", 1): 0, ("x", 2): 1, ("x", 3): 2, (None, 4): 0, (None, 5): 1, ("y", 2): 0}


@pytest.mark.parametrize("n_shards", [1, 3, 7])
def test_shards_are_even(spark, n_shards):
    shards = round_robin_shards(spark.range(100).withColumn("month", F.col("id") * 31 % 100), ["month"], n_shards)
    sizes = [r["count"] for r in shards.groupBy("shard").count().collect()]
    assert len(sizes) == n_shards and max(sizes) - min(sizes) <= 1
    assert all(r["ordinal"] == r["month"] and r["shard"] == r["month"] % n_shards for r in shards.collect())


def test_copies_spread_over_partitions(spark, tmp_path, with_conf):
    """A third of all rows are copies of one row; a column that tells copies apart lets them spread."""
    with_conf({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    path = str(tmp_path / "rows")
    spark.range(3000, numPartitions=4).selectExpr("if(id < 1000, 7, id) AS k").write.parquet(path)
    located = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("copy_id")
    frame = spark.read.parquet(path).select("k", located)
    numbered = with_ordinal(frame, ["k"], copy_id="copy_id")
    assert numbered.columns == ["k", "ordinal", "group_rows"]
    rows = sorted((r["ordinal"], r["k"]) for r in numbered.collect())
    assert rows == list(enumerate(sorted([7] * 1000 + list(range(1000, 3000)))))
    written = frame.repartitionByRange("k", "copy_id").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in written.collect()) < 1000


def test_cap(spark):
    frame = spark.range(50).withColumn("g", F.col("id") % 3)
    capped = capped_scan(frame, F.col("g"), ["id"], 10)
    assert capped.columns == ["id", "g", "ordinal", "truncated"]
    assert {r["id"] for r in capped.collect()} == set(range(30))
    assert all(r["truncated"] for r in capped.collect())
    whole = capped_scan(frame, F.col("g"), ["id"], 17)
    assert whole.count() == 50
    assert {r["g"] for r in whole.where("truncated").collect()} == set()
