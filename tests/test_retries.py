"""Counts, inserts and positions stay exact when tasks fail part-way and run again."""

import pytest
from pyspark import TaskContext

from weirgate.operators.ordinals import with_ordinal
from weirgate.operators.split import write_batch
from weirgate.operators.upsert import KeyedTable, insert_new, read_table

N = 20_000


@pytest.fixture
def flaky(spark):
    def fail_once(frames):
        task = TaskContext.get()
        for frame in frames:
            yield frame
            if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
                raise RuntimeError("task lost on purpose")

    return spark.range(0, N, 1, 6).mapInPandas(fail_once, "id long")


def test_observed_count(spark, flaky, tmp_path):
    path = str(tmp_path / "rows")
    assert write_batch(flaky, path, "b1") == N
    assert spark.read.parquet(path).count() == N


def test_insert(spark, flaky, tmp_path):
    table, staging = KeyedTable(str(tmp_path / "table"), ("id",)), str(tmp_path / "staging")
    assert insert_new(spark, flaky, table, staging, "b1").n_new == N
    assert insert_new(spark, flaky.unionAll(spark.range(N, N + 10)), table, staging, "b2").n_new == 10
    assert read_table(spark, table, flaky.schema).distinct().count() == N + 10


def test_positions(flaky):
    numbered = with_ordinal(flaky, ["id"])
    assert numbered.where("ordinal = id").count() == numbered.count() == N
