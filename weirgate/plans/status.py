"""What became of each batch: one small row per stage, batch and month."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from weirgate.sources import create_table, local_rows, open_table

STATUS_SCHEMA = StructType(
    [
        StructField("month", TimestampNTZType()),
        StructField("state", StringType()),
        StructField("n_rows", LongType()),
        StructField("at", LongType()),
        StructField("stage", StringType()),
        StructField("batch_id", StringType()),
    ]
)
STATUS_PARTS = ("stage", "batch_id")

#: States of a batch at the silver stage; the last two settle its months.
BEGUN, STAGED, LOADED, REJECTED = "begun", "staged", "loaded", "rejected"


def now() -> int:
    """Microseconds that order what one writer notes."""
    return time.time_ns() // 1000


def create_status(spark: SparkSession, path: str) -> None:
    create_table(spark, path, STATUS_SCHEMA, STATUS_PARTS)


def write_status(rows: DataFrame, path: str) -> None:
    """Note rows of the status table; those of the same stage and batch are replaced."""
    writer = rows.select(*STATUS_SCHEMA.names).write.partitionBy(*STATUS_PARTS).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def record(
    spark: SparkSession,
    path: str,
    stage: str,
    batch_id: str,
    state: str,
    n_rows: int,
    months: Iterable[datetime | None] = (None,),
    at: int | None = None,
) -> None:
    """Note the state of a batch at a stage, for each of its months."""
    shared = {"state": state, "n_rows": n_rows, "at": at or now(), "stage": stage, "batch_id": batch_id}
    rows = [{"month": m, **shared} for m in (list(months) or [None])]
    write_status(local_rows(spark, rows, STATUS_SCHEMA).coalesce(1), path)


def record_begin(spark: SparkSession, path: str, batch_id: str, failures: Mapping[str, int], at: int) -> None:
    """Note that a batch begins, and how many values of each column it lost to casts; columns without any are left out."""
    begun = {"month": None, "state": BEGUN, "n_rows": 0, "at": at, "stage": "silver", "batch_id": batch_id}
    casts = [{**begun, "state": column, "n_rows": n, "stage": "casts"} for column, n in failures.items() if n]
    write_status(local_rows(spark, [begun, *casts], STATUS_SCHEMA).coalesce(1), path)


def read_status(spark: SparkSession, path: str) -> DataFrame:
    return open_table(spark, path, STATUS_SCHEMA)


def silver_states(spark: SparkSession, path: str, batch_id: str) -> set[str]:
    """The states that the silver stage has noted for a batch; only the batch's own partition is read."""
    found = read_status(spark, path).where((F.col("stage") == "silver") & (F.col("batch_id") == batch_id))
    return {row["state"] for row in found.select("state").distinct().collect()}


def is_loaded(spark: SparkSession, path: str, batch_id: str) -> bool:
    """Has the silver stage finished this batch?"""
    return LOADED in silver_states(spark, path, batch_id)
