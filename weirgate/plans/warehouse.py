"""Insert-only merge of staged batches into the warehouse's main table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from weirgate.operators.schema import warehouse_projection
from weirgate.operators.split import write_batch
from weirgate.operators.upsert import BATCH_ID, create_keyed_table, merge_batches, read_table
from weirgate.plans.feed import Feed, Places
from weirgate.plans.recovery import settle_batches, staged_schema
from weirgate.plans.status import STATUS_SCHEMA, create_status, now, read_status, write_status
from weirgate.sources import local_rows, no_rows

#: Batches that one pass of a merge takes.
WAVE = 500


def unmerged_batches(spark: SparkSession, places: Places) -> DataFrame:
    """Loaded batches the warehouse has not taken yet, with their staged row counts."""
    status = read_status(spark, places.status)
    loaded = status.where("stage = 'silver' AND state = 'loaded'").groupBy(BATCH_ID)
    loaded = loaded.agg(F.max("n_rows").alias("n_rows"), F.max("at").alias("at"))
    merged = status.where("stage = 'warehouse'").select(BATCH_ID)
    return loaded.join(merged, BATCH_ID, "left_anti")


def warehouse_schema(feed: Feed) -> StructType:
    return StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in feed.warehouse_types.items()))


def waiting_rows(spark: SparkSession, feed: Feed, places: Places, batch_ids: Sequence[str]) -> DataFrame:
    """The staged rows of these batches with their ids. Only their folders are listed, whatever else was ever staged."""
    schema = StructType([*staged_schema(spark, feed).fields, StructField(BATCH_ID, StringType())])
    folders = [f"{places.staging}/{BATCH_ID}={b}" for b in batch_ids]
    return spark.read.schema(schema).option("basePath", places.staging).parquet(*folders)


def merge_warehouse(
    spark: SparkSession,
    feed: Feed,
    places: Places,
    null_safe_keys: bool = False,
    wave: int = WAVE,
    retire: bool = False,
    distinct_known: bool = False,
) -> int:
    """Merge every unmerged batch; gives the number of rows inserted.

    ``wave`` batches, the oldest ones first, are merged in one pass, so that the driver holds no more ids than that.
    A merge that is cut off takes up the waves that are not noted. ``retire`` empties the staging folders of merged
    batches; their rows then are no longer there to be read by their outcome.
    """
    create_status(spark, places.status)
    settle_batches(spark, feed, places)
    table = places.warehouse_table(feed)
    create_keyed_table(spark, table, warehouse_schema(feed))
    inserted, types = 0, {**feed.warehouse_types, BATCH_ID: "string"}
    while waiting := unmerged_batches(spark, places).orderBy("at", BATCH_ID).limit(wave).collect():
        filled = [row[BATCH_ID] for row in waiting if row["n_rows"]]
        if filled:
            projected = warehouse_projection(waiting_rows(spark, feed, places, filled), feed.time_column, types)
            inserted += merge_batches(spark, projected, table, filled, null_safe_keys, distinct_known)
        at = now()
        merged = [
            {"month": None, "state": "merged", "n_rows": row["n_rows"], "at": at, "stage": "warehouse", BATCH_ID: row[BATCH_ID]}
            for row in waiting
        ]
        write_status(local_rows(spark, merged, STATUS_SCHEMA), places.status)
        for batch_id in filled if retire else ():
            write_batch(no_rows(spark, staged_schema(spark, feed)), places.staging, batch_id)
    return inserted


def read_warehouse(spark: SparkSession, feed: Feed, places: Places) -> DataFrame:
    """The main table; there is one once :func:`merge_warehouse` has run."""
    return read_table(spark, places.warehouse_table(feed), warehouse_schema(feed))
