"""What batches that were cut off left behind, and how it is settled.

The status table notes a batch as ``begun`` before anything of it is written, as ``staged`` once its staging is whole,
and as ``loaded`` or ``rejected`` at the end. So a batch that is only staged is carried on from its staging, which
replaces what reached the table; one that has only begun leaves nothing in the table, and its staging and quarantine
are cleared. Settling may itself be cut off and run again.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from weirgate.operators.schema import cast_schema, derive_datetime
from weirgate.operators.split import clear_quarantine, read_batch, write_batch
from weirgate.operators.upsert import BATCH_ID, PART_MONTH, append_staged, snapshot
from weirgate.plans.feed import Feed, Places
from weirgate.plans.status import BEGUN, LOADED, STAGED, read_status, record
from weirgate.sources import no_rows

ABANDONED = "abandoned"


def batch_schema(spark: SparkSession, feed: Feed) -> StructType:
    """The columns of a prepared batch of the feed."""
    text = StructType([StructField(name, StringType()) for name in feed.types])
    return derive_datetime(cast_schema(no_rows(spark, text), feed.types), feed.time_column, feed.derived_time).schema


def staged_schema(spark: SparkSession, feed: Feed) -> StructType:
    """The same as it is staged, with the month that partitions the table."""
    return StructType([*batch_schema(spark, feed).fields, StructField(PART_MONTH, DateType())])


def settle_batches(spark: SparkSession, feed: Feed, places: Places, besides: str | None = None) -> list[str]:
    """Carry on or clear every batch that was cut off, but for ``besides``, which runs again itself; gives their ids.

    A table has one writer at a time, so each cut leaves one batch and there are hardly ever several.
    """
    open_states = F.col("state").isin(BEGUN, STAGED) & (F.col("stage") == "silver")
    noted = read_status(spark, places.status).where(open_states & (F.col(BATCH_ID) != F.lit(besides or "")))
    rows = sorted(noted.collect(), key=lambda row: (row["at"], row[BATCH_ID]))
    settled = []
    for batch_id, months in groupby(rows, key=lambda row: row[BATCH_ID]):
        months = list(months)
        state, n_new, at = months[0]["state"], months[0]["n_rows"], months[0]["at"]
        schema = staged_schema(spark, feed)
        if state == STAGED and n_new:
            staged = read_batch(spark, places.staging, batch_id, schema, n_new)
            append_staged(staged, places.silver_table(feed), batch_id)
        elif state == BEGUN:
            write_batch(no_rows(spark, schema), places.staging, batch_id)
        clear_quarantine(spark, places.quarantine, batch_id, batch_schema(spark, feed))
        done = LOADED if state == STAGED else ABANDONED
        record(spark, places.status, "silver", batch_id, done, n_new, [row["month"] for row in months], at)
        settled.append(batch_id)
    return settled


def read_silver(spark: SparkSession, feed: Feed, places: Places) -> DataFrame:
    """The silver table as far as its batches are settled; rows of a batch that was cut off are not seen."""
    schema = batch_schema(spark, feed)
    loaded = read_status(spark, places.status).where((F.col("stage") == "silver") & (F.col("state") == LOADED))
    rows = snapshot(spark, places.silver_table(feed), schema)
    return rows.join(loaded.select(BATCH_ID), BATCH_ID, "left_semi").select(*schema.names)
