"""Load landed months as they appear, with the stream's checkpoint in place of the work list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from weirgate.plans.feed import Feed, Places
from weirgate.plans.silver import load_batch
from weirgate.plans.status import create_status, is_loaded


def load_landed_files(
    spark: SparkSession, dimension: DataFrame, feed: Feed, places: Places, checkpoint: str, **options
) -> StreamingQuery:
    """Take every landed file not taken before through :func:`load_batch`, then stop.

    A micro-batch that is replayed after a failure has the same id: it replaces its own rows, or is passed
    over if it was loaded. A batch that fails its rules is quarantined and recorded; it does not stop the
    batches after it.
    """
    schema = StructType([StructField(name, StringType()) for name in feed.types])
    options.setdefault("on_reject", "record")
    create_status(spark, places.status)

    def load(batch: DataFrame, epoch: int) -> None:
        session, batch_id = batch.sparkSession, f"stream-{epoch:09d}"
        if not is_loaded(session, places.status, batch_id):
            load_batch(session, batch, dimension, feed, places, batch_id, **options)

    return (
        spark.readStream.schema(schema)
        .parquet(places.landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
