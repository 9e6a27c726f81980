"""Global positions in a sorted table, and what builds on them: even shards and a row cap per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.session import scratch_path

_POS, _PART, _COPY = "__pos", "__part", "__copy"


def with_ordinal(
    df: DataFrame,
    order_by: Sequence[str],
    within: Sequence[str] = (),
    copy_id: str | None = None,
) -> DataFrame:
    """Number the rows from 0 in the given order, separately per ``within`` group, without a global window.

    Adds ``ordinal`` and ``group_rows``, the size of the row's group.

    The table is range-partitioned and sorted by all its columns (the order columns first) and written
    once with each row's partition and offset. Only the number of rows per partition and group is then
    summed up in order, and added back. Range bounds come from a sample, so computing them twice could
    place rows differently; the written table settles them.

    Rows that differ anywhere can be told apart, so a hot order value spreads over partitions. Exact copies are
    told apart by ``copy_id``, a column that is dropped from the result; without one the table is written once
    and each row's place in it serves.
    """
    spark = df.sparkSession
    if copy_id is None:
        copy_id = _COPY
        df = with_copy_id(df, copy_id)
    first = [*within, *order_by]
    sort = first + [c for c in df.columns if c not in first and c != copy_id] + [copy_id]
    rows_path, spans_path = scratch_path(spark, "ordinal-rows"), scratch_path(spark, "ordinal-spans")
    (
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        # Partition number in the upper bits, offset inside the partition in the lower 33.
        .withColumn(_POS, F.monotonically_increasing_id())
        .drop(copy_id)
        .write.parquet(rows_path)
    )
    rows = spark.read.parquet(rows_path).withColumn(_PART, F.shiftright(_POS, 33))
    before = Window.partitionBy(*within).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        rows.groupBy(_PART, *within)
        .agg(F.min(_POS).alias("__first"), F.count(F.lit(1)).alias("__n"))
        .select(
            F.col(_PART).alias("__span"),
            *[F.col(c).alias(f"__in_{i}") for i, c in enumerate(within)],
            (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
            F.sum("__n").over(Window.partitionBy(*within)).alias("group_rows"),
        )
    )
    # Written out, so that its size is known when the join below chooses to broadcast it or not.
    spans.write.parquet(spans_path)
    same = [F.col(_PART) == F.col("__span")]
    same += [F.col(c).eqNullSafe(F.col(f"__in_{i}")) for i, c in enumerate(within)]
    located = rows.join(spark.read.parquet(spans_path), reduce(lambda a, b: a & b, same))
    columns = [c for c in df.columns if c != copy_id]
    return located.select(*columns, (F.col(_POS) + F.col("__shift")).alias("ordinal"), "group_rows")


def round_robin_shards(
    df: DataFrame, order_by: Sequence[str], n_shards: int, copy_id: str | None = None
) -> DataFrame:
    """Deal the ordered rows to ``n_shards`` workers in turn: ``shard = ordinal % n_shards``."""
    numbered = with_ordinal(df, order_by, copy_id=copy_id).drop("group_rows")
    return numbered.withColumn("shard", F.col("ordinal") % n_shards)


def with_copy_id(df: DataFrame, name: str = "copy_id") -> DataFrame:
    """Add a column that tells exact copies apart: each row's place in a stored table.

    A place in a file stays the same when a task runs again; a running number over shuffled rows would not.
    """
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return add_place(df.sparkSession.read.schema(df.schema).parquet(path), name)


def add_place(scan: DataFrame, name: str = "copy_id") -> DataFrame:
    """The same for a table that is a plain Parquet scan already."""
    return scan.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(name))


def capped_scan(
    df: DataFrame, group: Column, order_by: Sequence[str], cap: int, copy_id: str | None = None
) -> DataFrame:
    """At most ``cap`` rows per group, the first in order; no task holds a whole group.

    ``truncated`` tells for each kept row whether its group had more rows than the cap.

    Each task's first ``cap`` rows per group are cut before the shuffle, so what moves is bounded by the cap. Of
    equal rows any may be kept; ``copy_id`` (dropped) decides between them.
    """
    first = [c for c in [*order_by, *df.columns] if c != copy_id]
    order = list(dict.fromkeys(first)) + ([copy_id] if copy_id else [])
    grouped = df.withColumn("__group", group)
    nth = F.row_number().over(Window.partitionBy("__group").orderBy(*order))
    kept = grouped.withColumn("ordinal", nth).where(F.col("ordinal") <= cap)
    sizes = grouped.groupBy("__group").agg(F.count(F.lit(1)).alias("__rows"))
    sizes = sizes.select(F.col("__group").alias("__of"), (F.col("__rows") > cap).alias("truncated"))
    joined = kept.join(sizes, F.col("__group").eqNullSafe(F.col("__of")))
    columns = [c for c in df.columns if c != copy_id]
    return joined.select(*columns, (F.col("ordinal") - 1).cast("bigint").alias("ordinal"), "truncated")
