"""Insert-only loading of a keyed table, with a staging copy of what was new.

A table is a folder of Parquet files partitioned by month (where a key column fixes one) and by the
batch that brought the rows. A batch owns its partitions: writing it again replaces them, and its own
rows are not part of the snapshot it is compared with. So a batch that stopped anywhere can simply be
run again under the same id, and NULL keys are not inserted twice by that. The same id must mean the
same rows, and a table has one writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from weirgate.functions import month_date
from weirgate.operators.dedup import dedup_keys
from weirgate.operators.membership import anti_join_dimension, semi_join_dimension
from weirgate.operators.split import read_batch, write_batch, write_parts
from weirgate.session import scratch_path
from weirgate.sources.files import create_table, no_rows, open_table

PART_MONTH = "part_month"
BATCH_ID = "batch_id"


@dataclass(frozen=True)
class KeyedTable:
    """``month_key`` names the key column whose month partitions the table; equal keys share a month."""

    path: str
    keys: tuple[str, ...]
    month_key: str | None = None
    fmt: str = "parquet"

    def __post_init__(self) -> None:
        if self.month_key is not None and self.month_key not in self.keys:
            raise ValueError("the month must come from a key column, else equal keys may sit in two months")

    @property
    def partitions(self) -> tuple[str, ...]:
        return (PART_MONTH, BATCH_ID) if self.month_key else (BATCH_ID,)


@dataclass(frozen=True)
class Inserted:
    """``staged`` re-reads the new rows from staging; it does not run the batch again."""

    staged: DataFrame
    n_new: int
    months: Sequence[date | None]


def new_rows(
    batch: DataFrame, known: DataFrame, keys: Sequence[str], null_safe_keys: bool = False, distinct_known: bool = False
) -> DataFrame:
    """Rows of the batch whose key is not in ``known``. A key with a NULL is always new unless ``null_safe_keys``.

    ``distinct_known`` takes each known key once, at the price of another shuffle: for tables where one key, such as
    that of NULLs, is repeated so often that its copies fill a partition. The result is the same.
    """
    return anti_join_dimension(batch, keys, known, keys, null_safe_keys, distinct_known)


def check_batch_id(batch_id: str) -> str:
    # A leading letter keeps Spark from reading the folder name back as a number or a date.
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_.-]*", batch_id):
        raise ValueError(f"a batch id starts with a letter and has no other signs than _ . -: {batch_id!r}")
    return batch_id


def _stored_schema(table: KeyedTable, schema: StructType) -> StructType:
    parts = [StructField(p, DateType() if p == PART_MONTH else StringType()) for p in table.partitions]
    return StructType([*schema.fields, *parts])


def create_keyed_table(spark: SparkSession, table: KeyedTable, schema: StructType) -> None:
    """An empty table, unless there is something at its path."""
    create_table(spark, table.path, _stored_schema(table, schema), table.partitions, table.fmt)


def snapshot(spark: SparkSession, table: KeyedTable, schema: StructType) -> DataFrame:
    """The table with its partition columns. A path that is not there or holds other data is an error."""
    found = open_table(spark, table.path, _stored_schema(table, schema), table.fmt)
    # Every row of the table has a batch; the check prunes all its partitions and so reads nothing.
    if not found.where(F.col(BATCH_ID).isNull()).isEmpty():
        raise ValueError(f"{table.path} holds other data than this table")
    return found


def read_table(spark: SparkSession, table: KeyedTable, schema: StructType) -> DataFrame:
    """The table's own columns."""
    return snapshot(spark, table, schema).select(*schema.names)


def batch_months(placed: DataFrame, table: KeyedTable) -> list[date | None]:
    """Months of the batch, NULL included; a calendar bounds their number."""
    if not table.month_key:
        return []
    return [row[PART_MONTH] for row in placed.select(PART_MONTH).distinct().collect()]


def with_month(batch: DataFrame, table: KeyedTable) -> DataFrame:
    return batch.withColumn(PART_MONTH, month_date(F.col(table.month_key))) if table.month_key else batch


def known_rows(
    spark: SparkSession,
    table: KeyedTable,
    schema: StructType,
    months: Sequence[date | None],
    batch_ids: Sequence[str] | DataFrame,
) -> DataFrame:
    """What the table holds from other batches, in these months only (a partition filter).

    ``batch_ids`` are values, or a table with a column of them where their number has no bound.
    """
    known = snapshot(spark, table, schema)
    if isinstance(batch_ids, DataFrame):
        known = known.join(batch_ids.select(BATCH_ID), BATCH_ID, "left_anti")
    else:
        known = known.where(~F.col(BATCH_ID).isin(list(batch_ids)))
    if not table.month_key:
        return known
    found = F.col(PART_MONTH).isin([m for m in months if m is not None])
    return known.where(found | F.col(PART_MONTH).isNull() if None in months else found)


def _unseen(
    placed: DataFrame, known: DataFrame, keys: Sequence[str], null_safe_keys: bool, distinct_known: bool, stored: bool = True
) -> DataFrame:
    """The new rows of a batch, of which no more than needed is shuffled.

    No join where the table has nothing in the batch's months yet. Where it holds at least half as many rows as the
    batch, much of the batch may be known: the keys alone look for it, and the rows of those that are unseen follow,
    without a shuffle if these are few or none. A batch that is not ``stored`` would be run again for that.
    """
    n_known = known.count()
    if not n_known:
        return placed
    if not stored or 2 * n_known < placed.count():
        return new_rows(placed, known, keys, null_safe_keys, distinct_known)
    spark, path = placed.sparkSession, scratch_path(placed.sparkSession, "unseen")
    unseen = new_rows(placed.select(*keys), known, keys, null_safe_keys, distinct_known)
    if not write_batch(unseen, path, "unseen"):
        return no_rows(spark, placed.schema)
    unseen = spark.read.schema(unseen.schema).parquet(f"{path}/{BATCH_ID}=unseen")
    # What is unseen is settled, so here a NULL meets its like; copies of a hot key are taken once.
    return semi_join_dimension(placed, keys, unseen, keys, distinct=True, null_safe=True)


def _clustered(df: DataFrame, table: KeyedTable) -> DataFrame:
    """Bring the rows of a month together; adaptive execution cuts a large month into several files and joins small ones."""
    return df.hint("rebalance", PART_MONTH) if table.month_key else df


def one_per_key(
    placed: DataFrame, keys: Sequence[str], key_order: Sequence[Column], null_safe_keys: bool = False
) -> DataFrame:
    """The first row of each key. Keys with a NULL equal none unless ``null_safe_keys``, so each such row stays."""
    if null_safe_keys:
        return dedup_keys(placed, keys, key_order)
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return dedup_keys(placed.where(~unknown), keys, key_order).unionByName(placed.where(unknown))


def stage_new(
    spark: SparkSession,
    batch: DataFrame,
    table: KeyedTable,
    staging_path: str,
    batch_id: str,
    *,
    null_safe_keys: bool = False,
    key_order: Sequence[Column] | None = None,
    distinct_known: bool = False,
) -> Inserted:
    """Write the batch's unseen rows to its staging folder and read them back.

    Only the key columns of the batch's own months are read from the table. ``key_order`` keeps one row
    per key within the batch; without it, rows that share a new key are all new. ``distinct_known`` is that of
    :func:`new_rows`. The batch is read up to four times, for
    its months, size, unseen keys and the write, so hand in a stored one.
    """
    check_batch_id(batch_id)
    taken = {PART_MONTH, BATCH_ID} & set(batch.columns)
    if taken:
        raise ValueError(f"the batch must not have columns named {sorted(taken)}")
    placed = with_month(batch, table)
    create_keyed_table(spark, table, batch.schema)
    months = batch_months(placed, table)
    known = known_rows(spark, table, batch.schema, months, [batch_id])
    if key_order is not None:
        placed = one_per_key(placed, table.keys, key_order, null_safe_keys)
    fresh = _unseen(placed, known, table.keys, null_safe_keys, distinct_known, stored=key_order is None)
    n_new = write_batch(_clustered(fresh, table), staging_path, batch_id, table.fmt)
    return Inserted(read_batch(spark, staging_path, batch_id, placed.schema, n_new, table.fmt), n_new, months)


def append_staged(staged: DataFrame, table: KeyedTable, batch_id: str) -> int:
    """Put staged rows into the table under the batch's partitions; staging is already grouped by month."""
    months = (PART_MONTH,) if table.month_key else ()
    return write_batch(staged, table.path, batch_id, table.fmt, by=months)


def insert_new(
    spark: SparkSession,
    batch: DataFrame,
    table: KeyedTable,
    staging_path: str,
    batch_id: str,
    *,
    null_safe_keys: bool = False,
    key_order: Sequence[Column] | None = None,
    distinct_known: bool = False,
) -> Inserted:
    """Insert the batch's unseen keys: staging first, then the table from staging.

    A table that does not exist yet takes the whole batch. Rows already there are never changed.
    """
    new = stage_new(
        spark, batch, table, staging_path, batch_id, null_safe_keys=null_safe_keys, key_order=key_order, distinct_known=distinct_known
    )
    if new.n_new:
        append_staged(new.staged, table, batch_id)
    return Inserted(new.staged.select(*batch.columns), new.n_new, new.months)


def merge_batches(
    spark: SparkSession,
    staged: DataFrame,
    table: KeyedTable,
    batch_ids: Sequence[str] | DataFrame,
    null_safe_keys: bool = False,
    distinct_known: bool = False,
) -> int:
    """Insert the unseen keys of several staged batches at once; ``staged`` carries their batch ids.

    The table's rows from these same batches are left out of the comparison and replaced, so a merge
    that was cut off can run again, also together with further batches.
    """
    placed, schema = with_month(staged, table), staged.drop(BATCH_ID).schema
    create_keyed_table(spark, table, schema)
    months = batch_months(placed, table)
    known = known_rows(spark, table, schema, months, batch_ids)
    fresh = _unseen(placed, known, table.keys, null_safe_keys, distinct_known)
    return write_parts(_clustered(fresh, table), table.path, table.partitions, table.fmt)
