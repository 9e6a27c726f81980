"""Readers and writers of the landing area, the work list and the dimension file."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from weirgate.functions import FILE_PREFIX, iso_text, month_date, parse_iso, safe_file_name

MONTH_FILE = "month_file"
# Fixed value: the column of the work list.
WORKLIST_COLUMN = "new_timestamps"
UNDATED = "undated"
#: Footers that the driver asks for at a time.
SCHEMA_READERS = 8


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty, so that joins with it fall away before they run."""
    return spark.createDataFrame([], schema).where(F.lit(False))


def local_rows(spark: SparkSession, rows: list[dict[str, Any]], schema: StructType) -> DataFrame:
    """A handful of rows from the driver; as an Arrow table they need no Python worker on the executors."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(schema)), schema)


def create_table(
    spark: SparkSession, path: str, schema: StructType, parts: Sequence[str], fmt: str = "parquet"
) -> None:
    """Make an empty partitioned table at ``path`` unless there is something already. For writers only."""
    no_rows(spark, schema).write.format(fmt).partitionBy(*parts).mode("ignore").save(path)


def open_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The partitioned table at ``path``. Reading makes nothing: a path that is not there is an error."""
    return spark.read.format(fmt).schema(schema).load(path)


def read_json_pages(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], multi_line: bool = False, mode: str = "FAILFAST"
) -> DataFrame:
    """Dumped source pages, one object or one array of objects per line, every field as text.

    One all-text schema keeps the months alike whatever their values look like. A page that spans
    lines needs ``multi_line``, which makes one task read the whole file. A broken page fails the read.
    """
    schema = StructType([StructField(name, StringType()) for name in columns])
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", mode).json(path)


def read_dimension(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A CSV dimension with a header; quoted fields may hold commas and doubled quotes."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


@dataclass(frozen=True)
class Landed:
    """What a landing wrote: rows in all, rows without a month, and the months (a calendar bounds their number)."""

    n_rows: int
    n_undated: int
    months: Sequence[datetime]


def land_by_month(df: DataFrame, ts: Column, root: str, prefix: str = FILE_PREFIX) -> Landed:
    """Write one directory per calendar month, named after the month; a month written again is replaced.

    Rows whose time is no time go to a directory of their own, so that none is lost.

    The rebalance shuffle brings a month together and lets adaptive execution cut a heavy month into
    several files, so neither a hot month nor many small ones hurt. It carries the month as a date; the
    longer name is made after it.
    """
    create_landing(df.sparkSession, root)
    seen, month = Observation(), F.col("__month")
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(month.isNull()).alias("undated"), F.collect_set(month.cast("string")).alias("months")]
    name = F.coalesce(safe_file_name(month.cast("timestamp_ntz"), prefix), F.lit(undated_name(prefix)))
    (
        df.withColumn("__month", month_date(ts))
        .hint("rebalance", "__month")
        .observe(seen, *counts)
        .withColumn(MONTH_FILE, name)
        .drop("__month")
        .write.partitionBy(MONTH_FILE)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(root)
    )
    return Landed(seen.get["n"], seen.get["undated"], sorted(datetime.fromisoformat(m) for m in seen.get["months"]))


def create_landing(spark: SparkSession, root: str) -> None:
    """An empty landing area, so that a first run needs no special case."""
    create_table(spark, root, StructType([StructField("row", StringType()), StructField(MONTH_FILE, StringType())]), [MONTH_FILE])


def undated_name(prefix: str = FILE_PREFIX) -> str:
    """The name under which rows without a month land."""
    return f"{prefix}_{UNDATED}.parquet"


def month_file_names(months: Sequence[datetime | None], prefix: str = FILE_PREFIX) -> list[str]:
    """File names of months; None names the rows without one."""
    return sorted(
        f"{prefix}_{m:%Y-%m-%dT%H-%M-%S}-{m.microsecond // 1000:03d}.parquet" if m else undated_name(prefix)
        for m in set(months)
    )


def read_landed_months(
    spark: SparkSession, root: str, months: Sequence[datetime | None], prefix: str = FILE_PREFIX, flat: Sequence[datetime | None] = ()
) -> DataFrame:
    """Only the named months of the landing area: other months are not even listed.

    Months are directories as :func:`land_by_month` writes them; those in ``flat`` are single files right below the
    root. A month that is not there is an error.
    """
    folders = [f"{root}/{MONTH_FILE}={name}" for name in month_file_names([m for m in months if m not in flat], prefix)]
    return spark.read.parquet(*folders, *[f"{root}/{name}" for name in month_file_names(flat, prefix)])


def read_landed_columns(
    spark: SparkSession,
    root: str,
    months: Sequence[datetime | None],
    columns: Sequence[str],
    prefix: str = FILE_PREFIX,
    flat: Sequence[datetime | None] = (),
) -> DataFrame:
    """These columns of the named months as text, whatever each month's schema is.

    The schema of each month is read from a footer of its own, so none depends on which months come with it. A month
    that lacks a column is an error, which names all such months; other columns, their order and their types may
    differ. Times become the text form that landed files use. Months of one schema are scanned together.
    """
    paths = {m: f"{root}/{MONTH_FILE}={name}" for m in months if m not in flat for name in month_file_names([m], prefix)}
    paths |= {m: f"{root}/{name}" for m in months if m in flat for name in month_file_names([m], prefix)}
    order = sorted(paths, key=lambda m: (m is not None, m))
    with ThreadPoolExecutor(SCHEMA_READERS) as pool:
        schemas = dict(zip(order, pool.map(lambda m: spark.read.parquet(paths[m]).schema, order)))
    lacking = {m: [c for c in columns if c not in schemas[m].names] for m in order}
    if any(lacking.values()):
        told = [f"{', '.join(names)} in {f'{m:%Y-%m}' if m else UNDATED}" for m, names in lacking.items() if names]
        raise ValueError(f"missing columns: {'; '.join(told)}")
    alike: dict[str, list[datetime | None]] = {}
    for m in order:
        alike.setdefault(schemas[m].json(), []).append(m)
    parts = []
    for group in alike.values():
        schema = schemas[group[0]]
        found = spark.read.schema(schema).parquet(*[paths[m] for m in group])
        parts.append(found.select(*[_as_text(F.col(c), schema[c].dataType).alias(c) for c in columns]))
    return reduce(DataFrame.unionByName, parts)


def _as_text(value: Column, kind: DataType) -> Column:
    return iso_text(value) if isinstance(kind, (TimestampNTZType, TimestampType)) else value.cast("string")


def write_worklist(months: DataFrame, path: str, month: str = "month") -> None:
    """Replace the work list: one column of ISO month texts. A NULL month lists the rows without one."""
    listed = months.select(F.coalesce(iso_text(F.col(month)), F.lit(UNDATED)).alias(WORKLIST_COLUMN))
    listed.coalesce(1).sortWithinPartitions(WORKLIST_COLUMN).write.mode("overwrite").parquet(path)


def worklist_entries(spark: SparkSession, path: str) -> DataFrame:
    """Every entry of the work list: its text, its month (NULL for rows without one), and whether it is refused.

    Refused is text that is neither a month nor the name of the rows without one.
    """
    text = F.col(WORKLIST_COLUMN)
    listed = spark.read.schema(f"{WORKLIST_COLUMN} string").parquet(path).withColumn("month", parse_iso(text))
    undated = F.coalesce(text == UNDATED, F.lit(False))
    return listed.select(text.alias("entry"), "month", (F.col("month").isNull() & ~undated).alias("refused"))


def read_worklist(spark: SparkSession, path: str) -> DataFrame:
    """The work list as distinct months, NULL for rows without one. A refused entry fails the read and is named."""
    wrong = F.concat(F.lit("no month on the work list: "), F.coalesce("entry", F.lit("NULL")))
    month = F.when(F.col("refused"), F.raise_error(wrong).cast("timestamp_ntz")).otherwise(F.col("month"))
    return worklist_entries(spark, path).select(month.alias("month")).distinct()
