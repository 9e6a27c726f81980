"""Which months a source holds and which have been landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.functions import FILE_PREFIX, file_name_to_iso, month_start, parse_iso
from weirgate.sources.files import MONTH_FILE, undated_name


def source_months(df: DataFrame, ts: Column) -> DataFrame:
    """Distinct months of a source in order. Reads one column; the shuffle carries months only."""
    return df.select(month_start(ts).alias("month")).where("month IS NOT NULL").distinct().orderBy("month")


def landed_files(spark: SparkSession, root: str, prefix: str = FILE_PREFIX) -> DataFrame:
    """iso_time, undated, flat of what is landed below ``root``, told from the paths; no file is read.

    ``flat`` marks single files right below the root, the others are directories of a month.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path")
    )
    told = files.select(
        file_name_to_iso(F.col("path"), prefix).alias("iso_time"),
        F.contains("path", F.lit(f"{MONTH_FILE}={undated_name(prefix)}/")).alias("undated"),
        (~F.contains("path", F.lit(f"/{MONTH_FILE}="))).alias("flat"),
    )
    return told.where("iso_time IS NOT NULL OR undated").distinct()


def landing_inventory(spark: SparkSession, root: str, prefix: str = FILE_PREFIX) -> DataFrame:
    """ISO time of every landed month."""
    return landed_files(spark, root, prefix).where("iso_time IS NOT NULL").select("iso_time").distinct()


def landed_months(spark: SparkSession, root: str, prefix: str = FILE_PREFIX, undated: bool = False) -> DataFrame:
    """Distinct landed months in order; with ``undated`` a NULL month stands for landed rows without one."""
    files = landed_files(spark, root, prefix).select(parse_iso(F.col("iso_time")).alias("month"), "undated")
    wanted = files.where("month IS NOT NULL OR undated" if undated else "month IS NOT NULL")
    return wanted.select("month").distinct().orderBy("month")


def month_prints(df: DataFrame, ts: Column) -> DataFrame:
    """month, n_rows and a fingerprint of the rows of each month; the NULL month is that of rows without one.

    Two months have the same fingerprint if they have the same rows as often, in any order: it is the count and the
    sum of the rows' hashes. NULLs count. One scan; the shuffle carries a row a month and task.
    """
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    hashed = F.xxhash64(*columns, F.array(*[c.isNull() for c in columns])).cast("decimal(38,0)")
    counted = df.select(month_start(ts).alias("month"), hashed.alias("hash")).groupBy("month")
    prints = counted.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("hash").alias("total"))
    return prints.select("month", "n_rows", F.concat_ws(":", F.col("n_rows").cast("string"), F.col("total").cast("string")).alias("print"))
