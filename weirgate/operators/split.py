"""Good and bad rows under a null policy, and the quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from weirgate.functions import month_date
from weirgate.operators.rules import CHECKS, Rule, any_violation
from weirgate.sources.files import no_rows

NullPolicy = Literal["pass", "fail", "drop"]
VERDICT, GOOD, BAD, LIMBO = "verdict", "good", "bad", "limbo"


def is_bad(rules: Sequence[Rule], null_policy: NullPolicy = "pass") -> Column:
    """The row's verdict where no rule is violated but one is unknown: good, bad, or NULL (in neither part)."""
    violated = any_violation(rules)
    if null_policy == "pass":
        return F.coalesce(violated, F.lit(False))
    if null_policy == "fail":
        return F.coalesce(violated, F.lit(True))
    if null_policy == "drop":
        return violated
    raise ValueError(f"unknown null policy {null_policy!r}")


def good_rows(flagged: DataFrame, rules: Sequence[Rule], null_policy: NullPolicy = "pass") -> DataFrame:
    return flagged.where(~is_bad(rules, null_policy)).drop(CHECKS)


def bad_rows(flagged: DataFrame, rules: Sequence[Rule], null_policy: NullPolicy = "pass") -> DataFrame:
    # As a bare OR the predicate reaches a Parquet scan and skips row groups without a violation.
    verdict = is_bad(rules, null_policy) if null_policy == "fail" else any_violation(rules)
    return flagged.where(verdict).drop(CHECKS)


def limbo_rows(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that violate nothing but hold an unknown: what the ``drop`` policy leaves out."""
    return flagged.where(any_violation(rules).isNull()).drop(CHECKS)


def batch_counts(flagged: DataFrame, rules: Sequence[Rule], null_policy: NullPolicy = "pass") -> DataFrame:
    """Good, bad and all rows in one aggregate."""
    verdict = is_bad(rules, null_policy)
    return flagged.agg(
        F.count_if(~verdict).alias("n_good"), F.count_if(verdict).alias("n_bad"), F.count(F.lit(1)).alias("n_all")
    )


@dataclass(frozen=True)
class Quarantine:
    """The parts as written, and their counts; ``limbo`` is what the ``drop`` policy puts in neither part."""

    good: DataFrame
    bad: DataFrame
    limbo: DataFrame
    n_good: int
    n_bad: int
    n_limbo: int
    months: Sequence[datetime | None] = ()


def write_parts(df: DataFrame, path: str, parts: Sequence[str], fmt: str = "parquet") -> int:
    """Replace the partitions that ``df`` has rows for; gives the row count.

    The count is observed in the writing stage itself: no second job, and a retried task counts once.
    """
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.format(fmt)
        .partitionBy(*parts)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .save(path)
    )
    return seen.get["n"]


def write_batch(df: DataFrame, path: str, batch_id: str, fmt: str = "parquet", by: Sequence[str] = ()) -> int:
    """Write a batch into its own partition; gives the row count.

    Without ``by`` the whole partition is replaced, by nothing if there are no rows. With ``by`` a batch is one
    partition for each of these columns' values, and those it has rows for are replaced.
    """
    if by:
        return write_parts(df.withColumn("batch_id", F.lit(batch_id)), path, [*by, "batch_id"], fmt)
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("n"))
    observed.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")
    return seen.get["n"]


def quarantine(
    flagged: DataFrame,
    rules: Sequence[Rule],
    path: str,
    batch_id: str,
    null_policy: NullPolicy = "pass",
    time: Column | None = None,
) -> Quarantine:
    """Write a flagged batch, split by verdict, in one pass; what the batch left before is replaced as a whole.

    The folder is ``path/batch_id=.../verdict=...``, which :func:`read_quarantine` reads. Counts, and the months of
    ``time``, are observed in that pass.
    """
    bad = is_bad(rules, null_policy)
    verdict = F.when(bad, F.lit(BAD)).when(~bad, F.lit(GOOD)).otherwise(F.lit(LIMBO))
    seen = Observation()
    counts = [F.count_if(F.col(VERDICT) == v).alias(v) for v in (GOOD, BAD, LIMBO)]
    month = F.lit(None).cast("string") if time is None else month_date(time).cast("string")
    counts.append(F.collect_set(F.coalesce(month, F.lit(""))).alias("months"))
    split = flagged.withColumn(VERDICT, verdict).drop(CHECKS).observe(seen, *counts)
    split.write.partitionBy(VERDICT).mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    schema = flagged.drop(CHECKS).schema
    parts = [_read_verdict(flagged.sparkSession, path, batch_id, v, schema, seen.get[v]) for v in (GOOD, BAD, LIMBO)]
    months = [datetime.fromisoformat(m) if m else None for m in sorted(seen.get["months"])]
    return Quarantine(*parts, *[seen.get[v] for v in (GOOD, BAD, LIMBO)], months)


def _read_verdict(
    spark: SparkSession, path: str, batch_id: str, verdict: str, schema: StructType, n_rows: int
) -> DataFrame:
    if not n_rows:
        return no_rows(spark, schema)
    return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id}/{VERDICT}={verdict}")


def clear_quarantine(spark: SparkSession, path: str, batch_id: str, schema: StructType) -> None:
    """Leave nothing of a batch in quarantine."""
    parts = StructType([*schema.fields, StructField(VERDICT, StringType())])
    no_rows(spark, parts).write.partitionBy(VERDICT).mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_quarantine(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every quarantined row with its batch and verdict."""
    parts = [StructField(c, StringType()) for c in (VERDICT, "batch_id")]
    return spark.read.schema(StructType([*schema.fields, *parts])).parquet(path)


def read_batch(
    spark: SparkSession, path: str, batch_id: str, schema: StructType, n_rows: int, fmt: str = "parquet"
) -> DataFrame:
    """The rows a batch wrote below ``path``; a batch without rows has none to read."""
    if not n_rows:
        return no_rows(spark, schema)
    return spark.read.format(fmt).schema(schema).load(f"{path}/batch_id={batch_id}")
