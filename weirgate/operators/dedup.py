"""Duplicate removal and append union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct whole rows. Copies meet in the map-side aggregate first, so a hot row stays cheap."""
    return df.dropDuplicates()


def dedup_keys(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark cuts each key to one row per input task before the shuffle (a group limit below the window),
    so a key that holds much of the table sends one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").drop("__nth")


def append_union(*batches: DataFrame) -> DataFrame:
    """All rows of all batches, columns matched by name."""
    united = batches[0]
    for batch in batches[1:]:
        united = united.unionByName(batch)
    return united
