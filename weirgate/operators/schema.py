"""Column allow-list, casts and the warehouse projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions import datetime_text, lenient_cast


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns in order. A missing one is an error, others are dropped."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def cast_schema(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the mapped columns in the map's order; what does not fit becomes NULL."""
    return df.select(
        *[lenient_cast(F.col(name), df.schema[name].dataType, target).alias(name) for name, target in types.items()]
    )


def cast_failure_counts(df: DataFrame, types: Mapping[str, str]) -> list[Column]:
    """Per column, an aggregate: how many non-NULL values become NULL in :func:`cast_schema`."""
    casts = {name: lenient_cast(F.col(name), df.schema[name].dataType, target) for name, target in types.items()}
    return [F.count_if(F.col(name).isNotNull() & cast.isNull()).alias(name) for name, cast in casts.items()]


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The counts as a table, one row per column. One pass over the input."""
    counts = df.agg(*cast_failure_counts(df, types))
    rows = [F.struct(F.lit(name).alias("column_name"), F.col(name).alias("cast_failures")) for name in types]
    return counts.select(F.inline(F.array(*rows)))


def derive_datetime(df: DataFrame, source: str, target: str) -> DataFrame:
    """Add ``yyyy-MM-dd HH:mm:ss`` text of a timestamp column; the session zone plays no part."""
    return df.withColumn(target, datetime_text(F.col(source)))


def warehouse_projection(df: DataFrame, time_column: str, types: Mapping[str, str]) -> DataFrame:
    """The warehouse's columns in its order: text time to a timestamp, numbers widened, the rest as they are."""
    return df.select(
        *[
            F.col(name).try_cast("timestamp_ntz" if name == time_column else target).alias(name)
            for name, target in types.items()
        ]
    )
