"""Incremental discovery: month differences, windows and scan ranges."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions import add_month, moment, month_start


def month_delta(source: DataFrame, landed: DataFrame, reopen_last: int = 0) -> DataFrame:
    """Months of the source that are not landed, in order.

    ``reopen_last`` also lists the last n landed months again, for rows that came in late, and with them the NULL
    month of rows without one, if the source has such rows.
    """
    missing = source.select("month").subtract(landed.select("month"))
    if reopen_last:
        again = landed.select("month").where("month IS NOT NULL").orderBy(F.desc("month")).limit(reopen_last)
        undated = source.select("month").where("month IS NULL")
        missing = missing.union(again.join(source.select("month"), "month", "left_semi")).union(undated).distinct()
    return missing.orderBy("month")


def month_windows(months: DataFrame, month: str = "month") -> DataFrame:
    """Half-open window of each listed time: ``[start, start + 1 month)``."""
    return months.select(F.col(month).alias("start_month"), add_month(F.col(month)).alias("end_month"))


def in_window(ts: Column, start: datetime, end: datetime) -> Column:
    """Half-open range with literal bounds, which Spark pushes into a Parquet scan."""
    return (ts >= moment(start)) & (ts < moment(end))


def collect_months(months: DataFrame, month: str = "month") -> list[datetime]:
    """Distinct months as Python values; bounded by the calendar, not by the data."""
    rows = months.select(month_start(F.col(month)).alias("m")).where("m IS NOT NULL").distinct().collect()
    return sorted(row["m"] for row in rows)


def collect_listed(months: DataFrame, month: str = "month") -> list[datetime | None]:
    """A list of months as Python values, None for a NULL one; bounded by the calendar, not by the data."""
    return sorted({row[month] for row in months.select(month).collect()}, key=lambda m: (m is not None, m))


def _next(month: datetime) -> datetime:
    return month.replace(year=month.year + month.month // 12, month=month.month % 12 + 1)


def in_months(ts: Column, months: list[datetime | None]) -> Column:
    """True inside any of the months. Neighbouring months merge into one range, which the scan can push down.

    None takes the rows without a time.
    """
    runs: list[list[datetime]] = []
    for month in sorted({m for m in months if m is not None}):
        if runs and runs[-1][1] == month:
            runs[-1][1] = _next(month)
        else:
            runs.append([month, _next(month)])
    parts = [in_window(ts, low, high) for low, high in runs] + ([ts.isNull()] if None in months else [])
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


def scan_months(df: DataFrame, ts: Column, months: DataFrame) -> DataFrame:
    """All rows of the listed months in one pass over the source."""
    return df.where(in_months(ts, collect_months(months)))
