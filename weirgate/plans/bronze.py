"""Find the months a source has and the landing area lacks, land them, and publish the work list."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from weirgate.functions import month_start, parse_iso
from weirgate.operators.months import collect_listed, in_months
from weirgate.plans.feed import Feed, Places
from weirgate.plans.recovery import settle_batches
from weirgate.plans.status import LOADED, REJECTED, STATUS_SCHEMA, create_status, now, read_status, record, write_status
from weirgate.sources import (
    Landed,
    create_landing,
    land_by_month,
    landed_files,
    landed_months,
    local_rows,
    month_prints,
    read_landed_months,
    read_worklist,
    write_worklist,
)

LANDING, LANDED, PRINTS = "landing", "landed", "prints"


def land_missing_months(
    spark: SparkSession,
    source: DataFrame,
    feed: Feed,
    places: Places,
    reopen_last: int = 0,
    reopen_rejected: bool = False,
    changed: bool = False,
) -> DataFrame:
    """Land every missing month in one pass, all its rows; gives the work list of landed months to be loaded.

    Rows whose time is no time are landed as well, as one more month, the NULL one: they go through the gate
    and the quarantine like any others, and are landed again whenever they differ from those landed last. With ``changed``
    so is every month: the source is scanned for a fingerprint of each. Without, only its times and its undated rows
    are compared, and ``reopen_last`` lands the last months again, for rows that came in late. A month landed again is
    replaced by what the source has of it. ``reopen_rejected`` lists rejected months again, after a rule or a dimension
    has changed.
    """
    create_landing(spark, places.landing)
    create_status(spark, places.status)
    # Months are bounded by the calendar, so the lists are compared here and what is landed is listed once.
    landed = set(collect_listed(landed_months(spark, places.landing, undated=True)))
    if changed:
        prints = collect_prints(source, feed)
        offered = set(prints)
    else:
        offered = set(collect_listed(source.select(month_start(feed.time()).alias("month")).distinct()))
        prints = collect_prints(source.where(feed.time().isNull()), feed) if None in offered else {}
    last = sorted(m for m in landed if m is not None)[-reopen_last:] if reopen_last else []
    again = {*last, None} if reopen_last else set()
    noted, cut_off = noted_prints(spark, places)
    unknown = sorted((landed & set(prints)) - set(noted) - cut_off, key=_by_time)
    found = landed_prints(spark, feed, places, unknown) if unknown else {}
    differ = {m for m in landed & set(prints) if prints[m] != {**found, **noted}.get(m)}
    months = sorted((offered - landed) | (offered & (again | differ | cut_off)), key=_by_time)
    if months:
        # Noted before it happens: a run that is cut off in between lists a month once too often, never too seldom.
        at = now()
        record(spark, places.status, "landing", f"landing-{at}", LANDING, 0, months, at)
        done = land_by_month(source.where(in_months(feed.time(), months)), feed.time(), places.landing)
        note_landed(spark, places, f"landing-{at}", done, months, {m: prints[m] for m in months if m in prints}, at)
    settle_batches(spark, feed, places)
    publish_worklist(spark, places, landed.union(months), reopen_rejected)
    return read_worklist(spark, places.worklist)


def _by_time(month: datetime | None) -> tuple:
    return (month is not None, month)


def collect_prints(rows: DataFrame, feed: Feed) -> dict[datetime | None, str]:
    """The fingerprint of every month of ``rows``; as many as the calendar has months."""
    return {row["month"]: row["print"] for row in month_prints(rows, feed.time()).collect()}


def landed_prints(spark: SparkSession, feed: Feed, places: Places, months: list[datetime | None]) -> dict[datetime | None, str]:
    """Fingerprints of months as they are landed, for those that no landing has noted."""
    flat = landed_files(spark, places.landing).where("flat").select(parse_iso("iso_time").alias("month"))
    singles = set(collect_listed(flat)) & set(months)
    return collect_prints(read_landed_months(spark, places.landing, months, flat=sorted(singles, key=_by_time)), feed)


def noted_prints(spark: SparkSession, places: Places) -> tuple[dict[datetime | None, str], set[datetime | None]]:
    """The fingerprints noted of landed months since they were landed last, and the months whose landing was cut off."""
    landing, at = F.col("stage") == "landing", F.coalesce("at", F.lit(0))
    last = read_status(spark, places.status).where(landing | (F.col("stage") == PRINTS)).groupBy("month").agg(
        F.max(F.when(landing, at)).alias("landed_at"),
        F.max_by(F.when(landing, F.col("state")), F.when(landing, at)).alias("state"),
        F.max(F.when(~landing, at)).alias("noted_at"),
        F.max_by(F.when(~landing, F.col("state")), F.when(~landing, at)).alias("print"),
    )
    rows = last.collect()
    cut_off = {row["month"] for row in rows if row["state"] == LANDING}
    noted = {r["month"]: r["print"] for r in rows if r["noted_at"] is not None and r["noted_at"] >= (r["landed_at"] or 0)}
    return {m: p for m, p in noted.items() if m not in cut_off}, cut_off


def note_landed(
    spark: SparkSession,
    places: Places,
    batch_id: str,
    done: Landed,
    months: list[datetime | None],
    prints: dict[datetime | None, str],
    at: int,
) -> None:
    """What a landing did, in one write: its months, their fingerprints as far as they are known, and the undated rows."""
    shared = {"n_rows": done.n_rows, "at": at, "batch_id": batch_id}
    rows = [{**shared, "month": m, "state": LANDED, "stage": "landing"} for m in months]
    rows += [{**shared, "month": m, "state": text, "stage": PRINTS} for m, text in prints.items()]
    if done.n_undated:
        rows.append({**shared, "month": None, "state": LANDED, "n_rows": done.n_undated, "stage": "undated"})
    write_status(local_rows(spark, rows, STATUS_SCHEMA).coalesce(1), places.status)


def publish_worklist(
    spark: SparkSession, places: Places, landed: set[datetime | None], reopen_rejected: bool = False
) -> None:
    """Landed months that silver has not settled since they were landed last.

    The list is made from what really is there, so months of a run that was cut off before silver stay on it.
    """
    settles = (F.col("stage") == "silver") & F.col("state").isin(LOADED, REJECTED)
    landing, at = F.col("stage") == "landing", F.coalesce("at", F.lit(0))
    noted = read_status(spark, places.status).groupBy("month").agg(
        F.max(F.when(landing, at)).alias("landed_at"),
        F.max(F.when(settles, at)).alias("settled_at"),
        F.max_by(F.when(settles, F.col("state")), F.when(settles, at)).alias("state"),
    )
    settled = {
        row["month"]
        for row in noted.where("settled_at IS NOT NULL").collect()
        if (row["landed_at"] or 0) <= row["settled_at"] and not (reopen_rejected and row["state"] == REJECTED)
    }
    rows = [{"month": m} for m in landed - settled]
    write_worklist(local_rows(spark, rows, StructType([StructField("month", TimestampNTZType())])), places.worklist)
