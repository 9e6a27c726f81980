"""Dated URL lists joined to captures as of their fetch time, in DataFrame functions only.

A list is a log: at a time an entry (list, pattern) is added or removed. Entries become validity intervals, from an
addition to the next change of the same entry. A capture is matched by its host and every parent domain, by
every directory of its path, and by its whole address; it is judged by the entries active when it was fetched.

The as-of join splits time into slices. The intervals that a slice sees are those that begin in it, and for each
entry the one that is carried over from earlier slices, of which there is at most one per entry and slice. Captures
join them by pattern and slice, and times decide. No window holds captures: a host with a third of them, all fetched
within one slice, is one key of a join, which adaptive execution splits, and the other side of that key is as small as
the changes of its entries in one slice. Patterns that no list holds are dropped before anything else.

Of changes to one entry at the same time the last by ``number`` counts. Entries without list, pattern, time or with
an unknown action, and captures without time or address, match nothing; captures stay as ``unlisted``. Rows that repeat
an id share a verdict; repeated changes count once. Empty tables on either side are allowed, and other columns,
whatever their names, are not read. Long addresses are matched whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirgate.llm.common import stage

SLICE_SECONDS = 7 * 86400
ENTRY = ("list", "pattern")


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and final dot; empty if there is none."""
    rest = F.regexp_extract(F.lower(url), "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.rtrim(rest, F.lit("."))


def patterns_of(url: Column) -> Column:
    """All patterns that match an address: domains as ``example.org``, directories as ``host/a/``, the address
    as ``host/a/b?c``."""
    host = F.coalesce(host_of(url), F.lit(""))
    labels = F.split(host, "\\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    rest = F.regexp_extract(url, "^[^:]*://[^/?#]*([^#]*)", 1)
    parts = F.split(F.regexp_extract(rest, "^([^?]*)", 1), "/")
    directories = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
        lambda i: F.concat(host, F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")),
    )
    found = F.array_distinct(F.concat(domains, directories, F.array(F.concat(host, rest))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(found)


def _slice(time: Column, seconds: int) -> Column:
    return F.floor(time / seconds)


def validity_intervals(entries: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """``entries`` (list, pattern, time, number, action 'add' or 'remove') as list, pattern, valid_from, valid_to.

    valid_to is null for entries never changed again. Adding what is there already ends one interval and begins
    the next at the same time.
    """
    known = entries.where("list is not null and pattern is not null and time is not null and action in ('add', 'remove')")
    at_once = known.groupBy(*ENTRY, "time").agg(F.max_by("action", F.struct("number", "action")).alias("action"))
    sliced = at_once.withColumn("slice", _slice(F.col("time"), slice_seconds))
    within = Window.partitionBy(*ENTRY, "slice").orderBy("time")
    over = Window.partitionBy(*ENTRY).orderBy("slice")
    first = sliced.groupBy(*ENTRY, "slice").agg(F.min("time").alias("first"))
    later = first.withColumn("later", F.lead("first").over(over)).drop("first")
    ended = sliced.withColumn("next", F.lead("time").over(within)).join(later, [*ENTRY, "slice"])
    return ended.where("action = 'add'").select(
        *ENTRY, F.col("time").alias("valid_from"), F.coalesce("next", "later").alias("valid_to")
    )


def active_entries(captures: DataFrame, intervals: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """id, list, pattern, valid_from of each entry active at a capture (id, url, time)."""
    keys = captures.where("time is not null").select("id", "time", F.explode(patterns_of(F.col("url"))).alias("pattern"))
    entries = intervals.select(*ENTRY).distinct()
    listed = keys.join(entries.select("pattern").distinct(), "pattern", "left_semi")
    asked = listed.withColumn("slice", _slice(F.col("time"), slice_seconds))
    starts = intervals.withColumn("slice", _slice(F.col("valid_from"), slice_seconds))

    # One row per entry and slice that has captures or starts; what the slice begins with comes from those before.
    interval = F.struct("valid_from", "valid_to")
    ends = starts.groupBy(*ENTRY, "slice").agg(F.max(interval).alias("last"))
    visited = asked.select("pattern", "slice").distinct().join(entries, "pattern").select(*ENTRY, "slice")
    touched = visited.join(ends, [*ENTRY, "slice"], "full")
    before = Window.partitionBy(*ENTRY).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = touched.select(*ENTRY, "slice", F.last("last", ignorenulls=True).over(before).alias("it")).where("it is not null")
    live = starts.select(*ENTRY, "slice", "valid_from", "valid_to").union(
        carried.select(*ENTRY, "slice", "it.valid_from", "it.valid_to")
    )
    met = asked.join(live, ["pattern", "slice"])
    active = met.where("time >= valid_from and (valid_to is null or time < valid_to)")
    return active.select("id", *ENTRY, "valid_from")


def judge(captures: DataFrame, entries: DataFrame, allow_lists: tuple[str, ...] = ("allow",)) -> DataFrame:
    """id, url, host, time, verdict ('blocked', 'allowed', 'unlisted'), lists, n_entries of every capture.

    Entries of an allow list outweigh others. ``captures`` are id, url, time; rows that repeat an id share a verdict.
    """
    intervals = stage(validity_intervals(entries), "intervals")
    active = active_entries(captures, intervals).distinct()
    per_capture = active.groupBy("id").agg(
        F.sort_array(F.collect_set("list")).alias("lists"),
        F.count("*").alias("n_entries"),
        F.max(F.col("list").isin(*allow_lists)).alias("allowed"),
    )
    verdict = F.when(F.col("allowed"), "allowed").when(F.col("lists").isNotNull(), "blocked").otherwise("unlisted")
    return captures.select("id", "url", "time").join(per_capture, "id", "left").select(
        "id",
        "url",
        host_of(F.col("url")).alias("host"),
        "time",
        verdict.alias("verdict"),
        F.coalesce("lists", F.array().cast("array<string>")).alias("lists"),
        F.coalesce("n_entries", F.lit(0).cast("bigint")).alias("n_entries"),
    )
