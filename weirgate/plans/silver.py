"""Project, cast, deduplicate and check a batch; then quarantine it or insert its new rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from weirgate.functions import parse_iso
from weirgate.operators.dedup import dedup_rows
from weirgate.operators.months import collect_listed
from weirgate.operators.rules import CHECKS, Rule, evaluate
from weirgate.operators.schema import cast_failure_counts, cast_schema, derive_datetime, project_columns
from weirgate.operators.split import NullPolicy, clear_quarantine, quarantine
from weirgate.operators.summary import validation_gate, validation_summary
from weirgate.operators.upsert import append_staged, check_batch_id, stage_new
from weirgate.plans.feed import Feed, Places
from weirgate.plans.recovery import settle_batches
from weirgate.plans.status import LOADED, REJECTED, STAGED, create_status, now, record, record_begin, silver_states
from weirgate.session import scratch_path
from weirgate.sources import landed_files, read_landed_columns, read_worklist


@dataclass(frozen=True)
class BatchOutcome:
    """``flagged`` is the stored batch with its checks; ``new_rows`` reads the staged rows of a loaded one.

    ``cast_failures`` counts by column the raw values that became NULL; NULL passes most rules, so these are not
    seen there. ``absent_months`` were on the work list but are not landed.
    """

    batch_id: str
    state: Literal["loaded", "rejected", "empty"]
    rules: Sequence[Rule] = ()
    flagged: DataFrame | None = None
    new_rows: DataFrame | None = None
    n_new: int = 0
    n_good: int = 0
    n_bad: int = 0
    n_limbo: int = 0
    cast_failures: Mapping[str, int] = field(default_factory=dict)
    absent_months: Sequence[datetime | None] = ()

    def summary(self) -> DataFrame:
        """One row per rule: counts, percentage and samples."""
        return validation_summary(self.flagged, self.rules)


class BatchRejected(Exception):
    """A rule failed; the batch went to quarantine."""

    def __init__(self, outcome: BatchOutcome):
        super().__init__(f"batch {outcome.batch_id} rejected: {outcome.n_bad} bad and {outcome.n_good} good rows")
        self.outcome = outcome


def prepare_batch(raw: DataFrame, feed: Feed, rules: Sequence[Rule], seen: Observation | None = None) -> DataFrame:
    """Allow-list, casts, whole-row dedup, derived time and the rule checks: one plan, one shuffle.

    ``seen`` observes the cast failures of each column on the way.
    """
    wanted = project_columns(raw, list(feed.types))
    if seen is not None:
        wanted = wanted.observe(seen, *cast_failure_counts(wanted, feed.types))
    typed = cast_schema(wanted, feed.types)
    return evaluate(derive_datetime(dedup_rows(typed), feed.time_column, feed.derived_time), rules)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that later steps do not run it again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_batch(
    spark: SparkSession,
    raw: DataFrame,
    dimension: DataFrame,
    feed: Feed,
    places: Places,
    batch_id: str,
    null_policy: NullPolicy = "pass",
    on_reject: Literal["raise", "record"] = "raise",
    null_safe_keys: bool = False,
    key_order: Sequence[Column] | None = None,
    distinct_known: bool = False,
    progress: Callable[[str], None] = lambda step: None,
) -> BatchOutcome:
    """One batch through gate, then quarantine or insert.

    A batch that was cut off or rejected may run again under its id and replaces what it left: quarantine as a
    whole, and nothing stays there once it is loaded. Batches of other ids that were cut off are settled first, so
    that no row counts as known that the warehouse will not get. The id of a loaded batch is refused: other rows
    under it would replace the first ones. ``progress`` is told each step that is done: ``begun``, then ``quarantined``,
    or ``staged`` and ``appended``.
    """
    check_batch_id(batch_id)
    create_status(spark, places.status)
    settle_batches(spark, feed, places, besides=batch_id)
    begun = now()
    before = silver_states(spark, places.status, batch_id)
    if LOADED in before:
        raise ValueError(f"batch {batch_id} is loaded already; new rows need a new id")
    rules, seen = feed.rules(dimension), Observation()
    batch = store(prepare_batch(raw, feed, rules, seen), "batch")
    failures = dict(seen.get)
    record_begin(spark, places.status, batch_id, failures, begun)
    progress("begun")
    if not validation_gate(batch, rules).first()["success"]:
        kept = quarantine(batch, rules, places.quarantine, batch_id, null_policy, feed.time())
        progress("quarantined")
        record(spark, places.status, "silver", batch_id, REJECTED, 0, kept.months, begun)
        outcome = BatchOutcome(
            batch_id, "rejected", rules, batch, None, 0, kept.n_good, kept.n_bad, kept.n_limbo, failures
        )
        if on_reject == "raise":
            raise BatchRejected(outcome)
        return outcome
    rows, table = batch.drop(CHECKS), places.silver_table(feed)
    new = stage_new(
        spark, rows, table, places.staging, batch_id,
        null_safe_keys=null_safe_keys, key_order=key_order, distinct_known=distinct_known,
    )
    months = [datetime(m.year, m.month, 1) if m else None for m in new.months]
    record(spark, places.status, "silver", batch_id, STAGED, new.n_new, months, begun)
    progress("staged")
    if new.n_new:
        append_staged(new.staged, table, batch_id)
    progress("appended")
    if before:
        clear_quarantine(spark, places.quarantine, batch_id, rows.schema)
    record(spark, places.status, "silver", batch_id, LOADED, new.n_new, months, begun)
    staged = new.staged.select(*rows.columns)
    return BatchOutcome(batch_id, "loaded", rules, batch, staged, new.n_new, cast_failures=failures)


def load_worklist(
    spark: SparkSession, dimension: DataFrame, feed: Feed, places: Places, batch_id: str, **options
) -> BatchOutcome:
    """Load the months of the work list that are landed; an empty list does nothing.

    Months may differ in their other columns and in their types; one that lacks a column of the feed is an error.
    Listed months that are not landed are named in the outcome.
    """
    listed = collect_listed(read_worklist(spark, places.worklist))
    files = landed_files(spark, places.landing).select(parse_iso("iso_time").alias("month"), "flat").distinct().collect()
    flat = {row["month"]: row["flat"] for row in sorted(files, key=lambda row: not row["flat"])}
    there, absent = [m for m in listed if m in flat], [m for m in listed if m not in flat]
    if not there:
        create_status(spark, places.status)
        settle_batches(spark, feed, places)
        return BatchOutcome(batch_id, "empty", absent_months=absent)
    raw = read_landed_columns(spark, places.landing, there, list(feed.types), flat=[m for m in there if flat[m]])
    try:
        outcome = load_batch(spark, raw, dimension, feed, places, batch_id, **options)
    except BatchRejected as rejected:
        rejected.outcome = replace(rejected.outcome, absent_months=absent)
        raise
    return replace(outcome, absent_months=absent)
