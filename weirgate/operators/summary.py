"""Violation counts, bounded samples, the summary table and the gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from weirgate.operators.rules import CHECKS, Rule, any_violation, check, check_name

SAMPLE_SIZE = 20


def violation_counts(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its count and percentage over known values; a single aggregate for all rules."""
    numbers = range(len(rules))
    totals = flagged.agg(
        *[F.expr(f"count_if({CHECKS}.{check_name(i)}) AS bad_{i}") for i in numbers],
        *[F.expr(f"count({CHECKS}.{check_name(i)}) AS known_{i}") for i in numbers],
    )
    per_rule = ", ".join(f"struct(bad_{i} AS bad, known_{i} AS known)" for i in numbers)
    return totals.selectExpr(f"posexplode(array({per_rule})) AS (rule_no, n)").select(
        "rule_no",
        F.get(F.lit([r.expectation_type for r in rules]), "rule_no").alias("expectation_type"),
        F.get(F.lit([r.column for r in rules]), "rule_no").alias("column"),
        F.expr("n.bad = 0 AS success"),
        F.expr("n.bad AS unexpected_count"),
        F.expr("CASE WHEN n.known = 0 THEN 0D ELSE 100D * n.bad / n.known END AS unexpected_percent"),
    )


def _offender(flagged: DataFrame, position: int, rule: Rule) -> Column:
    """The offending value as text, with the number it sorts by where the column is numeric."""
    if len(rule.columns) == 1:
        text = F.col(rule.columns[0]).cast("string")
        numeric = isinstance(flagged.schema[rule.columns[0]].dataType, NumericType)
    else:
        text, numeric = F.concat_ws(",", *[F.col(c).cast("string") for c in rule.columns]), False
    number = F.col(rule.columns[0]).cast("double") if numeric else F.lit(None).cast("double")
    entry = F.struct(F.lit(position).alias("rule_no"), number.alias("number"), text.alias("value"))
    return F.when(check(position), entry)


def unexpected_samples(flagged: DataFrame, rules: Sequence[Rule], k: int = SAMPLE_SIZE) -> DataFrame:
    """The k smallest offending values per rule, repeats kept, as ``(rule_no, samples)``.

    The row number cuts each task to k values per rule before the shuffle, so a rule that every row violates
    moves k rows a task, and neither many distinct values nor one very frequent value moves more.
    """
    offenders = F.array(*[_offender(flagged, i, r) for i, r in enumerate(rules)])
    values = flagged.where(any_violation(rules)).select(F.inline(offenders)).where("rule_no IS NOT NULL")
    smallest = Window.partitionBy("rule_no").orderBy("number", "value")
    kept = values.withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= k)
    listed = F.array_sort(F.collect_list(F.struct("nth", "value")))
    return kept.groupBy("rule_no").agg(F.transform(listed, lambda e: e["value"]).alias("samples"))


def validation_summary(flagged: DataFrame, rules: Sequence[Rule], k: int = SAMPLE_SIZE) -> DataFrame:
    """One row per rule, in rule order."""
    # The samples have one row per rule at most, so this broadcast is bounded by the rule list.
    samples = F.broadcast(unexpected_samples(flagged, rules, k))
    empty = F.array().cast("array<string>")
    return (
        violation_counts(flagged, rules)
        .join(samples, "rule_no", "left")
        .orderBy("rule_no")
        .select(
            "expectation_type",
            "column",
            "success",
            "unexpected_count",
            "unexpected_percent",
            F.coalesce("samples", empty).alias("partial_unexpected_list"),
        )
    )


def validation_gate(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row, one boolean: did every rule succeed? NULL values do not fail a rule."""
    return violation_counts(flagged, rules).agg(F.bool_and("success").alias("success"))
