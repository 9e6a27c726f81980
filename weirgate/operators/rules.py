"""Declarative row rules.

A rule is stated once, as its three-valued violation: true, false, or NULL where the value is NULL.
:func:`evaluate` adds one struct of these booleans to a table, and the summary, the gate and the split
all derive from that struct.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.operators.membership import flag_members

CHECKS = "checks"

# The rule names that summaries report.
MATCH_REGEX = "expect_column_values_to_match_regex"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
PARSES_AS = "expect_column_values_to_be_of_type"


@dataclass(frozen=True)
class Rule:
    """``violation`` builds the check; a dimension rule has ``members`` instead, found by a join."""

    expectation_type: str
    columns: tuple[str, ...]
    violation: Callable[[], Column] | None = None
    members: DataFrame | None = None
    member_columns: tuple[str, ...] = ()

    @property
    def column(self) -> str:
        return ",".join(self.columns)


def matches_regex(column: str, pattern: str) -> Rule:
    return Rule(MATCH_REGEX, (column,), lambda: ~F.col(column).rlike(pattern))


def in_set(column: str, values: Sequence[Any]) -> Rule:
    known = [v for v in values if v is not None]
    return Rule(IN_SET, (column,), lambda: ~F.col(column).isin(known))


def between(column: str, low: float, high: float) -> Rule:
    """Closed range. NaN sorts above every number, so it violates the upper bound."""
    return Rule(BETWEEN, (column,), lambda: (F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high)))


def in_dimension(columns: str | Sequence[str], dimension: DataFrame, member_columns: Sequence[str] | None = None) -> Rule:
    """Membership in a dimension table; several columns must match as one combination."""
    wanted = (columns,) if isinstance(columns, str) else tuple(columns)
    return Rule(IN_SET, wanted, None, dimension, tuple(member_columns or wanted))


def not_null(column: str) -> Rule:
    return Rule(NOT_NULL, (column,), lambda: F.col(column).isNull())


def parses_as(column: str, type_name: str) -> Rule:
    """The text must hold a value of the type; stricter than a pattern, which accepts month 99."""
    return Rule(
        PARSES_AS,
        (column,),
        lambda: F.when(F.col(column).isNotNull(), F.col(column).try_cast(type_name).isNull()),
    )


def check_name(position: int) -> str:
    return f"rule_{position}"


def check(position: int) -> Column:
    return F.col(CHECKS).getField(check_name(position))


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the struct of all rule violations. Dimension rules add one join each, the rest none."""
    if not rules:
        raise ValueError("at least one rule is needed")
    if CHECKS in df.columns:
        raise ValueError(f"the batch must not have a column named {CHECKS}")
    columns, violations = df.columns, []
    for position, rule in enumerate(rules):
        if rule.members is None:
            violation = rule.violation()
        else:
            flag = f"__hit_{position}"
            df = flag_members(df, rule.columns, rule.members, rule.member_columns, flag)
            known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.columns])
            violation = F.when(known, ~F.col(flag))
        violations.append(violation.alias(check_name(position)))
    return df.select(*columns, F.struct(*violations).alias(CHECKS))


def any_violation(rules: Sequence[Rule]) -> Column:
    """Three-valued OR over all rules: true if one is violated, NULL if none is but one is unknown."""
    return F.expr(" OR ".join(f"{CHECKS}.{check_name(i)}" for i in range(len(rules))))
