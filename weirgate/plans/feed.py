"""What a feed is: columns, key, rules and folders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.operators.rules import Rule, between, in_dimension, in_set, matches_regex, not_null, parses_as
from weirgate.operators.upsert import KeyedTable


@dataclass(frozen=True)
class Feed:
    """Columns in order with their types, the business key, and what each column may hold.

    ``required`` columns may not be NULL, ``parseable`` ones must hold text of a type, and each of
    ``dimension_groups`` must be found in the dimension as one combination. A name that is no column is an error.
    """

    types: Mapping[str, str]
    keys: tuple[str, ...]
    time_column: str
    derived_time: str
    warehouse_types: Mapping[str, str]
    patterns: Mapping[str, str]
    accepted: Mapping[str, Sequence[Any]]
    ranges: Mapping[str, tuple[float, float]]
    dimension_columns: tuple[str, ...]
    required: tuple[str, ...] = ()
    parseable: Mapping[str, str] = field(default_factory=dict)
    dimension_groups: tuple[tuple[str, ...], ...] = ()

    def __post_init__(self) -> None:
        named = {
            "key": self.keys,
            "time column": (self.time_column,),
            "warehouse": tuple(self.warehouse_types),
            "pattern": tuple(self.patterns),
            "accepted values": tuple(self.accepted),
            "range": tuple(self.ranges),
            "dimension": (*self.dimension_columns, *[c for group in self.dimension_groups for c in group]),
            "required": self.required,
            "type": tuple(self.parseable),
        }
        for what, columns in named.items():
            unknown = [c for c in columns if c not in self.types]
            if unknown:
                raise ValueError(f"{what} for columns that the feed does not have: {', '.join(unknown)}")

    @classmethod
    def from_config(
        cls,
        config: Mapping[str, Any],
        time_column: str,
        derived_time: str,
        warehouse_types: Mapping[str, str],
        dimension_columns: Sequence[str] = (),
    ) -> Feed:
        """A feed from a parsed rule file: column list, casts, key, patterns, accepted values and ranges.

        Optional are ``required_columns``, ``parse_types`` (column to type) and ``dimension_groups`` (lists of columns).
        """
        unknown = [c for c in config["schema"] if c not in config["expected_columns"]]
        if unknown:
            raise ValueError(f"casts for columns that are not expected: {', '.join(unknown)}")
        return cls(
            types=dict(config["schema"]),
            keys=tuple(config["key_columns"]),
            time_column=time_column,
            derived_time=derived_time,
            warehouse_types=dict(warehouse_types),
            patterns=dict(config["regex_patterns"]),
            accepted=dict(config["allowed_values"]),
            ranges={c: (r["min"], r["max"]) for c, r in config["range_constraints"].items()},
            dimension_columns=tuple(dimension_columns),
            required=tuple(config.get("required_columns", ())),
            parseable=dict(config.get("parse_types", {})),
            dimension_groups=tuple(tuple(group) for group in config.get("dimension_groups", ())),
        )

    def time(self) -> Column:
        return F.col(self.time_column).try_cast("timestamp_ntz")

    def rules(self, dimension: DataFrame) -> list[Rule]:
        """All rules in column order, then the groups; dimension columns must be found each for itself."""
        rules = []
        for column in self.types:
            if column in self.required:
                rules.append(not_null(column))
            if column in self.parseable:
                rules.append(parses_as(column, self.parseable[column]))
            if column in self.patterns:
                rules.append(matches_regex(column, self.patterns[column]))
            if column in self.accepted:
                rules.append(in_set(column, self.accepted[column]))
            if column in self.dimension_columns:
                rules.append(in_dimension(column, dimension))
            if column in self.ranges:
                rules.append(between(column, *self.ranges[column]))
        return rules + [in_dimension(group, dimension) for group in self.dimension_groups]


@dataclass(frozen=True)
class Places:
    """Folders of one feed."""

    landing: str
    worklist: str
    quarantine: str
    silver: str
    staging: str
    warehouse: str
    status: str

    @classmethod
    def below(cls, root: str) -> Places:
        return cls(
            landing=f"{root}/landing",
            worklist=f"{root}/meta/worklist",
            quarantine=f"{root}/quarantine",
            silver=f"{root}/silver",
            staging=f"{root}/staging",
            warehouse=f"{root}/warehouse",
            status=f"{root}/meta/status",
        )

    def silver_table(self, feed: Feed) -> KeyedTable:
        return KeyedTable(self.silver, feed.keys, feed.time_column)

    def warehouse_table(self, feed: Feed) -> KeyedTable:
        return KeyedTable(self.warehouse, feed.keys, feed.time_column)
