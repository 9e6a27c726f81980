"""Membership of key values in a dimension.

None of these hints a broadcast. Catalyst broadcasts the dimension when its known or measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise runs a sort-merge join, where adaptive
execution splits a hot key on the batch side (left outer, semi and anti joins all allow that). For
:func:`flag_members` the dimension side is made distinct, map side first, so that a repeated member does not
multiply rows. Semi and anti joins need no distinct members; they take the members' one shuffle only. Where
one member is repeated so often that it fills a partition, ``distinct`` makes them so at the price of another.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all_equal(pairs: list[tuple[str, str]], null_safe: bool = False) -> Column:
    equal = [F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in pairs]
    return reduce(lambda a, b: a & b, equal)


def _members(
    dimension: DataFrame, columns: Sequence[str], tag: str, distinct: bool
) -> tuple[DataFrame, list[str]]:
    """The members under names that clash with nothing.

    A hot key is split only where both join inputs come straight out of a shuffle. Grouping by a hash
    besides the columns changes no result, but it keeps the join from reusing the aggregate's shuffle.
    """
    names = [f"__{tag}_{i}" for i in range(len(columns))]
    members = dimension.select(*[F.col(c).alias(n) for c, n in zip(columns, names)])
    if distinct:
        members = members.withColumn("__hash", F.xxhash64(*names)).distinct().drop("__hash")
    return members, names


def flag_members(
    df: DataFrame, columns: Sequence[str], dimension: DataFrame, dimension_columns: Sequence[str], flag: str
) -> DataFrame:
    """Add a boolean column: are the values of ``columns`` a row of the dimension?"""
    members, names = _members(dimension, dimension_columns, flag, distinct=True)
    members = members.withColumn(flag, F.lit(True))
    joined = df.join(members, _all_equal(list(zip(columns, names))), "left").drop(*names)
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def semi_join_dimension(
    df: DataFrame,
    columns: Sequence[str],
    dimension: DataFrame,
    dimension_columns: Sequence[str],
    distinct: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """Rows whose values are in the dimension. A row with a NULL among them has no match unless ``null_safe``."""
    members, names = _members(dimension, dimension_columns, "member", distinct)
    return df.join(members, _all_equal(list(zip(columns, names)), null_safe), "left_semi")


def anti_join_dimension(
    df: DataFrame,
    columns: Sequence[str],
    dimension: DataFrame,
    dimension_columns: Sequence[str],
    null_safe: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """Rows whose values are not in the dimension. A row with a NULL among them has no match unless ``null_safe``."""
    members, names = _members(dimension, dimension_columns, "member", distinct)
    return df.join(members, _all_equal(list(zip(columns, names)), null_safe), "left_anti")
