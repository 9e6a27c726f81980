"""Casts that give NULL where a value does not fit, whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, LongType, StringType


def lenient_cast(value: Column, source: DataType, target: str) -> Column:
    """Cast to ``target``, however its name is spelt; integer text may carry a fraction, which is cut off ('1.7' gives 1)."""
    kind = DataType.fromDDL(target)
    if isinstance(kind, IntegralType) and isinstance(source, StringType):
        through_double = value.try_cast("double").try_cast(kind)
        if isinstance(kind, LongType):
            # A double holds 53 bits, so whole numbers go straight to 64 bits first.
            return F.coalesce(value.try_cast(kind), through_double)
        return through_double
    return value.try_cast(kind)
