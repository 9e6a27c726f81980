"""Calendar-month and file-name expressions.

Times are zone-less (``timestamp_ntz``). ``date_trunc`` and ``date_format`` route such values through
the session zone and shift them inside a daylight-saving gap, so everything here goes through
``date`` or through the text form, which no session zone touches. The parsers use their input once and
have no branches, since Spark evaluates a nested input again for each use inside a branch.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms that landed files and work lists use.
FILE_PREFIX = "ridership"
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}$"
SAFE_TIME_PATTERN = r"(\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2}-\d{3})"


def moment(value: datetime) -> Column:
    """A zone-less literal. ``F.lit`` of a datetime would go through the machine's zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def month_date(ts: Column) -> Column:
    """First day of the month as a date; NULL for text that is no timestamp."""
    return F.trunc(ts.try_cast("timestamp_ntz").cast("date"), "MM")


def month_start(ts: Column) -> Column:
    """First instant of the month."""
    return month_date(ts).cast("timestamp_ntz")


def add_month(ts: Column) -> Column:
    """One calendar month later, clamped to the end of the month, keeping the time of day."""
    return ts + F.make_ym_interval(F.lit(0), F.lit(1))


def parse_iso(text: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.fff`` to a timestamp, NULL for any other text."""
    # Text that does not match becomes empty, and empty text is no timestamp.
    return F.regexp_extract(text, ISO_PATTERN, 0).try_cast("timestamp_ntz")


def _millis(text: Column) -> Column:
    # The text form drops trailing zeros of the fraction: '.5' is 500 ms, no fraction is 0.
    return F.rpad(F.substring(text, 21, 3), 3, "0")


def iso_text(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.fff``, truncated to milliseconds."""
    text = ts.cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), _millis(text))


def datetime_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a timestamp or of text that parses as one."""
    return F.substring(ts.try_cast("timestamp_ntz").cast("string"), 1, 19)


def safe_file_name(ts: Column, prefix: str = FILE_PREFIX) -> Column:
    """The file name that encodes a timestamp to the millisecond without colons or dots."""
    text = ts.cast("string")
    clock = F.replace(F.substring(text, 12, 8), F.lit(":"), F.lit("-"))
    return F.concat(
        F.lit(f"{prefix}_"), F.substring(text, 1, 10), F.lit("T"), clock, F.lit("-"), _millis(text), F.lit(".parquet")
    )


def file_name_pattern(prefix: str = FILE_PREFIX) -> str:
    """Matches a landed file, or a part file below a landed directory, at the end of a path."""
    return rf"(?:^|[/=]){re.escape(prefix)}_{SAFE_TIME_PATTERN}\.parquet(?:/part-[^/]*)?$"


def file_name_to_iso(path: Column, prefix: str = FILE_PREFIX) -> Column:
    """The ISO text a landed path encodes, NULL for other paths."""
    safe = F.regexp_extract(path, file_name_pattern(prefix), 1)
    return F.nullif(F.regexp_replace(safe, r"T(\d+)-(\d+)-(\d+)-(\d+)$", "T$1:$2:$3.$4"), F.lit(""))
