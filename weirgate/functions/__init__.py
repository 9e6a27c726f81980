from weirgate.functions.casts import lenient_cast
from weirgate.functions.months import (
    FILE_PREFIX,
    add_month,
    datetime_text,
    file_name_pattern,
    file_name_to_iso,
    iso_text,
    moment,
    month_date,
    month_start,
    parse_iso,
    safe_file_name,
)

__all__ = [
    "FILE_PREFIX",
    "add_month",
    "datetime_text",
    "file_name_pattern",
    "file_name_to_iso",
    "iso_text",
    "lenient_cast",
    "moment",
    "month_date",
    "month_start",
    "parse_iso",
    "safe_file_name",
]
