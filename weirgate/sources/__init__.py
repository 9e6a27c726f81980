from weirgate.sources.files import (
    MONTH_FILE,
    Landed,
    create_landing,
    create_table,
    land_by_month,
    local_rows,
    month_file_names,
    no_rows,
    open_table,
    read_dimension,
    read_json_pages,
    read_landed_columns,
    read_landed_months,
    read_worklist,
    worklist_entries,
    write_worklist,
)
from weirgate.sources.inventory import landed_files, landed_months, landing_inventory, month_prints, source_months

__all__ = [
    "MONTH_FILE",
    "Landed",
    "create_landing",
    "create_table",
    "land_by_month",
    "landed_files",
    "landed_months",
    "landing_inventory",
    "local_rows",
    "month_file_names",
    "no_rows",
    "open_table",
    "read_dimension",
    "read_json_pages",
    "month_prints",
    "read_landed_columns",
    "read_landed_months",
    "read_worklist",
    "source_months",
    "worklist_entries",
    "write_worklist",
]
