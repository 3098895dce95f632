from ledgerloom.sources.scans import (  # noqa: F401
    scan_by_header,
    scan_monthly_csv,
    scan_monthly_table,
    with_file_period,
)
from ledgerloom.sources.tables import table  # noqa: F401
