"""Sources (Parquet/CSV scans, the raw_* test views) and sinks."""

from tallyhouse.sources.tables import (  # noqa: F401
    RAW_TABLES,
    raw_orders,
    raw_products,
    raw_sources,
    raw_users,
    read_csv_typed,
    read_table,
)
from tallyhouse.sources.sinks import DuplicateKey, check_key, write_csv, write_files, write_table  # noqa: F401
