"""Sources: JSON records, page envelopes, Parquet tables, literal tables, page windows."""

from asterloom.sources.arrays import array_records, read_array_records
from asterloom.sources.readers import (
    CORRUPT_COLUMN,
    current_version,
    flatten_pages,
    literal_table,
    page_metrics,
    page_report,
    page_schema,
    read_if_present,
    read_pages,
    read_records,
    read_replaceable,
    read_table,
    read_target,
    target_keys,
    version_path,
)
from asterloom.sources.windows import concat_pages, page_window

__all__ = [
    "CORRUPT_COLUMN",
    "array_records",
    "concat_pages",
    "current_version",
    "flatten_pages",
    "literal_table",
    "page_metrics",
    "page_report",
    "page_schema",
    "page_window",
    "read_array_records",
    "read_if_present",
    "read_pages",
    "read_records",
    "read_replaceable",
    "read_table",
    "read_target",
    "target_keys",
    "version_path",
]
