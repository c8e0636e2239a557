"""Sinks: raw JSON landing, Parquet overwrite, Parquet append, scratch folders."""

from asterloom.scratch import new_scratch_dir
from asterloom.sinks.writers import (
    append_rows,
    by_key,
    create_if_absent,
    overwrite_single_file,
    overwrite_table,
    replace_safely,
    write_observed,
    write_records,
    write_table,
)

__all__ = [
    "append_rows",
    "by_key",
    "create_if_absent",
    "new_scratch_dir",
    "overwrite_single_file",
    "overwrite_table",
    "replace_safely",
    "write_observed",
    "write_records",
    "write_table",
]
