"""Readers and writers for flat text, CSV and tab-separated files."""

from batchkit.sources.readers import (
    drop_header,
    explode_lines,
    parse_delimited,
    read_key_value,
    read_lines,
    read_table,
    register,
)
from batchkit.sources.writers import to_csv_line, write_csv, write_key_value, write_lines

__all__ = [
    "drop_header",
    "explode_lines",
    "parse_delimited",
    "read_key_value",
    "read_lines",
    "read_table",
    "register",
    "to_csv_line",
    "write_csv",
    "write_key_value",
    "write_lines",
]
