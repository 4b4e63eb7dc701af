"""Readers that give DataFrames."""

from opsframe.sources.catalog import schema_info, table_info
from opsframe.sources.files import list_files, read_files_binary
from opsframe.sources.grid import (
    column_index,
    column_letters,
    grid_range,
    grid_range_frame,
    parse_range,
)
from opsframe.sources.json_text import (
    parse_lines,
    read_json_document,
    read_json_lines,
)
from opsframe.sources.paged import (
    PAGE_STYLES,
    PageStyle,
    check_pages,
    missing_pages,
    next_token,
    read_pages,
)
from opsframe.sources.reports import REPORT_TYPES, read_report_csv
from opsframe.sources.warehouse import jdbc_options, read_jdbc, run_sql

__all__ = [
    "PAGE_STYLES",
    "REPORT_TYPES",
    "PageStyle",
    "check_pages",
    "column_index",
    "column_letters",
    "grid_range",
    "grid_range_frame",
    "jdbc_options",
    "list_files",
    "missing_pages",
    "next_token",
    "parse_lines",
    "parse_range",
    "read_files_binary",
    "read_jdbc",
    "read_json_document",
    "read_json_lines",
    "read_pages",
    "read_report_csv",
    "run_sql",
    "schema_info",
    "table_info",
]
