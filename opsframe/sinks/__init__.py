"""Writers."""

from opsframe.sinks.files import (
    append_rows,
    export_frame,
    export_query,
    json_line,
    write_json_gzip,
    write_json_lines,
)
from opsframe.sinks.grid import grid_update, updated_range

__all__ = [
    "append_rows",
    "export_frame",
    "export_query",
    "grid_update",
    "json_line",
    "updated_range",
    "write_json_gzip",
    "write_json_lines",
]
