from marquee.sources.extracts import read_extract
from marquee.sources.inputs import input_files, missing_inputs, require_inputs, unread_files
from marquee.sources.tables import literal_rows, read_table, table_location, table_names, table_path

__all__ = [
    "input_files",
    "literal_rows",
    "missing_inputs",
    "read_extract",
    "read_table",
    "require_inputs",
    "table_location",
    "table_names",
    "table_path",
    "unread_files",
]
