from marquee.sinks.tables import SchemaChanged, preview, save_table, show_preview, write_table
from marquee.sinks.versions import new_version

__all__ = ["SchemaChanged", "new_version", "preview", "save_table", "show_preview", "write_table"]
