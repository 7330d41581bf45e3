from tablejobs.sources.files import export_json, export_json_pieces, read_csv, read_csv_inferred, read_json, write_csv
from tablejobs.sources.local import local_table, lookup_join
from tablejobs.sources.tables import (
    append_rows,
    bucketed_write,
    clustered_write,
    create_table,
    materialize,
    replace_table,
    temp_table,
)

__all__ = [
    "append_rows",
    "bucketed_write",
    "clustered_write",
    "create_table",
    "export_json",
    "export_json_pieces",
    "local_table",
    "lookup_join",
    "materialize",
    "read_csv",
    "read_csv_inferred",
    "read_json",
    "replace_table",
    "temp_table",
    "write_csv",
]
