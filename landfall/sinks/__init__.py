"""Writers."""

from .files import (
    archive_rows, export_folder, export_rows, move, results_frame, set_modified, write_document, write_parquet, write_results,
)
from .refresh import defined_name, full_refresh, remove_leftovers, replace_rows, same_table, swap
from .tables import (
    add_table_column, align, append_rows, day_columns, empty_table, ensure_table, fitted, location,
    partition_columns, properties, purge_table, quoted, remove_version, replace_day, rewrite, settle, table_on_date, table_rows,
)
