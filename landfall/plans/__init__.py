"""Jobs made of the operators."""

from .checks import completeness, completeness_line, landing_report, table_counts, validate_tables
from .documents import notices, publish_schema
from .loads import load_csv, load_documents, load_parquet, newest_file, open_process_runs, reload_date
from .statements import (
    definitions, export_query, period_day, purge_entries, purge_tables, render_scripts, run_definitions, run_insert,
    run_script_folder, run_scripts, run_sql, step_line, summary,
)
