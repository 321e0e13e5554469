"""Readers."""

from .delimited import never_closed, quoted_records, quoted_splits, quoting, read_csv
from .documents import calendar_entries, document_problem, document_texts, flatten_documents, missing_fields, read_calendar, read_documents
from .files import plain_path, recent_parquet, file_catalog, parquet_row_counts, path_exists, qualified_path, read_parquet, read_texts
from .params import each_entry, explode_params, first_entry, parse_entries, process_entries, rejected_params
from .schemas import Conflict, merged_schema, rows_by_file, schema_classes
