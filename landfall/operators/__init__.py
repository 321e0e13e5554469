"""Operators on frames."""

from .aggregate import (
    all_required, daily_counts, files_with_counts, keyed_counts, latest_start, newest, newest_path, outcome,
    period_values, row_count, row_count_on,
)
from .lookup import (
    calendar_days, due_schedules, expected_counts, expected_files, with_business_day,
)
from .mutate import RUN_COUNT, RUN_KEYS, close_runs, open_runs, purge, purged, stamp_nulls
from .order import concatenate, first_row, natural_ends, natural_key, natural_order
from .project import missing_names, normal_type, pick, route_required, string_projection, with_constants
from .schema import (
    add_missing_column, apply_schema, check_document, document_violations, enforce_required, raw_schema,
    required_violations, struct_type,
)
