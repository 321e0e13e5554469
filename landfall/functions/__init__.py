"""Column functions."""

from .dates import (
    LOAD_ZONE, day_literal, day_text, iso_weekday, load_stamp, moment, period_date, periodicity, text_date,
)
from .predicates import (
    FRESH_MINUTES, all_equal, any_of, by_status, default_if_absent, default_if_blank, in_array, is_open,
    missing, name_match, on_date, recent,
)
from .text import (
    DATE_PLACEHOLDER, base_name, blank, clean_name, col, dated_name, ddl_replace, ddl_table, export_path,
    field_list, file_slug, fill_date, folder_name, lenient_bool, path_parts, plain_text, qualified_name,
    render, repository_parts, staging_name, strip, three_part_name, uri_parts, vars_map,
)
