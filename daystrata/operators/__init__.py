from daystrata.operators.cleaning import cast_by_lists, clean, fill_by_type
from daystrata.operators.extremes import (
    cell_extremes,
    first_max_record,
    first_of_extremes,
    global_max,
    head_n,
    hottest_record,
    latest_rows,
    max_per_day,
    merge_extremes,
    where_all,
    where_max,
)
from daystrata.operators.quality import (
    cast_failures,
    check_not_empty,
    drop_null_key,
    failed_casts,
    file_row_counts,
    hour_out_of_range,
    non_empty,
    reconcile_content,
    reconcile_counts,
    row_count_report,
)
from daystrata.operators.shaping import (
    columns_of_type,
    drop_and_rename,
    label,
    project,
    reorder_last_first,
    stack_by_name,
)

__all__ = [
    "cast_by_lists",
    "cast_failures",
    "cell_extremes",
    "check_not_empty",
    "clean",
    "columns_of_type",
    "drop_and_rename",
    "drop_null_key",
    "failed_casts",
    "file_row_counts",
    "fill_by_type",
    "first_max_record",
    "first_of_extremes",
    "global_max",
    "head_n",
    "hottest_record",
    "hour_out_of_range",
    "label",
    "latest_rows",
    "max_per_day",
    "merge_extremes",
    "non_empty",
    "project",
    "reconcile_content",
    "reconcile_counts",
    "reorder_last_first",
    "row_count_report",
    "stack_by_name",
    "where_all",
    "where_max",
]
