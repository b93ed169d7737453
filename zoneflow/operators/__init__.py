"""DataFrame -> DataFrame operators: schema conformance, unions, merges, fills."""

from zoneflow.operators.enrich import (
    fill_from_knowledge,
    fill_from_latest_known,
    fill_plan,
    fill_with_state,
    known_pairs,
    latest_known_value,
    period_knowledge,
    periods_that_move,
    row_counts,
)
from zoneflow.operators.merge import (
    duplicate_rows,
    merge_by_priority,
    merge_grouped,
    merge_joined,
    merge_picked,
    merge_stored,
    picked_rows,
    store_by_key,
)
from zoneflow.operators.schema import (
    COACH_FIELDS,
    STANDARD_MATCH_COLUMNS,
    STANDING_CSV_SCHEMA,
    STANDING_RENAMES,
    SUBJECT_SCHEMAS,
    align_to_schema,
    cast_all_to_string,
    drop_columns,
    flatten_struct,
    rename_columns,
    resolve,
    standardize_columns,
    unify_schemas,
    union_by_name_lenient,
    union_by_name_strict,
)

__all__ = [
    "COACH_FIELDS", "STANDARD_MATCH_COLUMNS", "STANDING_CSV_SCHEMA", "STANDING_RENAMES",
    "SUBJECT_SCHEMAS", "align_to_schema", "cast_all_to_string", "drop_columns", "duplicate_rows",
    "fill_from_knowledge", "fill_from_latest_known", "fill_plan", "fill_with_state", "flatten_struct", "known_pairs",
    "latest_known_value", "merge_by_priority", "merge_grouped", "merge_joined", "merge_picked", "merge_stored",
    "period_knowledge", "periods_that_move", "picked_rows", "rename_columns", "resolve", "row_counts",
    "standardize_columns", "store_by_key", "unify_schemas", "union_by_name_lenient", "union_by_name_strict",
]
