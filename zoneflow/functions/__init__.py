"""Column expressions: names, synonyms, dates, scores, rendering."""

from zoneflow.functions.dates import (
    date_from_text,
    date_from_timestamp,
    day_from_iso,
    day_from_text,
    week_from_iso,
    week_from_text,
)
from zoneflow.functions.names import (
    NAME_STOP_TOKENS,
    TEAM_SYNONYM_RULES,
    canonicalize,
    canonicalize_by_join,
    close_rules,
    fold_rules,
    normalize_name,
)
from zoneflow.functions.render import as_text, row_as_json_array
from zoneflow.functions.scores import (
    backfill_int,
    is_null_token,
    null_token_default,
    pair_part,
    split_pair_to_ints,
)

__all__ = [
    "NAME_STOP_TOKENS", "TEAM_SYNONYM_RULES", "as_text", "backfill_int", "canonicalize",
    "canonicalize_by_join", "close_rules", "date_from_text", "date_from_timestamp", "day_from_iso",
    "day_from_text", "fold_rules", "is_null_token", "normalize_name", "null_token_default",
    "pair_part", "row_as_json_array", "split_pair_to_ints", "week_from_iso", "week_from_text",
]
