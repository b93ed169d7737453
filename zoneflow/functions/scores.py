"""Score and token expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from zoneflow.functions.casts import cast_value, text_to_integral

# --- fixed values ----------------------------------------------------------
NULL_TOKENS = ("NA",)
DEFAULT_ROUND_TYPE = "g"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pair_part(c: Column | str, index: int, sep: str = "-") -> Column:
    """Integer at position ``index`` (0-based) of ``"a-b"`` text; null when absent."""
    return text_to_integral(F.get(F.split(_col(c), sep), index), "int")


def split_pair_to_ints(c: Column | str, sep: str = "-") -> tuple[Column, Column]:
    """``"12-7"`` -> (12, 7); ``"12"`` -> (12, null); ``"-3-7"`` -> (null, 3)."""
    return pair_part(c, 0, sep), pair_part(c, 1, sep)


def is_null_token(c: Column | str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """True for real nulls and for the textual null tokens (``"NA"``)."""
    return _col(c).isNull() | _col(c).isin(list(tokens))


def null_token_default(c: Column | str, default: str = DEFAULT_ROUND_TYPE,
                       tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Replace null / ``"NA"`` by ``default``; everything else unchanged."""
    return F.when(is_null_token(c, tokens), F.lit(default)).otherwise(_col(c))


def backfill_int(primary: Column | str, fallback: Column | str | None,
                 primary_type: str = "string", fallback_type: str = "string") -> Column:
    """``primary`` when it is not null, else ``fallback``; then as int.

    A non-null but non-numeric ``primary`` yields null (it still wins).
    ``*_type`` are the source types (Spark simple strings) of the two columns.
    """
    first = _col(primary)
    first_int = cast_value(first, primary_type, "int")
    if fallback is None:
        return first_int
    return F.when(first.isNotNull(), first_int).otherwise(cast_value(_col(fallback), fallback_type, "int"))
