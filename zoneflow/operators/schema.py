"""Schema operators: rename, drop, conform, align, unify, union, flatten.

All of them are plan-time rewrites: they inspect ``df.schema`` (no data
access) and emit one ``select``.  Casts use ``try_cast`` so bad values become
null under ANSI mode instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from zoneflow.functions.casts import cast_value

# --- fixed values: declared schemas of the match and general data ------------
# The 22 standard match columns, in order, with their declared types.
STANDARD_MATCH_COLUMNS = (
    ("round", "string"), ("ft", "string"), ("ht", "string"), ("agg_ft", "string"),
    ("et", "string"), ("p", "string"), ("stage", "string"), ("group", "string"),
    ("day", "string"), ("week", "int"), ("dateonly", "string"), ("temporada", "string"),
    ("round_type", "string"), ("team_name_1", "string"), ("country_1", "string"),
    ("team_name_2", "string"), ("country_2", "string"), ("team1score", "int"),
    ("team2score", "int"), ("comments", "string"), ("partition_0", "string"),
    ("partition_1", "string"),
)

SUBJECT_SCHEMAS = {
    "TEAMS": {"name": "string", "foundation_year": "int", "status": "string"},
    "COUNTRIES": {"country_name": "string", "code": "string", "region": "string"},
    "PLAYERS": {"player_name": "string", "team": "string", "matches_played": "int", "goals": "int"},
}

# Team standing CSV: positional schema (the header line is not used for names).
STANDING_CSV_SCHEMA = StructType([
    StructField("index", IntegerType()),
    StructField("Team", StringType()),
    StructField("M.", IntegerType()),
    StructField("W", IntegerType()),
    StructField("D", IntegerType()),
    StructField("L", IntegerType()),
    StructField("goals", StringType()),
    StructField("Dif", IntegerType()),
    StructField("Pt.", IntegerType()),
])

STANDING_RENAMES = {
    "Team": "name", "M.": "matches_played", "W": "wins", "D": "draws", "L": "losses",
    "goals": "total_goals", "Dif": "goal_difference", "Pt.": "points",
}

COACH_FIELDS = ("first_name", "last_name", "nationality", "date_of_birth")
# ----------------------------------------------------------------------------


def resolve(df: DataFrame, name: str) -> str | None:
    """Actual column name matching ``name`` case-insensitively, else None."""
    if name in df.columns:
        return name
    lowered = name.lower()
    for c in df.columns:
        if c.lower() == lowered:
            return c
    return None


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename present columns (case-insensitive match); absent names are ignored."""
    present = {}
    for old, new in mapping.items():
        actual = resolve(df, old)
        if actual is not None:
            present[actual] = new
    return df.withColumnsRenamed(present) if present else df


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that exist (case-insensitive); absent names are ignored."""
    present = [c for c in (resolve(df, n) for n in names) if c is not None]
    return df.drop(*present) if present else df


def standardize_columns(df: DataFrame, columns: Sequence[tuple[str, str]] = STANDARD_MATCH_COLUMNS) -> DataFrame:
    """Add every declared column that is missing as a typed null; keep the rest."""
    missing = [F.lit(None).cast(t).alias(c) for c, t in columns if resolve(df, c) is None]
    return df.select("*", *missing) if missing else df


def align_to_schema(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Cast declared columns that exist, add missing ones as typed nulls, keep extras."""
    wanted = {name.lower(): (name, t) for name, t in schema.items()}
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = []
    for c in df.columns:
        hit = wanted.get(c.lower())
        cols.append(cast_value(F.col(f"`{c}`"), types[c], hit[1]).alias(c) if hit else F.col(f"`{c}`"))
    present = {c.lower() for c in df.columns}
    cols += [F.lit(None).cast(t).alias(n) for n, t in schema.items() if n.lower() not in present]
    return df.select(*cols)


_WIDENING = ("tinyint", "smallint", "int", "bigint", "float", "double")


def agreed_type(types: Iterable[str]) -> str:
    """The one type that holds values of all ``types``: itself, the widest number, else text."""
    seen = list(dict.fromkeys(t for t in types if t != "void")) or ["string"]
    if len(seen) == 1:
        return seen[0]
    if all(t in _WIDENING for t in seen):
        return "double" if {"bigint", "float"} <= set(seen) else max(seen, key=_WIDENING.index)
    return "string"


def column_types(dfs: Sequence[DataFrame]) -> dict[str, str]:
    """First-appearance order of every column with the type its frames agree on."""
    types: dict[str, list[str]] = {}
    for df in dfs:
        for field in df.schema.fields:
            types.setdefault(field.name, []).append(field.dataType.simpleString())
    return {c: agreed_type(t) for c, t in types.items()}


def as_type(name: str, have: str, want: str) -> Column:
    """Column ``name`` as ``want``; nested values become JSON text."""
    value = F.col(f"`{name}`")
    if have == want:
        return value
    if want == "string" and have.startswith(("struct", "array", "map")):
        return F.to_json(value).alias(name)
    return value.cast(want).alias(name)


def unify_schemas(dfs: Sequence[DataFrame]) -> list[DataFrame]:
    """Give every frame the union of all column sets in the types they agree on; missing columns are typed null."""
    types = column_types(dfs)
    out = []
    for df in dfs:
        have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        out.append(df.select(
            *[as_type(c, have[c], t) if c in have else F.lit(None).cast(t).alias(c) for c, t in types.items()]))
    return out


def union_by_name_strict(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; differing column sets raise ``AnalysisException``."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_by_name_lenient(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns missing from a frame are null-filled."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def cast_all_to_string(df: DataFrame) -> DataFrame:
    """Every column as text -- the safe common type before unioning CSV with JSON."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def flatten_struct(df: DataFrame, struct_col: str, fields: Sequence[str] = COACH_FIELDS,
                   prefix: str | None = None, field_type: str = "string") -> DataFrame:
    """Replace struct ``struct_col`` by ``<prefix>_<field>`` columns.

    Only when the struct exists.  Declared fields the struct lacks become typed
    nulls instead of failing with ``FIELD_NOT_FOUND``.
    """
    actual = resolve(df, struct_col)
    if actual is None:
        return df
    prefix = prefix or actual
    struct_type = df.schema[actual].dataType
    have = {f.name.lower(): f.name for f in struct_type.fields} if isinstance(struct_type, StructType) else {}
    flat = []
    for field in fields:
        name = f"{prefix}_{field}"
        if field.lower() in have:
            flat.append(F.col(f"`{actual}`").getField(have[field.lower()]).alias(name))
        else:
            flat.append(F.lit(None).cast(field_type).alias(name))
    rest = [F.col(f"`{c}`") for c in df.columns if c != actual]
    return df.select(*rest, *flat)
