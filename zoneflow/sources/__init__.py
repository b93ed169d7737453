"""Scans: season folders, CSV / JSON / parquet files, mixed folders, catalog tables."""

from zoneflow.sources.catalog import catalog_select_all, register_table
from zoneflow.sources.csv_ranges import read_csv_quoted
from zoneflow.sources.files import (
    BAD_RECORD_COLUMN,
    ragged_records,
    read_csv_by_header,
    read_csv_strings,
    read_csv_with_schema,
    read_json_multiline,
    read_mixed_format,
    read_parquet,
    read_parquet_recursive_merged,
    tolerant_scan,
    well_formed,
)
from zoneflow.sources.json_arrays import read_json_arrays
from zoneflow.sources.manifests import footer_manifest, header_manifest
from zoneflow.sources.seasons import (
    SKIPPED_SEASON,
    exclude_seasons,
    read_season_table,
    season_folder_scan,
    season_of_path,
    season_partitions,
)
from zoneflow.sources.tables import TableScan, row_counts_from_footers, scan_parquet, scan_season_table

__all__ = [
    "BAD_RECORD_COLUMN", "SKIPPED_SEASON", "TableScan", "catalog_select_all", "exclude_seasons", "footer_manifest",
    "header_manifest", "ragged_records", "read_csv_by_header", "read_csv_quoted", "read_csv_strings", "read_csv_with_schema", "read_json_arrays", "read_json_multiline", "read_mixed_format",
    "read_parquet", "read_parquet_recursive_merged", "read_season_table", "register_table",
    "row_counts_from_footers", "scan_parquet", "scan_season_table", "season_folder_scan", "season_of_path", "season_partitions", "tolerant_scan",
    "well_formed",
]
