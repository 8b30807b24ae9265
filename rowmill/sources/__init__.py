"""Table sources: CSV and Parquet scans, glob resolution, upstream fallback."""

from rowmill.sources.files import first_existing, read_csv, read_csv_by_name, read_parquet, read_table, resolve_paths, upstream_input, with_row_id

__all__ = ["first_existing", "read_csv", "read_csv_by_name", "read_parquet", "read_table", "resolve_paths", "upstream_input",
           "with_row_id"]
