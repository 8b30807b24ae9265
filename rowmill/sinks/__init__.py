"""Table sinks: Parquet / CSV writes, split outputs, per-report folders, SQL tables."""

from rowmill.sinks.scratch import shared_dir
from rowmill.sinks.writers import csv_safe, write_named, write_report, write_sides, write_sized, write_split, write_table

__all__ = ["csv_safe", "shared_dir", "write_named", "write_report", "write_sides", "write_sized", "write_split", "write_table"]
