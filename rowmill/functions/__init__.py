"""Column-level building blocks (pure expressions, no actions)."""

from rowmill.functions.columns import (
    ACRES,
    BATH,
    BEDS_AGG,
    BEDS_ROUTE,
    PRICE,
    SIZE_AGG,
    SIZE_ROUTE,
    DATE_FORMATS,
    dimension,
    first_present,
    lot_bucket,
    normalize_code,
    number,
    parse_date,
    year_of,
)
from rowmill.functions.text import clean_text, normalize_strings, string_columns, trim_strings

__all__ = [
    "ACRES", "BATH", "BEDS_AGG", "BEDS_ROUTE", "PRICE", "SIZE_AGG", "SIZE_ROUTE", "DATE_FORMATS",
    "dimension", "first_present", "lot_bucket", "normalize_code", "number", "parse_date", "year_of",
    "clean_text", "normalize_strings", "string_columns", "trim_strings",
]
