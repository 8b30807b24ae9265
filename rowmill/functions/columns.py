"""Typed column helpers: synonyms, safe numeric coercion, dates, buckets, codes.

Spark 4 runs with ANSI mode on, where ``cast('abc' as double)`` raises.  Every
coercion here therefore goes through ``try_cast`` / ``try_to_date`` so that
dirty text becomes null instead of failing the job.  Each synonym is coerced
*before* ``coalesce`` so that an unparsable first synonym falls through to the
next one rather than poisoning the common type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.names import named

# --- Fixed values: column-synonym lists (order is significant, first match wins).
# Routing uses one order for beds and size, the named reports another.
PRICE = ("price", "list_price", "sold_price")
BEDS_ROUTE = ("beds", "bedrooms", "bed")
SIZE_ROUTE = ("sqft", "sqft_living", "living_area", "house_size")
BEDS_AGG = ("bed", "beds", "bedrooms")
SIZE_AGG = ("house_size", "sqft", "sqft_living", "living_area")
BATH = ("bath", "baths", "bathrooms")
ACRES = ("acre_lot", "lot_size_acres", "acres")

# --- Fixed values: date formats tried in this order, the first that parses wins.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy", "yyyy/MM/dd")

# --- Fixed values: lot-size bucket edges in acres.
LOT_SMALL_BELOW = 0.25
LOT_LARGE_ABOVE = 1.0


def number(col: Column | str, dtype: str = "double") -> Column:
    """Coerce to a number without failing on dirty input.

    Integral targets go through ``double`` first so that the text ``"2.7"`` and
    the number ``2.7`` both give 2 (a direct ``try_cast('2.7' as int)`` is null).
    """
    c = F.col(col) if isinstance(col, str) else col
    if dtype in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
        return c.try_cast("double").try_cast(dtype)
    return c.try_cast(dtype)


def first_present(df: DataFrame, names: Sequence[str], dtype: str | None = "double") -> Column:
    """First non-null value among the synonyms that exist in ``df``.

    Presence is tested by exact name.  With ``dtype`` each synonym is coerced
    before the coalesce; an absent field is a null of that type.
    """
    present = [n for n in names if n in df.columns]
    if not present:
        return F.lit(None).cast(dtype or "string")
    cols = [number(named(n), dtype) if dtype else named(n) for n in present]
    return cols[0] if len(cols) == 1 else F.coalesce(*cols)


def dimension(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column ``name`` if it exists, otherwise a typed null under that name."""
    if name in df.columns:
        return named(name).alias(name)
    return F.lit(None).cast(dtype).alias(name)


def parse_date(col: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Parse text with the first format that fits; null when none does."""
    c = F.col(col) if isinstance(col, str) else col
    tries = [F.try_to_date(c, fmt) for fmt in formats]
    return tries[0] if len(tries) == 1 else F.coalesce(*tries)


def year_of(df: DataFrame, name: str = "prev_sold_date", formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Year of a multi-format date column; typed null when the column is absent."""
    if name not in df.columns:
        return F.lit(None).cast("int")
    return F.year(parse_date(named(name), formats))


def lot_bucket(acres: Column) -> Column:
    """<0.25 small, 0.25..1.0 medium (both ends in), >1.0 large, null unknown.

    NaN compares as the largest double in Spark, so it lands in ``large``.
    """
    return (
        F.when(acres < F.lit(LOT_SMALL_BELOW), F.lit("small"))
        .when((acres >= F.lit(LOT_SMALL_BELOW)) & (acres <= F.lit(LOT_LARGE_ABOVE)), F.lit("medium"))
        .when(acres > F.lit(LOT_LARGE_ABOVE), F.lit("large"))
        .otherwise(F.lit("unknown"))
    )


def normalize_code(
    col: Column | str,
    length: int | None = 5,
    numeric: bool = True,
    truncate: bool = False,
    null_as_empty: bool = False,
) -> Column:
    """Normalise a postal-style code: text, optionally digits only, left-padded.

    Values longer than ``length`` stay whole; ``truncate=True`` cuts them (ZIP+4 ->
    5 digits).  A null stays null unless
    ``null_as_empty`` asks for the padded-empty form (all zeros).
    """
    c = F.col(col) if isinstance(col, str) else col
    z = c.cast("string")
    if numeric:
        z = F.regexp_replace(z, r"[^0-9]", "")
    if null_as_empty:
        z = F.coalesce(z, F.lit(""))
    if not length:
        return z
    padded = F.lpad(z, int(length), "0")
    if truncate:
        return padded
    return F.when(F.length(z) >= F.lit(int(length)), z).otherwise(padded)
