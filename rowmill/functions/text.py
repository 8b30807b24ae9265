"""Text clean-up of string columns: trim, lower case, blank runs, punctuation.

All steps are ``regexp_replace`` / ``trim`` / ``lower`` expressions collapsed by
Catalyst into one projection, so the whole chain costs one pass over the data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rowmill.functions.names import named

# --- Fixed values: the patterns of the clean-up steps.
BLANK_RUN = r"\s+"
PUNCT_ASCII = r"[^\w\s]"          # ASCII word characters: letters with accents are dropped
PUNCT_UNICODE = r"[^\p{L}\p{N}_\s]"  # keeps letters and digits of every script
UNCLEAN = r"[^\w ]|  |^ | $"       # found in every text that blank runs and ASCII punctuation would change


def string_columns(df: DataFrame, columns: Iterable[str] | None = None) -> list[str]:
    """Names of the string-typed columns, optionally restricted to ``columns``."""
    wanted = None if columns is None else set(columns)
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, StringType) and (wanted is None or f.name in wanted)
    ]


def clean_text(
    col: Column | str,
    trim: bool = True,
    lowercase: bool = False,
    normalize_spaces: bool = False,
    strip_punct: bool = False,
    unicode: bool = False,
    final_trim: bool = False,
) -> Column:
    """The clean-up chain in its fixed order: trim -> lower -> blank runs -> punctuation.

    Punctuation is removed last, after the blank collapse, so ``"a - b"`` gives
    ``"a  b"`` (two blanks) just like the original pipeline; ``final_trim``
    collapses and trims once more and makes the chain idempotent.
    """
    x = F.col(col) if isinstance(col, str) else col
    if trim:
        x = F.trim(x)
    if lowercase:
        x = F.lower(x)
    given = x
    if normalize_spaces:
        x = F.trim(F.regexp_replace(x, BLANK_RUN, " "))
    if strip_punct:
        x = F.regexp_replace(x, PUNCT_UNICODE if unicode else PUNCT_ASCII, "")
    if normalize_spaces and strip_punct and not unicode:  # one search instead of two replacements where nothing changes
        x = F.when(given.rlike(UNCLEAN), x).otherwise(given)
    if final_trim:
        x = F.trim(F.regexp_replace(x, BLANK_RUN, " "))
    return x


def _rewrite(df: DataFrame, targets: list[str], fn) -> DataFrame:
    if not targets:
        return df
    chosen = set(targets)
    return df.select(*[fn(named(c)).alias(c) if c in chosen else named(c) for c in df.columns])


def trim_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Trim every string column (or the given ones); other types and order unchanged."""
    return _rewrite(df, string_columns(df, columns), F.trim)


def normalize_strings(
    df: DataFrame,
    lowercase: bool = False,
    normalize_spaces: bool = False,
    strip_punct: bool = False,
    columns: Iterable[str] | None = None,
    trim: bool = False,
    unicode: bool = False,
    final_trim: bool = False,
) -> DataFrame:
    """Apply :func:`clean_text` to every string column (or the given ones)."""
    return _rewrite(
        df,
        string_columns(df, columns),
        lambda c: clean_text(c, trim, lowercase, normalize_spaces, strip_punct, unicode, final_trim),
    )
