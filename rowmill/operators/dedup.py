"""Keep one row per key.

Default form: ``row_number() over (partition by keys order by <total order>) = 1``.
Catalyst plans it as ``WindowGroupLimit(Partial)`` *before* the exchange and
``WindowGroupLimit(Final)`` after it, so every map task already keeps only its
own best row per key: a key that holds a third of the table ships at most one
row per input partition through the shuffle, and the plan has a single
exchange.

The winner is repeatable: the default order is every non-key column ascending
with nulls first, so the only ties left are between identical rows.

The self-join form of the original pipeline (minimum row id per key, joined
back on keys + id) is kept as :func:`dedup_by_join`; the join key includes the
row id, so a hot key is spread across all join partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.sinks.scratch import stored

NULL_KEY_MODES = ("drop", "group", "keep")

# --- Fixed values: key columns for auto-detection.  Ids come first, then the combination of most columns:
# a shorter one would merge rows that differ in what it leaves out.
ID_CANDIDATES = ("parcel_number", "parcelnumber", "parcelid", "apn", "property_id", "mlsnumber", "mls_id", "id")
KEY_COMBOS = (
    ("address", "zipcode"),
    ("address", "city", "state"),
    ("street", "city", "state", "zip_code"),
    ("address", "city", "state", "zip"),
)

_RN = "__rowmill_rn"
_RID = "__rowmill_rid"
_HASH = "__rowmill_hash"
_NULLSEP = "__rowmill_nullsep"


def _c(name: str) -> Column:
    """A column by its exact name (dots and blanks are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def detect_keys(df: DataFrame, required: bool = True) -> list[str]:
    """Pick dedup keys from the schema (case-insensitive): an id column, else an address combo.

    With ``required`` an undetectable schema raises; otherwise ``[]`` is returned.
    """
    own = {c.lower(): c for c in df.columns}
    choices = [(name,) for name in ID_CANDIDATES] + sorted(KEY_COMBOS, key=len, reverse=True)
    fitting = (choice for choice in choices if own.keys() >= set(choice))
    keys = [own[name] for name in next(fitting, ())]
    if required and not keys:
        raise ValueError(f"none of the known key columns is in {sorted(own)}; pass keys explicitly")
    return keys


def _order_exprs(df: DataFrame, keys: Sequence[str], order_by, keys_vary: bool = False) -> list[tuple[Column, bool]]:
    """``(expression, descending)`` pairs.

    The default is every non-key column ascending; when keys are matched after
    a normalisation their original values differ inside a group, so they follow
    as the last tie-breakers.  A name prefixed with ``-`` sorts descending.
    """
    if order_by is None:
        rest = [c for c in df.columns if c not in set(keys)]
        if keys_vary:
            rest += list(keys)
        return [(_c(c), False) for c in rest] or [(F.lit(1), False)]
    if order_by == "physical":
        return [(c, False) for c in _physical(df)]
    out = []
    for c in order_by:
        if isinstance(c, str) and c.startswith("-"):
            out.append((_c(c[1:]), True))
        else:
            out.append((_c(c) if isinstance(c, str) else c, False))
    return out


def _physical(df: DataFrame) -> list[Column]:
    """A row's place: file and row number for a plain Parquet scan, which stay whatever tasks its files are
    split into; else the order in which this plan's partitions hand rows out."""
    place = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    try:
        df.select(*place)
    except AnalysisException:
        return [F.monotonically_increasing_id()]
    return place


def _sorted(pairs: list[tuple[Column, bool]]) -> list[Column]:
    """Ascending with nulls first; descending with nulls last (the mirror order)."""
    return [c.desc_nulls_last() if desc else c.asc_nulls_first() for c, desc in pairs]


def _key_columns(keys: Sequence[str], match_on: Callable[[Column], Column] | None) -> list[Column]:
    return [match_on(_c(k)) if match_on else _c(k) for k in keys]


def _prepare(df: DataFrame, keys: Sequence[str], null_keys: str, on_missing_keys: str):
    if null_keys not in NULL_KEY_MODES:
        raise ValueError(f"null_keys must be one of {NULL_KEY_MODES}")
    if not keys:
        if on_missing_keys == "skip":
            return None
        raise ValueError("dedup keys must be given")
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"dedup keys not in table: {missing}")
    return list(keys)


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | str | None = None,
    null_keys: str = "drop",
    match_on: Callable[[Column], Column] | None = None,
    on_missing_keys: str = "error",
) -> DataFrame:
    """One row per key, chosen by ``order_by`` (first row wins).

    ``order_by`` lists names or expressions, ascending with nulls first; a name
    written ``"-col"`` sorts descending with nulls last (keep the latest row).
    ``None`` means every non-key column.  ``null_keys``: ``drop`` rows with a
    null key (as an inner self-join does), ``group`` nulls together as one key
    value, or ``keep`` every such row.
    ``match_on`` compares keys after a normalisation (e.g. :func:`clean_text`)
    while the output keeps the original values.  ``order_by='physical'`` keeps
    the first row in scan order: by file and row number for a plain Parquet scan, else as the
    input is partitioned (see :func:`rowmill.sources.with_row_id` for lasting numbers).
    """
    keys = _prepare(df, keys, null_keys, on_missing_keys)
    if keys is None:
        return df
    cols = df.columns
    src = df
    order = _order_exprs(df, keys, order_by, match_on is not None)
    if order_by == "physical":  # taken at the scan, before any projection
        src = src.select("*", *[c.alias(f"__rowmill_p{i}") for i, (c, _) in enumerate(order)])
        order = [(F.col(f"__rowmill_p{i}"), False) for i in range(len(order))]
    if match_on is not None:
        # materialise the normalised keys once: as window partition expressions they
        # would be re-evaluated by every sort comparison (regexes, O(n log n) times)
        src = src.select("*", *[k.alias(f"__rowmill_k{i}") for i, k in enumerate(_key_columns(keys, match_on))])
        part = [F.col(f"__rowmill_k{i}") for i in range(len(keys))]
        # equal keys have equal hashes, so it changes no group; as the first sort column it settles nearly
        # every comparison as one number, where texts with common beginnings are compared column by column
        src = src.withColumn(_HASH, F.xxhash64(*part))
        part = [F.col(_HASH), *part]
    else:
        part = [_c(k) for k in keys]
    if null_keys == "drop":
        src = src.filter(_all_not_null(keys))
    elif null_keys == "keep":
        # each row with a null key becomes its own group: kept, and spread over all partitions
        src = src.withColumn(_NULLSEP, F.when(~_all_not_null(keys), F.monotonically_increasing_id()))
        part = part + [F.col(_NULLSEP)]
    w = Window.partitionBy(*part).orderBy(*_sorted(order))
    return src.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).select(*[_c(c) for c in cols])


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = _c(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & _c(k).isNotNull()
    return cond


def dedup_by_join(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | str | None = None,
    null_keys: str = "drop",
    on_missing_keys: str = "error",
) -> DataFrame:
    """Self-join form: the winning row id per key, joined back on keys + id.

    The winner is the minimum of ``(order..., row id)``, so it is repeatable for
    the same ``order_by`` as :func:`dedup`; the row id only separates identical
    rows.  Rows with a null key never match the join (``drop``) unless
    ``null_keys='group'`` compares keys null-safely.

    The id-tagged table is written once to the shared scratch folder and both
    sides of the join read it.  An id evaluated on both sides would differ as soon
    as their plans do (other columns, other partitions after AQE) and rows would
    be lost.
    """
    keys = _prepare(df, keys, null_keys, on_missing_keys)
    if keys is None:
        return df
    if null_keys == "keep":
        raise ValueError("dedup_by_join supports null_keys 'drop' or 'group'")
    cols = df.columns
    with_id = stored(df.withColumn(_RID, F.monotonically_increasing_id()), "dedup")
    # physical order: the row id itself decides (one evaluation of the id, shared by both sides)
    order = [] if order_by == "physical" else _order_exprs(df, keys, order_by)
    if any(desc for _, desc in order):
        raise ValueError("dedup_by_join orders ascending only; use dedup() for descending keys")
    # min() over a struct compares its fields left to right, ascending, nulls first:
    # the same winner as the window form, with the row id separating identical rows.
    # Keys of text sort faster behind their hash, and the join behind the row id: one number settles a comparison.
    winners = with_id.groupBy(F.xxhash64(*[_c(k) for k in keys]).alias(_HASH), *[_c(k) for k in keys]).agg(
        F.min(F.struct(*[o.alias(f"o{i}") for i, (o, _) in enumerate(order)], F.col(_RID).alias("rid")))
        .getField("rid").alias(_RID)
    )
    left, right = with_id.alias("l"), winners.alias("r")
    eq = (lambda a, b: a.eqNullSafe(b)) if null_keys == "group" else (lambda a, b: a == b)
    cond = [F.col(f"l.{_RID}") == F.col(f"r.{_RID}")] + [eq(F.col(f"l.`{k}`"), F.col(f"r.`{k}`")) for k in keys]
    return left.join(right, cond, "inner").select(*[F.col(f"l.`{c}`").alias(c) for c in cols])
