"""Group-by metrics from a short specification, and top-k.

Aggregates are declared, never computed on the driver: Spark runs a partial
aggregate in every map task (a hot group is collapsed before the shuffle) and a
final aggregate after a hash exchange on the group keys.

``scale`` switches sums and averages to exact decimal arithmetic
(``decimal(38, scale)``): the result no longer depends on the order in which
partial sums meet, so it is identical run after run and engine after engine.
The average is then ``sum / count`` over the values summed.  Values that the decimal
can't hold (NaN, infinities, too large) are left out of both, as a null is;
:func:`skipped_of` counts them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.names import named

# --- Fixed values: supported aggregate names ("mean" is "avg").
ALIASES = {"mean": "avg"}

_METRIC = re.compile(r"\s*(?P<column>[^:,]*[^:,\s])\s*:\s*(?P<name>\w+)\s*")


def exact(x: Column, scale: int) -> Column:
    """``x`` as ``decimal(38, scale)``; null where it doesn't fit (NaN, infinities, too large)."""
    return x.try_cast(f"decimal(38,{scale})")


def sum_of(x: Column, scale: int | None = None) -> Column:
    """Sum; with ``scale`` of the values that fit the decimal, null if their sum doesn't."""
    return F.sum(x) if scale is None else F.try_sum(exact(x, scale)).cast("double")


def avg_of(x: Column, scale: int | None = None) -> Column:
    """Average; with ``scale`` over exactly the values that :func:`sum_of` adds."""
    return F.avg(x) if scale is None else F.try_divide(sum_of(x, scale), F.count(exact(x, scale)))


#: Sums of values below this many units of 10^-scale are kept in a long, which holds 9 billion of them.
SMALL = 10**9


def exact_parts(name: str, x: Column, scale: int) -> dict[str, Column]:
    """Columns from which :func:`sum_of_parts` and :func:`avg_of_parts` get what :func:`sum_of` and :func:`avg_of` get
    from ``x``: small values as whole units in a long, large ones as decimals.  Decimals of 38 digits
    are slow to add; where a row counts in many groups it is converted once, before it is copied for them."""
    value, small = exact(x, scale), F.abs(exact(x, scale)) < F.lit(Decimal(SMALL).scaleb(-scale))
    units = (value.try_cast(f"decimal({scale + 18},{scale})") * F.lit(Decimal(10**scale))).try_cast("bigint")
    return {f"{name}_small": F.when(small, units), f"{name}_large": F.when(~small, value)}


def _count_of_parts(name: str) -> Column:
    return F.count(named(f"{name}_small")) + F.count(named(f"{name}_large"))


def sum_of_parts(name: str, scale: int) -> Column:
    """:func:`sum_of` the values behind :func:`exact_parts`."""
    whole, zero = f"decimal(38,{scale})", F.lit(0)
    small = F.coalesce(F.sum(named(f"{name}_small")), zero).cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-scale))
    large = F.when(F.count(named(f"{name}_large")) > 0, F.try_sum(named(f"{name}_large"))).otherwise(zero.cast(whole))
    return F.when(_count_of_parts(name) > 0, F.try_add(large, small.cast(whole))).cast("double")


def avg_of_parts(name: str, scale: int) -> Column:
    """:func:`avg_of` the values behind :func:`exact_parts`."""
    return F.try_divide(sum_of_parts(name, scale), _count_of_parts(name))


def skipped_of(x: Column, scale: int) -> Column:
    """How many non-null values a sum or average with ``scale`` leaves out."""
    return F.count_if(x.isNotNull() & exact(x, scale).isNull())


AGGREGATES: Mapping[str, Callable[[Column, int | None], Column]] = {
    "sum": sum_of,
    "avg": avg_of,
    "min": lambda x, scale: F.min(x),
    "max": lambda x, scale: F.max(x),
    "count": lambda x, scale: F.count(x),
}


def parse_metrics(spec: str | Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """``"price:sum,price:max"`` (or pairs) -> ``[("price", "sum"), ("price", "max")]``.

    All parts that aren't ``column:aggregate`` with a known aggregate are named in one error.
    """
    texts = spec.split(",") if isinstance(spec, str) else [":".join(pair) for pair in spec or ()]
    texts = [t for t in texts if t.strip()]
    matches = [_METRIC.fullmatch(t) for t in texts]
    pairs = [(m["column"], ALIASES.get(m["name"].lower(), m["name"].lower())) if m else ("", "") for m in matches]
    wrong = [t for t, (_, name) in zip(texts, pairs) if name not in AGGREGATES]
    if wrong or not pairs:
        raise ValueError(f"metrics are column:aggregate, aggregates {sorted(AGGREGATES)}; got {wrong or spec!r}")
    return pairs


def metric(df: DataFrame, col: str, agg: str, scale: int | None = None, alias: str | None = None) -> Column:
    """One aggregate over ``col`` coerced to double (absent column -> null)."""
    x = named(col).try_cast("double") if col in df.columns else F.lit(None).cast("double")
    return AGGREGATES[agg](x, scale).alias(alias or f"{col}_{agg}")


def metric_columns(df: DataFrame, metrics, scale: int | None = None) -> list[Column]:
    return [metric(df, c, a, scale) for c, a in parse_metrics(metrics)]


def aggregate(df: DataFrame, group_by: Sequence[str | Column], metrics, scale: int | None = None) -> DataFrame:
    """``groupBy(group_by).agg(<col>_<agg> ...)``; an absent group column raises."""
    return df.groupBy(*group_by).agg(*metric_columns(df, metrics, scale))


def top_k(df: DataFrame, by: str | Column, k: int = 5, ascending: bool = False,
          tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """The ``k`` best rows by ``by`` (planned as TakeOrderedAndProject: a bounded
    heap per task, then one merge of ``k`` rows per task)."""
    first = F.col(by) if isinstance(by, str) else by
    order = [first.asc_nulls_last() if ascending else first.desc_nulls_last()]
    order += [F.col(t).asc_nulls_first() if isinstance(t, str) else t for t in tie_breakers]
    return df.orderBy(*order).limit(int(k))
