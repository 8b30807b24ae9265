"""Derive a label column by first-match rules (a chained CASE WHEN).

A rule whose condition is null counts as no match, exactly as ``CASE WHEN``
does; the expression is row-wise, so it also runs on streaming frames.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import BEDS_ROUTE, PRICE, SIZE_ROUTE, first_present

Condition = Column | str | Callable[[DataFrame], Column]


@dataclass(frozen=True)
class Rule:
    """``label`` is assigned when ``condition`` is true (SQL text, Column or fn(df) -> Column)."""

    label: str
    condition: Condition

    def resolve(self, df: DataFrame) -> Column:
        c = self.condition
        if isinstance(c, str):
            return F.expr(c)
        if isinstance(c, Column):
            return c
        return c(df)


def segment_expr(df: DataFrame, rules: Sequence[Rule], default: str | None) -> Column:
    if not rules:
        return F.lit(default).cast("string")
    expr = None
    for rule in rules:
        cond, label = rule.resolve(df), F.lit(rule.label)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit(default).cast("string"))


def route(df: DataFrame, rules: Sequence[Rule], default: str | None = "standard", column: str = "segment") -> DataFrame:
    """Add (or replace) ``column`` with the label of the first matching rule."""
    return df.withColumn(column, segment_expr(df, rules, default))


# --- Fixed values: the basic preset (price in currency units, size in square feet).
LUXURY_PRICE_ABOVE = 1_000_000
FAMILY_MIN_BEDS = 3
FAMILY_MIN_SIZE = 2000

PRESET_BASIC: tuple[Rule, ...] = (
    Rule("luxury", lambda df: first_present(df, PRICE, "double") > F.lit(LUXURY_PRICE_ABOVE)),
    Rule(
        "family",
        lambda df: (first_present(df, BEDS_ROUTE, "int") >= F.lit(FAMILY_MIN_BEDS))
        & (first_present(df, SIZE_ROUTE, "double") >= F.lit(FAMILY_MIN_SIZE)),
    ),
)

RULE_SETS: Mapping[str, tuple[Rule, ...]] = {"preset_basic": PRESET_BASIC}


def apply_rule_set(df: DataFrame, name: str = "preset_basic", column: str = "segment") -> DataFrame:
    """Route with a named rule set; unknown names are refused."""
    if name not in RULE_SETS:
        raise ValueError(f"unknown rule set {name!r}; known: {sorted(RULE_SETS)}")
    return route(df, RULE_SETS[name], default="standard", column=column)
