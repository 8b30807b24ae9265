"""Named aggregation reports over listing-shaped tables.

Each report resolves its fields through the synonym lists, so it works on any
table that has some of them; absent dimensions group as a typed null.  All are
single ``groupBy`` aggregates with map-side partial aggregation.

The market-trends median is exact by default (SQL ``percentile_disc(0.5)``,
computed as a distributed prefix sum, see :mod:`rowmill.operators.quantile`),
so no group is ever buffered in one task.  ``median="approx"`` uses
``percentile_approx`` instead: a mergeable sketch of bounded size, one pass,
rank error below 1/accuracy of the group size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import ACRES, BATH, BEDS_AGG, PRICE, SIZE_AGG, dimension, first_present, lot_bucket, year_of
from rowmill.operators.aggregate import avg_of, avg_of_parts, exact_parts, sum_of, sum_of_parts
from rowmill.operators.quantile import attach, percentile_disc, percentile_from_counts
from rowmill.sinks.scratch import stored

MEDIAN_ACCURACY = 10_000


def market_trends(df: DataFrame, scale: int | None = None, median: str = "exact",
                  median_accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    price, size = first_present(df, PRICE), first_present(df, SIZE_AGG)
    dims = df.select(dimension(df, "city"), dimension(df, "state"), price.alias("__price"), size.alias("__size"))
    p, s = F.col("__price"), F.col("__size")
    if median == "approx":
        return dims.groupBy("city", "state").agg(
            avg_of(p, scale).alias("avg_price"),
            F.percentile_approx(p, 0.5, median_accuracy).alias("median_price"),
            F.count(F.lit(1)).alias("num_properties"),
            avg_of(s, scale).alias("avg_house_size"),
        )
    if median != "exact":
        raise ValueError("median must be 'exact' or 'approx'")
    # averages ship a row a group and task; only (city, state, price) and a count travel for the median.  Its
    # range-partitioned table is one exchange that both of its readers use: nothing is stored
    base = dims.groupBy("city", "state").agg(
        avg_of(p, scale).alias("avg_price"), F.count(F.lit(1)).alias("num_properties"), avg_of(s, scale).alias("avg_house_size"))
    med = percentile_disc(dims, ["city", "state"], p, 0.5, "median_price")
    out = attach(base, med, ["city", "state"], ["median_price"])
    return out.select("city", "state", "avg_price", "median_price", "num_properties", "avg_house_size")


def property_type_size(df: DataFrame, scale: int | None = None) -> DataFrame:
    price = first_present(df, PRICE)
    return df.groupBy(
        first_present(df, BEDS_AGG, "int").alias("bed"), first_present(df, BATH, "int").alias("bath")
    ).agg(
        avg_of(price, scale).alias("avg_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.count(F.lit(1)).alias("num_properties"),
    )


def lot_size_influence(df: DataFrame, scale: int | None = None) -> DataFrame:
    price, size = first_present(df, PRICE), first_present(df, SIZE_AGG)
    return df.groupBy(lot_bucket(first_present(df, ACRES)).alias("lot_bucket")).agg(
        avg_of(price, scale).alias("avg_price"),
        avg_of(size, scale).alias("avg_house_size"),
    )


def broker_performance(df: DataFrame, scale: int | None = None) -> DataFrame:
    price = first_present(df, PRICE)
    return df.groupBy(dimension(df, "brokered_by")).agg(
        F.count(F.lit(1)).alias("num_listings"),
        avg_of(price, scale).alias("avg_price"),
        sum_of(price, scale).alias("total_listing_value"),
    )


def status_analysis(df: DataFrame, scale: int | None = None) -> DataFrame:
    price, size = first_present(df, PRICE), first_present(df, SIZE_AGG)
    return df.groupBy(dimension(df, "status")).agg(
        F.count(F.lit(1)).alias("count"),
        avg_of(price, scale).alias("avg_price"),
        avg_of(size, scale).alias("avg_house_size"),
    )


def time_yearly(df: DataFrame, scale: int | None = None) -> DataFrame:
    """Unparsable or absent dates form the null-year group."""
    price = first_present(df, PRICE)
    return df.groupBy(year_of(df, "prev_sold_date").alias("year")).agg(
        avg_of(price, scale).alias("avg_price"),
        F.count(F.lit(1)).alias("num_transactions"),
    )


def segment_state(df: DataFrame, scale: int | None = None) -> DataFrame:
    """Summary of a routed table: average price and rows per segment and state."""
    price = first_present(df, PRICE)
    return df.groupBy(dimension(df, "segment"), dimension(df, "state")).agg(
        avg_of(price, scale).alias("avg_price"),
        F.count(F.lit(1)).alias("count"),
    )


REPORTS: Mapping[str, Callable[..., DataFrame]] = {
    "market_trends": market_trends,
    "property_type_size": property_type_size,
    "lot_size_influence": lot_size_influence,
    "broker_performance": broker_performance,
    "status_analysis": status_analysis,
    "time_yearly": time_yearly,
}


def run_report(df: DataFrame, name: str, scale: int | None = None) -> DataFrame:
    if name not in REPORTS:
        raise ValueError(f"unknown report {name!r}; known: {sorted(REPORTS)}")
    return REPORTS[name](df, scale=scale)


def run_reports(df: DataFrame, names: Iterable[str] | None = None, scale: int | None = None,
                one_pass: bool = False) -> dict[str, DataFrame]:
    """Plans for the chosen reports (all by default).

    By default each report is its own plan and prunes the scan to the 2-4
    columns it needs.  ``one_pass=True`` computes them together from one scan
    and one shuffle (see :func:`reports_one_pass`): on storage where scans
    dominate it reads each column once instead of once per report.
    """
    for n in names or ():
        if n not in REPORTS:
            raise ValueError(f"unknown report {n!r}; known: {sorted(REPORTS)}")
    if one_pass:
        return reports_one_pass(df, names, scale)
    return {n: run_report(df, n, scale) for n in (names or REPORTS)}


# --- one pass for all reports ------------------------------------------------------------

# --- Fixed values: the reports' groupings and column names.
_CELL = ("city", "state", "__cell")
_DIMS = ("city", "state", "bed", "bath", "lot_bucket", "brokered_by", "status", "year", "__cell")
_SETS = {
    "market_trends": ("city", "state"),
    "property_type_size": ("bed", "bath"),
    "lot_size_influence": ("lot_bucket",),
    "broker_performance": ("brokered_by",),
    "status_analysis": ("status",),
    "time_yearly": ("year",),
}
_OUTPUT = {
    "market_trends": ("city", "state", "avg_price", "median_price", "num_properties", "avg_house_size"),
    "property_type_size": ("bed", "bath", "avg_price", "min_price", "max_price", "num_properties"),
    "lot_size_influence": ("lot_bucket", "avg_price", "avg_house_size"),
    "broker_performance": ("brokered_by", "num_listings", "avg_price", "total_listing_value"),
    "status_analysis": ("status", "count", "avg_price", "avg_house_size"),
    "time_yearly": ("year", "avg_price", "num_transactions"),
}


def _gid(dims: tuple[str, ...]) -> int:
    n = len(_DIMS)
    return sum(1 << (n - 1 - i) for i, c in enumerate(_DIMS) if c not in dims)


def reports_one_pass(df: DataFrame, names: Iterable[str] | None = None, scale: int | None = None) -> dict[str, DataFrame]:
    """All chosen reports from one scan and one shuffle (``GROUPING SETS``).

    Each input row is expanded once per report, and once by (city, state, price)
    for the market-trends median, and partially aggregated before the shuffle.
    The combined result -- one row per group -- is written to the shared scratch
    folder, and every report is read from it.
    """
    names = list(names or REPORTS)
    price, size = first_present(df, PRICE), first_present(df, SIZE_AGG)
    dims = df.select(
        dimension(df, "city"), dimension(df, "state"),
        first_present(df, BEDS_AGG, "int").alias("bed"), first_present(df, BATH, "int").alias("bath"),
        lot_bucket(first_present(df, ACRES)).alias("lot_bucket"),
        dimension(df, "brokered_by"), dimension(df, "status"),
        year_of(df, "prev_sold_date").alias("year"),
        price.alias("__price"), size.alias("__size"), price.alias(_CELL[-1]),
    )
    p, s = F.col("__price"), F.col("__size")
    if scale is None:
        sums = {"avg_price": F.avg(p), "total_listing_value": F.sum(p), "avg_house_size": F.avg(s)}
    else:  # a row is copied for every grouping: its exact values are made before
        dims = dims.select("*", *[c.alias(n) for n, c in {**exact_parts("__p", p, scale), **exact_parts("__s", s, scale)}.items()])
        sums = {"avg_price": avg_of_parts("__p", scale), "total_listing_value": sum_of_parts("__p", scale),
                "avg_house_size": avg_of_parts("__s", scale)}
    sets = [list(_SETS[n]) for n in names] + ([list(_CELL)] if "market_trends" in names else [])
    combined = dims.groupingSets(sets, *_DIMS).agg(
        F.grouping_id().alias("__gid"),
        F.count(F.lit(1)).alias("__rows"),
        F.min(p).alias("min_price"),
        F.max(p).alias("max_price"),
        *[c.alias(n) for n, c in sums.items()],
    )
    combined = stored(combined, "reports")
    out: dict[str, DataFrame] = {}
    for name in names:
        part = combined.filter(F.col("__gid") == F.lit(_gid(_SETS[name])))
        part = part.withColumns({"num_properties": F.col("__rows"), "num_listings": F.col("__rows"),
                                 "count": F.col("__rows"), "num_transactions": F.col("__rows")})
        if name == "market_trends":
            cells = combined.filter((F.col("__gid") == F.lit(_gid(_CELL))) & F.col(_CELL[-1]).isNotNull())
            med = percentile_from_counts(cells, ["city", "state"], _CELL[-1], "__rows", 0.5, "median_price")
            part = attach(part, med, ["city", "state"], ["median_price"])
        out[name] = part.select(*_OUTPUT[name])
    return out
