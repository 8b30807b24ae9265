"""Listing-shaped views derived from the TPC-H-style tables.

The driver's tables have no listing columns, so the listing operators run on
a view built by joins over ``lineitem``, ``part``, ``supplier``, ``nation`` and
``region``.  The SQL text is written in the common subset of Spark SQL and
DuckDB so that both engines build the identical table; the oracle queries
prepend the same text as a CTE.  ``%`` here injects defects (nulls, negative
prices, letter suffixes) into *every* row that qualifies -- nothing is
filtered away.

At scale the view is a star join: ``nation`` (25 rows) and ``region`` (5 rows)
are bounded and broadcast; ``part`` and ``supplier`` grow with the data, so
their strategy is left to Catalyst and AQE (broadcast only when the measured
size is below ``spark.sql.autoBroadcastJoinThreshold``, sort-merge otherwise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

LISTINGS_TEMPLATE = """
select cast(l_orderkey as string)||'-'||cast(l_linenumber as string) as street,
  n_name as city, r_name as state,
  case when l_orderkey%89=0 then cast(l_partkey as string)||'a'
       else cast(10000+l_partkey*37%90000 as string) end as zip_code,
  case when l_orderkey%53=0 then null else s_name end as brokered_by,
  l_returnflag as status,
  case when l_orderkey%97=0 then null when l_orderkey%101=0 then -1.0
       else l_extendedprice*20 end as price,
  p_size%7 as bed,
  cast(l_linenumber as double)/case when l_orderkey%83=0 then 2 else 1 end as bath,
  case when l_orderkey%71=0 then null else l_discount*20 end as acre_lot,
  l_quantity*80 as house_size, cast(l_shipdate as date) as prev_sold_date
from {lineitem} join {part} on l_partkey=p_partkey join {supplier} on l_suppkey=s_suppkey
  join {nation} on s_nationkey=n_nationkey join {region} on n_regionkey=r_regionkey
"""

LISTINGS_DIRTY_TEMPLATE = """
select street, city, state, zip_code, brokered_by, status, price, bed, bath,
       acre_lot, house_size, prev_sold_date from {listings}
union all
select '  '||upper(street)||'.' as street, '  '||city as city, upper(state)||'  ' as state,
       zip_code, brokered_by, status, price+1 as price, bed, bath,
       acre_lot, house_size, prev_sold_date from {listings} where bed = 3
"""

_BASE = ("lineitem", "part", "supplier", "nation", "region")
# the same text with plain table names: what the DuckDB oracle runs
LISTINGS_SQL = LISTINGS_TEMPLATE.format(**{t: t for t in _BASE})
LISTINGS_DIRTY_SQL = LISTINGS_DIRTY_TEMPLATE.format(listings="listings")


def with_listings(sql: str, dirty: bool = False) -> str:
    """Prefix ``sql`` with the fixture views as CTEs (for the DuckDB oracle)."""
    ctes = f"with listings as ({LISTINGS_SQL})"
    if dirty:
        ctes += f", listings_dirty as ({LISTINGS_DIRTY_SQL})"
    return f"{ctes}\n{sql}"


#: Schemas by session and path: a table's footers are read for its schema once, not in a job of their own for every query.
_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    """DataFrames over the parquet tables of ``sf_dir``; the fixed-size dimensions carry a broadcast hint."""
    out = {}
    for name in names:
        df = table(spark, sf_dir, name)
        if name in ("nation", "region"):
            df = F.broadcast(df)  # fixed-size dimension tables: 25 and 5 rows at every scale
        out[name] = df
    return out


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing view.  DataFrames are bound into the SQL text as arguments, so no
    temporary view is registered in the caller's session."""
    return spark.sql(LISTINGS_TEMPLATE, **tables(spark, sf_dir, _BASE))


def listings_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``LISTINGS_DIRTY_TEMPLATE`` from one pass over the joins: a listing that comes twice is
    doubled where it stands, not joined a second time."""
    rows, again = listings(spark, sf_dir), F.col("__again")
    copies = F.when(F.col("bed") == 3, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    changed = {
        "street": F.concat(F.lit("  "), F.upper("street"), F.lit(".")), "city": F.concat(F.lit("  "), F.col("city")),
        "state": F.concat(F.upper("state"), F.lit("  ")), "price": F.col("price") + 1,
    }
    return rows.select("*", F.explode(copies).alias("__again")).select(
        *[F.when(again, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else c for c in rows.columns])
