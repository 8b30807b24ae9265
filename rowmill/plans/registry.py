"""Registered queries: one per operator of the blueprint, each with its DuckDB check.

Every query reads the whole given tables (or a view Spark derives from all of
their rows); nothing is sampled, capped or filtered to make the check cheaper.
A ``limit`` appears only where it is the operator itself (ordered limit, top-k,
invalid-row sample).  Money and size sums use exact decimal arithmetic
(``scale=2``) so that results do not depend on the order of partial sums.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.columns import (
    BEDS_AGG, PRICE, SIZE_AGG, dimension, first_present, lot_bucket, number, parse_date,
)
from rowmill.functions.text import normalize_strings
from rowmill.operators.aggregate import aggregate, top_k
from rowmill.operators.dedup import dedup, dedup_by_join, detect_keys
from rowmill.operators.limit import take_ordered
from rowmill.operators.profile import profile
from rowmill.operators.quality import QualitySpec, duplicate_groups, failing, parse_thresholds, quality_report, quality_summary
from rowmill.operators.quality_state import QualityStore
from rowmill.operators.reports import REPORTS, run_reports, segment_state
from rowmill.operators.sketch import RANK_ERROR, merge_sketches, quantile_of, quantile_sketches, rank_errors
from rowmill.operators.route import Rule, apply_rule_set, route
from rowmill.operators.validate import (
    ValidationSpec, annotate, error_counts, invalid_sample, normalize_zip, split, validation_counts, zip_changes,
)
from rowmill.plans import oracle as O
from rowmill.plans.fixtures import listings, listings_dirty, table
from rowmill.plans.end_to_end import PipelineOptions, key_normalizer, run as run_pipeline, summary_by_segment
from rowmill.plans.publish import publish_tables, publish_version
from rowmill.plans.throughput import measure, timed
from rowmill.sinks.scratch import input_bytes, shared_dir, stored
from rowmill.sinks.writers import write_named, write_report, write_split, write_table
from rowmill.sources.files import RAW, read_csv, read_parquet, read_table, upstream_input
from rowmill.streaming.dedup import dedup_stream, winners
from rowmill.streaming.split import annotate_stream, split_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

SCALE = 2  # prices and sizes are whole cents


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _unique(what: str) -> str:
    """A table prefix of its own: sessions that share a catalog don't overwrite each other's tables."""
    return f"rowmill_{what}_{uuid.uuid4().hex}_"


def _errors_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("validation_errors", F.concat_ws("|", F.col("validation_errors")))


def _lineitem_no_ts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(*O.LINEITEM_NO_TS)


def _csv_copy(df: DataFrame, spark: SparkSession, header: bool = True, sep: str = ",") -> str:
    path = shared_dir(spark, "csv")
    df.write.mode("overwrite").option("header", str(header).lower()).option("sep", sep).csv(path)
    return path


# ---------------------------------------------------------------- sources
_INFERRED = (
    "select cast(l_orderkey as integer) as {0}, cast(l_partkey as integer) as {1}, cast(l_suppkey as integer) as {2}, "
    "l_linenumber as {3}, l_quantity as {4}, l_extendedprice as {5}, l_discount as {6}, l_tax as {7}, "
    "l_returnflag as {8}, l_linestatus as {9} from lineitem"
)


@register("scan_csv", _INFERRED.format(*O.LINEITEM_NO_TS))
def scan_csv(spark, sf):
    return read_csv(spark, _csv_copy(_lineitem_no_ts(spark, sf), spark))


@register("scan_csv_multi", _INFERRED.format(*O.LINEITEM_NO_TS))
def scan_csv_multi(spark, sf):
    li = _lineitem_no_ts(spark, sf)
    returned = _csv_copy(li.filter(F.col("l_returnflag") == "R"), spark)
    others = _csv_copy(li.filter(~F.col("l_returnflag").eqNullSafe("R")), spark)
    return read_csv(spark, [returned, others])


_MIXED = ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")


@register("scan_csv_mixed_headers",
          "select l_orderkey, l_linenumber, l_quantity, l_returnflag, "
          "case when l_returnflag = 'A' then null else l_linestatus end as l_linestatus, "
          "case when l_returnflag = 'N' then l_discount end as l_discount from lineitem")
def scan_csv_mixed_headers(spark, sf):
    """Three folders of CSV files as one table: the columns in another order, one missing, one more."""
    li = table(spark, sf, "lineitem")
    parts = [
        _csv_copy(li.filter("l_returnflag = 'R'").select(*_MIXED), spark),
        _csv_copy(li.filter("l_returnflag = 'A'").select("l_returnflag", "l_quantity", "l_linenumber", "l_orderkey"), spark),
        _csv_copy(li.filter("l_returnflag not in ('R', 'A')").select("l_discount", *reversed(_MIXED)), spark),
    ]
    types = {f.name: f.dataType.simpleString() for f in li.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in (*_MIXED, "l_discount"))
    return read_csv(spark, parts, headers="by_name", schema=schema)


@register("scan_csv_no_header", _INFERRED.format(*[f"_c{i}" for i in range(10)]))
def scan_csv_no_header(spark, sf):
    return read_csv(spark, _csv_copy(_lineitem_no_ts(spark, sf), spark, header=False), header=False)


@register(
    "scan_csv_strings",
    "select cast(l_orderkey as string) as l_orderkey, cast(l_partkey as string) as l_partkey, "
    "cast(l_suppkey as string) as l_suppkey, cast(l_linenumber as string) as l_linenumber, "
    "l_returnflag, l_linestatus from lineitem",
)
def scan_csv_strings(spark, sf):
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    path = _csv_copy(table(spark, sf, "lineitem").select(*cols), spark)
    return read_csv(spark, path, infer_schema=False)


@register("scan_csv_delim", _INFERRED.format(*O.LINEITEM_NO_TS))
def scan_csv_delim(spark, sf):
    return read_csv(spark, _csv_copy(_lineitem_no_ts(spark, sf), spark, sep="|"), delimiter="|")


@register("scan_csv_schema", "select * from lineitem")
def scan_csv_schema(spark, sf):
    li = table(spark, sf, "lineitem")
    return read_csv(spark, _csv_copy(li, spark), schema=li.schema)


@register("scan_parquet", "select * from lineitem")
def scan_parquet(spark, sf):
    return read_table(spark, f"{sf.rstrip('/')}/lineitem.parquet")


# ---------------------------------------------------------------- sinks (K1-K9)
@register("roundtrip_parquet", O.listings_query("select * from listings"))
def roundtrip_parquet(spark, sf):
    paths = write_table(listings(spark, sf), shared_dir(spark, "out"), formats=("parquet",))
    return read_table(spark, paths["parquet"])


@register("roundtrip_csv", O.listings_query("select * from listings"))
def roundtrip_csv(spark, sf):
    df = listings(spark, sf)
    paths = write_table(df, shared_dir(spark, "out"), formats=("csv",))
    return read_csv(spark, paths["csv"], schema=df.schema)


@register("roundtrip_split", O.listings_query(O.annotated_sql()))
def roundtrip_split(spark, sf):
    paths = write_split(annotate(listings(spark, sf)), shared_dir(spark, "split"))
    back = spark.read.parquet(paths["valid"]["parquet"]).unionByName(spark.read.parquet(paths["invalid"]["parquet"]))
    return _errors_as_text(back)


@register("roundtrip_partitioned", O.listings_query("select * from listings"))
def roundtrip_partitioned(spark, sf):
    paths = write_table(listings(spark, sf), shared_dir(spark, "out"), formats=("parquet",), partition_by=["state"])
    return spark.read.parquet(paths["parquet"])


_MARKET = (
    "select city, state, {avg_price} as avg_price, quantile_disc(price, 0.5) as median_price, "
    "count(*) as num_properties, {avg_size} as avg_house_size from listings group by city, state"
).format(avg_price=O.davg("price"), avg_size=O.davg("house_size"))


@register("publish_tables", O.listings_query(_MARKET))
def publish(spark, sf):
    root = shared_dir(spark, "outputs")
    write_table(REPORTS["market_trends"](listings(spark, sf), scale=SCALE), f"{root}/aggregated/market_trends",
                formats=("parquet",))
    (name,) = publish_tables(spark, root, ["market_trends"], location=shared_dir(spark, "tables"), prefix=_unique("report"))
    return spark.table(name)


# ---------------------------------------------------------------- text clean-up
_DOC = "doc_id, {t} as text, {l} as lang, {s} as source, n_chars from documents"


def _doc_sql(fn) -> str:
    return "select " + _DOC.format(t=fn("text"), l=fn("lang"), s=fn("source"))


def _documents(spark, sf):
    return table(spark, sf, "documents")


@register("clean_trim", _doc_sql(lambda c: f"trim({c})"))
def clean_trim(spark, sf):
    return normalize_strings(_documents(spark, sf), trim=True)


@register("clean_lower", _doc_sql(lambda c: f"lower({c})"))
def clean_lower(spark, sf):
    return normalize_strings(_documents(spark, sf), lowercase=True)


@register("clean_spaces", _doc_sql(lambda c: rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"))
def clean_spaces(spark, sf):
    return normalize_strings(_documents(spark, sf), normalize_spaces=True)


@register("clean_punct", _doc_sql(lambda c: rf"regexp_replace({c}, '[^\w\s]', '', 'g')"))
def clean_punct(spark, sf):
    return normalize_strings(_documents(spark, sf), strip_punct=True)


@register("clean_full", _doc_sql(O.norm))
def clean_full(spark, sf):
    return normalize_strings(_documents(spark, sf), trim=True, lowercase=True, normalize_spaces=True, strip_punct=True)


# ---------------------------------------------------------------- derived columns
_SYN_SRC = (
    "select street, case when bed = 0 then null else price end as list_price, price as sold_price, "
    "house_size as sqft_living, cast(bed as string) as bedrooms from listings"
)


@register(
    "synonym_coalesce",
    O.listings_query(
        "select street, coalesce(list_price, sold_price) as price_value, sqft_living as size_value, "
        "cast(bedrooms as integer) as beds_value from syn",
        extra_ctes=f"syn as ({_SYN_SRC})",
    ),
)
def synonym_coalesce(spark, sf):
    L = listings(spark, sf)
    syn = L.select(
        "street",
        F.when(F.col("bed") == 0, F.lit(None)).otherwise(F.col("price")).alias("list_price"),
        F.col("price").alias("sold_price"),
        F.col("house_size").alias("sqft_living"),
        F.col("bed").cast("string").alias("bedrooms"),
    )
    return syn.select(
        "street",
        first_present(syn, PRICE).alias("price_value"),
        first_present(syn, SIZE_AGG).alias("size_value"),
        first_present(syn, BEDS_AGG, "int").alias("beds_value"),
    )


@register(
    "coerce_numeric",
    O.listings_query(
        "select street, try_cast(zip_code as double) as zip_num, try_cast(zip_code as integer) as zip_int, "
        "try_cast(street as double) as street_num, cast(trunc(bath) as integer) as bath_int from listings"
    ),
)
def coerce_numeric(spark, sf):
    L = listings(spark, sf)
    return L.select(
        "street",
        number("zip_code").alias("zip_num"),
        number("zip_code", "int").alias("zip_int"),
        number("street").alias("street_num"),
        number("bath", "int").alias("bath_int"),
    )


@register("dim_or_null", O.listings_query("select street, brokered_by, cast(null as string) as county from listings"))
def dim_or_null(spark, sf):
    L = listings(spark, sf)
    return L.select("street", dimension(L, "brokered_by"), dimension(L, "county"))


DATES_TEMPLATE = """
select l_orderkey, l_linenumber, case l_orderkey % 5
  when 0 then cast(year(d) as string)||'-'||lpad(cast(month(d) as string), 2, '0')||'-'||lpad(cast(day(d) as string), 2, '0')
  when 1 then lpad(cast(month(d) as string), 2, '0')||'/'||lpad(cast(day(d) as string), 2, '0')||'/'||cast(year(d) as string)
  when 2 then cast(month(d) as string)||'/'||cast(day(d) as string)||'/'||cast(year(d) as string)
  when 3 then cast(year(d) as string)||'/'||lpad(cast(month(d) as string), 2, '0')||'/'||lpad(cast(day(d) as string), 2, '0')
  else 'junk' end as d_text
from (select l_orderkey, l_linenumber, cast(l_shipdate as date) as d from {lineitem}) x
"""
DATES_SQL = DATES_TEMPLATE.format(lineitem="lineitem")


@register(
    "parse_dates",
    f"with dates as ({DATES_SQL}), p as (select *, coalesce(try_strptime(d_text, '%Y-%m-%d'), "
    "try_strptime(d_text, '%m/%d/%Y'), try_strptime(d_text, '%-m/%-d/%Y'), try_strptime(d_text, '%Y/%m/%d'))::date "
    "as parsed from dates) select l_orderkey, l_linenumber, d_text, parsed, cast(year(parsed) as integer) as year from p",
)
def parse_dates(spark, sf):
    d = spark.sql(DATES_TEMPLATE, lineitem=table(spark, sf, "lineitem"))
    parsed = parse_date(F.col("d_text"))
    return d.select("l_orderkey", "l_linenumber", "d_text", parsed.alias("parsed"), F.year(parsed).alias("year"))


@register("bucket_lot", O.listings_query(f"select street, acre_lot, {O.LOT_BUCKET} as lot_bucket from listings"))
def bucket_lot(spark, sf):
    return listings(spark, sf).select("street", "acre_lot", lot_bucket(F.col("acre_lot")).alias("lot_bucket"))


@register("route_basic", O.listings_query(f"select *, {O.ROUTE_BASIC} as segment from listings"))
def route_basic(spark, sf):
    return apply_rule_set(listings(spark, sf), "preset_basic")


ORDER_RULES = (
    Rule("urgent", "o_orderpriority = '1-URGENT'"),
    Rule("large", lambda df: F.col("o_totalprice") > F.lit(300000)),
    Rule("failed", lambda df: F.col("o_orderstatus") == F.lit("F")),
)


@register(
    "route_custom",
    "select *, case when o_orderpriority = '1-URGENT' "
    "then 'urgent' when o_totalprice > 300000 then 'large' when o_orderstatus = 'F' then 'failed' "
    "else 'normal' end as order_class from orders",
)
def route_custom(spark, sf):
    return route(table(spark, sf, "orders"), ORDER_RULES, default="normal", column="order_class")


_ZIPN = r"lpad(regexp_replace(zip_code, '[^0-9]', '', 'g'), 5, '0')"


@register("zip_normalize", O.listings_query(f"select street, {_ZIPN} as zip_code from listings"))
def zip_normalize(spark, sf):
    return normalize_zip(listings(spark, sf), "zip_code", 5, numeric=True, truncate=True).select("street", "zip_code")


@register("zip_changed_count",
          O.listings_query(f"select count(*) filter (where zip_code <> {_ZIPN}) as changed_rows from listings"))
def zip_changed_count(spark, sf):
    return zip_changes(listings(spark, sf), "zip_code", 5, numeric=True, truncate=True)


# ---------------------------------------------------------------- filters, limits, inspection (F1-F8)
@register("split_valid", O.listings_query(f"select * from ({O.annotated_sql()}) v where is_valid"))
def split_valid(spark, sf):
    return _errors_as_text(split(annotate(listings(spark, sf)))[0])


@register("split_invalid", O.listings_query(f"select * from ({O.annotated_sql()}) v where not is_valid"))
def split_invalid(spark, sf):
    return _errors_as_text(split(annotate(listings(spark, sf)))[1])


@register(
    "duplicate_groups",
    O.listings_query("select city, state, zip_code, count(*) as count from listings "
                     "group by city, state, zip_code having count(*) > 1"),
)
def dup_groups(spark, sf):
    return duplicate_groups(listings(spark, sf), ["city", "state", "zip_code"])


@register("limit_ordered",
          O.listings_query(f"select * from listings order by {O.order_all(O.LISTING_COLUMNS)} limit 1000"))
def limit_ordered(spark, sf):
    return take_ordered(listings(spark, sf), 1000)


_HALF = "(select count(*) // 2 from listings)"


@register("limit_ordered_half", O.listings_query(
    f"select * exclude (rn) from (select *, row_number() over (order by {O.order_all(O.LISTING_COLUMNS)}) as rn "
    f"from listings) t where rn <= {_HALF}"))
def limit_ordered_half(spark, sf):
    """The first half of the table in the order of all columns: a limit far beyond what one task should hold."""
    rows = listings(spark, sf)
    return take_ordered(rows, rows.count() // 2, small=0)


@register("row_id", "select *, row_number() over () - 1 as row_id from lineitem")
def row_id(spark, sf):
    """Every row with its number, by file and place in the file."""
    return read_parquet(spark, f"{sf.rstrip('/')}/lineitem.parquet", row_id="row_id")


@register("dedup_first_row",
          "with numbered as (select *, row_number() over () as place from lineitem) select * exclude (place, rn) from "
          "(select *, row_number() over (partition by l_partkey, l_suppkey order by place) as rn from numbered) t where rn = 1")
def dedup_first_row(spark, sf):
    """The first physical row of every key, all columns."""
    return dedup(read_parquet(spark, f"{sf.rstrip('/')}/lineitem.parquet"), ["l_partkey", "l_suppkey"], order_by="physical")


@register(
    "top_states",
    O.listings_query(f"select state, city, avg_price, num_properties from ({_MARKET}) m "
                     "order by avg_price desc nulls last, state, city limit 5"),
)
def top_states(spark, sf):
    m = REPORTS["market_trends"](listings(spark, sf), scale=SCALE)
    return top_k(m, "avg_price", 5, tie_breakers=["state", "city"]).select("state", "city", "avg_price", "num_properties")


_TYPES = ("string",) * 6 + ("double", "int", "double", "double", "double", "date")
_PROFILE = " union all ".join(
    f"select {i} as position, '{c}' as \"column\", '{t}' as type, count(*) as rows, "
    f"count(*) filter (where {c} is null) as nulls from listings"
    for i, (c, t) in enumerate(zip(O.LISTING_COLUMNS, _TYPES))
)


@register("profile_table", O.listings_query(_PROFILE))
def profile_table(spark, sf):
    return profile(listings(spark, sf))


@register(
    "invalid_sample",
    O.listings_query(
        f"select validation_errors, {', '.join(O.LISTING_COLUMNS)} from ({O.annotated_sql()}) v where not is_valid "
        f"order by {O.order_all(O.LISTING_COLUMNS)} limit 5"
    ),
)
def invalid_rows_sample(spark, sf):
    return _errors_as_text(invalid_sample(annotate(listings(spark, sf)), 5))


# ---------------------------------------------------------------- dedup
ADDRESS = ["street", "city", "state", "zip_code"]


@register("dedup_first", O.listings_query(O.dedup_sql("listings_dirty", ADDRESS, normalized=True), dirty=True))
def dedup_first(spark, sf):
    return dedup(listings_dirty(spark, sf), ADDRESS, match_on=key_normalizer)


@register("dedup_by_join", O.listings_query(O.dedup_sql("listings", ["city", "state", "zip_code"])))
def dedup_join(spark, sf):
    return dedup_by_join(listings(spark, sf), ["city", "state", "zip_code"])


_KEYS3 = ("city", "state", "zip_code")
_NORMALIZED = ", ".join(f"{O.norm(c)} as {c}" if c in _KEYS3 else c for c in O.LISTING_COLUMNS)


@register("dedup_by_join_normalized", O.listings_query(
    O.dedup_sql("normalized", _KEYS3), dirty=True, extra_ctes=f"normalized as (select {_NORMALIZED} from listings_dirty)"))
def dedup_join_dirty(spark, sf):
    clean = normalize_strings(listings_dirty(spark, sf), trim=True, lowercase=True, normalize_spaces=True, strip_punct=True,
                              columns=_KEYS3)
    return dedup_by_join(clean, _KEYS3)


_ZIPPED = {"street": "address", "zip_code": "zip"}


@register("dedup_auto_keys_zip", O.listings_query(
    O.dedup_sql("named", ["address", "city", "state", "zip"], cols=[_ZIPPED.get(c, c) for c in O.LISTING_COLUMNS]), dirty=True,
    extra_ctes="named as (select " + ", ".join(f"{c} as {_ZIPPED.get(c, c)}" for c in O.LISTING_COLUMNS) + " from listings_dirty)"))
def dedup_auto_keys_zip(spark, sf):
    df = listings_dirty(spark, sf).withColumnsRenamed(_ZIPPED)
    return dedup(df, detect_keys(df))


@register("dedup_no_keys", O.listings_query("select * from listings_dirty", dirty=True))
def dedup_no_keys(spark, sf):
    return dedup(listings_dirty(spark, sf), [], on_missing_keys="skip")


@register("dedup_null_drop", O.listings_query(O.dedup_sql("listings", ["brokered_by", "zip_code"])))
def dedup_null_drop(spark, sf):
    return dedup(listings(spark, sf), ["brokered_by", "zip_code"], null_keys="drop")


@register("dedup_null_group", O.listings_query(O.dedup_sql("listings", ["brokered_by", "zip_code"], null_keys="group")))
def dedup_null_group(spark, sf):
    return dedup(listings(spark, sf), ["brokered_by", "zip_code"], null_keys="group")


@register("dedup_null_keep", O.listings_query(O.dedup_sql("listings", ["brokered_by", "zip_code"], null_keys="keep")))
def dedup_null_keep(spark, sf):
    return dedup(listings(spark, sf), ["brokered_by", "zip_code"], null_keys="keep")


@register("dedup_null_group_by_join",
          O.listings_query(O.dedup_sql("listings", ["brokered_by", "zip_code"], null_keys="group")))
def dedup_null_group_join(spark, sf):
    return dedup_by_join(listings(spark, sf), ["brokered_by", "zip_code"], null_keys="group")


@register("dedup_auto_keys", O.listings_query(O.dedup_sql("listings_dirty", ADDRESS), dirty=True))
def dedup_auto_keys(spark, sf):
    df = listings_dirty(spark, sf)
    return dedup(df, detect_keys(df))


@register(
    "dedup_text",
    "select doc_id, text, lang, source, n_chars from (select *, row_number() over (partition by text "
    "order by doc_id asc nulls first, lang asc nulls first, source asc nulls first, n_chars asc nulls first) rn "
    "from documents where text is not null) d where rn = 1",
)
def dedup_text(spark, sf):
    return dedup(_documents(spark, sf), ["text"])


# ---------------------------------------------------------------- aggregation
_ROUTED = f"routed as (select *, {O.ROUTE_BASIC} as segment from listings)"


@register(
    "agg_generic",
    O.listings_query(
        f"select segment, state, {O.dsum('price')} as price_sum, min(price) as price_min, max(price) as price_max, "
        f"{O.davg('price')} as price_avg, {O.davg('house_size')} as house_size_avg from routed group by segment, state",
        extra_ctes=_ROUTED,
    ),
)
def agg_generic(spark, sf):
    routed = apply_rule_set(listings(spark, sf), "preset_basic")
    return aggregate(routed, ["segment", "state"], "price:sum,price:min,price:max,price:avg,house_size:avg", scale=SCALE)


@register(
    "agg_sum",
    f"select l_returnflag, l_linestatus, {O.dsum('l_quantity')} as l_quantity_sum, "
    f"{O.dsum('l_extendedprice')} as l_extendedprice_sum from lineitem group by l_returnflag, l_linestatus",
)
def agg_sum(spark, sf):
    return aggregate(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
                     "l_quantity:sum,l_extendedprice:sum", scale=SCALE)


@register("agg_min", "select l_suppkey, min(l_extendedprice) as l_extendedprice_min, "
          "min(l_discount) as l_discount_min from lineitem group by l_suppkey")
def agg_min(spark, sf):
    return aggregate(table(spark, sf, "lineitem"), ["l_suppkey"], "l_extendedprice:min,l_discount:min")


@register("agg_max", "select o_orderpriority, o_orderstatus, max(o_totalprice) as o_totalprice_max "
          "from orders group by o_orderpriority, o_orderstatus")
def agg_max(spark, sf):
    return aggregate(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], "o_totalprice:max")


@register(
    "agg_avg",
    f"select l_returnflag, {O.davg('l_quantity')} as l_quantity_avg, {O.davg('l_discount')} as l_discount_avg "
    "from lineitem group by l_returnflag",
)
def agg_avg(spark, sf):
    return aggregate(table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity:avg,l_discount:mean", scale=SCALE)


@register(
    "agg_count",
    O.listings_query(
        "select state, count(try_cast(zip_code as double)) as zip_code_count, count(price) as price_count, "
        "count(try_cast(brokered_by as double)) as brokered_by_count, count(cast(null as double)) as county_count "
        "from listings group by state"
    ),
)
def agg_count(spark, sf):
    return aggregate(listings(spark, sf), ["state"], "zip_code:count,price:count,brokered_by:count,county:count")


@register("agg_median", O.listings_query(
    "select city, state, quantile_disc(price, 0.5) as median_price from listings group by city, state"))
def agg_median(spark, sf):
    return REPORTS["market_trends"](listings(spark, sf), scale=SCALE).select("city", "state", "median_price")


@register(
    "validation_counts",
    O.listings_query(f"select count(*) as total, count(*) filter (where is_valid) as valid, "
                     f"count(*) filter (where not is_valid) as invalid from ({O.annotated_sql()}) v"),
)
def counts(spark, sf):
    return validation_counts(annotate(listings(spark, sf)))


# ---------------------------------------------------------------- named reports
@register("report_market_trends", O.listings_query(_MARKET))
def report_market_trends(spark, sf):
    return REPORTS["market_trends"](listings(spark, sf), scale=SCALE)


@register(
    "report_property_type_size",
    O.listings_query(
        f"select cast(bed as integer) as bed, cast(trunc(bath) as integer) as bath, {O.davg('price')} as avg_price, "
        "min(price) as min_price, max(price) as max_price, count(*) as num_properties from listings "
        "group by cast(bed as integer), cast(trunc(bath) as integer)"
    ),
)
def report_property_type_size(spark, sf):
    return REPORTS["property_type_size"](listings(spark, sf), scale=SCALE)


@register(
    "report_lot_size",
    O.listings_query(f"select {O.LOT_BUCKET} as lot_bucket, {O.davg('price')} as avg_price, "
                     f"{O.davg('house_size')} as avg_house_size from listings group by 1"),
)
def report_lot_size(spark, sf):
    return REPORTS["lot_size_influence"](listings(spark, sf), scale=SCALE)


@register(
    "report_broker",
    O.listings_query(f"select brokered_by, count(*) as num_listings, {O.davg('price')} as avg_price, "
                     f"{O.dsum('price')} as total_listing_value from listings group by brokered_by"),
)
def report_broker(spark, sf):
    return REPORTS["broker_performance"](listings(spark, sf), scale=SCALE)


@register(
    "report_status",
    O.listings_query(f"select status, count(*) as count, {O.davg('price')} as avg_price, "
                     f"{O.davg('house_size')} as avg_house_size from listings group by status"),
)
def report_status(spark, sf):
    return REPORTS["status_analysis"](listings(spark, sf), scale=SCALE)


@register(
    "report_time_yearly",
    O.listings_query(f"select cast(year(prev_sold_date) as integer) as year, {O.davg('price')} as avg_price, "
                     "count(*) as num_transactions from listings group by 1"),
)
def report_time_yearly(spark, sf):
    return REPORTS["time_yearly"](listings(spark, sf), scale=SCALE)


@register(
    "report_segment_state",
    O.listings_query(f"select segment, state, {O.davg('price')} as avg_price, count(*) as count "
                     "from routed group by segment, state", extra_ctes=_ROUTED),
)
def report_segment_state(spark, sf):
    return segment_state(apply_rule_set(listings(spark, sf), "preset_basic"), scale=SCALE)


# ---------------------------------------------------------------- row validation
def _validated(spark, sf, **spec) -> DataFrame:
    return _errors_as_text(annotate(listings(spark, sf), ValidationSpec(**spec)))


_NONE = dict(required=(), range_column=None, zip_column=None, nonneg=(), integers=())


def _vq(**spec) -> str:
    return O.listings_query(O.annotated_sql(**{**_NONE, **spec}))


@register("validate_missing_col", _vq(required=("street", "lot_id")))
def validate_missing_col(spark, sf):
    return _validated(spark, sf, **{**_NONE, "required": ("street", "lot_id")})


@register("validate_required", _vq(required=("street", "city", "state", "zip_code", "price", "brokered_by")))
def validate_required(spark, sf):
    return _validated(spark, sf, **{**_NONE, "required": ("street", "city", "state", "zip_code", "price", "brokered_by")})


@register("validate_range", _vq(range_column="price", min_value=0.0, max_value=2000000.0))
def validate_range(spark, sf):
    return _validated(spark, sf, **{**_NONE, "range_column": "price", "min_value": 0.0, "max_value": 2000000.0})


@register("validate_nonneg", _vq(nonneg=("price", "house_size", "acre_lot", "lot_depth")))
def validate_nonneg(spark, sf):
    return _validated(spark, sf, **{**_NONE, "nonneg": ("price", "house_size", "acre_lot", "lot_depth")})


@register("validate_integer", _vq(integers=("bed", "bath", "zip_code", "street")))
def validate_integer(spark, sf):
    return _validated(spark, sf, **{**_NONE, "integers": ("bed", "bath", "zip_code", "street")})


@register("validate_zip", _vq(zip_column="zip_code", zip_length=5, zip_numeric=True))
def validate_zip(spark, sf):
    return _validated(spark, sf, **{**_NONE, "zip_column": "zip_code", "zip_length": 5, "zip_numeric": True})


@register("validate_coercion", _vq(numeric=("zip_code", "street", "price", "county")))
def validate_coercion(spark, sf):
    return _validated(spark, sf, **{**_NONE, "numeric": ("zip_code", "street", "price", "county")})


_FULL = dict(max_value=2000000.0, zip_numeric=True)


@register("validate_all", O.listings_query(O.annotated_sql(**_FULL)))
def validate_all(spark, sf):
    return _validated(spark, sf, **_FULL)


@register(
    "validation_error_counts",
    O.listings_query(
        f"select error, count(*) as rows from (select unnest(string_split(validation_errors, '|')) as error "
        f"from ({O.annotated_sql(**_FULL)}) v where validation_errors <> '') e group by error"
    ),
)
def validation_error_counts(spark, sf):
    return error_counts(annotate(listings(spark, sf), ValidationSpec(**_FULL)))


# ---------------------------------------------------------------- dataset quality (Q1-Q9)
@register("quality_report", O.quality_sql())
def quality(spark, sf):
    return quality_report(listings(spark, sf))


@register("quality_missing_col", O.quality_sql(required=("street", "lot_id"), unique_keys=(), minimum={},
                                               max_null_fraction={}))
def quality_missing_col(spark, sf):
    spec = QualitySpec(required=("street", "lot_id"), unique_keys=(), minimum={}, max_null_fraction={})
    return quality_report(listings(spark, sf), spec)


@register("quality_required", O.quality_sql(unique_keys=(), minimum={}, max_null_fraction={}))
def quality_required(spark, sf):
    return quality_report(listings(spark, sf), QualitySpec(unique_keys=(), minimum={}, max_null_fraction={}))


_NULLS = {"status": 0.2, "brokered_by": 0.01, "acre_lot": 0.5, "county": 0.1}


@register("quality_null_rate", O.quality_sql(required=(), unique_keys=(), minimum={}, max_null_fraction=_NULLS))
def quality_null_rate(spark, sf):
    spec = QualitySpec(required=(), unique_keys=(), minimum={}, max_null_fraction=_NULLS)
    return quality_report(listings(spark, sf), spec)


_MINS = {"price": 0.0, "house_size": 100.0, "acre_lot": 0.0}


@register("quality_min", O.quality_sql(required=(), unique_keys=(), minimum=_MINS, max_null_fraction={}))
def quality_min(spark, sf):
    spec = QualitySpec(required=(), unique_keys=(), minimum=_MINS, max_null_fraction={})
    return quality_report(listings(spark, sf), spec)


_MAXS = {"price": 2000000.0, "bath": 6.0}


@register("quality_max", O.quality_sql(required=(), unique_keys=(), minimum={}, maximum=_MAXS, max_null_fraction={}))
def quality_max(spark, sf):
    spec = QualitySpec(required=(), unique_keys=(), minimum={}, maximum=_MAXS, max_null_fraction={})
    return quality_report(listings(spark, sf), spec)


@register("quality_unique", O.quality_sql(required=(), unique_keys=("city", "state", "zip_code"), minimum={},
                                          max_null_fraction={}))
def quality_unique(spark, sf):
    spec = QualitySpec(required=(), unique_keys=("city", "state", "zip_code"), minimum={}, max_null_fraction={})
    return quality_report(listings(spark, sf), spec)


@register("quality_summary", O.quality_sql(then=(
    "select max(total_rows) as total_rows, count(*) filter (where status = 'pass') as passed, "
    "count(*) filter (where status = 'fail') as failed from report")))
def quality_summary_q(spark, sf):
    return quality_summary(quality_report(listings(spark, sf)))


@register("quality_failing", O.quality_sql(then="select * from report where status = 'fail'"))
def quality_failing(spark, sf):
    return failing(quality_report(listings(spark, sf)))


# ---------------------------------------------------------------- throughput
def _throughput(spark, sf):
    return measure(spark, listings(spark, sf), sizes=(-1,), handoff="write")


@register(
    "throughput_records",
    O.listings_query(
        "select 'all' as size, stage, records from (select 'read' as stage, count(*) as records from listings "
        "union all select 'dedup', count(*) from d union all select 'route', count(*) from d "
        "union all select 'aggregate', count(*) from (select distinct segment, state from r) g) t",
        extra_ctes=f"d as ({O.dedup_sql('listings', ADDRESS)}), r as (select *, {O.ROUTE_BASIC} as segment from d)",
    ),
)
def throughput_records(spark, sf):
    return _throughput(spark, sf).select("size", "stage", "records")


@register("throughput")
def throughput(spark, sf):
    return _throughput(spark, sf)


# ---------------------------------------------------------------- end to end
_TRIMMED = (
    "trimmed as (select trim(street) as street, trim(city) as city, trim(state) as state, trim(zip_code) as zip_code, "
    "trim(brokered_by) as brokered_by, trim(status) as status, price, bed, bath, acre_lot, house_size, prev_sold_date "
    "from listings_dirty)"
)
_E2E = (
    f"{_TRIMMED}, deduped as ({O.dedup_sql('trimmed', ADDRESS, normalized=True)}), "
    f"routed as (select *, {O.ROUTE_BASIC} as segment from deduped), "
    f"annotated as (select *, {O.errors_sql()} as errs from routed)"
)


@register(
    "end_to_end",
    O.listings_query(
        "select segment, state, count(*) filter (where errs = '') as valid_rows, "
        "count(*) filter (where errs <> '') as invalid_rows, "
        "cast(sum(case when errs = '' then cast(price as decimal(38,2)) end) as double) "
        "/ nullif(count(case when errs = '' then price end), 0) as avg_valid_price "
        "from annotated group by segment, state",
        dirty=True,
        extra_ctes=_E2E,
    ),
)
def end_to_end(spark, sf):
    return summary_by_segment(listings_dirty(spark, sf), PipelineOptions(keys=ADDRESS, scale=SCALE))


def _e2e_run(spark, sf):
    return run_pipeline(listings_dirty(spark, sf), PipelineOptions(keys=ADDRESS, scale=SCALE, one_pass=True))


_VALID = f"{_E2E}, v as (select * exclude (errs), errs as validation_errors from annotated where errs = '')"


@register("end_to_end_split", O.listings_query(
    "select * exclude (errs), errs as validation_errors, errs = '' as is_valid from annotated", dirty=True, extra_ctes=_E2E))
def end_to_end_split(spark, sf):
    """The whole run; its split outputs, written and read back."""
    paths = write_split(_e2e_run(spark, sf)["annotated"], shared_dir(spark, "validated"), formats=("parquet",))
    return _errors_as_text(spark.read.parquet(*(paths[side]["parquet"] for side in ("valid", "invalid"))))


@register("end_to_end_reports", O.listings_query(
    f"select 'broker_performance' as report, brokered_by as name, count(*) as rows, {O.davg('price')} as avg_price from v group by brokered_by "
    f"union all select 'status_analysis', status, count(*), {O.davg('price')} from v group by status "
    f"union all select 'market_trends', state || ' ' || city, count(*), {O.davg('price')} from v group by state, city",
    dirty=True, extra_ctes=_VALID))
def end_to_end_reports(spark, sf):
    """The whole run; three of its reports, written to a folder each and read back."""
    out = _e2e_run(spark, sf)
    names = {"broker_performance": ("brokered_by", "num_listings"), "status_analysis": ("status", "count"),
             "market_trends": (F.concat_ws(" ", "state", "city"), "num_properties")}
    paths = write_named({n: out[n] for n in names}, shared_dir(spark, "aggregated"), formats=("parquet",))
    parts = [
        spark.read.parquet(paths[n]["parquet"]).select(
            F.lit(n).alias("report"), (F.col(k) if isinstance(k, str) else k).alias("name"), F.col(c).alias("rows"), "avg_price")
        for n, (k, c) in names.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("quality_written", O.quality_sql())
def quality_written(spark, sf):
    """The quality report as its sink writes it, read back."""
    report = quality_report(listings(spark, sf))
    return spark.read.schema(report.schema).json(write_report(report, shared_dir(spark, "quality"))["json"])


@register(
    "throughput_written",
    O.listings_query(
        "select '1000' as size, stage, records from (select 'read' as stage, count(*) as records from first1000 "
        "union all select 'dedup', count(*) from d union all select 'route', count(*) from d "
        "union all select 'aggregate', count(*) from (select distinct segment, state from r) g) t",
        extra_ctes=f"first1000 as (select * from listings order by street limit 1000), "
                   f"d as ({O.dedup_sql('first1000', ADDRESS)}), r as (select *, {O.ROUTE_BASIC} as segment from d)",
    ),
)
def throughput_written(spark, sf):
    """Sizes with an order, and the metrics table as its sink writes it, read back."""
    m = measure(spark, listings(spark, sf), sizes=(1000,), handoff="write", order_by=["street"])
    back = spark.read.schema(m.schema).json(write_report(m, shared_dir(spark, "metrics"))["json"])
    return back.select("size", "stage", "records")


# ---------------------------------------------------------------- streaming (row-wise operators on a stream)
@register(
    "stream_split",
    O.listings_query(
        f"select * exclude (segment, validation_errors, is_valid), segment, validation_errors, is_valid "
        f"from ({O.annotated_sql(source='routed')}) v",
        extra_ctes=_ROUTED,
    ),
)
def stream_split(spark, sf):
    src = shared_dir(spark, "stream-source")
    base = listings(spark, sf)
    base.write.mode("overwrite").parquet(src)
    out = shared_dir(spark, "stream-out")
    q = split_stream(annotate_stream(spark, src, base.schema, max_files_per_trigger=2), out)
    q.awaitTermination()
    back = spark.read.parquet(f"{out}/valid").unionByName(spark.read.parquet(f"{out}/invalid"))
    return _errors_as_text(back.drop("batch"))


# ---------------------------------------------------------------- the same operators on other tables
@register(
    "dedup_events_latest",
    "select event_id, ts, user_id, event_type, value, props from (select *, row_number() over (partition by "
    "user_id, event_type order by ts desc nulls last, event_id asc nulls first) as rn from events "
    "where user_id is not null and event_type is not null) e where rn = 1",
)
def dedup_events_latest(spark, sf):
    return dedup(table(spark, sf, "events"), ["user_id", "event_type"], order_by=["-ts", "event_id"])


@register(
    "agg_events",
    f"select event_type, {O.dsum('value')} as value_sum, {O.davg('value')} as value_avg, min(value) as value_min, "
    "max(value) as value_max, count(value) as value_count from events group by event_type",
)
def agg_events(spark, sf):
    return aggregate(table(spark, sf, "events"), ["event_type"],
                     "value:sum,value:avg,value:min,value:max,value:count", scale=SCALE)


EVENT_RULES = (
    Rule("high_value_purchase", "event_type = 'purchase' and value > 100"),
    Rule("failure", "event_type = 'error'"),
    Rule("engaged", "event_type in ('click', 'view') and value >= 50"),
)


@register(
    "route_events",
    "select *, case when event_type = 'purchase' and value > 100 then 'high_value_purchase' "
    "when event_type = 'error' then 'failure' when event_type in ('click', 'view') and value >= 50 then 'engaged' "
    "else 'other' end as event_class from events",
)
def route_events(spark, sf):
    return route(table(spark, sf, "events"), EVENT_RULES, default="other", column="event_class")


_ORDERS_Q = dict(
    required=("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"),
    unique_keys=("o_orderkey",),
    minimum={"o_totalprice": 0.0},
    maximum={"o_totalprice": 450000.0},
    max_null_fraction={"o_orderpriority": 0.0},
)
_ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@register("quality_orders", O.quality_sql(source="orders", present=_ORDER_COLS, **_ORDERS_Q))
def quality_orders(spark, sf):
    return quality_report(table(spark, sf, "orders"), QualitySpec(**_ORDERS_Q))


_CUSTOMER_V = dict(
    required=("c_name", "c_mktsegment", "c_phone"),
    range_column="c_acctbal", min_value=0.0, max_value=9000.0,
    zip_column=None, nonneg=("c_acctbal",), integers=("c_nationkey", "c_name"), numeric=("c_mktsegment",),
)
_CUSTOMER_COLS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register(
    "validate_customer",
    O.annotated_sql(source="customer", present=_CUSTOMER_COLS, strings=("c_name", "c_mktsegment"), **_CUSTOMER_V),
)
def validate_customer(spark, sf):
    return _errors_as_text(annotate(table(spark, sf, "customer"), ValidationSpec(**_CUSTOMER_V)))


_ORDER_TYPES = ("bigint", "bigint", "string", "double", "timestamp_ntz", "string")


@register(
    "profile_orders",
    " union all ".join(
        f"select {i} as position, '{c}' as \"column\", '{t}' as type, count(*) as rows, "
        f"count(*) filter (where {c} is null) as nulls from orders"
        for i, (c, t) in enumerate(zip(_ORDER_COLS, _ORDER_TYPES))
    ),
)
def profile_orders(spark, sf):
    return profile(table(spark, sf, "orders"))


@register(
    "clean_conversations",
    "select conv_id, turn, {r} as role, {t} as text from conversations".format(
        r=r"regexp_replace(trim(regexp_replace(lower(trim(role)), '\s+', ' ', 'g')), '[^\p{L}\p{N}_\s]', '', 'g')",
        t=r"regexp_replace(trim(regexp_replace(lower(trim(text)), '\s+', ' ', 'g')), '[^\p{L}\p{N}_\s]', '', 'g')",
    ),
)
def clean_conversations(spark, sf):
    return normalize_strings(table(spark, sf, "conversations"), trim=True, lowercase=True, normalize_spaces=True,
                             strip_punct=True, unicode=True)


@register(
    "duplicate_groups_lineitem",
    "select l_orderkey, l_linenumber, count(*) as count from lineitem group by l_orderkey, l_linenumber "
    "having count(*) > 1",
)
def duplicate_groups_lineitem(spark, sf):
    return duplicate_groups(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_LI_Q = dict(required=("l_orderkey", "l_returnflag"), unique_keys=("l_orderkey", "l_linenumber"),
             minimum={"l_quantity": 1.0, "l_discount": 0.0}, maximum={"l_discount": 0.1}, max_null_fraction={})


@register("quality_lineitem", O.quality_sql(source="lineitem", present=O.LINEITEM_NO_TS, **_LI_Q))
def quality_lineitem(spark, sf):
    return quality_report(table(spark, sf, "lineitem"), QualitySpec(**_LI_Q))


@register("dedup_physical", O.listings_query(
    "select distinct street, city, state, zip_code from listings where street is not null and city is not null "
    "and state is not null and zip_code is not null"))
def dedup_physical(spark, sf):
    # first row per key in scan order (P9).  Which duplicate wins depends on the physical order,
    # so only the key columns are returned: that part of the result is order-independent.
    return dedup(listings(spark, sf), ADDRESS, order_by="physical").select(*ADDRESS)


@register(
    "top_states_sql",
    O.listings_query(f"select state, avg_price, num_properties from ({_MARKET}) m "
                     "order by avg_price desc nulls last, state, city limit 5"),
)
def top_states_sql(spark, sf):
    # F6 as the original runs it: SQL over the published report table
    root = shared_dir(spark, "outputs")
    write_table(REPORTS["market_trends"](listings(spark, sf), scale=SCALE), f"{root}/aggregated/market_trends",
                formats=("parquet",))
    (name,) = publish_tables(spark, root, ["market_trends"], location=shared_dir(spark, "tables"), prefix=_unique("top"))
    return spark.sql(f"select state, avg_price, num_properties from {name} "
                     "order by avg_price desc nulls last, state, city limit 5")


# ---------------------------------------------------------------- all reports in one pass (R8 option)
def _one_pass(spark, sf, name):
    return run_reports(listings(spark, sf), scale=SCALE, one_pass=True)[name]


@register("reports_one_pass_market_trends", O.listings_query(_MARKET))
def reports_one_pass_market_trends(spark, sf):
    return _one_pass(spark, sf, "market_trends")


@register(
    "reports_one_pass_broker",
    O.listings_query(f"select brokered_by, count(*) as num_listings, {O.davg('price')} as avg_price, "
                     f"{O.dsum('price')} as total_listing_value from listings group by brokered_by"),
)
def reports_one_pass_broker(spark, sf):
    return _one_pass(spark, sf, "broker_performance")


for _report, _plain in (("property_type_size", "report_property_type_size"), ("lot_size_influence", "report_lot_size"),
                        ("status_analysis", "report_status"), ("time_yearly", "report_time_yearly")):
    register(f"reports_one_pass_{_report}", ORACLE[_plain])(lambda spark, sf, name=_report: _one_pass(spark, sf, name))


@register("report_market_trends_approx")
def report_market_trends_approx(spark, sf):
    # D8 option: one-pass percentile_approx sketch (accuracy 10,000) instead of the exact median.
    # Rows-only: its median may differ from SQL percentile_disc by the sketch's rank error and
    # takes the lower middle value for even counts, so no SQL oracle states it exactly.
    return REPORTS["market_trends"](listings(spark, sf), scale=SCALE, median="approx")


# ---------------------------------------------------------------- more tables
@register(
    "dedup_orders_latest",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from ("
    "select *, row_number() over (partition by o_custkey order by o_orderdate desc nulls last, "
    "o_orderkey asc nulls first) as rn from orders where o_custkey is not null) o where rn = 1",
)
def dedup_orders_latest(spark, sf):
    return dedup(table(spark, sf, "orders"), ["o_custkey"], order_by=["-o_orderdate", "o_orderkey"])


_EVENTS_V = dict(
    required=("event_id", "ts", "event_type"), range_column="value", min_value=0.0, max_value=400.0,
    zip_column=None, nonneg=("value",), integers=("user_id",), numeric=("props",),
)
_EVENT_COLS = ("event_id", "ts", "user_id", "event_type", "value", "props")


@register(
    "validate_events",
    O.annotated_sql(source="events", present=_EVENT_COLS, strings=("event_type", "props"), **_EVENTS_V),
)
def validate_events(spark, sf):
    return _errors_as_text(annotate(table(spark, sf, "events"), ValidationSpec(**_EVENTS_V)))


_UNI = r"regexp_replace(trim(regexp_replace(lower(trim({c})), '\s+', ' ', 'g')), '[^\p{{L}}\p{{N}}_\s]', '', 'g')"


@register("clean_pages", "select page_id, {u} as url, {h} as html from pages".format(
    u=_UNI.format(c="url"), h=_UNI.format(c="html")))
def clean_pages(spark, sf):
    return normalize_strings(table(spark, sf, "pages"), trim=True, lowercase=True, normalize_spaces=True,
                             strip_punct=True, unicode=True)


# ---------------------------------------------------------------- formats, globs, fallback, file sizes
@register("scan_by_format", "select * exclude (l_shipdate), 'parquet' as read_as from lineitem where l_linenumber % 2 = 0 "
          "union all select * exclude (l_shipdate), 'csv' as read_as from lineitem where l_linenumber % 2 = 1")
def scan_by_format(spark, sf):
    """One call reads a folder of Parquet files and a folder of CSV files, each by what it holds."""
    li = _lineitem_no_ts(spark, sf)
    own = shared_dir(spark, "format")
    li.filter("l_linenumber % 2 = 0").write.parquet(f"{own}/a")
    li.filter("l_linenumber % 2 = 1").write.option("header", "true").csv(f"{own}/b")
    parquet = read_table(spark, f"{own}/a").withColumn("read_as", F.lit("parquet"))
    return parquet.unionByName(read_table(spark, f"{own}/b", schema=li.schema).withColumn("read_as", F.lit("csv")))


@register("scan_glob", "select o_orderpriority, o_orderstatus, count(*) as orders from orders where o_orderpriority like '%-%' "
          "and o_orderstatus <> 'P' group by o_orderpriority, o_orderstatus")
def scan_glob(spark, sf):
    """A glob of folders: two of three statuses, whatever files they hold."""
    root = shared_dir(spark, "glob")
    table(spark, sf, "orders").withColumn("status", F.col("o_orderstatus")).write.partitionBy("status").option("header", "true").csv(root)
    found = read_table(spark, f"{root}/status=[!P]", schema=table(spark, sf, "orders").schema)
    return found.filter("o_orderpriority like '%-%'").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@register("upstream_fallback", "select 'raw' as stage, r_regionkey, r_name from region union all "
          "select 'dedup', n_regionkey, n_name from nation union all select 'routed', r_regionkey, r_name from region where r_regionkey < 3")
def upstream_fallback(spark, sf):
    """What a stage reads while only the raw files, then the deduplicated and then the routed folder are there."""
    root = shared_dir(spark, "upstream")
    region = table(spark, sf, "region").select("r_regionkey", "r_name")
    nation = table(spark, sf, "nation").select(F.col("n_regionkey").alias("r_regionkey"), F.col("n_name").alias("r_name"))
    parts = []
    for stage, rows, folder in (("raw", region, RAW.rpartition("/")[0]), ("dedup", nation, "processed/cleanse_dedup/parquet"),
                                ("routed", region.filter("r_regionkey < 3"), "processed/routed/parquet")):
        writer = rows.coalesce(1).write
        (writer.option("header", "true").csv(f"{root}/{folder}") if stage == "raw" else writer.parquet(f"{root}/{folder}"))
        found = read_table(spark, upstream_input(root, "aggregate", spark), schema=region.schema) if stage == "raw" else read_table(spark, upstream_input(root, "aggregate", spark))
        parts.append(found.select(F.lit(stage).alias("stage"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("files_by_size", "select * from lineitem")
def files_by_size(spark, sf):
    """Written as sorted files of 200 KB and read back."""
    paths = write_table(table(spark, sf, "lineitem"), shared_dir(spark, "sized"), formats=("parquet",), target_bytes=200_000, sort_by=["l_returnflag", "l_shipdate"])
    return read_parquet(spark, paths["parquet"])


@register("quality_limits_text", O.quality_sql(required=(), unique_keys=(), minimum={"price": 0.0, "house_size": 100.0},
                                               maximum={"bath": 6.0}, max_null_fraction={"brokered_by": 0.01}))
def quality_limits_text(spark, sf):
    """Limits given as text, as the command line takes them."""
    spec = QualitySpec(required=(), unique_keys=(), minimum=parse_thresholds("price:0, house_size:1e2"),
                       maximum=parse_thresholds("bath:6"), max_null_fraction=parse_thresholds("brokered_by:.01"))
    return quality_report(listings(spark, sf), spec)


@register("timed_stages", O.listings_query("select 'listings' as stage, count(*) as records, true as took_time from listings union all "
          "select 'dedup', count(*), true from (select distinct city, state, zip_code from listings where city is not null and state is not null and zip_code is not null) d"))
def timed_stages(spark, sf):
    """Two stages run to their end: rows counted in the same run, seconds above zero."""
    stages = {"listings": listings(spark, sf), "dedup": dedup(listings(spark, sf), ["city", "state", "zip_code"])}
    rows = [(name, n, seconds > 0) for name, (seconds, n) in ((k, timed(df)) for k, df in stages.items())]
    return spark.createDataFrame(rows, "stage string, records bigint, took_time boolean")


# ---------------------------------------------------------------- uniqueness of wide keys, growing tables, sketches, streams
_DOC_UNIQUE = dict(required=("text",), unique_keys=("text", "lang", "source"), minimum={}, max_null_fraction={"lang": 0.5})
_DOC_COLS = ("doc_id", "text", "lang", "source", "n_chars")


@register("quality_unique_wide", O.quality_sql(source="documents", present=_DOC_COLS, **_DOC_UNIQUE))
def quality_unique_wide(spark, sf):
    """Keys of whole texts: hashes are shuffled first, texts only where they may repeat."""
    return quality_report(_documents(spark, sf), QualitySpec(**_DOC_UNIQUE, wide_keys=True))


@register("duplicate_groups_wide", "select text, lang, count(*) as count from documents group by text, lang having count(*) > 1")
def duplicate_groups_wide(spark, sf):
    return duplicate_groups(_documents(spark, sf), ["text", "lang"], wide_keys=True)


@register("quality_incremental", O.quality_sql(unique_keys=("city", "state", "zip_code")))
def quality_incremental(spark, sf):
    """Three increments checked one by one; the report of all of them comes from their states."""
    rows = listings(spark, sf)
    store = QualityStore(spark, shared_dir(spark, "quality-state"), rows.columns, QualitySpec(unique_keys=("city", "state", "zip_code")))
    for k in range(3):
        store.add(f"part-{k}", rows.filter(F.coalesce(F.col("bed"), F.lit(0)) % 3 == k))
    return store.report()


@register("median_sketch", O.listings_query("select city, state, count(price) as n, true as within, true as approx_within "
                                            "from listings group by city, state having count(price) > 0"))
def median_sketch(spark, sf):
    """Median price by city from sketches of yearly runs, stored and merged, and from the one-pass approximation: both
    lie within the stated rank error of the exact ranks."""
    rows, by = listings(spark, sf), ["city", "state"]
    runs = [stored(quantile_sketches(rows.filter(F.coalesce(F.year("prev_sold_date"), F.lit(0)) % 3 == k), by, "price"), "sketch") for k in range(3)]
    merged = quantile_of(merge_sketches(runs, by), 0.5, "median")
    approx = REPORTS["market_trends"](rows, scale=SCALE, median="approx").filter("median_price is not null")
    one = rank_errors(rows, by, "price", merged, "median").select(*by, "n", (F.col("error") <= RANK_ERROR).alias("within"))
    two = rank_errors(rows, by, "price", approx, "median_price").select(*by, (F.col("error") <= RANK_ERROR).alias("approx_within"))
    return one.join(two, by)


#: So many bytes of the tables behind the listings make a file of the stream.
ARRIVAL_BYTES = 16 << 20


@register("stream_dedup", O.listings_query(O.dedup_sql("listings", ["city", "state", "zip_code"])))
def stream_dedup(spark, sf):
    """Listings that come in several batches: the winners are those of one dedup of all of them."""
    rows, keys, root = listings(spark, sf), ["city", "state", "zip_code"], shared_dir(spark, "stream-dedup")
    files = max(4, input_bytes(rows) // ARRIVAL_BYTES)  # grow in number, not in size
    rows.repartition(files, *rows.columns).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files // 2).parquet(f"{root}/in")
    dedup_stream(stream, keys, f"{root}/out").awaitTermination()
    return winners(spark, f"{root}/out", rows.schema, keys)


@register("publish_versions", "select 'before' as seen, n_regionkey as key, n_name as name from nation union all select 'after', r_regionkey, r_name from region")
def publish_versions(spark, sf):
    """A name refreshed while a reader holds it: the reader goes on with the old rows, the next one gets the new."""
    name, root = f"{_unique('versions')}t", shared_dir(spark, "versions")
    publish_version(table(spark, sf, "nation").select(F.col("n_regionkey").alias("key"), F.col("n_name").alias("name")), name, root)
    reader = spark.table(name)
    publish_version(table(spark, sf, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")), name, root)
    return reader.select(F.lit("before").alias("seen"), "*").unionByName(spark.table(name).select(F.lit("after").alias("seen"), "*"))
