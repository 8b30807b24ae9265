"""SQL text for the independent DuckDB check of every registered query.

Each function returns plain ANSI-style SQL over the pre-registered tables; the
listing views are prepended as CTEs (see :mod:`rowmill.plans.fixtures`).  The
builders mirror the *specification* of an operator (which rules, which
thresholds), never its Spark implementation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from rowmill.plans.fixtures import with_listings

LISTING_COLUMNS = (
    "street", "city", "state", "zip_code", "brokered_by", "status", "price", "bed", "bath",
    "acre_lot", "house_size", "prev_sold_date",
)
LISTING_STRINGS = ("street", "city", "state", "zip_code", "brokered_by", "status")
LINEITEM_NO_TS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)

ROUTE_BASIC = (
    "case when price > 1000000 then 'luxury' "
    "when cast(bed as integer) >= 3 and house_size >= 2000 then 'family' else 'standard' end"
)

LOT_BUCKET = (
    "case when acre_lot < 0.25 then 'small' when acre_lot >= 0.25 and acre_lot <= 1.0 then 'medium' "
    "when acre_lot > 1.0 then 'large' else 'unknown' end"
)


def norm(x: str) -> str:
    """trim -> lower -> collapse blanks + trim -> drop ASCII punctuation."""
    return rf"regexp_replace(trim(regexp_replace(lower(trim({x})), '\s+', ' ', 'g')), '[^\w\s]', '', 'g')"


def dsum(x: str, scale: int = 2) -> str:
    return f"cast(sum(cast({x} as decimal(38,{scale}))) as double)"


def davg(x: str, scale: int = 2) -> str:
    return f"{dsum(x, scale)} / nullif(count({x}), 0)"


def order_all(cols: Sequence[str]) -> str:
    return ", ".join(f"{c} asc nulls first" for c in cols)


def dedup_sql(source: str, keys: Sequence[str], cols: Sequence[str] = LISTING_COLUMNS, normalized: bool = False,
              null_keys: str = "drop") -> str:
    part = ", ".join(norm(k) if normalized else k for k in keys)
    rest = [c for c in cols if c not in keys] + (list(keys) if normalized else [])
    any_null = " or ".join(f"{k} is null" for k in keys)
    where = f"where not ({any_null})" if null_keys == "drop" else ""
    keep = f"or ({any_null})" if null_keys == "keep" else ""
    return (
        f"select {', '.join(cols)} from (select *, row_number() over (partition by {part} "
        f"order by {order_all(rest)}) as rn from {source} {where}) t where rn = 1 {keep}"
    )


def errors_sql(
    required: Sequence[str] = ("street", "city", "state", "zip_code", "price"),
    range_column: str | None = "price",
    min_value: float | None = 0.0,
    max_value: float | None = None,
    zip_column: str | None = "zip_code",
    zip_length: int | None = 5,
    zip_numeric: bool = False,
    nonneg: Sequence[str] = ("price", "house_size", "acre_lot"),
    integers: Sequence[str] = ("bed", "bath"),
    numeric: Sequence[str] = (),
    present: Sequence[str] = LISTING_COLUMNS,
    strings: Sequence[str] = LISTING_STRINGS,
) -> str:
    parts: list[str] = []
    for c in required:
        if c not in present:
            parts.append(f"'missing_column:{c}'")
        elif c in strings:
            parts.append(f"case when {c} is null or trim({c}) = '' then 'required_empty:{c}' end")
        else:
            parts.append(f"case when {c} is null then 'required_empty:{c}' end")
    if range_column and range_column in present:
        if min_value is not None:
            parts.append(f"case when cast({range_column} as double) < {float(min_value)!r} then '{range_column}_below_min' end")
        if max_value is not None:
            parts.append(f"case when cast({range_column} as double) > {float(max_value)!r} then '{range_column}_above_max' end")
    for c in nonneg:
        if c in present:
            parts.append(f"case when cast({c} as double) < 0 then 'negative:{c}' end")
    for c in integers:
        if c in present:
            if c in strings:
                parts.append(f"case when regexp_replace({c}, '[0-9]', '', 'g') <> '' then 'not_integer:{c}' end")
            else:
                parts.append(f"case when cast({c} as double) % 1 <> 0 then 'not_integer:{c}' end")
    for c in numeric:
        if c in present:
            parts.append(f"case when {c} is not null and try_cast({c} as double) is null then 'not_numeric:{c}' end")
    if zip_column and zip_column in present and (zip_length is not None or zip_numeric):
        z = f"cast({zip_column} as string)"
        if zip_numeric:
            parts.append(f"case when regexp_matches({z}, '[^0-9]') then 'zip_non_numeric' end")
        if zip_length is not None:
            digits = f"regexp_replace({z}, '[^0-9]', '', 'g')" if zip_numeric else z
            parts.append(f"case when length(coalesce({digits}, '')) <> {int(zip_length)} then 'zip_wrong_length' end")
    if not parts:
        return "''"
    return "concat_ws('|', " + ", ".join(parts) + ")"


def annotated_sql(source: str = "listings", **spec) -> str:
    return (
        f"select * exclude (errs), errs as validation_errors, errs = '' as is_valid "
        f"from (select *, {errors_sql(**spec)} as errs from {source}) a"
    )


def quality_sql(
    source: str = "listings",
    required: Sequence[str] = ("street", "city", "state", "zip_code", "price"),
    unique_keys: Sequence[str] = ("street", "city", "state", "zip_code"),
    minimum: Mapping[str, float] | None = None,
    maximum: Mapping[str, float] | None = None,
    max_null_fraction: Mapping[str, float] | None = None,
    present: Sequence[str] = LISTING_COLUMNS,
    then: str | None = None,
) -> str:
    """The report rows; with ``then`` they become a CTE named ``report`` that ``then`` selects from."""
    minimum = {"price": 0.0, "house_size": 0.0, "acre_lot": 0.0} if minimum is None else minimum
    maximum = {} if maximum is None else maximum
    max_null_fraction = {"status": 0.2, "brokered_by": 0.5} if max_null_fraction is None else max_null_fraction
    aggs = ["count(*) as total"]
    rows: list[str] = []

    def row(k, check, status, nulls="null", frac="null", oor="null", dup="null", tname=None, tval=None):
        tn = "null" if tname is None else f"'{tname}'"
        tv = "null" if tval is None else repr(float(tval))
        return (
            f"select cast({k} as integer) as ordinal, '{check}' as \"check\", {status} as status, "
            f"cast(total as bigint) as total_rows, cast({nulls} as bigint) as nulls, cast({frac} as double) as fraction, "
            f"cast({oor} as bigint) as out_of_range, cast({dup} as bigint) as duplicate_key_groups, "
            f"cast({tn} as string) as threshold_name, cast({tv} as double) as threshold from s"
        )

    def frac(n):
        return f"case when total > 0 then round(cast({n} as double) / total, 6) else 0.0 end"

    k = 0
    for i, c in enumerate(required):
        if c not in present:
            rows.append(row(k, f"required_present:{c}", "'fail'"))
        else:
            n = f"req{i}"
            aggs.append(f"count(*) filter (where {c} is null or trim(cast({c} as string)) = '') as {n}")
            rows.append(row(k, f"required_non_null:{c}", f"case when {n} = 0 then 'pass' else 'fail' end",
                            n, frac(n), tname="nulls", tval=0.0))
        k += 1
    for i, (c, lim) in enumerate(max_null_fraction.items()):
        if c in present:
            n = f"nul{i}"
            aggs.append(f"count(*) filter (where {c} is null) as {n}")
            raw = f"case when total > 0 then cast({n} as double) / total else 0.0 end"
            rows.append(row(k, f"null_rate:{c}", f"case when {raw} <= {float(lim)!r} then 'pass' else 'fail' end",
                            n, frac(n), tname="max_fraction", tval=lim))
            k += 1
    for label, bounds, op in (("min", minimum, "<"), ("max", maximum, ">")):
        for i, (c, v) in enumerate(bounds.items()):
            if c in present:
                n = f"{label}{i}"
                aggs.append(f"count(*) filter (where cast({c} as double) {op} {float(v)!r}) as {n}")
                rows.append(row(k, f"{label}:{c}", f"case when {n} = 0 then 'pass' else 'fail' end",
                                oor=n, tname=label, tval=v))
                k += 1
    if unique_keys and all(c in present for c in unique_keys):
        keys = ", ".join(unique_keys)
        aggs.append(f"(select count(*) from (select 1 from {source} group by {keys} having count(*) > 1) d) as dup_groups")
        rows.append(row(k, f"unique_keys:{','.join(unique_keys)}",
                        "case when dup_groups = 0 then 'pass' else 'fail' end", dup="dup_groups",
                        tname="duplicates", tval=0.0))
    ctes = f"s as (select {', '.join(aggs)} from {source})"
    body = "\nunion all\n".join(rows)
    if then is not None:
        ctes, body = f"{ctes}, report as ({body})", then
    if source.startswith("listings"):
        return listings_query(body, dirty=source == "listings_dirty", extra_ctes=ctes)
    return f"with {ctes}\n{body}"


def listings_query(sql: str, dirty: bool = False, extra_ctes: str = "") -> str:
    """``sql`` over the listing views; ``extra_ctes`` are appended after them."""
    body = f", {extra_ctes}\n{sql}" if extra_ctes else f"\n{sql}"
    return with_listings("", dirty).rstrip("\n") + body
