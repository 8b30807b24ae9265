"""Property tests (hypothesis) for the invariants of dedup, split, quality and reports."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rowmill.operators import annotate, apply_rule_set, dedup, quality_report, quality_summary, split
from rowmill.operators.quantile import percentile_disc
from rowmill.operators.reports import run_reports

SCHEMA = "street string, city string, zip_code string, price double, bed int"

row = st.tuples(
    st.sampled_from(["a st", "b st", " ", None]),
    st.sampled_from(["x", "y", None]),
    st.sampled_from(["12345", "1234", "9x999", None]),
    st.one_of(st.none(), st.floats(min_value=-10, max_value=2e6, allow_nan=False)),
    st.one_of(st.none(), st.integers(min_value=0, max_value=6)),
)
frames = st.lists(row, min_size=0, max_size=25)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(data=frames, mode=st.sampled_from(["drop", "group", "keep"]))
def test_dedup_idempotent_and_unique(spark, data, mode):
    df = spark.createDataFrame(data, SCHEMA)
    once = dedup(df, ["street", "city"], null_keys=mode)
    got = [tuple(r) for r in once.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, (tuple(r) for r in dedup(once, ["street", "city"], null_keys=mode).collect())))
    keyed = [(s, c) for s, c, *_ in got if s is not None and c is not None]
    assert len(keyed) == len(set(keyed))
    if mode != "drop":
        keys_in = {(s, c) for s, c, *_ in data}
        assert {(s, c) for s, c, *_ in got} == keys_in


@SETTINGS
@given(data=frames)
def test_split_complete_and_disjoint(spark, data):
    ann = annotate(spark.createDataFrame(data, SCHEMA))
    valid, invalid = split(ann)
    v, i = valid.count(), invalid.count()
    assert v + i == len(data)
    assert valid.filter("size(validation_errors) > 0").count() == 0
    assert invalid.filter("size(validation_errors) = 0").count() == 0


@SETTINGS
@given(data=frames)
def test_quality_accounting(spark, data):
    rep = quality_report(spark.createDataFrame(data, SCHEMA))
    s = quality_summary(rep).first()
    assert s["passed"] + s["failed"] == rep.count()
    assert (s["total_rows"] or 0) == len(data) or rep.count() == 0


@SETTINGS
@given(data=frames)
def test_counting_reports_sum_to_input(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    for name, col in (("market_trends", "num_properties"), ("property_type_size", "num_properties"),
                      ("broker_performance", "num_listings"), ("status_analysis", "count"),
                      ("time_yearly", "num_transactions")):
        total = run_reports(df, [name])[name].agg({col: "sum"}).first()[0]
        assert (total or 0) == len(data), name


@SETTINGS
@given(values=st.lists(st.tuples(st.sampled_from(["g", "h", None]), st.integers(0, 9)), min_size=1, max_size=40),
       p=st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]))
def test_percentile_disc_brute_force(spark, values, p):
    df = spark.createDataFrame(values, "g string, v int")
    got = {r["g"]: r["q"] for r in percentile_disc(df, ["g"], "v", p, alias="q", partitions=3).collect()}
    for g in {k for k, _ in values}:
        vals = sorted(v for k, v in values if k == g)
        want = next(v for i, v in enumerate(vals, 1) if i >= p * len(vals))
        assert got[g] == want


def _expected_errors(row, spec):
    """Plain-Python statement of the row rules, used as an independent oracle."""
    street, price, bath, zip_code, bed = row
    cols = {"street": street, "price": price, "bath": bath, "zip_code": zip_code, "bed": bed}
    strings = {"street", "price", "bath", "zip_code", "bed"}  # every column of this frame is text
    out = []
    for c in spec["required"]:
        v = cols.get(c, "absent")
        if v == "absent":
            out.append(f"missing_column:{c}")
        elif v is None or (c in strings and v.strip(" ") == ""):
            out.append(f"required_empty:{c}")

    def num(v):
        try:
            return float(v) if v is not None else None
        except ValueError:
            return None

    p = num(price)
    if p is not None and p < spec["min_value"]:
        out.append("price_below_min")
    if p is not None and p > spec["max_value"]:
        out.append("price_above_max")
    if p is not None and p < 0:
        out.append("negative:price")
    for c in ("bath", "bed"):
        v = cols[c]
        if v is not None and any(ch not in "0123456789" for ch in v):
            out.append(f"not_integer:{c}")
    z = zip_code
    if z is not None and any(ch not in "0123456789" for ch in z):
        out.append("zip_non_numeric")
    digits = "".join(ch for ch in (z or "") if ch in "0123456789")
    if len(digits) != 5:
        out.append("zip_wrong_length")
    return out


text = st.one_of(st.none(), st.text(alphabet="0123456789 .-ab", max_size=7))
dirty_rows = st.lists(st.tuples(text, st.one_of(st.none(), st.sampled_from(["-3", "0", "12.5", "2000001", "abc", ""])),
                                text, text, text), min_size=1, max_size=20)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=dirty_rows)
def test_validation_rules_match_plain_python(spark, data):
    from rowmill.operators import ValidationSpec
    spec = dict(required=("street", "price", "lot"), min_value=0.0, max_value=2000000.0)
    vs = ValidationSpec(required=spec["required"], min_value=0.0, max_value=2000000.0, zip_numeric=True,
                        nonneg=("price",), integers=("bath", "bed"))
    df = spark.createDataFrame(data, "street string, price string, bath string, zip_code string, bed string")
    got = [r["validation_errors"] for r in annotate(df, vs).collect()]
    assert got == [_expected_errors(r, spec) for r in data]


def _clean_py(s):
    import re
    if s is None:
        return None
    s = s.strip(" ").lower()
    s = re.sub(r"\s+", " ", s, flags=re.ASCII).strip(" ")
    return re.sub(r"[^\w\s]", "", s, flags=re.ASCII)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.text(alphabet="aZ9_ .,-#\t\néÉ", max_size=12)), min_size=1, max_size=20))
def test_clean_text_matches_plain_python(spark, values):
    from rowmill.functions import clean_text
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(clean_text("s", True, True, True, True)).collect()]
    assert got == [_clean_py(v) for v in values]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=frames)
def test_quality_counts_match_plain_python(spark, data):
    from rowmill.operators import QualitySpec
    spec = QualitySpec(required=("street", "price"), unique_keys=("street", "city"), minimum={"price": 0.0},
                       maximum={"bed": 4.0}, max_null_fraction={"city": 0.3})
    got = {r["check"]: r for r in quality_report(spark.createDataFrame(data, SCHEMA), spec).collect()}
    n = len(data)
    blank_street = sum(1 for s, *_ in data if s is None or s.strip(" ") == "")
    null_price = sum(1 for *_, p, _b in data if p is None)
    null_city = sum(1 for _s, c, *_ in data if c is None)
    below = sum(1 for *_, p, _b in data if p is not None and p < 0)
    above = sum(1 for *_, b in data if b is not None and b > 4)
    keys = {}
    for s, c, *_ in data:
        keys[(s, c)] = keys.get((s, c), 0) + 1
    dup = sum(1 for v in keys.values() if v > 1)
    assert got["required_non_null:street"]["nulls"] == blank_street
    assert got["required_non_null:price"]["nulls"] == null_price
    assert got["null_rate:city"]["nulls"] == null_city
    assert got["null_rate:city"]["status"] == ("pass" if (null_city / n if n else 0.0) <= 0.3 else "fail")
    assert got["min:price"]["out_of_range"] == below and got["max:bed"]["out_of_range"] == above
    assert got["unique_keys:street,city"]["duplicate_key_groups"] == dup
    assert all(r["total_rows"] == n for r in got.values())


def _parse_py(s):
    """Plain-Python statement of the four date formats, first match wins."""
    import datetime as dt
    import re
    if s is None:
        return None
    patterns = (
        (r"(\d{4})-(\d{2})-(\d{2})", (0, 1, 2)),   # yyyy-MM-dd
        (r"(\d{2})/(\d{2})/(\d{4})", (2, 0, 1)),   # MM/dd/yyyy
        (r"(\d{1,2})/(\d{1,2})/(\d{4})", (2, 0, 1)),  # M/d/yyyy
        (r"(\d{4})/(\d{2})/(\d{2})", (0, 1, 2)),   # yyyy/MM/dd
    )
    for pat, (y, m, d) in patterns:
        hit = re.fullmatch(pat, s)
        if hit:
            g = hit.groups()
            try:
                return dt.date(int(g[y]), int(g[m]), int(g[d]))
            except ValueError:
                continue
    return None


date_text = st.one_of(
    st.none(),
    st.builds(lambda y, m, d, f: f.format(y=y, m=m, d=d),
              st.integers(1990, 2030), st.integers(0, 13), st.integers(0, 32),
              st.sampled_from(["{y}-{m:02d}-{d:02d}", "{m:02d}/{d:02d}/{y}", "{m}/{d}/{y}", "{y}/{m:02d}/{d:02d}",
                               "{y}-{m}-{d}", "{d:02d}.{m:02d}.{y}", "{y}{m:02d}{d:02d}"])),
    st.text(alphabet="0123456789/-", max_size=10),
)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(date_text, min_size=1, max_size=25))
def test_parse_date_matches_plain_python(spark, values):
    from rowmill.functions import parse_date
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(parse_date("s")).collect()]
    assert got == [_parse_py(v) for v in values]


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.tuples(
    st.one_of(st.none(), st.text(alphabet="0123456789-a ", max_size=11)),
    st.one_of(st.none(), st.sampled_from([0.0, 0.2499, 0.25, 0.5, 1.0, 1.0001, 7.5, -1.0])),
    st.one_of(st.none(), st.sampled_from([999999.0, 1000000.0, 1000001.0, 5.0])),
    st.one_of(st.none(), st.integers(0, 6)),
    st.one_of(st.none(), st.sampled_from([1999.0, 2000.0, 2500.0])),
), min_size=1, max_size=25))
def test_codes_buckets_and_routing_match_plain_python(spark, values):
    from pyspark.sql import functions as F
    from rowmill.functions import lot_bucket, normalize_code
    df = spark.createDataFrame(values, "zip string, acre_lot double, price double, beds int, sqft double")
    out = apply_rule_set(df).select(normalize_code("zip", 5, numeric=True, truncate=True).alias("z"),
                                    lot_bucket(F.col("acre_lot")).alias("b"), "segment").collect()

    def zip_py(z):
        if z is None:
            return None
        digits = "".join(ch for ch in z if ch.isdigit())
        return digits[:5] if len(digits) >= 5 else digits.rjust(5, "0")

    def bucket_py(a):
        if a is None:
            return "unknown"
        return "small" if a < 0.25 else "medium" if a <= 1.0 else "large"

    def segment_py(price, beds, sqft):
        if price is not None and price > 1_000_000:
            return "luxury"
        if beds is not None and sqft is not None and beds >= 3 and sqft >= 2000:
            return "family"
        return "standard"

    expected = [(zip_py(z), bucket_py(a), segment_py(p, b, s)) for z, a, p, b, s in values]
    assert [tuple(r) for r in out] == expected


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=frames, mode=st.sampled_from(["drop", "group"]))
def test_dedup_winner_matches_brute_force(spark, data, mode):
    df = spark.createDataFrame(data, SCHEMA)
    got = sorted(map(repr, (tuple(r) for r in dedup(df, ["street", "city"], null_keys=mode).collect())))

    def order_key(row):  # remaining columns ascending, nulls first
        return tuple((v is not None, v) for v in row[2:])

    best = {}
    for row in data:
        key = row[:2]
        if mode == "drop" and (key[0] is None or key[1] is None):
            continue
        if key not in best or order_key(row) < order_key(best[key]):
            best[key] = row
    assert got == sorted(map(repr, best.values()))


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.sampled_from(["g", "h", None]),
                               st.one_of(st.none(), st.sampled_from(["1.25", "-3", "10", "abc", " 7 ", "", "0.01"]))),
                     min_size=1, max_size=30))
def test_spec_aggregates_match_plain_python(spark, data):
    from decimal import Decimal

    from rowmill.operators import aggregate
    df = spark.createDataFrame(data, "g string, v string")
    got = {r["g"]: r.asDict() for r in aggregate(df, ["g"], "v:sum,v:min,v:max,v:avg,v:count", scale=2).collect()}

    def num(text):
        try:
            return Decimal(text.strip()) if text is not None and text.strip() else None
        except Exception:  # noqa: BLE001
            return None

    for g in {k for k, _ in data}:
        vals = [num(v) for k, v in data if k == g]
        vals = [v for v in vals if v is not None]
        row = got[g]
        assert row["v_count"] == len(vals)
        if vals:
            assert row["v_sum"] == float(sum(vals)) and row["v_min"] == float(min(vals))
            assert row["v_max"] == float(max(vals)) and row["v_avg"] == float(sum(vals)) / len(vals)
        else:
            assert row["v_sum"] is None and row["v_min"] is None and row["v_avg"] is None


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=frames)
def test_profile_and_error_histogram_match_plain_python(spark, data):
    from collections import Counter

    from rowmill.operators import error_counts, profile
    df = spark.createDataFrame(data, SCHEMA)
    prof = {r["column"]: (r["rows"], r["nulls"]) for r in profile(df).collect()}
    for i, name in enumerate(["street", "city", "zip_code", "price", "bed"]):
        assert prof[name] == (len(data), sum(1 for row in data if row[i] is None))
    ann = annotate(df)
    hist = {r["error"]: r["rows"] for r in error_counts(ann).collect()}
    expected = Counter(e for r in ann.select("validation_errors").collect() for e in r[0])
    assert hist == dict(expected)
