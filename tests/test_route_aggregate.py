import pytest
from pyspark.sql import functions as F

from rowmill.operators import Rule, aggregate, apply_rule_set, parse_metrics, route, top_k
from rowmill.operators.quantile import percentile_disc
from rowmill.operators.reports import REPORTS, market_trends, run_reports
from tests.conftest import rows


def test_route_preset_on_sample(sample):
    routed = apply_rule_set(sample)
    counts = dict(rows(routed.groupBy("segment").count()))
    assert counts == {"luxury": 2, "family": 2, "standard": 6}


def test_route_edges_and_null_conditions(spark):
    df = spark.createDataFrame([(999999.0,), (1000000.0,), (1000001.0,), (None,)], "price double")
    assert [r[0] for r in apply_rule_set(df).select("segment").collect()] == ["standard", "standard", "luxury", "standard"]
    fam = spark.createDataFrame([(3, 2000.0), (3, None), (2, 5000.0)], "bedrooms int, sqft double")
    assert [r[0] for r in apply_rule_set(fam).select("segment").collect()] == ["family", "standard", "standard"]
    with pytest.raises(ValueError):
        apply_rule_set(df, "preset_fancy")


def test_custom_rules_first_match(spark):
    df = spark.createDataFrame([(1,), (5,), (50,)], "x int")
    out = route(df, [Rule("small", "x < 10"), Rule("tiny", F.col("x") < 2)], default="big", column="size")
    assert [r[0] for r in out.select("size").collect()] == ["small", "small", "big"]


def test_parse_metrics():
    assert parse_metrics("price:sum, price:MEAN,size:count") == [("price", "sum"), ("price", "avg"), ("size", "count")]
    assert parse_metrics([("a", "max")]) == [("a", "max")]
    for bad in ("", "price", "price:", ":sum", "price:median", ","):
        with pytest.raises(ValueError):
            parse_metrics(bad)


def test_aggregate_generic(sample):
    out = aggregate(sample, [], "price:sum,price:min,price:max,price:avg,price:count,nope:sum")
    r = out.first().asDict()
    assert r["price_sum"] == 6000000 and r["price_min"] == 225000 and r["price_max"] == 1250000
    assert r["price_avg"] == 600000 and r["price_count"] == 10 and r["nope_sum"] is None
    exact = aggregate(sample, ["status"], "price:avg", scale=2)
    assert dict(rows(exact)) == {"For Sale": 3530000 / 7, "Sold": 2470000 / 3}
    with pytest.raises(Exception):
        aggregate(sample, ["absent_dim"], "price:sum").collect()


def test_scale_leaves_out_what_it_cannot_hold_and_counts_it(spark):
    from rowmill.operators.aggregate import skipped_of
    df = spark.createDataFrame([("a", float("nan")), ("a", 1.5), ("a", float("inf")), ("a", 2.5), ("a", 1e40), ("a", None), ("b", 1e40)],
                               "g string, v double")
    out = aggregate(df, ["g"], "v:sum,v:avg,v:count", scale=2)
    assert rows(out) == [("a", 4.0, 2.0, 5), ("b", None, None, 1)]
    assert rows(df.groupBy("g").agg(skipped_of(F.col("v"), 2))) == [("a", 3), ("b", 1)]
    big = spark.createDataFrame([(9e35,), (9e35,)], "price double")
    assert REPORTS["market_trends"](big, scale=2).first()["num_properties"] == 2


def test_market_trends_stores_nothing(spark, sample, tmp_path, monkeypatch):
    """Two pruned scans of the facts, one for the averages and one for the median, and no copy of them."""
    path = str(tmp_path / "facts")
    sample.write.parquet(path)
    written = []
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", lambda self, path, *a, **k: written.append(path))
    plan = market_trends(spark.read.parquet(path), scale=2)._jdf.queryExecution().executedPlan().toString()
    assert path in plan and not written


def test_reports_on_sample(sample):
    rep = run_reports(sample)
    assert set(rep) == set(REPORTS)
    lot = {r["lot_bucket"]: r for r in rep["lot_size_influence"].collect()}
    assert set(lot) == {"small", "medium", "large"}
    assert lot["medium"]["avg_price"] == 531250 and lot["small"]["avg_house_size"] == 1115 and lot["large"]["avg_price"] == 1175000
    status = {r["status"]: (r["count"], round(r["avg_price"], 2), round(r["avg_house_size"], 2)) for r in rep["status_analysis"].collect()}
    assert status == {"For Sale": (7, 504285.71, 1860.0), "Sold": (3, 823333.33, 2213.33)}
    pts = {(r["bed"], r["bath"]): (r["avg_price"], r["min_price"], r["max_price"], r["num_properties"])
           for r in rep["property_type_size"].collect()}
    assert pts[(2, 1)] == (390000, 390000, 390000, 2) and pts[(3, 2)] == (545000, 475000, 640000, 3)
    yearly = {r["year"]: (r["avg_price"], r["num_transactions"]) for r in rep["time_yearly"].collect()}
    assert yearly[2018] == (945000, 2) and len(yearly) == 9
    assert rep["market_trends"].count() == 10 and rep["broker_performance"].count() == 10
    top = [tuple(r) for r in top_k(rep["market_trends"], "avg_price", 5, tie_breakers=["state"]).select("state", "avg_price").collect()]
    assert top == [("NM", 1250000.0), ("OK", 1100000.0), ("UT", 700000.0), ("NH", 640000.0), ("GA", 520000.0)]


def test_reports_absent_columns_give_typed_null_groups(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "list_price double")
    out = REPORTS["market_trends"](df)
    assert rows(out.select("city", "avg_price", "median_price", "num_properties")) == [(None, 2.0, 1.0, 2)]
    assert out.schema["city"].dataType.simpleString() == "string"


def test_median_discrete_and_approx(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 4)] + [("h", 5.0), ("h", None)], "city string, price double")
    exact = {r["city"]: r["median_price"] for r in market_trends(df).collect()}
    assert exact == {"g": 2.0, "h": 5.0}
    approx = {r["city"]: r["median_price"] for r in market_trends(df, median="approx").collect()}
    assert approx["h"] == 5.0


def test_percentile_disc_matches_brute_force_with_hot_group(spark):
    import random
    rnd = random.Random(7)
    data = [("hot" if i % 3 else f"g{i % 7}", float(rnd.randint(0, 500))) for i in range(6000)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r["p"] for r in percentile_disc(df, ["g"], "v", 0.5, alias="p", partitions=16).collect()}
    for p in (0.1, 0.9):
        got_p = {r["g"]: r["p"] for r in percentile_disc(df, ["g"], "v", p, alias="p", partitions=5).collect()}
        for g in got_p:
            vals = sorted(v for k, v in data if k == g)
            need = p * len(vals)
            expect = next(v for i, v in enumerate(vals, 1) if i >= need)
            assert got_p[g] == expect
    for g in got:
        vals = sorted(v for k, v in data if k == g)
        assert got[g] == vals[(len(vals) + 1) // 2 - 1]


def test_one_pass_reports_equal_separate_plans(sample, spark):
    df = sample.union(sample.limit(3).selectExpr("street", "city", "state", "zip_code", "null as brokered_by",
                                                 "status", "price + 1", "bed", "bath", "acre_lot", "house_size",
                                                 "null as prev_sold_date"))
    sep = run_reports(df, scale=2)
    one = run_reports(df, scale=2, one_pass=True)
    assert set(sep) == set(one)
    for name in sep:
        assert sep[name].columns == one[name].columns
        assert rows(sep[name]) == rows(one[name]), name
    with pytest.raises(ValueError):
        run_reports(df, ["nope"])


def test_report_registry(sample):
    from rowmill.operators.reports import run_report
    assert run_report(sample, "status_analysis").count() == 2
    with pytest.raises(ValueError):
        run_report(sample, "no_such_report")


def test_percentile_without_exchange_reuse(spark):
    data = [("g", float(v)) for v in range(101)] + [("h", float(v)) for v in (5, 1, 9)]
    df = spark.createDataFrame(data, "g string, v double")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {r["g"]: r["p"] for r in percentile_disc(df, ["g"], "v", 0.5, alias="p", partitions=7).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    assert got == {"g": 50.0, "h": 5.0}


def test_sums_in_parts_are_the_exact_sums(spark):
    """Small values as units in a long, large ones as decimals: the same sums, averages and nulls as of decimals alone."""
    from rowmill.operators.aggregate import avg_of, avg_of_parts, exact_parts, sum_of, sum_of_parts

    top, nan, inf = 9.9e35, float("nan"), float("inf")
    groups = {"small": [0.1, 0.2, -0.305, 1.005, None], "edge": [9999999.99, 1e7, 9999999.995, -1e7, -9999999.994], "mixed": [1e20, 0.01, -1e20, 3.0],
              "none": [None, None], "odd": [nan, inf, 1e300, 5.25], "only odd": [nan, -inf], "over": [top, top], "large": [1e15, 2e15]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    for scale in (0, 2, 4):
        want = df.groupBy("g").agg(sum_of(F.col("v"), scale).alias("s"), avg_of(F.col("v"), scale).alias("a"))
        parts = df.select("g", *[c.alias(n) for n, c in exact_parts("x", F.col("v"), scale).items()])
        assert rows(parts.groupBy("g").agg(sum_of_parts("x", scale).alias("s"), avg_of_parts("x", scale).alias("a"))) == rows(want)
