import __spark_entry__ as E
from rowmill.plans import registry
from rowmill.operators.dedup import dedup
from rowmill.plans.end_to_end import PipelineOptions, run
from rowmill.plans.throughput import measure
from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    out = df.collect()
    assert len(out) > 0 and df.columns == ["segment", "state", "valid_rows", "invalid_rows", "avg_valid_price"]


def test_every_query_has_an_oracle_but_timings():
    missing = set(registry.QUERIES) - set(registry.ORACLE)
    assert missing == {"throughput", "report_market_trends_approx"}


def test_pipeline_run_outputs(spark, sample):
    out = run(sample, PipelineOptions(keys=["street", "city", "state", "zip_code"]))
    c = out["counts"].first()
    assert (c["total"], c["valid"], c["invalid"]) == (10, 10, 0)
    assert out["valid"].count() + out["invalid"].count() == 10
    assert out["segment_state"].groupBy().sum("count").first()[0] == 10
    assert {"market_trends", "time_yearly"} <= set(out)


def test_throughput_records(spark, sample):
    m = measure(spark, sample, sizes=(-1, 5), keys=["street", "city", "state", "zip_code"])
    got = {(r["size"], r["stage"]): r["records"] for r in m.collect()}
    assert got[("all", "read")] == 10 and got[("all", "dedup")] == 10 and got[("5", "read")] == 5
    assert got[("all", "aggregate")] == 10
    assert set(m.columns) >= {"seconds", "rps", "aqe", "shuffle_partitions"}


def test_dedup_on_testdata_lineitem(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    out = dedup(li, ["l_partkey", "l_suppkey"])
    assert out.count() == li.select("l_partkey", "l_suppkey").distinct().count()


def test_pipeline_one_pass_reports_equal(spark, sample):
    from tests.conftest import rows
    keys = ["street", "city", "state", "zip_code"]
    a = run(sample, PipelineOptions(keys=keys, scale=2))
    b = run(sample, PipelineOptions(keys=keys, scale=2, one_pass=True))
    for name in ("market_trends", "status_analysis", "time_yearly"):
        assert rows(a[name]) == rows(b[name])


def test_rows_only_queries(spark):
    q = E.queries()
    stages = q["throughput"](spark, SF_SMALL).collect()
    assert [r["stage"] for r in stages] == ["read", "dedup", "route", "aggregate"]
    approx = q["report_market_trends_approx"](spark, SF_SMALL)
    exact = q["report_market_trends"](spark, SF_SMALL)
    assert approx.columns == exact.columns
    assert sorted((r["city"], r["state"], r["num_properties"]) for r in approx.collect()) == sorted(
        (r["city"], r["state"], r["num_properties"]) for r in exact.collect())


def test_throughput_write_handoff(spark, sample):
    m = measure(spark, sample, keys=["street", "city", "state", "zip_code"], handoff="write")
    got = {r["stage"]: r["records"] for r in m.collect()}
    assert got == {"read": 10, "dedup": 10, "route": 10, "aggregate": 10}


def test_entry_module_import_is_side_effect_free():
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, '.'); import __spark_entry__ as E; "
            "from pyspark import SparkContext; assert SparkContext._active_spark_context is None; "
            "from rowmill.plans.registry import ORACLE, QUERIES; "
            "assert QUERIES.keys() <= E.queries().keys() and ORACLE.keys() <= E.oracle_sql().keys(); "
            "print(len(QUERIES), len(ORACLE))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         cwd=__file__.rsplit("/tests/", 1)[0])
    assert out.returncode == 0, out.stderr[-2000:]
    n_queries, n_oracles = map(int, out.stdout.split())
    assert n_queries == n_oracles + 2
