"""Plan checks: pruning and pushdown reach the scan, no redundant exchanges."""

import re

import pytest

from rowmill.operators import QualitySpec, dedup, quality_report
from rowmill.operators.reports import REPORTS
from rowmill.streaming.split import _write_batch
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def sample_parquet(spark, sample, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pq") / "listings")
    sample.write.parquet(path)
    return spark.read.parquet(path)


def read_schema(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


NEEDS = {
    "market_trends": {"city", "state", "price", "house_size"},
    "property_type_size": {"bed", "bath", "price"},
    "lot_size_influence": {"acre_lot", "price", "house_size"},
    "broker_performance": {"brokered_by", "price"},
    "status_analysis": {"status", "price", "house_size"},
    "time_yearly": {"prev_sold_date", "price"},
}


@pytest.mark.parametrize("name", sorted(NEEDS))
def test_reports_read_only_their_columns(sample_parquet, name):
    for kwargs in ({}, {"median": "approx"}) if name == "market_trends" else ({},):
        schemas = read_schema(REPORTS[name](sample_parquet, **kwargs))
        assert schemas
        for s in schemas:
            cols = {f.split(":")[0] for f in s.split(",")}
            assert cols <= NEEDS[name], (name, cols)


def test_exact_median_carries_only_group_and_price(sample_parquet, monkeypatch):
    from rowmill.operators import reports
    monkeypatch.setattr(reports, "stored", lambda *a: pytest.fail("the report stored a copy"))
    df = REPORTS["market_trends"](sample_parquet)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan or plan.count("rangepartitioning") == 1  # one range-partitioned table, two readers
    assert not any("house_size" in line and "rangepartitioning" in line for line in plan.splitlines())


def test_few_splits_are_spread_before_the_key_clean_up(spark, sample_parquet, monkeypatch):
    from rowmill.plans import end_to_end as P
    assert "RoundRobinPartitioning" in P.spread(sample_parquet)._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")  # many splits
        assert P.spread(sample_parquet) is sample_parquet
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_null_key_filter_is_pushed_to_the_scan(sample_parquet):
    plan = dedup(sample_parquet, ["city", "zip_code"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(city), IsNotNull(zip_code)]" in plan


def test_quality_report_key_scan_reads_only_the_keys(sample_parquet):
    plan = quality_report(sample_parquet)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<street:string,city:string,state:string,zip_code:string>" in plan


def test_streaming_batch_replay_is_idempotent(spark, sample, tmp_path):
    from rowmill.operators import annotate
    root = str(tmp_path / "out")
    write = _write_batch(root)
    batch = annotate(sample)
    write(batch, 7)
    write(batch, 7)  # a replay of the same batch after a failure replaces its output
    assert spark.read.parquet(f"{root}/valid").count() == sample.count()


def test_bucketed_table_dedups_without_exchange(spark, sample, tmp_path):
    from rowmill.plans.publish import save_table
    keys = ["city", "state"]
    save_table(sample, "bucketed_listings", str(tmp_path / "bucketed"), bucket_by=(4, keys))
    t = spark.table("bucketed_listings")
    plan = dedup(t, keys)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert dedup(t, keys).count() == 10
    q = quality_report(t, QualitySpec(unique_keys=keys))
    assert "Exchange hashpartitioning" not in q._jdf.queryExecution().executedPlan().toString()


def test_quality_report_job_count(spark, sample_parquet):
    # the original ran one action (a full scan) per check; here the whole report is one
    # query: with AQE every query stage is its own job
    sc = spark.sparkContext
    sc.setJobGroup("rowmill-quality-jobs", "quality report job count")
    try:
        quality_report(sample_parquet).collect()
        jobs = sc.statusTracker().getJobIdsForGroup("rowmill-quality-jobs")
    finally:
        sc.setJobGroup(None, None)
    assert 1 <= len(jobs) <= 5


def test_doubled_listings_are_joined_once(spark):
    from rowmill.plans import fixtures as X
    dirty = X.listings_dirty(spark, SF_SMALL)
    assert dirty._jdf.queryExecution().executedPlan().toString().count("ReadSchema: struct<l_orderkey") == 1
    sql = spark.sql(X.LISTINGS_DIRTY_TEMPLATE, listings=X.listings(spark, SF_SMALL))
    assert dirty.schema.simpleString() == sql.schema.simpleString() and rows(dirty) == rows(sql)


def test_files_that_spark_cuts_for_all_cores_are_not_shuffled(sample_parquet, monkeypatch):
    from rowmill.plans import end_to_end as P
    monkeypatch.setattr(P, "SPREAD_BYTES", 100, raising=False)
    assert P.spread(sample_parquet) is sample_parquet


def test_dedup_sorts_by_one_number_first(spark, sample_parquet):
    from rowmill.operators.dedup import dedup_by_join
    from rowmill.plans.end_to_end import key_normalizer
    plan = dedup(sample_parquet, ["city", "zip_code"], match_on=key_normalizer)._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if " Sort [" in line]
    assert len(sorts) == 2 and all("Sort [__rowmill_hash" in line for line in sorts)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for nulls in ("drop", "group"):
            plan = dedup_by_join(sample_parquet, ["city", "zip_code"], null_keys=nulls)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin [__rowmill_rid" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_pass_converts_exact_values_before_the_copies(sample_parquet, monkeypatch):
    from rowmill.operators import reports
    taken = []
    monkeypatch.setattr(reports, "stored", lambda df, name: taken.append(df) or df)
    reports.reports_one_pass(sample_parquet, scale=2)
    plan = taken[0]._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Expand")]
    assert "price" not in above or "cast(__price" not in above.replace("try_", "")
    assert "__p_small" in above
