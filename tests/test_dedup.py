import pytest

from rowmill.functions import clean_text
from rowmill.operators import dedup, dedup_by_join, detect_keys
from tests.conftest import rows


@pytest.fixture
def keyed(spark):
    return spark.createDataFrame(
        [("a", None, 1), ("a", None, 2), ("b", "x", 3), ("b", "x", 4)], "k string, k2 string, v int"
    )


def test_null_key_modes(keyed):
    assert rows(dedup(keyed, ["k", "k2"])) == [("b", "x", 3)]
    assert rows(dedup(keyed, ["k", "k2"], null_keys="group")) == [("a", None, 1), ("b", "x", 3)]
    assert rows(dedup(keyed, ["k", "k2"], null_keys="keep")) == [("a", None, 1), ("a", None, 2), ("b", "x", 3)]


def test_join_form_matches_window_form(keyed):
    assert rows(dedup_by_join(keyed, ["k", "k2"])) == rows(dedup(keyed, ["k", "k2"]))
    assert rows(dedup_by_join(keyed, ["k", "k2"], null_keys="group")) == rows(dedup(keyed, ["k", "k2"], null_keys="group"))


def test_order_by_and_column_order(keyed):
    out = dedup(keyed, ["k"], order_by=["v"], null_keys="group")
    assert out.columns == ["k", "k2", "v"]
    from pyspark.sql import functions as F
    assert rows(dedup(keyed, ["k"], order_by=[-F.col("v")])) == [("a", None, 2), ("b", "x", 4)]


def test_idempotent_and_unique(sample):
    keys = ["street", "city", "state", "zip_code"]
    once = dedup(sample, keys)
    assert once.count() == 10
    assert rows(dedup(once, keys)) == rows(once)


def test_match_on_normalized_keys_keeps_original_values(spark):
    df = spark.createDataFrame([("  Main St.", 2), ("main st", 1)], "street string, v int")
    out = dedup(df, ["street"], match_on=lambda c: clean_text(c, True, True, True, True))
    assert rows(out) == [("main st", 1)]


def test_missing_keys(keyed):
    with pytest.raises(ValueError):
        dedup(keyed, [])
    assert dedup(keyed, [], on_missing_keys="skip") is keyed
    with pytest.raises(ValueError):
        dedup(keyed, ["nope"])


def test_detect_keys(spark):
    def cols(*names):
        return spark.createDataFrame([], ", ".join(f"{n} string" for n in names))
    assert detect_keys(cols("MLS_ID", "street")) == ["MLS_ID"]
    assert detect_keys(cols("address", "zipcode", "city")) == ["address", "zipcode"]
    assert detect_keys(cols("address", "city", "state")) == ["address", "city", "state"]
    assert detect_keys(cols("address", "city", "state", "zip")) == ["address", "city", "state", "zip"]
    assert detect_keys(cols("address", "street", "city", "state", "zip_code")) == ["street", "city", "state", "zip_code"]
    assert detect_keys(cols("street", "city", "state", "zip_code")) == ["street", "city", "state", "zip_code"]
    assert detect_keys(cols("foo"), required=False) == []
    with pytest.raises(ValueError):
        detect_keys(cols("foo"))


def test_plan_single_exchange_with_map_side_limit(sample):
    plan = dedup(sample, ["city"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in plan


def test_hot_key_is_reduced_before_the_shuffle(spark):
    # one key holding most rows: the partial limit leaves at most one row per input partition
    df = spark.range(0, 20000, 1, 8).selectExpr("case when id % 3 = 0 then id else 0 end as k", "id as v")
    out = dedup(df, ["k"])
    assert out.filter("k = 0").collect()[0]["v"] == 0
    assert out.count() == df.selectExpr("k").distinct().count()


def test_descending_order_keeps_latest(spark):
    import datetime as dt
    df = spark.createDataFrame(
        [(1, "u", dt.datetime(2024, 1, 1)), (2, "u", dt.datetime(2024, 1, 3)), (3, "u", None), (4, "v", None)],
        "id int, user string, ts timestamp",
    )
    assert rows(dedup(df, ["user"], order_by=["-ts", "id"]).select("user", "id")) == [("u", 2), ("v", 4)]
    with pytest.raises(ValueError):
        dedup_by_join(df, ["user"], order_by=["-ts"])


def test_physical_order_keeps_first_scanned_row(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), ("a", 2)], "k string, v int").coalesce(1)
    assert rows(dedup(df, ["k"], order_by="physical")) == [("a", 3), ("b", 2)]


def test_join_form_physical_order_and_odd_names(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "`key col` string, `v.x` int").coalesce(1)
    assert rows(dedup_by_join(df, ["key col"], order_by="physical")) == [("a", 3), ("b", 2)]
    assert rows(dedup_by_join(df, ["key col"])) == [("a", 1), ("b", 2)]
    assert rows(dedup(df, ["key col"], order_by=["v.x"])) == [("a", 1), ("b", 2)]
    assert rows(dedup(df, ["key col"], order_by=["-v.x"])) == [("a", 3), ("b", 2)]
    assert dedup(df, ["key col"]).columns == ["key col", "v.x"]


def test_join_form_on_unrepeatable_input(spark):
    df = spark.range(0, 5000, 1, 4).selectExpr("id % 50 as k", "id as v").repartition(7)  # round-robin order
    out = dedup_by_join(df, ["k"])
    assert out.count() == 50 and rows(out) == rows(dedup(df, ["k"]))


def test_join_form_survives_without_broadcast_under_aqe(spark):
    """Counts, keys and rows agree with the window form when nothing is small enough to broadcast."""
    from rowmill.plans.fixtures import listings
    from tests.conftest import SF_SMALL
    keys = ["city", "state", "zip_code"]
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for nulls in ("drop", "group"):
            want = dedup(listings(spark, SF_SMALL), keys, null_keys=nulls)
            n = want.count()
            assert dedup_by_join(listings(spark, SF_SMALL), keys, null_keys=nulls).count() == n > 0
            assert dedup_by_join(listings(spark, SF_SMALL), keys, null_keys=nulls).select(*keys).count() == n
            assert rows(dedup_by_join(listings(spark, SF_SMALL), keys, null_keys=nulls)) == rows(want)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
