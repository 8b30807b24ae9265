import pytest
from pyspark.sql import functions as F

from rowmill.operators import (
    QualitySpec, ValidationSpec, annotate, error_counts, invalid_sample, normalize_zip, parse_thresholds,
    quality_report, quality_summary, split, validation_counts, zip_changes,
)
from rowmill.operators.quality import report_to_dict
from tests.conftest import rows


def test_validation_on_sample_zip_inferred_as_int(spark, sample_csv):
    inferred = spark.read.option("header", "true").option("inferSchema", "true").csv(sample_csv)
    assert inferred.schema["zip_code"].dataType.simpleString() == "int"
    ann = annotate(inferred)
    c = validation_counts(ann).first()
    assert (c["total"], c["valid"], c["invalid"]) == (10, 9, 1)
    bad = invalid_sample(ann).first()
    assert bad["validation_errors"] == ["zip_wrong_length"] and bad["city"] == "Portsmouth"
    assert zip_changes(inferred).first()["changed_rows"] == 1
    fixed = annotate(normalize_zip(inferred))
    assert validation_counts(fixed).first()["valid"] == 10


def test_validation_on_sample_zip_as_text(sample):
    c = validation_counts(annotate(sample)).first()
    assert (c["valid"], c["invalid"]) == (10, 0)


def test_rules_and_error_order(spark):
    df = spark.createDataFrame(
        [(None, "-5", "2.5", "12a45", "x"), ("  ", "10", "3", "123", "-3"), ("ok", "7", None, "02108", None)],
        "street string, price string, bath string, zip_code string, bed string",
    )
    spec = ValidationSpec(required=("street", "lot"), max_value=8.0, zip_numeric=True, nonneg=("price",),
                          integers=("bath", "bed"))
    got = [r["validation_errors"] for r in annotate(df, spec).collect()]
    assert got[0] == ["required_empty:street", "missing_column:lot", "price_below_min", "negative:price",
                      "not_integer:bath", "not_integer:bed", "zip_non_numeric", "zip_wrong_length"]
    assert got[1] == ["required_empty:street", "missing_column:lot", "price_above_max", "not_integer:bed",
                      "zip_wrong_length"]
    assert got[2] == ["missing_column:lot"]


def test_split_is_disjoint_and_complete(sample):
    ann = annotate(sample.withColumn("price", F.when(F.col("city") == "Mobile", F.lit(-1.0)).otherwise(F.col("price"))))
    valid, invalid = split(ann)
    assert valid.count() + invalid.count() == sample.count()
    assert rows(error_counts(ann)) == [("negative:price", 1), ("price_below_min", 1)]
    assert ann.schema["validation_errors"].dataType.simpleString() == "array<string>"


def test_numeric_integer_rule_on_doubles(spark):
    df = spark.createDataFrame([(2.0,), (2.5,), (None,), (float("nan"),)], "bath double")
    spec = ValidationSpec(required=(), range_column=None, zip_column=None, nonneg=(), integers=("bath",))
    assert [r[0] for r in annotate(df, spec).select("is_valid").collect()] == [True, False, True, False]


def test_quality_report_defaults(sample):
    rep = quality_report(sample)
    d = report_to_dict(rep)
    assert d["summary"] == {"total_rows": 10, "passed": 11, "failed": 0}
    assert [c["check"] for c in d["checks"]][:2] == ["required_non_null:street", "required_non_null:city"]
    s = quality_summary(rep).first()
    assert s["passed"] + s["failed"] == rep.count()


def test_quality_failures_and_missing(spark):
    df = spark.createDataFrame(
        [("a", None, -1.0), ("a", "x", 5.0), ("", "y", None)], "street string, status string, price double"
    )
    spec = QualitySpec(required=("street", "zip"), unique_keys=("street",), minimum={"price": 0.0},
                       maximum={"price": 4.0}, max_null_fraction={"status": 0.2, "absent": 0.1})
    got = {r["check"]: r for r in quality_report(df, spec).collect()}
    assert got["required_non_null:street"]["nulls"] == 1 and got["required_non_null:street"]["fraction"] == 0.333333
    assert got["required_present:zip"]["status"] == "fail"
    assert got["null_rate:status"]["status"] == "fail"
    assert "null_rate:absent" not in got
    assert got["min:price"]["out_of_range"] == 1 and got["max:price"]["out_of_range"] == 1
    assert got["unique_keys:street"]["duplicate_key_groups"] == 1


def test_quality_empty_table(spark):
    df = spark.createDataFrame([], "street string, city string, state string, zip_code string, price double")
    got = {r["check"]: r for r in quality_report(df).collect()}
    assert got["required_non_null:street"]["fraction"] == 0.0 and got["unique_keys:street,city,state,zip_code"]["status"] == "pass"


def test_quality_shuffles_only_keys_and_a_count(sample):
    plan = quality_report(sample)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    partial = [x for x in plan.splitlines() if "HashAggregate(keys=[street" in x and "partial_count" in x]
    assert len(partial) == 1 and partial[0].count("partial_") == 1


def test_blank_test_leaves_other_types_alone(sample):
    plan = quality_report(sample)._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(price" not in plan and "trim(street" in plan


def test_parse_thresholds():
    assert parse_thresholds("price:0, house size : -1.5e2 ,") == {"price": 0.0, "house size": -150.0}
    assert parse_thresholds("") == {}
    with pytest.raises(ValueError, match=r"\['junk', 'b:x'\]"):
        parse_thresholds("price:0,junk,b:x")


def test_coercion_rule_reports_unparsable_text(spark):
    df = spark.createDataFrame([("12",), ("12a",), (None,), (" 7 ",)], "p string")
    spec = ValidationSpec(required=(), range_column=None, zip_column=None, nonneg=(), integers=(), numeric=("p",))
    assert [r[0] for r in annotate(df, spec).select("validation_errors").collect()] == [[], ["not_numeric:p"], [], []]
