import pytest

from rowmill.cli import main


@pytest.fixture
def root(tmp_path, sample_csv):
    raw = tmp_path / "raw" / "usa-real-estate"
    raw.mkdir(parents=True)
    (raw / "sample.csv").write_text(open(sample_csv).read())
    return str(tmp_path)


def test_stage_chain(spark, root, tmp_path):
    assert main(["ingest", "--root", root], spark)["rows"] == 10
    out = main(["cleanse", "--root", root, "--keys", "street,city,state,zip_code", "--lowercase",
                "--write-output"], spark)
    assert out["rows"] == 10
    assert main(["cleanse", "--root", root, "--auto-keys", "--method", "join"], spark)["keys"] == [
        "street", "city", "state", "zip_code"]
    routed = main(["route", "--root", root, "--write-output", "--coalesce", "1"], spark)
    assert routed["segments"] == {"luxury": 2, "family": 2, "standard": 6}
    reps = main(["aggregate", "--root", root, "--run-all-presets", "--write-output"], spark)
    assert reps["groups"]["time_yearly"] == 9 and set(reps["paths"]) == {
        "market_trends", "property_type_size", "lot_size_influence", "broker_performance", "status_analysis",
        "time_yearly"}
    gen = main(["aggregate", "--root", root, "--group-by", "segment,state", "--metrics",
                "price:sum,price:min,price:max,price:avg,house_size:avg"], spark)
    assert gen["groups"] == 10
    val = main(["validate", "--root", root, "--zip-numeric", "--write-output"], spark)
    assert (val["total"], val["valid"], val["invalid"]) == (10, 9, 1)  # 03801 was inferred as 3801
    assert val["sample_invalid"][0]["validation_errors"] == ["zip_wrong_length"]
    fixed = main(["validate", "--root", root, "--zip-numeric", "--zip-normalize"], spark)
    assert (fixed["valid"], fixed["zip_changed_rows"]) == (10, 1)
    q = main(["quality", "--root", root, "--write-output", "--print-all"], spark)
    assert q["summary"] == {"total_rows": 10, "passed": 11, "failed": 0}
    t = main(["throughput", "--root", root, "--sizes", "5,-1", "--keys", "street,city,state,zip_code",
              "--write-output"], spark)
    assert len(t["metrics"]) == 8
    p = main(["persist", "--root", root, "--refresh-all", "--location", str(tmp_path / "tables")], spark)
    assert "market_trends" in p["tables"] and spark.table("market_trends").count() == 10


def test_cleanse_needs_keys(spark, root):
    with pytest.raises(SystemExit):
        main(["cleanse", "--root", root], spark)
    with pytest.raises(SystemExit):
        main(["aggregate", "--root", root], spark)


def test_take_is_ordered_and_parallel(spark, root):
    from rowmill.cli import _limit
    from rowmill.sources import read_csv
    df = read_csv(spark, root + "/raw/usa-real-estate/*.csv")
    small = _limit(df, 3)
    assert small.count() == 3 and small.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r["street"] for r in small.collect()) == ["1200 Bluebonnet Dr", "17 Harbor Way", "2204 Mesa Trail"]


def test_cleanse_normalisation_scope(spark, root):
    main(["cleanse", "--root", root, "--keys", "street,city,state,zip_code", "--lowercase", "--columns", "city",
          "--write-output"], spark)
    out = spark.read.parquet(root + "/processed/cleanse_dedup/parquet")
    assert out.filter("city = 'portsmouth'").count() == 1 and out.filter("state = 'NH'").count() == 1
    main(["cleanse", "--root", root, "--keys", "street,city,state,zip_code", "--lowercase", "--strip-punct",
          "--keep-original-values", "--write-output"], spark)
    out = spark.read.parquet(root + "/processed/cleanse_dedup/parquet")
    assert out.count() == 10 and out.filter("city = 'Portsmouth'").count() == 1


def test_price_bounds_can_be_disabled(spark, root):
    main(["cleanse", "--root", root, "--keys", "street", "--write-output"], spark)
    strict = main(["validate", "--root", root, "--min-price", "1000000", "--zip-col", "none"], spark)
    assert strict["invalid"] == 8
    off = main(["validate", "--root", root, "--min-price", "none", "--zip-col", "none"], spark)
    assert off["invalid"] == 0


def test_cleanse_join_after_take(spark, root):
    out = main(["cleanse", "--root", root, "--keys", "street,city,state,zip_code", "--method", "join",
                "--take", "7"], spark)
    assert out["rows"] == 7


def test_ingest_csv_flags(spark, root, tmp_path):
    from tests.conftest import SAMPLE_HEADER, SAMPLE_ROWS
    piped = tmp_path / "piped.csv"
    piped.write_text("\n".join(r.replace(",", "|") for r in [SAMPLE_HEADER, *SAMPLE_ROWS]))
    out = main(["ingest", "--input", str(piped), "--delimiter", "|", "--no-header", "--no-infer-schema",
                "--take", "3"], spark)
    assert out["rows"] == 3 and set(out["sample"][0]) == {f"_c{i}" for i in range(12)}
    assert all(isinstance(v, str) for v in out["sample"][0].values())
