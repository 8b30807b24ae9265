import glob

import pytest

from rowmill.operators import annotate
from rowmill.plans.publish import publish_tables
from rowmill.sinks import shared_dir, write_named, write_split, write_table
from rowmill.sources import first_existing, read_csv, read_table, resolve_paths
from rowmill.sources.files import csv_headers
from tests.conftest import SAMPLE_HEADER, SAMPLE_ROWS


def test_csv_options(spark, sample_csv, tmp_path):
    inferred = read_csv(spark, sample_csv)
    assert inferred.count() == 10 and inferred.schema["prev_sold_date"].dataType.simpleString() == "date"
    strings = read_csv(spark, sample_csv, infer_schema=False)
    assert {f.dataType.simpleString() for f in strings.schema.fields} == {"string"}
    assert strings.filter("city = 'Portsmouth'").first()["zip_code"] == "03801"
    no_header = read_csv(spark, sample_csv, header=False, infer_schema=False)
    assert no_header.columns[:2] == ["_c0", "_c1"] and no_header.count() == 11
    piped = tmp_path / "piped.csv"
    piped.write_text("\n".join(x.replace(",", "|") for x in [SAMPLE_HEADER, *SAMPLE_ROWS]))
    assert read_csv(spark, str(piped), delimiter="|").columns == inferred.columns


def test_multi_path_and_globs(spark, sample_csv, tmp_path):
    other = tmp_path / "b.csv"
    other.write_text("\n".join([SAMPLE_HEADER, *SAMPLE_ROWS[:3]]))
    assert read_csv(spark, [sample_csv, str(other)]).count() == 13
    assert resolve_paths(str(tmp_path / "*.csv")) == [str(other)]
    assert resolve_paths(f"file://{tmp_path}/*.csv") == [f"file:{other}"]
    with pytest.raises(FileNotFoundError):
        resolve_paths(str(tmp_path / "*.nothing"))
    with pytest.raises(FileNotFoundError):
        first_existing([str(tmp_path / "x"), str(tmp_path / "y")])
    assert first_existing([str(tmp_path / "x"), sample_csv]) == sample_csv


def test_write_and_format_rule(spark, sample, tmp_path):
    root = str(tmp_path / "out")
    paths = write_table(sample, root)
    assert read_table(spark, paths["parquet"]).count() == 10  # one directory -> parquet
    assert read_table(spark, paths["csv"] + "/*.csv").count() == 10  # a glob of files -> csv
    one = write_table(sample.repartition(4), str(tmp_path / "one"), formats=("parquet",), coalesce=1)
    assert len(glob.glob(one["parquet"] + "/*.parquet")) == 1
    many = write_table(sample.repartition(4), str(tmp_path / "many"), formats=("parquet",))
    assert len(glob.glob(many["parquet"] + "/*.parquet")) == 4


def test_split_sink_arrays_in_csv(spark, sample, tmp_path):
    out = write_split(annotate(sample), str(tmp_path / "v"))
    assert set(out) == {"valid", "invalid"}
    back = spark.read.parquet(out["valid"]["parquet"])
    assert back.schema["validation_errors"].dataType.simpleString() == "array<string>"
    assert spark.read.option("header", "true").csv(out["valid"]["csv"]).count() == 10
    named = write_named({"a": sample, "b": sample.limit(1)}, str(tmp_path / "n"), formats=("csv",))
    assert sorted(named) == ["a", "b"]


def test_partitioned_output(spark, sample, tmp_path):
    p = write_table(sample, str(tmp_path / "p"), formats=("parquet",), partition_by=["state"])["parquet"]
    assert len(glob.glob(p + "/state=*")) == 10
    pruned = spark.read.parquet(p).filter("state = 'NM'")
    assert "PartitionFilters: [isnotnull(state" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 1


def test_shared_dir_uses_checkpoint_conf(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    d = shared_dir(spark, "t")
    assert d != shared_dir(spark, "t") and "/rowmill-" in d and "/t-" in d
    if configured:
        assert d.startswith(configured.rstrip("/"))


def test_publish_tables(spark, sample, tmp_path, capsys):
    root = str(tmp_path / "outputs")
    write_table(sample, root + "/routed", formats=("parquet",))
    written = publish_tables(spark, root, ["routed", "nope"], location=str(tmp_path / "tables"), prefix="t_")
    assert written == ["t_routed"] and "skipping unknown table 'nope'" in capsys.readouterr().out
    assert spark.table("t_routed").count() == 10
    publish_tables(spark, root, ["routed"], location=str(tmp_path / "tables"), prefix="t_")
    assert spark.table("t_routed").count() == 10


def test_upstream_fallback(spark, tmp_path, sample_csv):
    from rowmill.sources import upstream_input
    raw = tmp_path / "raw" / "usa-real-estate"
    raw.mkdir(parents=True)
    (raw / "a.csv").write_text(open(sample_csv).read())
    assert upstream_input(str(tmp_path)).endswith("raw/usa-real-estate/*.csv")
    (tmp_path / "processed" / "cleanse_dedup" / "parquet").mkdir(parents=True)
    assert upstream_input(str(tmp_path)).endswith("processed/cleanse_dedup/parquet")
    (tmp_path / "processed" / "routed" / "parquet").mkdir(parents=True)
    assert upstream_input(str(tmp_path)).endswith("processed/routed/parquet")
    assert upstream_input(str(tmp_path), "route").endswith("processed/cleanse_dedup/parquet")
    with pytest.raises(FileNotFoundError):
        upstream_input(str(tmp_path / "empty"))


def test_report_sinks(spark, sample, tmp_path):
    from rowmill.operators import quality_report
    from rowmill.plans.throughput import measure
    from rowmill.sinks import write_report
    q = write_report(quality_report(sample), str(tmp_path / "quality"))
    assert len(glob.glob(q["json"] + "/*.json")) == 1
    assert spark.read.json(q["json"]).count() == 11
    t = write_report(measure(spark, sample, keys=["street"]), str(tmp_path / "metrics"))
    assert spark.read.option("header", "true").csv(t["csv"]).count() == 4


def test_partitioned_write_is_rebalanced(spark, tmp_path):
    from pyspark.sql import functions as F
    # one partition value holds a third of the rows, spread over 16 input partitions
    df = spark.range(0, 30000, 1, 16).withColumn("state", F.when(F.col("id") % 3 == 0, "HOT").otherwise(
        F.concat(F.lit("S"), (F.col("id") % 7).cast("string"))))
    p = write_table(df, str(tmp_path / "r"), formats=("parquet",), partition_by=["state"])["parquet"]
    files = glob.glob(p + "/state=*/*.parquet")
    assert len(files) < 16 * 8  # far fewer than tasks x values
    assert spark.read.parquet(p).count() == 30000


def test_reader_options_and_compression(spark, tmp_path, sample):
    p = tmp_path / "quoted.csv"
    p.write_text('a;b\n"x;1";2\n')
    df = read_csv(spark, str(p), delimiter=";", options={"quote": '"', "mode": "FAILFAST"})
    assert tuple(df.first()) == ("x;1", 2)
    out = write_table(sample, str(tmp_path / "z"), formats=("parquet",), compression="zstd")
    assert glob.glob(out["parquet"] + "/*.zstd.parquet")


def test_publish_bucketed(spark, sample, tmp_path):
    root = str(tmp_path / "outputs")
    write_table(sample, root + "/routed", formats=("parquet",))
    publish_tables(spark, root, ["routed"], location=str(tmp_path / "tables"), prefix="b_",
                   buckets={"routed": (4, ["city", "state"])})
    t = spark.table("b_routed")
    assert t.count() == 10
    plan = t.groupBy("city", "state").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # already partitioned by the bucket columns


def test_uris_and_folders_of_either_format(spark, sample, tmp_path):
    paths = write_table(sample, f"file://{tmp_path}/b")
    import os
    os.rename(f"{tmp_path}/b/parquet", f"{tmp_path}/b/routed")  # no telling suffix
    for uri in (f"file://{tmp_path}/b/routed", f"file:{tmp_path}/b/routed", f"{tmp_path}/b/routed"):
        assert read_table(spark, uri).schema == sample.schema and read_table(spark, uri).count() == 10
    assert read_table(spark, paths["csv"]).count() == 10  # a folder of CSV files
    with pytest.raises(FileNotFoundError):
        first_existing([f"file://{tmp_path}/none", f"file:{tmp_path}/nor/this*"])
    assert first_existing([f"file://{tmp_path}/none", f"file:{tmp_path}/b/routed"]) == f"file:{tmp_path}/b/routed"


def test_no_local_scratch_off_local_masters(spark, monkeypatch):
    from types import SimpleNamespace

    from rowmill.sinks import scratch
    monkeypatch.setattr(scratch, "_configured", lambda s: None)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch.shared_dir(SimpleNamespace(sparkContext=SimpleNamespace(master=master)))


def counted(spark, df):
    """``df`` with an accumulator that counts how often its rows are computed."""
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return df.mapInArrow(touch, df.schema), seen


def test_each_write_runs_the_plan_once(spark, sample, tmp_path):
    from rowmill.streaming.split import _write_batch
    df, seen = counted(spark, sample)
    write_table(df, str(tmp_path / "two"))
    assert seen.value == 10
    df, seen = counted(spark, sample)
    write_table(df, str(tmp_path / "text"), formats=("json", "csv"))
    assert seen.value == 10
    df, seen = counted(spark, sample)
    write_split(annotate(df), str(tmp_path / "split"))
    assert seen.value == 10
    df, seen = counted(spark, sample)
    _write_batch(str(tmp_path / "batch"))(annotate(df), 0)
    assert seen.value == 10


def test_partitioned_csv_equals_parquet(spark, sample, tmp_path):
    p = write_table(sample, str(tmp_path / "p"), partition_by=["bed"])
    back = read_csv(spark, p["csv"], schema=sample.schema).select(*sample.columns)
    assert sorted(back.collect()) == sorted(sample.collect())


def test_csv_headers_sorts_no_lines(spark, tmp_path):
    """Only line numbers are aggregated: an aggregate over the text would hold and sort every line of a split."""
    for k in range(5):
        (tmp_path / f"{k}.csv").write_text("\n" * k + f"a,c{k}\n" + f"{k},x\n" * 50)
    (tmp_path / "empty.csv").write_text("")
    headers = csv_headers(spark, str(tmp_path))
    assert "SortAggregate" not in headers._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["path"].rpartition("/")[2], r["header"]) for r in headers.collect()) == [(f"{k}.csv", f"a,c{k}") for k in range(5)]
