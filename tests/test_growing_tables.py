"""Published versions, two-level uniqueness, mergeable checks and sketches, streaming dedup, split and sized writes."""

import glob
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowmill.operators import (
    QualitySpec, QualityStore, annotate, check_state, dedup, duplicate_groups, merge_sketches, merge_states, quality_report,
    quantile_of, quantile_sketches, rank_errors, report_from_state,
)
from rowmill.plans.publish import publish_tables, publish_version, save_table, versions
from rowmill.sinks import shared_dir, write_sized, write_split, write_table
from rowmill.streaming import compact, dedup_stream, winners
from tests.conftest import rows


# ---- published versions


def test_readers_keep_the_version_they_planned(spark, tmp_path):
    name, root = "versioned_a", str(tmp_path / "t")
    publish_version(spark.range(3), name, root)
    first = spark.table(name)
    publish_version(spark.range(10, 14).withColumn("more", F.lit("x")), name, root)
    assert sorted(r[0] for r in first.collect()) == [0, 1, 2]  # planned before the swap
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 4
    assert len(versions(spark, name)) == 2 and len(glob.glob(root + "/v*")) == 2
    publish_version(spark.range(1), name, root)
    assert [v.split("__v")[1][:6] for v in versions(spark, name)] == ["000002", "000003"]
    assert [os.path.basename(x)[:7] for x in sorted(glob.glob(root + "/v*"))] == ["v000002", "v000003"]
    publish_version(spark.range(2), name, root, keep=1)
    assert len(versions(spark, name)) == 1 and spark.table(name).count() == 2
    with pytest.raises(ValueError):
        publish_version(spark.range(1), name, root, keep=0)


def test_a_failed_write_changes_nothing(spark, tmp_path):
    name, root = "versioned_b", str(tmp_path / "t")
    publish_version(spark.range(5), name, root)
    before = versions(spark, name)
    bad = spark.range(100, 200).withColumn("id", F.when(F.col("id") > 150, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        publish_version(bad, name, root)
    assert versions(spark, name) == before and spark.table(name).count() == 5
    assert [os.path.basename(x)[:7] for x in glob.glob(root + "/*")] == ["v000001"]
    publish_version(spark.range(6), name, root)  # and the next one works
    assert spark.table(name).count() == 6


def test_a_table_of_that_name_gives_way(spark, sample, tmp_path):
    save_table(sample, "versioned_c", str(tmp_path / "old"))
    root = str(tmp_path / "outputs")
    write_table(sample.limit(4), root + "/routed", formats=("parquet",))
    publish_tables(spark, root, ["routed"], prefix="x_")
    assert spark.table("x_routed").count() == 4
    publish_version(sample.limit(2), "versioned_c")
    assert spark.table("versioned_c").count() == 2
    assert versions(spark, "versioned") == []  # names that begin alike aren't mixed up


# ---- uniqueness in two levels


def test_two_levels_find_what_one_finds(spark):
    rng = random.Random(5)
    data = [(rng.choice([None, "a", "b", "c" * 500]), rng.choice([None, *range(300)]), rng.random()) for _ in range(3000)] + [("hot", 1, 0.0)] * 1500
    df = spark.createDataFrame(data, "`my key` string, k int, v double").repartition(5)
    keys = ["my key", "k"]
    want = {k: n for k, n in Counter((a, b) for a, b, _ in data).items() if n > 1}
    for wide in (False, True):
        assert {(r[0], r[1]): r["count"] for r in duplicate_groups(df, keys, wide_keys=wide).collect()} == want
        spec = QualitySpec(required=(), unique_keys=keys, minimum={}, max_null_fraction={}, wide_keys=wide)
        assert quality_report(df, spec).first()["duplicate_key_groups"] == len(want)
    assert duplicate_groups(df.where("k < 0"), keys, wide_keys=True).count() == 0


def test_first_level_shuffles_hashes_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000).select(F.concat(F.repeat(F.lit("x"), 300), F.col("id").cast("string")).alias("text")).write.parquet(path)
    df = spark.read.parquet(path)
    out = duplicate_groups(df, ["text"], wide_keys=True)
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "SortMergeJoin" in plan
    assert "hashpartitioning(__rowmill_hash" in plan


# ---- mergeable checks


def test_states_add_up(spark, sample):
    data = sample.unionByName(sample.limit(3)).withColumn("status", F.when(F.col("bed") > 2, F.col("status")))
    parts = [data.where("bed <= 2"), data.where("bed = 3"), data.where("bed > 3")]
    for spec in (QualitySpec(), QualitySpec(required=("street", "none"), unique_keys=("city",), maximum={"price": 5e5}), QualitySpec(unique_keys=("none",))):
        want = rows(quality_report(data, spec))
        states = [check_state(p, spec) for p in parts]
        assert rows(report_from_state(merge_states(states), data.columns, spec)) == want
        assert rows(report_from_state(states[0].unionByName(states[2]).unionByName(states[1]), data.columns, spec)) == want


def test_store_reads_no_increment_twice(spark, sample, tmp_path):
    store = QualityStore(spark, str(tmp_path / "state"), sample.columns)
    assert rows(store.report()) == rows(quality_report(sample.limit(0)))
    store.add("2024-01", sample.where("price < 500000"))
    source = str(tmp_path / "increment")
    sample.where("price >= 500000").write.parquet(source)
    store.add("2024-02", spark.read.parquet(source))
    os.rename(source, source + "-gone")  # its rows can't be read again
    assert rows(store.report()) == rows(quality_report(sample))
    store.add("2024-01", sample.where("price < 500000"))  # again: replaced, not counted twice
    assert rows(store.report()) == rows(quality_report(sample))
    store.add("copies", sample)
    assert store.report().where("check like 'unique%'").first()["duplicate_key_groups"] == 10
    store.drop("copies")
    assert rows(store.report()) == rows(quality_report(sample))
    with pytest.raises(ValueError):
        store.add("a/b", sample)
    with pytest.raises(ValueError):
        store.add("x", sample.drop("price"))


# ---- sketches


def test_merged_sketches_stay_within_the_error(spark):
    df = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
        F.when(F.col("id") % 17 > 0, F.pow((F.hash("id") % 1000).cast("double"), 3)).alias("v"))
    parts = [quantile_sketches(df.where(F.col("v") < 0), ["g"], "v"), quantile_sketches(df.where(F.col("v") >= 0), ["g"], "v"), quantile_sketches(df.limit(0), ["g"], "v")]
    merged = merge_sketches(parts, ["g"])
    assert {r["g"]: r["n"] for r in merged.collect()} == {r["g"]: r["n"] for r in df.where("v is not null").groupBy("g").agg(F.count("v").alias("n")).collect()}
    for p in (0.0, 0.1, 0.5, 0.99, 1.0):
        errors = rank_errors(df, ["g"], "v", quantile_of(merged, p, "q"), "q", p).collect()
        assert len(errors) == 7 and max(r["error"] for r in errors) <= 0.01
    bad = merged.select("g", F.lit(0.0).alias("q"))
    assert max(r["error"] for r in rank_errors(df, ["g"], "v", bad, "q", 0.9).collect()) > 0.3  # the check tells errors
    assert merged.agg(F.max(F.length("sketch"))).first()[0] < 20_000


# ---- streaming dedup


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 1, 0, 2]])
def test_batches_in_any_order_give_one_dedup(spark, tmp_path, order):
    rng = random.Random(9)
    data = [(rng.choice([None, "a", "b", "c", "d"]), rng.randrange(6), rng.choice([None, *range(50)]), f"s{rng.randrange(9)}") for _ in range(400)]
    whole = spark.createDataFrame(data, "k string, j int, v int, s string")
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), shared_dir(spark, "dedup-stream")
    for nulls, by in (("drop", None), ("group", ["s"])):
        src, out, ckpt = f"{src}_{nulls}", f"{out}_{nulls}", shared_dir(spark, "dedup-stream")
        for i in order:  # a run for each part: the state lives in the checkpoint
            spark.createDataFrame(data[i * 100 : i * 100 + 100], whole.schema).write.mode("append").parquet(src)
            stream = spark.readStream.schema(whole.schema).parquet(src)
            dedup_stream(stream, ["k", "j"], out, by, nulls, ckpt).awaitTermination()
        want = rows(dedup(whole, ["k", "j"], None if by is None else ["s", "v"], null_keys=nulls))
        got = winners(spark, out, whole.schema, ["k", "j"], by)
        assert rows(got) == want and got.columns == whole.columns
        assert len(glob.glob(out + "/batch=*")) >= 4
        spark.read.parquet(sorted(glob.glob(out + "/batch=*"))[0]).write.parquet(out + "/batch=99")  # a replayed change alters nothing
        assert rows(winners(spark, out, whole.schema, ["k", "j"], by)) == want
        compact(spark, out, whole.schema, ["k", "j"], by)
        assert glob.glob(out + "/*") == [out + "/batch=compacted"] and rows(winners(spark, out, whole.schema, ["k", "j"], by)) == want
    with pytest.raises(ValueError):
        dedup_stream(spark.readStream.schema(whole.schema).parquet(src), ["none"], out)


# ---- split and sized writes


def test_split_writes_rows_once(spark, sample, tmp_path):
    import rowmill.sinks.writers as W
    root = str(tmp_path / "v")
    copies = []
    original, W.stored = W.stored, lambda df, name="": copies.append(name) or original(df, name)
    try:
        mixed = sample.withColumn("price", F.when(F.rand() < 0.5, -1.0).otherwise(F.col("price")))  # a second run would split otherwise
        out = write_split(annotate(mixed), root)
    finally:
        W.stored = original
    valid, invalid = (spark.read.parquet(out[side]["parquet"]) for side in ("valid", "invalid"))
    assert copies == [] and valid.count() + invalid.count() == 10
    assert valid.schema == invalid.schema and valid.columns[-2:] == ["validation_errors", "is_valid"]
    assert rows(valid.select("street").unionByName(invalid.select("street"))) == rows(sample.select("street"))
    assert all(r["is_valid"] for r in valid.collect()) and not any(r["is_valid"] for r in invalid.collect())
    for side, df in (("valid", valid), ("invalid", invalid)):
        assert spark.read.option("header", "true").csv(out[side]["csv"]).count() == df.count()
    assert sorted(x for x in os.listdir(root)) == ["invalid", "valid"]  # nothing of the staging is left


def test_split_with_an_empty_side_and_failures(spark, sample, tmp_path):
    root = str(tmp_path / "v")
    out = write_split(annotate(sample), root, formats=("csv", "parquet"))
    assert spark.read.parquet(out["invalid"]["parquet"]).schema == spark.read.parquet(out["valid"]["parquet"]).schema
    assert spark.read.parquet(out["invalid"]["parquet"]).count() == 0 and list(out["valid"]) == ["csv", "parquet"]
    bad = annotate(sample).withColumn("street", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        write_split(bad, root)
    assert spark.read.parquet(out["valid"]["parquet"]).count() == 10 and sorted(os.listdir(root)) == ["invalid", "valid"]
    only = write_split(annotate(sample), str(tmp_path / "c"), formats=("csv",))
    assert spark.read.option("header", "true").csv(only["valid"]["csv"]).count() == 10


def sizes(path):
    return sorted(os.path.getsize(f) for f in glob.glob(path + "/*.parquet"))


def test_files_are_of_the_size_asked_for(spark, tmp_path):
    path = str(tmp_path / "sized")
    # a third of the rows share one key; sorting compresses it well
    df = spark.range(0, 200_000, 1, 12).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.hash("id") % 1000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("s"), "id")
    n = write_sized(df, path, 1_000_000, ["k"])
    own = sizes(path)
    assert len(own) == n > 8 and all(500_000 <= x <= 2_000_000 for x in own[1:])
    back = spark.read.parquet(path)
    assert back.count() == 200_000 and back.agg(F.sum("id"), F.countDistinct("s")).first()[:] == (sum(range(200_000)), 200_000)
    ranges = sorted((r["a"], r["b"]) for r in back.groupBy(F.input_file_name()).agg(F.min("k").alias("a"), F.max("k").alias("b")).collect())
    assert all(x[1] <= y[0] for x, y in zip(ranges, ranges[1:]))  # files hold ranges of the key
    assert sum(a == b == 7 for a, b in ranges) >= 2  # the hot key fills files of its own
    assert write_sized(df.limit(10), path, 1_000_000) == 1 and spark.read.parquet(path).count() == 10
    assert write_sized(df.limit(0), str(tmp_path / "none"), 1000) == 1 and spark.read.parquet(str(tmp_path / "none")).columns == ["k", "s", "id"]
    with pytest.raises(ValueError):
        write_sized(df, path, 0)
    with pytest.raises(ValueError):
        write_table(df, path, target_bytes=5, partition_by=["k"])
    both = write_table(df, str(tmp_path / "both"), target_bytes=2_000_000, sort_by=["k"])
    assert spark.read.option("header", "true").csv(both["csv"]).count() == 200_000


def test_failed_sized_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_sized(spark.range(5), path, 10_000)
    with pytest.raises(Exception, match="broken"):
        write_sized(spark.range(9).withColumn("id", F.raise_error(F.lit("broken")).cast("long")), path, 10_000)
    assert spark.read.parquet(path).count() == 5 and glob.glob(path + ".sized*") == []
