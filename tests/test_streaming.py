from pyspark.sql import functions as F

from rowmill.operators import annotate, apply_rule_set
from rowmill.sinks import shared_dir
from rowmill.streaming import annotate_stream, split_stream
from tests.conftest import SF_SMALL, rows


def test_stream_split_matches_batch(spark, sample, tmp_path):
    src = str(tmp_path / "src")
    sample.repartition(3).write.parquet(src)
    out = str(tmp_path / "out")
    q = split_stream(annotate_stream(spark, src, sample.schema, max_files_per_trigger=1), out,
                     checkpoint=shared_dir(spark, "test-stream"))
    q.awaitTermination()
    back = spark.read.parquet(f"{out}/valid")
    assert back.select("batch").distinct().count() >= 2  # several micro-batches
    expected = annotate(apply_rule_set(sample))
    assert rows(back.drop("batch").select("street", "segment", "is_valid")) == rows(expected.select("street", "segment", "is_valid"))


def test_stream_restart_processes_only_new_files(spark, sample, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    ckpt = shared_dir(spark, "restart-stream")
    sample.limit(4).write.parquet(src + "/part=a")
    q = split_stream(annotate_stream(spark, src, sample.schema), out, checkpoint=ckpt)
    q.awaitTermination()
    first = spark.read.parquet(f"{out}/valid").count()
    sample.write.parquet(src + "/part=b")  # new files arrive
    q = split_stream(annotate_stream(spark, src, sample.schema), out, checkpoint=ckpt)
    q.awaitTermination()
    total = spark.read.parquet(f"{out}/valid").count()
    assert (first, total) == (4, 14)  # the restart read only the new files, nothing twice


def test_stream_dedup_reads_files_that_grow_in_number(spark, tmp_path, monkeypatch):
    """More input makes more files of the stream, of about equal size, and no more batches; the winners stay."""
    from rowmill.operators import dedup
    from rowmill.plans import registry
    from rowmill.plans.fixtures import listings

    monkeypatch.setattr(registry, "ARRIVAL_BYTES", 10_000, raising=False)
    monkeypatch.setattr(registry, "shared_dir", lambda spark, name="scratch": str(tmp_path / name))
    found = registry.QUERIES["stream_dedup"](spark, SF_SMALL)
    files = [r["count"] for r in spark.read.parquet(str(tmp_path / "stream-dedup" / "in")).groupBy(F.input_file_name()).count().collect()]
    assert len(files) >= 8 and max(files) < 1.5 * sum(files) / len(files)
    assert 2 <= len(list((tmp_path / "stream-dedup" / "out").glob("batch=*"))) <= 3
    assert rows(found) == rows(dedup(listings(spark, SF_SMALL), ["city", "state", "zip_code"]))
