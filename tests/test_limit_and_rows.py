"""Large limits, row numbers, and CSV files united by column name."""

import random

import pytest
from pyspark.sql import functions as F

from rowmill.operators import dedup, take_any, take_ordered
from rowmill.sources import read_csv, read_parquet, with_row_id


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """5,000 rows, a third of them equal, nulls in both columns, in 7 files."""
    rng = random.Random(3)
    rows = [(7, "hot") if k % 3 == 0 else (rng.choice([None, *range(40)]), rng.choice([None, "a", "b", f"x{k % 11}"])) for k in range(5000)]
    path = str(tmp_path_factory.mktemp("limit") / "t")
    spark.createDataFrame(rows, "k int, s string").repartition(7).write.parquet(path)
    return path


def in_order(rows, *places):
    return sorted(rows, key=lambda r: [(r[p] is not None, r[p] or (0 if p == 0 else "")) for p in places])


@pytest.mark.parametrize("n", [1, 1666, 2500, 4999, 5000, 9000])
def test_cut_equals_the_sorted_prefix(spark, table, n):
    df = spark.read.parquet(table)
    rows = [tuple(r) for r in df.collect()]
    got = take_ordered(df, n, small=0)
    assert in_order([tuple(r) for r in got.collect()], 0, 1) == in_order(rows, 0, 1)[:n]
    assert in_order([tuple(r) for r in take_ordered(df, n, ["s"], small=0).collect()], 1, 0) == in_order(rows, 1, 0)[:n]
    assert in_order([tuple(r) for r in take_ordered(df, n).collect()], 0, 1) == in_order(rows, 0, 1)[:n]
    plan = plan_of(got)
    assert "Exchange" not in plan and "Limit" not in plan and "PushedFilters: [IsNotNull(__limit_at), LessThan(__limit_at," in plan


def test_take_any(spark, table):
    df = spark.read.parquet(table)
    rows = [tuple(r) for r in df.collect()]
    for n in (1, 2500, 4999, 6000):
        got = take_any(df, n, small=0)
        own = [tuple(r) for r in got.collect()]
        assert len(own) == min(n, 5000) and "Exchange" not in plan_of(got)
        for r in set(own):
            assert own.count(r) <= rows.count(r)
    assert take_any(df, 0) is df and take_ordered(df, -1) is df and take_any(df, 10).count() == 10


def test_hot_value_is_spread_over_ranges(spark, table, monkeypatch):
    from rowmill.operators import limit
    seen = []
    monkeypatch.setattr(limit, "stored", lambda df, name: seen.append(df) or df.checkpoint())
    spark.sparkContext.setCheckpointDir(limit.F and __import__("tempfile").mkdtemp(prefix="limit-"))
    take_ordered(spark.read.parquet(table), 2000, small=0).count()
    sizes = [r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 5000 / 8  # the hot value alone has 1,667 rows


def test_row_ids_dont_depend_on_splits(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 60_000, 1, 5).select(F.col("id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("s")).write.option("parquet.block.size", "65536").parquet(path)
    own, ids = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(own)
    try:
        for size in ("134217728", "100000"):
            spark.conf.set(own, size)
            df = read_parquet(spark, path, row_id="n")
            ids.append(sorted((r["id"], r["n"]) for r in df.select("id", "n").collect()))
            ids.append(sorted((r["id"], r["n"]) for r in df.where("id % 7 = 3").repartition(3).select("id", "n").collect()))
    finally:
        spark.conf.set(own, before)
    assert ids[0] == ids[2] and ids[1] == ids[3] == [x for x in ids[0] if x[0] % 7 == 3]
    assert sorted(n for _, n in ids[0]) == list(range(60_000))
    files = sorted(r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect())
    assert len(files) == 5
    first = spark.read.parquet(files[0]).count()
    assert {r["id"] for r in spark.read.parquet(files[0]).collect()} == {i for i, n in ids[0] if n < first}
    with pytest.raises(ValueError):
        with_row_id(spark.read.parquet(path), "id")


def test_physical_dedup_keeps_the_first_row_of_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 9000, 1, 3).select((F.col("id") % 500).alias("k"), F.col("id").alias("v")).write.parquet(path)
    numbered = [tuple(r) for r in read_parquet(spark, path, row_id="n").collect()]
    want = {}
    for k, v, n in sorted(numbered, key=lambda r: r[2]):
        want.setdefault(k, v)
    scan = spark.read.parquet(path)
    got = dedup(scan, ["k"], order_by="physical")
    assert got.columns == ["k", "v"] and dict(map(tuple, got.collect())) == want
    assert dedup(scan.where("v >= 0").select("v", "k"), ["k"], order_by="physical").count() == 500  # no plain scan: any order


@pytest.fixture
def files(tmp_path):
    def write(**texts):
        for name, text in texts.items():
            (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
        return [str(tmp_path / f"{name}.csv") for name in texts]

    return write


def test_by_name_finds_each_column_where_it_stands(spark, files):
    paths = files(a="id,price\n1,10\n2,20\n", b="price,id\n30,3\n40,4\n", c='﻿id,zip,"pri,ce"\n5,02108,x\n6,abc,y\n', d="\nzip,id,price\n7,7,1.5\n", e="", f="id,price\n")
    df = read_csv(spark, paths, headers="by_name")
    assert df.dtypes == [("id", "int"), ("price", "double"), ("zip", "string"), ("pri,ce", "string")]
    rows = sorted(map(tuple, df.collect()))
    assert rows == [(1, 10.0, None, None), (2, 20.0, None, None), (3, 30.0, None, None), (4, 40.0, None, None), (5, None, "02108", "x"), (6, None, "abc", "y"), (7, 1.5, "7", None)]
    typed = read_csv(spark, paths, headers="by_name", schema="zip string, id bigint, extra date")
    assert typed.dtypes == [("zip", "string"), ("id", "bigint"), ("extra", "date")]
    assert sorted(map(tuple, typed.collect()), key=lambda r: r[1]) == [(None, 1, None), (None, 2, None), (None, 3, None), (None, 4, None), ("02108", 5, None), ("abc", 6, None), ("7", 7, None)]
    strings = read_csv(spark, paths, headers="by_name", infer_schema=False)
    assert {t for _, t in strings.dtypes} == {"string"} and sorted(r["id"] for r in strings.collect()) == list("1234567")


def test_other_headers_are_refused_or_ignored(spark, files):
    paths = files(a="id,price\n1,10\n", b="price,id\n30,3\n")
    for schema in (None, "id int, price int"):
        with pytest.raises(Exception, match="b.csv"):
            read_csv(spark, paths, schema=schema).collect()
    assert sorted(r[0] for r in read_csv(spark, paths, schema="id int, price int", headers="ignore").collect()) == [1, 30]
    assert sorted(r["id"] for r in read_csv(spark, paths, headers="by_name").collect()) == [1, 3]
    with pytest.raises(ValueError, match="headers"):
        read_csv(spark, paths, headers="sorted")
    with pytest.raises(ValueError, match="twice"):
        read_csv(spark, files(t="x,y,x\n1,2,3\n"), headers="by_name")
    same = files(c="id,price\n1,10\n", d="ID,price\n2,20\n")
    assert read_csv(spark, same, schema="id int, price int").count() == 2  # names compare without case, as in Spark


def test_by_name_reads_options_and_many_splits(spark, tmp_path):
    folder = tmp_path / "big"
    left = spark.range(4000).select(F.col("id").alias("a b"), F.concat(F.lit("v|"), "id").alias("v"))
    left.coalesce(1).write.option("header", "true").option("sep", "|").csv(str(folder / "one"))
    left.select("v", F.col("a b")).repartition(3).write.option("header", "true").option("sep", "|").csv(str(folder / "two"))
    own, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set(own, "10000")  # headers stand in the first split of a file only
        df = read_csv(spark, [str(folder / "one"), str(folder / "two")], delimiter="|", headers="by_name")
        assert sorted(df.columns) == ["a b", "v"] and df.count() == 8000
        assert df.where(F.col("v") != F.concat(F.lit("v|"), F.col("`a b`"))).count() == 0
    finally:
        spark.conf.set(own, before)


def test_types_meet(spark, files):
    df = read_csv(spark, files(a="n,d,t,x\n1,2020-01-01,1,\n", b="x,t,d,n\n2020-01-01,true,2020-01-01 10:00:00,99999999999\n"), headers="by_name")
    assert df.select("n", "d", "t", "x").dtypes[0][1] == "bigint" and dict(df.dtypes)["d"] == "timestamp" and dict(df.dtypes)["t"] == "string"
    assert sorted((r["n"], r["t"]) for r in df.collect()) == [(1, "1"), (99999999999, "true")]
