import datetime as dt

from pyspark.sql import functions as F

from rowmill.functions import clean_text, first_present, lot_bucket, normalize_code, number, parse_date, year_of
from rowmill.functions.text import normalize_strings, trim_strings


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def test_number_coercion_never_fails(spark):
    df = one_col(spark, ["abc", " 7 ", "2.7", "-3", "3.0", "", None])
    got = [tuple(r) for r in df.select(number("x").alias("d"), number("x", "int").alias("i")).collect()]
    assert got == [(None, None), (7.0, 7), (2.7, 2), (-3.0, -3), (3.0, 3), (None, None), (None, None)]


def test_first_present_coerces_each_synonym_before_coalesce(spark):
    df = spark.createDataFrame([("junk", 5.0), (None, 6.0), ("7", 8.0)], "price string, list_price double")
    got = [r[0] for r in df.select(first_present(df, ["price", "list_price", "sold_price"])).collect()]
    assert got == [5.0, 6.0, 7.0]
    assert df.select(first_present(df, ["nope"]).alias("n")).schema["n"].dataType.simpleString() == "double"


def test_parse_date_four_formats(spark):
    df = one_col(spark, ["2018-06-15", "06/15/2018", "6/5/2018", "2018/06/15", "junk", None])
    got = [r[0] for r in df.select(parse_date("x")).collect()]
    assert got == [dt.date(2018, 6, 15), dt.date(2018, 6, 15), dt.date(2018, 6, 5), dt.date(2018, 6, 15), None, None]
    assert [r[0] for r in df.select(year_of(df, "x")).collect()] == [2018, 2018, 2018, 2018, None, None]
    assert df.select(year_of(df, "absent").alias("y")).schema["y"].dataType.simpleString() == "int"


def test_lot_bucket_edges(spark):
    df = one_col(spark, [0.2499, 0.25, 1.0, 1.0001, None, float("nan")], "double")
    got = [r[0] for r in df.select(lot_bucket(F.col("x"))).collect()]
    assert got == ["small", "medium", "medium", "large", "unknown", "large"]


def test_normalize_code(spark):
    df = one_col(spark, ["02108", "2108", "90210-1234", "12a345", "", None])
    got = [r[0] for r in df.select(normalize_code("x", 5, numeric=True, truncate=True)).collect()]
    assert got == ["02108", "02108", "90210", "12345", "00000", None]
    keep_long = [r[0] for r in df.select(normalize_code("x", 5, numeric=True)).collect()]
    assert keep_long[2] == "902101234"
    as_ref = [r[0] for r in df.select(normalize_code("x", 5, numeric=True, null_as_empty=True)).collect()]
    assert as_ref[-1] == "00000"


def test_clean_text_chain(spark):
    df = one_col(spark, [None, "", "   ", "  12 Main-St.,  Apt #4 -  ", "Café  Né", "a\tb", "a - b"])
    full = [r[0] for r in df.select(clean_text("x", True, True, True, True)).collect()]
    assert full == [None, "", "", "12 mainst apt 4 ", "caf n", "a b", "a  b"]
    uni = [r[0] for r in df.select(clean_text("x", True, True, True, True, unicode=True)).collect()]
    assert uni[4] == "café né"
    fixed = [r[0] for r in df.select(clean_text("x", True, True, True, True, final_trim=True)).collect()]
    assert fixed[3] == "12 mainst apt 4" and fixed[6] == "a b"
    again = df.select(clean_text("x", True, True, True, True, final_trim=True).alias("x"))
    assert [r[0] for r in again.select(clean_text("x", True, True, True, True, final_trim=True)).collect()] == fixed


def test_string_rewrites_keep_types_and_order(spark):
    df = spark.createDataFrame([(" A ", 1, " B ")], "a string, n int, b string")
    out = trim_strings(df)
    assert out.columns == ["a", "n", "b"] and tuple(out.first()) == ("A", 1, "B")
    only_b = normalize_strings(df, lowercase=True, columns=["b"])
    assert tuple(only_b.first()) == (" A ", 1, " b ")


def test_year_of_timestamps(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2019, 12, 31, 23, 59),)], "prev_sold_date timestamp_ntz")
    assert df.select(year_of(df)).first()[0] == 2019
    d = spark.createDataFrame([(dt.date(2020, 2, 29),)], "prev_sold_date date")
    assert d.select(year_of(d)).first()[0] == 2020


def test_names_with_dots_and_blanks(spark):
    from rowmill.operators import annotate, profile, quality_report, QualitySpec, ValidationSpec
    from rowmill.sinks import csv_safe
    df = spark.createDataFrame([(" a ", 1.0), (None, -2.0)], "`my.street` string, `list price` double")
    assert trim_strings(df).first()[0] == "a"
    assert df.select(first_present(df, ["list price"])).first()[0] == 1.0
    spec = ValidationSpec(required=("my.street",), range_column="list price", zip_column=None, nonneg=("list price",),
                          integers=())
    assert [r["validation_errors"] for r in annotate(df, spec).collect()] == [
        [], ["required_empty:my.street", "list price_below_min", "negative:list price"]]
    assert profile(df).count() == 2
    rep = quality_report(df, QualitySpec(required=("my.street",), unique_keys=("my.street",),
                                         minimum={"list price": 0.0}, max_null_fraction={"my.street": 0.1}))
    assert rep.count() == 4
    assert csv_safe(annotate(df, spec)).columns[0] == "my.street"


def test_clean_text_skips_only_what_nothing_changes(spark):
    """Texts that need no blank or punctuation clean-up take the short way; odd ones come out as by the whole chain."""
    import re

    texts = ["Plain Text_1", " a", "a ", "a  b", "a\tb", "\na", "a\n", "a - b", "É a", "", " ", "\t", "a b", "12345-6.", "- a", "a -", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")

    def whole(t, trim):
        t = (t.strip(" ") if trim else t).lower()
        return re.sub(r"[^\w\s]", "", re.sub(r"\s+", " ", t, flags=re.A).strip(" "), flags=re.A)

    for trim in (True, False):
        got = df.select("k", clean_text("t", trim, True, True, True).alias("c"))
        assert dict(map(tuple, got.collect())) == {k: None if t is None else whole(t, trim) for k, t in enumerate(texts)}
    assert "rlike" in got._jdf.queryExecution().optimizedPlan().toString().lower()
