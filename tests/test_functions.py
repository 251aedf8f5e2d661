import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakemart import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_surrogate_key_is_md5_of_parts(spark):
    key = one(spark, fn.surrogate_key(F.lit("7"), F.lit("erp")))
    assert key == hashlib.md5("7\x1ferp".encode()).hexdigest()


def test_packed_keys_come_back_and_stay_different(spark):
    digest = hashlib.md5(b"7").hexdigest()
    keys = [digest, digest.upper(), digest + "\n", "\0" * 16, "x" * 16, "", "é7", "0" * 32, bytes(17).decode(), None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", fn.packed("k").alias("p"))
    found = df.select("k", "p", fn.unpacked("p").alias("again")).collect()
    assert [r["again"] for r in found] == [r["k"] for r in found] == keys
    assert len({bytes(r["p"]) for r in found if r["p"] is not None}) == len(keys) - 1
    assert len(found[0]["p"]) == 16


def test_surrogate_key_keeps_nulls_and_boundaries_apart(spark):
    null = F.lit(None).cast("string")
    keys = {
        one(spark, fn.surrogate_key(F.lit("a"), null)),
        one(spark, fn.surrogate_key(null, F.lit("a"))),
        one(spark, fn.surrogate_key(F.lit("a"), F.lit(""))),
        one(spark, fn.surrogate_key(F.lit("a"))),
        one(spark, fn.surrogate_key(F.lit("a-"), F.lit("b"))),
        one(spark, fn.surrogate_key(F.lit("a"), F.lit("-b"))),
    }
    assert len(keys) == 6 and None not in keys


def test_name_parts(spark):
    df = spark.createDataFrame([("src2brz__sales__shop",), ("plain",), ("a__b__c__d",)], "name string")
    out = df.select(fn.source_of("name").alias("s"), fn.name_parts("name").alias("p")).collect()
    assert [r["s"] for r in out] == ["shop", "plain", "d"]
    assert out[0]["p"].asDict() == {"layer": "src2brz", "subject": "sales", "source": "shop"}
    assert out[1]["p"] is None and out[2]["p"] is None


def test_cursor_start_reads_iso_then_us_dates(spark):
    df = spark.createDataFrame([("2024-01-02",), ("1/2/2024",), ("12/31/2023",), ("soon",)], "c string")
    got = [r[0] for r in df.select(fn.cursor_start("c").cast("date")).collect()]
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 1, 2), dt.date(2023, 12, 31), None]


def test_iso_weekday_and_keys(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    assert rows(df.select(fn.iso_weekday("d"), fn.date_key("d"))) == [(1, 20240101), (7, 20240107)]


def test_elapsed_hours_rounds_to_one_digit(spark):
    a, b = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-02 00:02:24").cast("timestamp_ntz")
    assert one(spark, fn.elapsed_hours(a, b)) == 24.0


def test_division_by_zero_is_null(spark):
    assert one(spark, fn.safe_divide(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.ratio_if_positive(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.ratio_if_positive(F.lit(1), F.lit(-2))) is None
    assert one(spark, fn.ratio_if_positive(F.lit(1), F.lit(4))) == 0.25


def test_conditional_aggregates(spark):
    df = spark.createDataFrame([("a", 1.5), ("a", None), ("b", 2.0)], "k string, v double").select(
        "k", fn.money("v").alias("v")
    )
    got = df.agg(
        fn.sum_where("v", F.col("k") == "a"),
        fn.sum_or_zero("v", F.col("k") == "none"),
        fn.count_where(F.col("k") == "a"),
        fn.mean("v"),
        fn.percent(F.lit(None)),
    ).first()
    assert tuple(got) == (Decimal("1.50"), Decimal("0.00"), 2, 1.75, 0.0)


def test_time_slice_never_falls_as_the_column_rises(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 23, 59, 59),), (dt.datetime(2024, 1, 2),), (dt.datetime(2024, 2, 1),)], "t timestamp_ntz"
    )
    for unit, different in (("hour", 3), ("day", 3), ("month", 2), ("year", 1)):
        cut = [r[0] for r in df.orderBy("t").select(fn.time_slice(df, "t", unit)).collect()]
        assert cut == sorted(cut) and len(set(cut)) == different
    with pytest.raises(TypeError, match="no order"):
        fn.time_slice(df.select(F.array("t").alias("t")), "t")
