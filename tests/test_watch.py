import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakemart.operators import monitor, quality
from lakemart.plans.checks import DECLARED

NOW = dt.datetime(2024, 1, 10, 12)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "a"), (None, "z")], "k int, s string")
    parent = spark.createDataFrame([(2,)], "id int")
    out = quality.suite(
        [
            quality.not_null(df, "t", ["k", "s"]),
            quality.unique(df, "t", ["k"]),
            quality.unique(df, "t", ["k", "s"]),
            quality.relationships(df, "t", "k", parent, "id"),
            quality.accepted_values(df, "t", "s", ["a", "b"]),
        ]
    )
    assert rows(out) == [
        ("accepted_values_t_s", "warn", 1),
        ("not_null_t_k", "fail", 2),
        ("not_null_t_s", "fail", 1),
        ("relationships_t_k", "fail", 2),
        ("unique_t_k", "fail", 1),
        ("unique_t_k_s", "pass", 0),
    ]
    assert rows(quality.summary(out)) == [(1, 4, 1, 6)]
    assert rows(quality.orphan_rows(df, "k", parent, "id")) == [(1, "a"), (1, "b")]


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "k int")
    out = quality.suite([quality.not_null(df, "t", ["k"]), quality.unique(df, "t", ["k"]), quality.relationships(df, "t", "k", df, "k")])
    assert {r.status for r in out.collect()} == {"pass"}


def test_error_counts_as_failure(spark):
    results = spark.createDataFrame([("pass",), ("error",), ("warn",)], "status string")
    assert rows(quality.summary(results)) == [(1, 1, 1, 3)]


def test_declared_counts():
    checks = DECLARED.values()
    assert sum(len(c.get("unique", ())) for c in checks) == 10
    assert sum(len(c.get("not_null", ())) for c in checks) == 40
    assert sum(len(c.get("relationships", ())) for c in checks) == 3
    assert sum(len(c.get("accepted_values", ())) for c in checks) == 1


def test_daily_trend(spark):
    results = spark.createDataFrame(
        [("pass", NOW), ("fail", NOW), ("warn", NOW), ("pass", NOW - dt.timedelta(days=1))], "status string, created_at timestamp_ntz"
    )
    assert [tuple(r) for r in quality.daily_trend(results).collect()] == [
        (NOW.date(), 1, 1), (NOW.date() - dt.timedelta(days=1), 1, 0),
    ]


def test_freshness_limits(spark):
    hour = dt.timedelta(hours=1)
    audit = spark.createDataFrame(
        [
            ("src2brz__a", "exact", "s", "success", NOW - 24 * hour),
            ("src2brz__a", "rounded", "s", "success", NOW - 24 * hour - dt.timedelta(minutes=2)),
            ("src2brz__a", "late", "s", "success", NOW - 24 * hour - dt.timedelta(minutes=7)),
            ("src2brz__a", "failed", "s", "failed", NOW),
            ("stg2sil__a", "other_job", "s", "success", NOW),
            ("src2brz__a", "other_subject", "x", "success", NOW),
        ],
        "dag_id string, source string, data_subject string, status string, finished_at timestamp_ntz",
    )
    names = ["exact", "rounded", "late", "failed", "other_job", "other_subject"]
    thresholds = spark.createDataFrame(
        [(n, "s", 24, 1) for n in names] + [("off", "s", 24, 0)],
        "source_name string, data_subject string, max_stale_hours int, active int",
    )
    got = {r.source_name: (r.status, r.hours_since_load) for r in monitor.freshness(audit, thresholds, NOW).collect()}
    assert got == {
        "exact": ("fresh", 24.0), "rounded": ("fresh", 24.0), "late": ("stale", 24.1),
        "failed": ("stale", None), "other_job": ("stale", None), "other_subject": ("stale", None),
    }


def test_retention_counts(spark):
    listing = spark.createDataFrame(
        [("a", "s", "p", "t", n) for n in ("01-01-2024", "02-01-2024", "03-01-2024", "01-01-2024(1)", "junk")],
        "source_name string, data_subject string, source_schema string, table_name string, name string",
    ).withColumn("load_date", monitor.partition_day(F.col("name")))
    limits = spark.createDataFrame(
        [("a", "s", "p", 8, 1)], "source_name string, data_subject string, source_schema string, retention_days int, active int"
    )
    assert rows(monitor.retention_plan(listing, limits, NOW.date())) == [("a", "s", 1, 2, 2)]


def test_rows_within_retention(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),), (None,)], "d date")
    kept = {r.d for r in monitor.within_retention(df, "d", NOW.date(), 8).collect()}
    assert kept == {dt.date(2024, 1, 2), None}


def test_row_count_history(spark):
    audit = spark.createDataFrame(
        [("a", "s", "t", 5, "success", NOW), ("a", "s", "t", None, "failed", NOW), ("a", "s", "t", 0, "success", NOW + dt.timedelta(hours=1))],
        "source string, data_subject string, table_name string, row_count long, status string, finished_at timestamp_ntz",
    )
    assert [r.row_count for r in monitor.row_count_history(audit).collect()] == [0, 5]


KEYED = [("a", "x", 1), ("a", "x", 2), ("a", None, 1), ("a", None, 1), ("b", "x", 1), ("ab", "", 1), ("a", "b", 1), ("b", "x", 3), ("a", "x", 9)]


@pytest.mark.parametrize("mark", [F.xxhash64, lambda *c: F.xxhash64(*c) % 2, lambda *c: F.lit(0).cast("long")])
def test_wide_keys_that_share_a_fingerprint_are_told_apart(spark, mark):
    df = spark.createDataFrame(KEYED, "k string, l string, n int")
    found = quality.unique(df, "t", ["k", "l"], fingerprint=mark).first()
    assert (found["test_name"], found["status"], found["failures"]) == ("unique_t_k_l", "fail", 2)
    assert quality.unique(df.where("n = 1 and l is not null"), "t", ["k", "l"], fingerprint=mark).first()["failures"] == 0


def test_only_fingerprints_of_wide_keys_are_counted_first(spark, tmp_path):
    spark.createDataFrame(KEYED, "k string, l string, n int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    wide = quality.unique(df, "t", ["k", "l"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_mark" in wide and "LeftSemi" in wide
    narrow = quality.unique(df, "t", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "_mark" not in narrow
