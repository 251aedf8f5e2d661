"""Merges into bucketed tables."""

import re

from conftest import rows
from pyspark.sql import functions as F

from lakemart import operators as op
from lakemart.sources.bucketed import BucketedTable

SCHEMA = "id int, v string, _load_id long, _source string"


def keyed(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def test_merge_keeps_deleted_late_and_unloaded_rows_out(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["id"], ["v"], buckets=4)
    assert table.read() is None
    table.refresh(keyed(spark, (1, "a", 5, "x"), (1, "old", 4, "x"), (1, "b", 5, "y"), (2, "c", 5, "x"), (3, "d", 5, "x")))
    assert rows(table.read(), "id", "v", "_source") == [(1, "a", "x"), (1, "b", "y"), (2, "c", "x"), (3, "d", "x")]
    late = [(1, "late", 5, "x"), (2, "none", None, "x"), (3, "D", 6, "x"), (3, "E", 6, "x"), (4, "new", 7, "x"), (1, "z", 1, "z")]
    table.refresh(keyed(spark, *late))
    want = [(1, "a", "x"), (1, "b", "y"), (1, "z", "z"), (2, "c", "x"), (3, "E", "x"), (4, "new", "x")]
    assert rows(table.read(), "id", "v", "_source") == want
    table.refresh(keyed(spark, *late))  # the same batch again
    table.refresh(keyed(spark, *late).where("false"))
    assert rows(table.read(), "id", "v", "_source") == want


def test_same_rows_as_the_merge_of_frames(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["id"], ["v"], buckets=3)
    first = keyed(spark, *[(n % 40, f"v{n}", n % 17, "xy"[n % 2]) for n in range(300)])
    second = keyed(spark, *[(n % 55, f"w{n}", 10 + n % 23, "xyz"[n % 3]) for n in range(300)])
    table.refresh(first)
    want = rows(op.merge_incremental(table.read(), second, ["id"], ["v"]), "id", "v", "_load_id", "_source")
    table.refresh(second)
    assert rows(table.read(), "id", "v", "_load_id", "_source") == want


def test_columns_are_added_and_kept(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["id"], buckets=2)
    table.refresh(keyed(spark, (1, "a", 1, "x"), (2, "b", 1, "x")))
    table.refresh(keyed(spark, (2, 2, "x", 9), schema="id int, _load_id long, _source string, more int"))
    assert rows(table.read(), "id", "v", "more") == [(1, "a", None), (2, None, 9)]


def test_stored_side_is_read_where_it_lies(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["id"], ["v"], buckets=5)
    table.refresh(keyed(spark, *[(n, "v", 1, "x") for n in range(50)]))
    keyed(spark, *[(n, "w", 2, "x") for n in range(40, 60)]).write.parquet(str(tmp_path / "batch"))
    plan = table.merged(spark.read.parquet(str(tmp_path / "batch")))._jdf.queryExecution().executedPlan().toString()
    join = plan.index("SortMergeJoin")
    stored, batch = plan.index("FileScan", join), plan.rindex("FileScan")
    assert "Bucketed: true" in plan[stored : stored + 1000] and "Exchange" not in plan[join:stored]
    assert re.search(r"Exchange hashpartitioning\(id#\d+, _source#\d+, 5\)", plan[stored:batch])


def test_another_session_reads_the_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    BucketedTable(spark, path, ["id"], buckets=3).refresh(keyed(spark, (1, "a", 1, "x"), (2, "b", 1, "x")))
    other = BucketedTable(spark, path, ["id"], buckets=7)  # the stored number counts
    spark.sql(f"DROP TABLE {other._name(0)}")
    assert rows(other.read(), "id", "v") == [(1, "a"), (2, "b")]
    other.refresh(keyed(spark, (2, "B", 2, "x")))
    assert rows(other.read().where(F.col("id") == 2), "v") == [("B",)]


def test_unfinished_versions_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    table = BucketedTable(spark, path, ["id"], buckets=2)
    table.refresh(keyed(spark, (1, "a", 1, "x")))
    keyed(spark, (1, "broken", 2, "x")).write.parquet(f"{path}/version=1")
    assert rows(table.read(), "v") == [("a",)]
    assert table.refresh(keyed(spark, (1, "b", 2, "x"))) == 2
    for n in (3, 4):
        table.refresh(keyed(spark, (1, f"v{n}", n, "x")))
    assert rows(table.read(), "v") == [("v4",)]


def test_rows_without_a_key_equal_no_other(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["id"], buckets=2)
    table.refresh(keyed(spark, (None, "a", 1, "x")))
    table.refresh(keyed(spark, (None, "b", 2, "x")))
    assert rows(table.read(), "v") == [("a",), ("b",)]
