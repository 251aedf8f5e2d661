import importlib
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakemart import operators as op

SCHEMA = "id int, v string, _load_id long"


def table(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def keyed(spark, data):
    return spark.createDataFrame(data, SCHEMA + ", _source string")


def test_newest_row_wins_and_null_load_id_loses(spark):
    df = table(spark, [(1, "old", 1), (1, "new", 2), (1, "none", None), (2, "only", None), (None, "x", 1), (None, "y", 2)])
    assert rows(op.newest_per_key(df, ["id"], ["_load_id"]), "id", "v") == [(1, "new"), (2, "only"), (None, "y")]


def test_ties_are_settled_by_the_tie_breaker(spark):
    df = table(spark, [(1, "a", 5), (1, "c", 5), (1, "b", 5)])
    for parts in (1, 3):
        assert rows(op.newest_per_key(df.repartition(parts), ["id"], ["_load_id", "v"]), "v") == [("c",)]


def test_same_key_in_two_sources_stays_twice(spark):
    out = op.current_rows({"x": table(spark, [(1, "a", 1), (1, "b", 2)]), "y": table(spark, [(1, "c", 1)])}, ["id"])
    assert rows(out, "id", "v", "_source") == [(1, "b", "x"), (1, "c", "y")]


def test_union_is_by_name_and_fills_missing_columns(spark):
    more = table(spark, [(9, 3, "z", 1)], "_load_id int, id int, v string, extra int")
    out = op.union_sources({"x": table(spark, [(1, "a", 1)]), "y": more})
    assert rows(out, "id", "v", "extra", "_source") == [(1, "a", None, "x"), (3, "z", 1, "y")]


def test_upsert_replaces_and_keeps(spark):
    target = keyed(spark, [(1, "a", 1, "x"), (2, "b", 1, "x")])
    landing = keyed(spark, [(2, "B", 2, "x"), (3, "c", 2, "x"), (3, "C", 3, "x")])
    out = op.merge_incremental(target, landing, ["id"])
    assert rows(out, "id", "v") == [(1, "a"), (2, "B"), (3, "C")]


def test_same_batch_twice_changes_nothing(spark):
    target = keyed(spark, [(1, "a", 1, "x")])
    landing = keyed(spark, [(1, "A", 2, "x"), (2, "b", 2, "x")])
    once = op.merge_incremental(target, landing, ["id"])
    assert rows(op.merge_incremental(once, landing, ["id"])) == rows(once)


def test_empty_target_takes_everything_and_empty_delta_nothing(spark):
    data = keyed(spark, [(1, "a", 1, "x"), (2, "b", 1, "y")])
    none = data.where(F.lit(False))
    for watermark in ("per_source", "global"):
        assert rows(op.merge_incremental(none, data, ["id"], watermark=watermark)) == rows(data)
        assert rows(op.merge_incremental(data, none, ["id"], watermark=watermark)) == rows(data)


def test_late_batch_of_one_source(spark):
    """A batch of y older than x's newest: kept by the per-source mark, lost by the global one."""
    target = keyed(spark, [(1, "a", 10, "x"), (1, "b", 3, "y")])
    late = keyed(spark, [(1, "late", 5, "y"), (7, "first", 1, "z")])
    kept = op.merge_incremental(target, late, ["id"])
    assert rows(kept, "id", "v", "_source") == [(1, "a", "x"), (1, "late", "y"), (7, "first", "z")]
    assert rows(op.merge_incremental(target, late, ["id"], watermark="global")) == rows(target)


def test_new_column_is_appended_with_nulls(spark):
    target = keyed(spark, [(1, "a", 1, "x"), (2, "b", 1, "x")])
    landing = keyed(spark, [(2, "B", 2, "x")]).withColumn("extra", F.lit(7))
    out = op.merge_incremental(target, landing, ["id"])
    assert rows(out, "id", "v", "extra") == [(1, "a", None), (2, "B", 7)]


def test_insert_newer_only_appends(spark):
    fact = table(spark, [(1, "a", 1), (2, "b", 5)])
    more = table(spark, [(2, "changed", 5), (3, "c", 6)])
    assert rows(op.insert_newer(fact, more, "_load_id"), "id", "v") == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(op.insert_newer(fact.where("false"), more, "_load_id")) == rows(more)


def test_insert_newer_runs_no_job_while_it_is_made_and_pushes_its_mark(spark, tmp_path):
    for name, last in (("fact", 5), ("rows", 9)):
        data = [(n, f"v{n}", n) for n in range(last)]
        table(spark, data).write.parquet(str(tmp_path / name))
    fact, more = (spark.read.parquet(str(tmp_path / name)) for name in ("fact", "rows"))
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    out = op.insert_newer(fact, more, "_load_id")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    assert rows(out, "id") == [(n,) for n in range(9)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(_load_id), GreaterThan(_load_id,ScalarSubquery" in plan


@pytest.mark.parametrize(
    "kind", ["timestamp", "timestamp_ntz", "date", "tinyint", "int", "bigint", "decimal(10,2)", "double", "string"]
)
def test_insert_newer_into_an_empty_fact(spark, kind):
    value = F.lit("2024-01-05" if kind in ("timestamp", "timestamp_ntz", "date") else "7").cast(kind)
    more = spark.range(2).select("id", F.when(F.col("id") == 0, value).alias("t"))
    assert rows(op.insert_newer(more.where("false"), more, "t"), "id") == [(0,)]


def ancestors_by_hand(edges):
    above = {}
    for node, parent in edges:
        if node is not None and parent is not None:
            above.setdefault(node, set()).add(parent)
    out = []
    for node in above:
        distance, last = {node: 0}, {node}
        while last:
            last = {p for n in last for p in above.get(n, ())} - distance.keys()
            distance |= {p: 1 + max(distance.values()) for p in last}
        out += [(node, a, d) for a, d in distance.items() if a != node]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_ancestors_with_cycles_and_several_parents(spark, seed):
    pick = random.Random(seed)
    chain = [(n, n + 1) for n in range(100, 137)]  # a line that ends in a parent that is no node
    cycle = [(n, 200 + (n - 199) % 7) for n in range(200, 207)] + [(300, 203), (301, 301), (None, 5), (302, None), (300, 203)]
    edges = chain + cycle + [(pick.randrange(30), pick.randrange(30)) for _ in range(25)]
    found = op.ancestors(spark.createDataFrame(edges, "id int, parent int"), "id", "parent")
    assert rows(found) == ancestors_by_hand(edges)


def test_each_turn_writes_only_new_ancestors(spark, tmp_path, monkeypatch):
    paths = iter(f"{tmp_path}/{n}" for n in range(99))
    module = importlib.import_module("lakemart.operators.ancestors")
    monkeypatch.setattr(module, "new_table_path", lambda spark, name: next(paths))
    line = spark.createDataFrame([(n, n - 1 if n > 1 else None) for n in range(1, 21)], "id int, parent int")
    found = op.ancestors(line, "id", "parent")
    assert rows(found) == sorted(((n, m, n - m) for n in range(1, 21) for m in range(1, n)), key=repr)
    written = [spark.read.parquet(f.path).count() for f in os.scandir(tmp_path)]
    assert sum(written) == found.count()


def test_ancestors_are_the_path_where_both_are_given(spark):
    units = spark.createDataFrame([(1, None), (5, 1), (9, 5), (7, 1)], "unit int, parent int")
    paths = spark.createDataFrame([(9, "/1/5/9/"), (7, "/1/7/"), (1, "/1/")], "dept int, path string")
    by_path = op.join_path_contains(paths, units.select("unit"), "path", "unit").where("dept <> unit")
    found = op.ancestors(units, "unit", "parent").where("unit <> 5")
    assert rows(found, "unit", "ancestor") == rows(by_path, "dept", "unit")


@pytest.mark.parametrize("nearest", [False, True])
def test_path_containment_matches_like(spark, nearest):
    paths = spark.createDataFrame(
        [(1, "1/5/9/"), (2, "/5/5/9/"), (3, "5/"), (4, None), (5, "1/55/"), (6, "9/5"), (7, "1/5/9/"), (8, "")],
        "dept int, parent_path string",
    )
    units = spark.createDataFrame([(5, "five"), (9, "nine"), (1, "one")], "unit int, name string")
    got = op.join_path_contains(paths, units, "parent_path", "unit", nearest).select("dept", "unit")
    like = F.expr("parent_path like '%/' || unit || '/%'")
    want = paths.join(units, like, "left").select("dept", "unit")
    if nearest:
        assert rows(got) == [(1, 9), (2, 9), (3, None), (4, None), (5, None), (6, None), (7, 9), (8, None)]
    else:
        assert rows(got) == rows(want)
