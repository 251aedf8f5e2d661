import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakemart.operators import monitor
from lakemart.sources import bronze, folders, load, meta, rdbms, seed, staging, tables
from lakemart.sources.store import HistoryTable, KeyedTable, write_models

DAY = dt.date


def numbers(spark, *values, schema="id int, v string"):
    return spark.createDataFrame(values, schema)


def test_tables_go_to_the_folder_the_cluster_names(spark):
    from lakemart.session import new_table_path

    named = spark.conf.get("spark.checkpoint.dir")
    assert named and new_table_path(spark, "t").startswith(named)


def test_table_path():
    assert bronze.table_path("/lake/", "crm", "pg", "public", "customers") == "/lake/crm/pg/public/customers"


def test_newest_day_is_a_date_not_a_text(spark, tmp_path):
    """As text 25-03-2026 sorts after 01-04-2026; as a date it does not."""
    path = str(tmp_path / "t")
    for day in (DAY(2026, 3, 25), DAY(2026, 4, 1), DAY(2026, 3, 15)):
        bronze.write_day(numbers(spark, (1, day.strftime("%d-%m-%Y"))), path, day)
    assert rows(bronze.read_latest(spark, path), "v") == [("01-04-2026",)]
    assert rows(bronze.latest_snapshot(spark.read.parquet(path)), "v") == [("01-04-2026",)]


def test_no_folder_has_no_latest(spark, tmp_path):
    assert bronze.read_latest(spark, str(tmp_path / "missing")) is None
    (tmp_path / "empty").mkdir()
    assert bronze.read_latest(spark, str(tmp_path / "empty")) is None


def test_same_day_again_replaces_only_that_day(spark, tmp_path):
    path = str(tmp_path / "t")
    assert bronze.write_day(numbers(spark, (1, "a"), (2, "b")), path, DAY(2024, 1, 1)) == 2
    bronze.write_day(numbers(spark, (3, "c")), path, DAY(2024, 1, 2))
    bronze.write_day(numbers(spark, (1, "A")), path, DAY(2024, 1, 1))
    assert rows(spark.read.parquet(path), "id", "v") == [(1, "A"), (3, "c")]


def test_runs_of_a_day_are_numbered_and_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    runs = [bronze.write_run(numbers(spark, (n, "x")), path, DAY(2024, 1, 1)) for n in range(11)]
    assert runs == [(n, 1) for n in range(11)]
    assert bronze.write_run(numbers(spark, (99, "other")), path, DAY(2023, 12, 31)) == (0, 1)
    (tmp_path / "t" / "load_date=2024-01-01" / "run_seq=11" / "_temporary").mkdir(parents=True)
    assert rows(bronze.read_latest(spark, path), "id") == [(10,)]
    assert rows(bronze.latest_snapshot(spark.read.parquet(path)), "id") == [(10,)]
    assert spark.read.parquet(path).count() == 12


def test_group_lands_completely_or_not_at_all(spark, tmp_path):
    good = numbers(spark, (1, "a"))
    bad = good.withColumn("v", F.raise_error(F.lit("source gone")).cast("string"))
    for earlier in (None, [(1, "a")]):
        with pytest.raises(Exception, match="source gone"):
            bronze.land_group({"good": good, "bad": bad}, str(tmp_path), DAY(2024, 1, 1), attempts=2, pause=0)
        runs = folders.partition_values(spark, f"{tmp_path}/good/load_date=2024-01-01", "run_seq")
        assert len(runs) == (0 if earlier is None else 1)
        if earlier is None:
            assert bronze.land_group({"good": good}, str(tmp_path), DAY(2024, 1, 1)) == {"good": 1}
    assert rows(bronze.read_latest(spark, f"{tmp_path}/good"), "id", "v") == [(1, "a")]


def test_bookkeeping_tables_are_not_counted(spark, tmp_path):
    counts = bronze.write_counted({"a": numbers(spark, (1, "x")), "_state": numbers(spark, (1, "x"))}, str(tmp_path))
    assert counts == {"a": 1}


def test_added_column_reads_as_null_on_earlier_days(spark, tmp_path):
    path = str(tmp_path / "t")
    bronze.write_day(numbers(spark, (1, "a")).select("id"), path, DAY(2024, 1, 1))
    bronze.write_day(numbers(spark, (2, "b")), path, DAY(2024, 1, 2))
    assert rows(bronze.read_runs(spark, path), "id", "v") == [(1, None), (2, "b")]


def test_retention_keeps_the_cutoff_day(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in (DAY(2024, 1, 1), DAY(2024, 1, 2), DAY(2024, 1, 3)):
        bronze.write_day(numbers(spark, (1, "a")), path, day)
    (tmp_path / "t" / "load_date=soon").mkdir()
    assert bronze.purge(spark, {"t": path}, DAY(2024, 1, 12), 10) == {"t": (1, 2, 1)}
    assert sorted(bronze.partition_values(spark, path, bronze.DAY)) == ["2024-01-02", "2024-01-03", "soon"]
    assert bronze.read_latest(spark, path).count() == 1


def test_partition_listing(spark):
    paths = spark.createDataFrame(
        [("/lake/crm/pg/public/t/load_date=2024-01-02",), ("/lake/crm/pg/public/t/load_date=oops",)], "path string"
    )
    assert rows(bronze.listing_from_paths(paths)) == [
        ("pg", "crm", "public", "t", None),
        ("pg", "crm", "public", "t", dt.date(2024, 1, 2)),
    ]


def test_staging_replaces_skips_and_reports(spark, tmp_path):
    lake, stage = str(tmp_path / "lake"), str(tmp_path / "stage")
    bronze.write_day(numbers(spark, (1, "a"), (2, "b")), f"{lake}/t", DAY(2024, 1, 1))
    paths = {"t": f"{lake}/t", "none": f"{lake}/none"}
    staging.stage_group(spark, paths, stage)
    bronze.write_day(numbers(spark, (3, "c", 1.5), schema="id int, v string, extra double"), f"{lake}/t", DAY(2024, 1, 2))
    results = staging.stage_group(spark, paths, stage)
    assert rows(results) == [("none", "skipped", 0, "no snapshot", 0), ("t", "loaded", 1, "", 1)]
    assert rows(tables.read_table(spark, f"{stage}/t")) == [(3, "c", 1.5)]
    assert rows(monitor.load_summary(results)) == [("OK", 1, 1, 1), ("SKIP", 1, 0, 0)]


def test_failing_table_does_not_stop_the_others(spark, tmp_path):
    lake = str(tmp_path / "lake")
    bronze.write_day(numbers(spark, (1, "a")), f"{lake}/good", DAY(2024, 1, 1))
    broken = tmp_path / "lake" / "broken" / "load_date=2024-01-01"
    broken.mkdir(parents=True)
    (broken / "part.parquet").write_bytes(b"not parquet")
    out = staging.stage_group(spark, {"broken": f"{lake}/broken", "good": f"{lake}/good"}, str(tmp_path / "stage"))
    assert rows(out, "table_name", "status") == [("broken", "failed"), ("good", "loaded")]


def test_group_without_any_snapshot_fails(spark, tmp_path):
    with pytest.raises(staging.NothingToStage):
        staging.stage_group(spark, {"none": str(tmp_path / "none")}, str(tmp_path / "stage"))


def test_incremental_load(spark, tmp_path):
    target, state = str(tmp_path / "t"), str(tmp_path / "state")
    shared = {"table": "t", "cursor": "seq", "state": state}
    schema = "id int, seq long"
    first = load.load(numbers(spark, (1, 5), (2, 9), schema=schema), target, "incremental", run_id="1", **shared)
    assert (first.strategy, first.rows, first.cursor_value) == ("full", 2, "9")
    more = numbers(spark, (1, 5), (2, 9), (3, 9), (4, 10), schema=schema)
    second = load.load(more, target, "incremental", run_id="2", **shared)
    assert (second.strategy, second.rows, second.cursor_value) == ("incremental", 2, "10")
    nothing = load.load(more.where("false"), target, "incremental", run_id="3", **shared)
    assert (nothing.rows, nothing.cursor_value) == (0, None)
    again = load.load(more, target, "incremental", run_id="4", **shared)
    assert again.rows == 0
    assert rows(load.read_target(spark, target), "id") == [(1,), (2,), (3,), (4,)]


def test_rows_at_the_cursor_are_told_apart(spark, tmp_path):
    target, schema = str(tmp_path / "t"), "id int, a string, b string, seq double"
    runs = iter(range(99))

    def take(*data, more=(), **options):
        df = numbers(spark, *data, schema=schema)
        for column in more:
            df = df.withColumn(column, F.lit("new"))
        shared = {"table": "t", "cursor": "seq", "state": str(tmp_path / "state"), "run_id": str(next(runs)), **options}
        return load.load(df, target, "incremental", **shared).rows

    old = [(1, "x", None, 0.1), (1, None, "x", 0.1), (2, "x", "x", 0.1)]
    assert take(*old[:1]) == 1
    assert take(*old[:1]) == 0
    assert take(*old) == 2  # nulls in other places are other rows
    assert take(*old) == 0  # seen in two runs at one value
    assert take(*old, old[2], old[2]) == 2  # equal rows count as often as they come more
    assert take(*old, more=["c"]) == 0  # a new column makes no loaded row new
    assert take(*old, (3, "y", "y", 0.1), more=["c"]) == 1
    assert take(*old, (4, "z", "z", 0.2), more=["c"]) == 1
    assert take((4, "z", "other", 0.2), more=["c"]) == 1
    assert take((4, "z", "z", 0.2), (4, "z", "other", 0.2), more=["c"]) == 0
    assert load.read_target(spark, target).count() == 8


def test_identity_names_what_tells_rows_apart(spark, tmp_path):
    shared = {"table": "t", "cursor": "seq", "state": str(tmp_path / "state"), "identity": ["id"]}
    for run, (data, new) in enumerate([([(1, "a", 5)], 1), ([(1, "changed", 5), (2, "b", 5)], 1), ([(3, "c", 4)], 0)]):
        df = numbers(spark, *data, schema="id int, v string, seq int")
        assert load.load(df, str(tmp_path / "t"), "incremental", run_id=str(run), **shared).rows == new


def test_maps_and_lists_at_the_cursor(spark, tmp_path):
    shared = {"table": "t", "cursor": "seq", "state": str(tmp_path / "state")}
    df = spark.createDataFrame([(1, {"a": 1}, [1, None])], "seq int, m map<string,int>, l array<int>")
    for run, new in enumerate((1, 0)):
        assert load.load(df, str(tmp_path / "t"), "incremental", run_id=str(run), **shared).rows == new


def test_initial_value_starts_a_new_table_of_a_known_source(spark, tmp_path):
    state = str(tmp_path / "state")
    old = spark.createDataFrame([(1, dt.datetime(2023, 12, 31)), (2, dt.datetime(2024, 1, 1))], "id int, ts timestamp_ntz")
    load.load(old, str(tmp_path / "a"), "incremental", table="a", cursor="ts", state=state, run_id="1")
    got = load.load(
        old, str(tmp_path / "b"), "incremental", table="b", cursor="ts", state=state, run_id="1", initial_value="1/1/2024"
    )
    assert (got.strategy, got.rows) == ("incremental", 1)


def test_incremental_without_cursor_and_append_add_everything(spark, tmp_path):
    target, data = str(tmp_path / "t"), numbers(spark, (1, "a"))
    assert load.load(data, target, "append").rows == 1
    assert load.load(data, target, "incremental").strategy == "append"
    assert load.read_target(spark, target).count() == 2
    assert load.load(data, target, "full").rows == 1
    assert load.read_target(spark, target).count() == 1


def test_seed_round_trip(spark, tmp_path):
    path = str(tmp_path / "seed")
    seed.write_seed(seed.cost_categories(spark), path)
    back = seed.read_seed(spark, path, seed.COST_CATEGORY_SCHEMA)
    assert rows(back) == sorted(seed.COST_CATEGORIES, key=repr) and back.count() == 7


def test_run_log_keeps_zero_rows_and_first_error_line(spark, tmp_path):
    log = str(tmp_path / "log")
    assert meta.read(spark, log, meta.AUDIT_SCHEMA).count() == 0

    def fails():
        raise ValueError("first line\nsecond line")

    meta.audited(spark, log, lambda: 0, task_id="empty")
    result = meta.audited(spark, log, fails, task_id="broken")
    assert isinstance(result["error"], ValueError)
    stored = meta.read(spark, log, meta.AUDIT_SCHEMA)
    assert rows(stored, "task_id", "status", "row_count", "error_message") == [
        ("broken", "failed", None, "first line"),
        ("empty", "success", 0, None),
    ]
    assert stored.where("finished_at >= started_at").count() == 2


def test_unwritable_log_does_not_stop_the_run(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    assert meta.audited(spark, f"{tmp_path}/file/log", lambda: 3)["status"] == "success"


def test_models_are_stored_and_pruned_by_partition(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 4).cast("int").alias("date_key"), F.col("id").alias("v"))
    stored = write_models({"m": df}, str(tmp_path), {"m": "date_key"})["m"]
    assert stored.columns == ["date_key", "v"] and stored.dtypes == df.dtypes
    one = stored.where("date_key = 3")
    assert one.count() == 25
    assert "PartitionFilters: [isnotnull(date_key" in one._jdf.queryExecution().executedPlan().toString()


SCHEMA = "id int, v string, _load_id int, _source string"


def test_keyed_table_versions(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    assert table.read() is None
    assert table.refresh(numbers(spark, (1, "a", 1, "x"), (1, "b", 2, "x"), (5, "e", 1, "y"), schema=SCHEMA)) == 0
    assert table.refresh(numbers(spark, (1, "c", 3, "x"), (2, "d", 3, "x"), schema=SCHEMA)) == 1
    assert rows(table.read(), "id", "v") == [(1, "c"), (2, "d"), (5, "e")]
    assert rows(table.read(before=1), "id", "v") == [(1, "b"), (5, "e")]
    assert table.refresh(numbers(spark, (1, "late", 2, "x"), schema=SCHEMA)) == 1
    (tmp_path / "t" / "data" / "version=7" / "bucket=0").mkdir(parents=True)
    assert table.versions() == [0, 1]
    assert table.keep(1) == 1
    assert rows(table.read(), "id", "v") == [(1, "c"), (2, "d"), (5, "e")]


def test_merge_writes_only_the_buckets_it_touches(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=8)
    table.refresh(numbers(spark, *[(n, "old", 1, "x") for n in range(100)], schema=SCHEMA))
    table.refresh(numbers(spark, (42, "new", 2, "x"), schema=SCHEMA))
    written = folders.partition_values(spark, f"{tmp_path}/t/data/version=1", "bucket")
    assert len(written) == 1 and len(folders.partition_values(spark, f"{tmp_path}/t/data/version=0", "bucket")) == 8
    assert rows(table.read().where("v = 'new'"), "id") == [(42,)] and table.read().count() == 100


def test_new_column_appears_in_buckets_not_yet_rewritten(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=8)
    table.refresh(numbers(spark, *[(n, "old", 1, "x") for n in range(20)], schema=SCHEMA))
    table.refresh(numbers(spark, (3, "new", 2, "x", 7), schema=SCHEMA + ", extra int"))
    assert rows(table.read().where("extra is not null"), "id", "extra") == [(3, 7)] and table.read().count() == 20
    table.refresh(numbers(spark, (4, "newer", 3, "x"), schema=SCHEMA))
    assert rows(table.read().where("extra is not null"), "id", "extra") == [(3, 7)] and table.read().count() == 20


def test_repeated_batch_is_recognised(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    table.merge_batch(numbers(spark, (1, "a", 5, "x"), schema=SCHEMA), "s", 0)
    second = numbers(spark, (1, "older", 4, "x"), (2, "b", 1, "x"), schema=SCHEMA)
    assert [table.merge_batch(second, "s", 1), table.merge_batch(second, "s", 1)] == [1, 1]
    assert table.versions() == [0, 1]
    assert rows(table.read(), "id", "v") == [(1, "a"), (2, "b")]


def test_stream_batch_numbers_are_not_versions(spark, tmp_path):
    """Refresh, then batch 0 of a stream, then batch 0 of the stream that follows a lost checkpoint."""
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    table.refresh(numbers(spark, *[(n, "a", 1, "x") for n in range(10)], schema=SCHEMA))
    table.merge_batch(numbers(spark, (3, "b", 2, "x"), schema=SCHEMA), "first", 0)
    table.merge_batch(numbers(spark, (4, "c", 3, "x"), schema=SCHEMA), "second", 0)
    assert table.read().count() == 10 and rows(table.read().where("v <> 'a'"), "id", "v") == [(3, "b"), (4, "c")]


@pytest.mark.parametrize("first, second", [(4, 7), (7, 4)])
def test_bucket_count_of_the_table_is_used(spark, tmp_path, first, second):
    KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=first).refresh(
        numbers(spark, *[(n, "old", 1, "x") for n in range(40)], schema=SCHEMA)
    )
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=second)
    table.refresh(numbers(spark, *[(n, "new", 2, "x") for n in range(0, 40, 3)], schema=SCHEMA))
    want = [(n, "new" if n % 3 == 0 else "old") for n in range(40)]
    assert sorted(rows(table.read(), "id", "v")) == want
    table.rebucket(second)
    table.refresh(numbers(spark, *[(n, "newer", 3, "x") for n in range(0, 40, 2)], schema=SCHEMA))
    assert rows(table.read(), "id") == [(n,) for n in sorted(range(40), key=lambda n: repr((n,)))]
    assert table.read().where("v = 'newer'").count() == 20
    assert table.keep(1) > 0 and table.read().count() == 40


def test_whole_number_keys_of_any_type_meet(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    table.refresh(numbers(spark, *[(n, "old", 1, "x") for n in range(20)], schema=SCHEMA))
    table.refresh(numbers(spark, (7, "new", 2, "x"), (2**40, "big", 2, "x"), schema=SCHEMA.replace("id int", "id long")))
    table.refresh(numbers(spark, (8, "newer", 3, "x"), schema=SCHEMA))
    assert table.read().count() == 21 and table.read().schema["id"].dataType.simpleString() == "bigint"
    assert rows(table.read().where("v <> 'old'"), "id", "v") == [(1099511627776, "big"), (7, "new"), (8, "newer")]
    with pytest.raises(ValueError, match="key id"):
        table.refresh(numbers(spark, ("7", "new", 9, "x"), schema=SCHEMA.replace("id int", "id string")))


def test_first_refresh_may_be_empty(spark, tmp_path):
    table, none = KeyedTable(spark, str(tmp_path / "t"), ["id"]), numbers(spark, schema=SCHEMA)
    assert table.refresh(none) == 0 and table.read().count() == 0
    assert table.refresh(none) == 0
    assert table.refresh(numbers(spark, (1, "a", 1, "x"), schema=SCHEMA)) == 1
    assert rows(table.read(), "id", "v") == [(1, "a")]
    assert not folders.names(spark, f"{tmp_path}/t/batch")


def test_merge_that_fails_shows_nothing(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    table.refresh(numbers(spark, (1, "a", 1, "x"), schema=SCHEMA))
    bad = numbers(spark, (1, "b", 2, "x"), schema=SCHEMA).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.refresh(bad)
    assert rows(table.read(), "id", "v") == [(1, "a")]


def failing(spark):
    return numbers(spark, (1, "a")).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))


def test_failed_replacement_leaves_the_old_table(spark, tmp_path):
    path, day = str(tmp_path / "m"), DAY(2024, 1, 1)
    write_models({"m": numbers(spark, (1, "a"))}, str(tmp_path))
    bronze.write_day(numbers(spark, (1, "a")), f"{tmp_path}/d", day)
    load.load_full(numbers(spark, (1, "a")), f"{tmp_path}/f", "1")
    for write in (
        lambda: write_models({"m": failing(spark)}, str(tmp_path)),
        lambda: bronze.write_day(failing(spark), f"{tmp_path}/d", day),
        lambda: load.load_full(failing(spark), f"{tmp_path}/f", "2"),
    ):
        with pytest.raises(Exception, match="lost"):
            write()
    assert rows(tables.read_table(spark, path)) == [(1, "a")]
    assert rows(bronze.read_latest(spark, f"{tmp_path}/d")) == [(1, "a")]
    assert rows(load.read_target(spark, f"{tmp_path}/f")) == [(1, "a")]
    for _ in range(4):
        write_models({"m": numbers(spark, (2, "b"))}, str(tmp_path))
    assert rows(tables.read_table(spark, path)) == [(2, "b")]
    assert len(folders.finished_versions(spark, path)) == tables.KEPT


def test_repeated_load_adds_nothing(spark, tmp_path):
    target, data = str(tmp_path / "t"), numbers(spark, (1, "a"), (2, "b"))
    assert [load.load_append(data, target, "run-1").rows for _ in range(3)] == [2, 2, 2]
    assert load.read_target(spark, target).count() == 2
    load.load_append(data, target, "run-2")
    assert load.read_target(spark, target).count() == 4
    with pytest.raises(FileNotFoundError):
        load.read_target(spark, str(tmp_path / "none"))


def test_a_day_without_rows_is_empty(spark, tmp_path):
    path, day = str(tmp_path / "t"), DAY(2024, 1, 1)
    assert bronze.write_day(numbers(spark, *[(n, "a") for n in range(5)]), path, day) == 5
    assert bronze.write_day(numbers(spark, (1, "a")).limit(0), path, day) == 0
    assert bronze.read_latest(spark, path).count() == 0


def test_group_without_its_marker_is_invisible(spark, tmp_path):
    """The driver is lost after the tables were written and before the marker was."""
    root, day = str(tmp_path), DAY(2024, 1, 1)
    bronze.land_group({"a": numbers(spark, (1, "a")), "b": numbers(spark, (1, "b"))}, root, day)
    bronze.write_run(numbers(spark, (2, "a"), (3, "a")), f"{root}/a", day, group="lost")
    assert rows(bronze.read_latest(spark, f"{root}/a"), "id") == [(1,)]
    bronze.land_group({"a": numbers(spark, (9, "a")), "b": numbers(spark, (9, "b"))}, root, day)
    assert rows(bronze.read_latest(spark, f"{root}/a"), "id") == rows(bronze.read_latest(spark, f"{root}/b"), "id") == [(9,)]


def test_history_table_adds_closed_versions_only(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), ["id"], ["v"], "at")
    schema = "id int, v string, at int"
    assert table.read() is None
    table.apply(numbers(spark, (1, "a", 1), (1, "b", 2), (2, "a", 1), schema=schema))
    table.apply(numbers(spark, (1, "c", 3), (3, "a", 3), schema=schema))
    table.apply(numbers(spark, (2, "a", 9), schema=schema))
    assert rows(table.read(), "id", "v", "valid_from", "valid_to") == [
        (1, "a", 1, 2), (1, "b", 2, 3), (1, "c", 3, None), (2, "a", 1, None), (3, "a", 3, None),
    ]
    assert spark.read.parquet(f"{tmp_path}/h/closed/version=1").count() == 1


class Reader:
    """Stands in for ``spark.read``; a real database is not started in tests."""

    def __init__(self):
        self.calls = []

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self.calls[-1]


class Session:
    def __init__(self):
        self.read = Reader()


def test_jdbc_reads_are_split():
    session, connection = Session(), rdbms.Connection("jdbc:x", "x.Driver", {"user": "u"})
    ranged = rdbms.Split("id", 1, 1000, 20)
    clauses = rdbms.Split(predicates=["id < 5", "id >= 5"])
    rdbms.read_group(session, connection, "public", ["a", "b", "c"], {"a": ranged, "b": clauses})
    (_, name_a, a), (_, _, b), (_, _, c) = session.read.calls
    assert name_a == "public.a"
    assert (a["column"], a["lowerBound"], a["upperBound"], a["numPartitions"]) == ("id", 1, 1000, 20)
    assert b["predicates"] == ["id < 5", "id >= 5"] and "column" not in c
    assert c["properties"] == {"user": "u", "fetchsize": "10000", "driver": "x.Driver"}
