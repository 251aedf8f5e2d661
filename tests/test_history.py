import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakemart import operators as op
from lakemart.sources.store import HistoryTable

START = dt.datetime(2024, 1, 1)
SCHEMA = "k string, a string, t timestamp_ntz, n int"


def at(day, second=0):
    return START + dt.timedelta(days=day, seconds=second)


def history_by_hand(data):
    """The plain definition, one key after the other."""
    out = []
    for key in sorted({r[0] for r in data}, key=repr):
        versions = []
        for _, value, when, _ in sorted((r for r in data if r[0] == key), key=lambda r: (r[2], r[3])):
            if not versions or versions[-1][0] != value:
                versions.append((value, when))
        for i, (value, since) in enumerate(versions):
            until = versions[i + 1][1] if i + 1 < len(versions) else None
            out.append((key, value, since, until, until is None))
    return sorted(out, key=repr)


def events(count, seed, hot_part=1 / 3):
    rnd = random.Random(seed)
    out = []
    for n in range(count):
        key = "hot" if rnd.random() < hot_part else f"k{rnd.randrange(40)}"
        burst = 86400 * 20 if rnd.random() < 0.3 else rnd.randrange(86400 * 30)
        value = rnd.choice("abc") if rnd.random() < 0.9 else None
        out.append((key, value, START + dt.timedelta(seconds=burst + rnd.randrange(3)), n))
    return out


def build(spark, data, **limits):
    return op.build_history(spark.createDataFrame(data, SCHEMA), ["k"], ["a"], "t", ["n"], **limits)


def test_value_that_returns_is_a_new_version(spark):
    data = [("x", "a", at(1), 1), ("x", "b", at(2), 2), ("x", "b", at(3), 3), ("x", "a", at(4), 4), ("y", None, at(1), 5)]
    assert rows(build(spark, data)) == history_by_hand(data)
    assert len(history_by_hand(data)) == 4


def test_random_history(spark):
    data = events(1500, 1)
    assert rows(build(spark, data)) == history_by_hand(data)


@pytest.mark.parametrize("slices", [1, 3, 40, 2000])
@pytest.mark.parametrize("strategy", ["check", "timestamp"])
def test_any_number_of_slices_gives_the_same_history(spark, slices, strategy):
    data = events(1500, 2)
    want = history_by_hand if strategy == "check" else timestamps_by_hand
    assert rows(build(spark, data, slices=slices, strategy=strategy)) == want(data)


def largest_slice(spark, data, slices):
    df = spark.createDataFrame(data, SCHEMA)
    sliced, any_cut = op.history.cut_hot_keys(df, ["k"], ["t", "n"], slices)
    assert any_cut
    return sliced.groupBy(op.history.PLACE).count().agg(F.max("count")).first()[0]


def test_a_key_with_a_third_of_all_rows_within_one_day_is_cut(spark):
    data = [("hot", "ab"[n // 7 % 2], at(3, n // 10), n) for n in range(20_000)]
    data += [(f"k{n % 4000}", "ab"[n % 2], at(n % 30, n), n) for n in range(40_000)]
    assert largest_slice(spark, data, 60) < 2.5 * len(data) / 60
    assert rows(build(spark, data, slices=60)) == history_by_hand(data)


def test_rows_of_one_second_are_cut_by_their_tie_breaker(spark):
    data = [("hot", "ab"[n // 5 % 2], at(3), n) for n in range(20_000)]
    assert largest_slice(spark, data, 50) < 2.5 * len(data) / 50


def test_outliers_do_not_change_the_slices(spark):
    """The largest slice has about as many rows with a first and a last day of time in the table as without."""
    data = [("hot", "ab"[n % 2], at(n // 50), n) for n in range(2000)]
    ends = [("hot", "a", dt.datetime(1970, 1, 1), -1), ("hot", "a", dt.datetime(9999, 12, 31), -2)]
    assert max(largest_slice(spark, data, 20), largest_slice(spark, data + ends, 20)) < 2.5 * len(data) / 20
    assert rows(build(spark, data + ends, slices=20)) == history_by_hand(data + ends)


def test_null_keys_and_positions_with_cuts(spark):
    data = [(None if n % 2 else "x", "ab"[n // 9 % 2], at(0, n), None if n % 3 else n) for n in range(900)]
    assert rows(build(spark, data, slices=12)) == rows(build(spark, data, slices=1))
    assert build(spark, data, slices=12).where("is_current").count() == 2


def test_copies_of_one_row_do_not_swell_the_sample(spark):
    data = [("hot", "a", at(1), 1)] * 5000 + [("x", "b", at(2), n) for n in range(50)]
    assert rows(build(spark, data, slices=10)) == [("hot", "a", at(1), None, True), ("x", "b", at(2), None, True)]


@pytest.mark.parametrize("hot", [0, 1 / 3])
def test_rows_are_shuffled_once_and_edges_are_broadcast(spark, tmp_path, hot):
    data = [(f"k{n}" if n % 3 or not hot else "hot", "ab"[n // 9 % 2], at(1, n), n) for n in range(3000)]
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / "e"))
    df = op.build_history(spark.read.parquet(str(tmp_path / "e")), ["k"], ["a"], "t", ["n"], slices=40)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "NestedLoop" not in plan
    assert ("BroadcastHashJoin" in plan) == bool(hot)
    assert hot or plan.count("Exchange") == 1


@pytest.mark.parametrize("kind", ["timestamp", "date", "string", "long"])
def test_any_time_column_can_be_cut(spark, kind):
    data = [(k, v, t.replace(hour=0, second=0, minute=0), n) for k, v, t, n in events(300, 6)]
    df = spark.createDataFrame(data, SCHEMA)
    cast = F.unix_seconds(F.col("t").cast("timestamp")) if kind == "long" else F.col("t").cast(kind)
    got = op.build_history(df.withColumn("t", cast), ["k"], ["a"], "t", ["n"])
    assert got.count() == len(history_by_hand(data)) and got.where("is_current").count() == len({r[0] for r in data})


def timestamps_by_hand(data):
    out = []
    for key in sorted({r[0] for r in data}):
        last = {}
        for _, value, when, n in sorted((r for r in data if r[0] == key), key=lambda r: (r[2], r[3])):
            last[when] = value
        times = sorted(last)
        for since, until in zip(times, [*times[1:], None]):
            out.append((key, last[since], since, until, until is None))
    return sorted(out, key=repr)


def test_timestamp_strategy_opens_a_version_for_each_time(spark):
    data = events(800, 7)
    assert rows(build(spark, data, strategy="timestamp")) == timestamps_by_hand(data)
    with pytest.raises(ValueError, match="strategy"):
        build(spark, data, strategy="other")


@pytest.mark.parametrize("strategy", ["check", "timestamp"])
@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_give_the_whole_history(spark, tmp_path, strategy, seed):
    data, draw = events(400, seed), random.Random(seed)
    draw.shuffle(data)
    table = HistoryTable(spark, str(tmp_path / "h"), ["k"], ["a"], "t", ["n"], strategy)
    want = history_by_hand if strategy == "check" else timestamps_by_hand
    for end in (100, 250, 250, 400):
        start = {100: 0, 250: 100, 400: 250}[end]
        table.apply(spark.createDataFrame(data[start:end], SCHEMA))
        assert rows(table.read(), "k", "a", "valid_from", "valid_to", "is_current") == want(data[:end])
    table.keep(1)
    assert rows(table.read(), "k", "a", "valid_from", "valid_to", "is_current") == want(data)


def test_late_row_between_equal_ones(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), ["k"], ["a"], "t", ["n"])
    for row in (("x", "a", at(10), 1), ("x", "a", at(20), 2), ("x", "b", at(15), 3)):
        table.apply(spark.createDataFrame([row], SCHEMA))
    assert rows(table.read(), "a", "valid_from", "is_current") == [
        ("a", at(10), False), ("a", at(20), True), ("b", at(15), False),
    ]


@pytest.mark.parametrize("limits", [{}, {"slices": 30}])
def test_batches_add_up_to_the_whole_history(spark, limits):
    data = sorted(events(900, 4), key=lambda r: (r[2], r[3]))
    cuts = [at(8), at(20)]
    parts = [
        [r for r in data if r[2] < cuts[0]],
        [r for r in data if cuts[0] <= r[2] < cuts[1]],
        [r for r in data if r[2] >= cuts[1]],
    ]
    history = build(spark, parts[0], **limits)
    for part in parts[1:]:
        batch = spark.createDataFrame(part, SCHEMA)
        stored = spark.createDataFrame(history.collect(), history.schema)
        history = op.apply_batch(stored, batch, ["k"], ["a"], "t", ["n"], **limits)
    assert rows(history) == history_by_hand(data)


def test_batch_applied_twice_and_late_rows_change_nothing(spark):
    data = [("x", "a", at(1), 1), ("x", "b", at(5), 2)]
    batch = spark.createDataFrame([("x", "c", at(9), 3), ("z", "a", at(9), 4)], SCHEMA)
    once = op.apply_batch(build(spark, data), batch, ["k"], ["a"], "t", ["n"])
    twice = op.apply_batch(once, batch, ["k"], ["a"], "t", ["n"])
    assert rows(twice) == rows(once) and once.count() == 4
    late = spark.createDataFrame([("x", "q", at(3), 9)], SCHEMA)
    assert rows(op.apply_batch(once, late, ["k"], ["a"], "t", ["n"])) == rows(once)


def test_empty_batch(spark):
    history = build(spark, [("x", "a", at(1), 1)])
    batch = spark.createDataFrame([], SCHEMA)
    assert rows(op.apply_batch(history, batch, ["k"], ["a"], "t", ["n"])) == rows(history)


def test_fact_without_open_version_keeps_nulls(spark):
    history = build(spark, [("x", "a", at(1), 1), ("x", "b", at(2), 2)])
    fact = spark.createDataFrame([("x", 10), ("nobody", 20)], "k string, amount int")
    assert rows(op.lookup_current(fact, history, ["k"]), "k", "amount", "a") == [("nobody", 20, None), ("x", 10, "b")]
