"""Figures of divisions and the company against plain sets."""

import random
from decimal import Decimal

from conftest import rows

from lakemart.plans import levels, metrics

WORK = "date_key int, division string, employee_key long, work_class string, employee_rate decimal(18,2), hours decimal(18,2), base_salary decimal(18,2)"
PRESENCE = "date_key int, division string, employee_key long, base_salary decimal(18,2), employment_type string"
MONTHS = [20231101, 20231201, 20240101, 20240201, 20240501]


def levels_of(division):
    return [("division", division), ("company", None)]


def work_rows(count=400):
    pick = random.Random(8)
    kinds = [metrics.BILLABLE, metrics.HR, metrics.TRAINING, metrics.PRESALE, metrics.POOL, "internal", None]
    # numbers on both sides of a bitmap's end, and heads that two divisions share
    numbers = [1, 2, 32_768, 32_769, 70_000, 9_999_999_999, *range(50, 70)]
    return [
        (pick.choice(MONTHS), pick.choice(["north", "south", None]), pick.choice(numbers), pick.choice(kinds), Decimal(2), Decimal(3), Decimal(100))
        for _ in range(count)
    ]


def test_distinct_heads_of_both_levels(spark):
    data = work_rows()
    want = {}
    classes = [
        lambda k: True, lambda k: k == "billable", lambda k: k in ("billable", "hr"), lambda k: k == "pool", lambda k: k == "training",
    ]
    for month, division, number, kind, *_ in data:
        for level in levels_of(division):
            sets = want.setdefault((month, *level), [set() for _ in classes])
            for n, holds in enumerate(classes):
                if holds(kind):
                    sets[n].add(number)
    found = levels.work_counts(spark.createDataFrame(data, WORK))
    figures = [*levels.LEVEL, "total_hc", "billable_hc", "busy_hc", "available_hc", "training_hc"]
    assert rows(found, *figures) == sorted(((*k, *map(len, sets)) for k, sets in want.items()), key=repr)
    rates = {tuple(r)[:3]: (r["billable_rate"], r["busy_rate"]) for r in found.collect()}
    assert rates == {k: (len(s[1]) / len(s[0]) * 100, len(s[2]) / len(s[0]) * 100) for k, s in want.items()}


def test_departed_heads_of_both_levels(spark):
    pick = random.Random(3)
    data = [
        (pick.choice(MONTHS), pick.choice(["north", "south"]), pick.choice([1, 40_000, *range(5, 15)]), Decimal(50), pick.choice(["Out", "In", None]))
        for _ in range(60)
    ]
    data = [(m, d, n, pay, {0: "Out", 1: "In", 2: None}[n % 3]) for m, d, n, pay, _ in data]
    number = {m: (m // 10000) * 12 + m // 100 % 100 - 1 for m in MONTHS}
    there = {}
    for month, division, head, *_ in data:
        for level in levels_of(division):
            there.setdefault(level, {}).setdefault(number[month], set()).add(head)
    want, last = [], max(number[row[0]] for row in data)
    for level, months in there.items():
        for month in sorted({m for own in months for m in (own, own + 1) if m <= last}):
            now, before = months.get(month, set()), months.get(month - 1, set())
            outside = len([n for n in now if n % 3 == 0])
            key = month // 12 * 10000 + (month % 12 + 1) * 100 + 1
            rate = len(before - now) / ((len(now) + len(before)) / 2) * 100
            want.append((key, *level, len(now), outside, len(now) - outside, len(before - now), rate))
    found = levels.presence_counts(spark.createDataFrame(data, PRESENCE), ["Out"])
    assert rows(found) == sorted(want, key=repr)


def test_no_kind_of_cost_is_null_and_levels_add_up(spark):
    members = spark.createDataFrame(
        [(20240101, "north", Decimal(10), Decimal(7)), (20240101, None, Decimal(1), Decimal(1))],
        "date_key int, division string, cost_forecast decimal(18,2), cost_actual decimal(18,2)",
    )
    work = [
        (20240101, "north", 1, metrics.HR, Decimal(2), Decimal(3), Decimal(100)),
        (20240101, "south", 2, metrics.POOL, Decimal(2), Decimal(3), Decimal(100)),
        (20240101, "south", 2, metrics.POOL, Decimal(2), Decimal(9), Decimal(100)),
        (20240201, "south", 2, metrics.PRESALE, Decimal(2), Decimal("0.5"), None),
    ]
    found = levels.cost_summary(members, spark.createDataFrame(work, WORK))
    assert not [r for r in found.collect() if None in r[3:]]
    total = {tuple(r)[:3]: float(r["total_cost_actual"]) for r in found.collect()}
    assert total == {
        (20240101, "division", "north"): 13, (20240101, "division", "south"): 100, (20240101, "division", None): 1,
        (20240101, "company", None): 114, (20240201, "division", "south"): 1, (20240201, "company", None): 1,
    }


def test_a_head_in_two_divisions_is_paid_once_in_the_company(spark):
    data = [(20240101, "north", 1, Decimal(50), "In"), (20240101, "south", 1, Decimal(50), "In"), (20240101, "south", 2, None, "In")]
    presence = spark.createDataFrame(data, PRESENCE)
    work = spark.createDataFrame([(20240301, "west", 7, "hr", Decimal(1), Decimal(1), None)], WORK)
    found = {tuple(r)[:3]: r for r in levels.hr_summary(work, presence, ["Out"]).collect()}
    company = found[20240101, "company", None]
    assert (company["headcount"], company["total_salary"], company["dev_avg_salary"]) == (2, 50, 25.0)
    assert (company["total_hc"], company["billable_rate"]) == (0, None)
    assert found[20240301, "division", "west"]["headcount"] == 0


def test_one_scan_serves_both_levels(spark, tmp_path):
    spark.createDataFrame(work_rows(20), WORK).write.parquet(str(tmp_path / "w"))
    plan = levels.work_counts(spark.read.parquet(str(tmp_path / "w")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Expand") == 1
