"""Figures of divisions and of the whole company in one pass.

Rows are added up by grouping sets, (month, division) and (month), so the company's figures come from the same scan and
shuffle as its divisions'. Heads are sets: one bitmap of employee numbers per month, division and class of work. Bitmaps
merge by OR, so a head that two divisions have counts once in the company, and no row is read again for another level.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.measures import AMOUNT
from lakemart.plans import metrics

DIVISION, COMPANY = "division", "company"
LEVEL = ["date_key", "level", "division"]
COST_KINDS = ("hr_cost", "training_cost", "presale_cost", "resource_pool_cost")


def _level() -> Column:
    return F.when(F.grouping("division") == 1, COMPANY).otherwise(DIVISION).alias("level")


def _both_levels(rows: DataFrame, aggregates: Sequence[Column], *more: str) -> DataFrame:
    """Aggregates per (month, division, ``more``) and per (month, ``more``)."""
    sets = [["date_key", "division", *more], ["date_key", *more]]
    return rows.groupingSets(sets, "date_key", "division", *more).agg(_level(), *aggregates)


def cost_summary(member_costs: DataFrame, work: DataFrame) -> DataFrame:
    """Every kind of cost per month, for each division and for the company; a kind without cost is 0.

    Production cost is what members cost (``metrics.member_cost``), planned and actual; the other kinds come from
    ``work`` as ``metrics.operational_cost`` takes it, and are actual. The total adds all kinds up.
    """
    sides = {"production_cost_forecast": "cost_forecast", "production_cost_actual": "cost_actual"}
    made = member_costs.groupBy("date_key", "division").agg(*[F.sum(c).alias(n) for n, c in sides.items()])
    rows = made.unionByName(metrics.operational_cost(work), allowMissingColumns=True)
    kinds = [*sides, *COST_KINDS]
    summed = _both_levels(rows, [F.coalesce(F.sum(k), F.lit(0)).cast(AMOUNT).alias(k) for k in kinds])
    actual = [F.col(k) for k in ("production_cost_actual", *COST_KINDS)]
    total = sum(actual[1:], actual[0]).cast(AMOUNT).alias("total_cost_actual")
    return summed.select(
        *LEVEL, *sides, *[F.col(k).alias(f"{k}_actual") for k in COST_KINDS], total
    )


def head_sets(rows: DataFrame, classes: Mapping[str, Column], number: str = "employee_key") -> DataFrame:
    """A bitmap per class, month and level; ``number`` is the employee's number, from 1 on.

    Numbers beyond one bitmap go to the next ``bucket``. A class without a head has an empty bitmap.
    """
    bucket, place = F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number)
    base = rows.where(F.col(number).isNotNull()).groupBy("date_key", "division", bucket)
    sets = base.agg(*[F.bitmap_construct_agg(F.when(c, place)).alias(n) for n, c in classes.items()])
    return _both_levels(sets, [F.bitmap_or_agg(n).alias(n) for n in classes], "bucket")


def head_counts(sets: DataFrame, names: Sequence[str]) -> DataFrame:
    """How many heads each set holds, per month and level."""
    return sets.groupBy(*LEVEL).agg(*[F.sum(F.bitmap_count(n)).alias(n) for n in names])


def _percent(part: str, whole: str | Column) -> Column:
    return F.col(part) / (F.col(whole) if isinstance(whole, str) else whole) * 100


def work_counts(work: DataFrame, number: str = "employee_key") -> DataFrame:
    """Heads by class of work and the billable and busy rate; as ``metrics.rates_by_division`` for both levels."""
    kind = F.col("work_class")
    classes = {
        "total_hc": F.lit(True),
        "billable_hc": kind == metrics.BILLABLE,
        "busy_hc": kind.isin(metrics.BILLABLE, metrics.HR),
        "available_hc": kind == metrics.POOL,
        "training_hc": kind == metrics.TRAINING,
    }
    counts = head_counts(head_sets(work, classes, number), list(classes))
    rates = [_percent(f"{n}_hc", "total_hc").alias(f"{n}_rate") for n in ("billable", "busy")]
    return counts.select(*counts.columns, *rates)


def _month_number(date_key: Column) -> Column:
    return (F.floor(date_key / 10000) * 12 + F.floor(date_key / 100) % 100 - 1).cast("int")


def presence_counts(presence: DataFrame, outsource_types: Sequence[str], number: str = "employee_key") -> DataFrame:
    """Heads present, outsourced and internal ones, departed ones and turnover, per month and level.

    Departed in a month is who is in the month before and not in it: the heads of both months together less those of
    the month. Turnover is departed over the average of the two months, in percent. The month after a level's last
    one shows its departures, except behind the last month of all.
    """
    outside = F.coalesce(F.col("employment_type").isin(*outsource_types), F.lit(False))
    sets = head_sets(presence, {"present": F.lit(True), "outsource": outside}, number)
    month = _month_number(F.col("date_key"))
    own = F.struct(month.alias("month"), F.lit(True).alias("own"))
    following = F.struct((month + 1).alias("month"), F.lit(False).alias("own"))
    shown = sets.select("level", "division", "bucket", "present", "outsource", F.inline(F.array(own, following)))
    mine = F.col("own")
    parts = shown.groupBy("month", "level", "division", "bucket").agg(
        F.sum(F.when(mine, F.bitmap_count("present")).otherwise(0)).alias("headcount"),
        F.sum(F.when(~mine, F.bitmap_count("present")).otherwise(0)).alias("headcount_before"),
        F.sum(F.when(mine, F.bitmap_count("outsource")).otherwise(0)).alias("outsource_hc"),
        F.bitmap_count(F.bitmap_or_agg("present")).alias("of_both"),
    )
    names = ("headcount", "headcount_before", "outsource_hc", "of_both")
    counted = parts.groupBy("month", "level", "division").agg(*[F.sum(n).alias(n) for n in names])
    last = presence.select(F.max(month)).scalar()
    departed = (F.col("of_both") - F.col("headcount")).alias("departed")
    average = (F.col("headcount") + F.col("headcount_before")) / F.lit(2.0)
    date_key = F.floor(F.col("month") / 12) * 10000 + (F.col("month") % 12 + 1) * 100 + 1
    counted = counted.where(F.col("month") <= last).select(
        date_key.cast("int").alias("date_key"),
        "level",
        "division",
        "headcount",
        "outsource_hc",
        (F.col("headcount") - F.col("outsource_hc")).alias("internal_hc"),
        departed,
        average.alias("average"),
    )
    return counted.withColumn("turnover_rate", _percent("departed", "average")).drop("average")


def salary_totals(presence: DataFrame) -> DataFrame:
    """Salary of all heads per month and level; one that several divisions have counts once in the company."""
    heads = presence.groupBy("date_key", "division", "employee_key").agg(F.max("base_salary").alias("salary"))
    heads = _both_levels(heads, [F.max("salary").alias("salary")], "employee_key")
    return heads.groupBy(*LEVEL).agg(F.sum("salary").alias("total_salary"))


def hr_summary(
    work: DataFrame, presence: DataFrame, outsource_types: Sequence[str], number: str = "employee_key"
) -> DataFrame:
    """Heads by class, rates, turnover and salaries per month, for each division and for the company.

    A month and level that only work or only presence knows has 0 heads on the other side; a rate without heads is null.
    """
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in LEVEL]

    def joined(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        keys = [F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in LEVEL]
        rest = [c for df in (a, b) for c in df.columns if c not in LEVEL]
        return a.alias("a").join(b.alias("b"), same, how).select(*keys, *rest)

    there = joined(presence_counts(presence, outsource_types, number), salary_totals(presence), "left")
    rows = joined(work_counts(work, number), there, "full")
    counts = [c for c in rows.columns if c.endswith("_hc") or c in ("headcount", "departed")]
    rates = [c for c in rows.columns if c.endswith("_rate")]
    average = F.when(F.col("headcount") > 0, F.col("total_salary").cast("double") / F.col("headcount").cast("double"))
    return rows.select(
        *LEVEL,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        *rates,
        F.coalesce("total_salary", F.lit(0)).cast("decimal(28,2)").alias("total_salary"),
        average.alias("dev_avg_salary"),
    )
