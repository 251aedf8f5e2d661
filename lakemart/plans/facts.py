"""Monthly facts: cost, headcount, revenue.

Activity rows are inputs. ``activity``: year, month, employee_key, project_key, org_key, days_worked,
total_hours, total_overtime_hours. ``presence``: year, month, employee_key, org_key,
has_billable_work, total_hours. ``assignments``: year, month, employee_key, project_name,
hours_on_project.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import amount, packed, safe_divide, surrogate_key, unpacked
from lakemart.functions.measures import AMOUNT, MONEY
from lakemart.plans.calendar import per_month

# Category keys, norms and words the rules depend on.
SALARY = "member_salary"
OVERTIME = "member_overtime"
HOURS_PER_DAY = 8
OVERTIME_FACTOR = "1.5"
PART_TIME = "Part-time"
PART_TIME_VALUE = "0.5"
FIX_COST_TYPE = "Fix Cost"
FIX_COST = "fix_cost"
TEAM_BASE = "teambase"
HR_WORDS = ("hr", "interview")
POOL_WORDS = ("pool",)
TRAINING_WORDS = ("training", "resource pool")

KEYS = ["date_key", "employee_key", "project_key", "org_key"]
COST_COLUMNS = [
    "cost_monthly_key",
    *KEYS,
    "cost_category_key",
    "working_days_in_month",
    "days_worked",
    "base_salary",
    "prorated_salary",
    "project_bonus",
    "overtime_cost",
    "cost_actual",
    "cost_forecast",
]


def _gathered(rows: DataFrame, key: str) -> DataFrame:
    """The rows of a month together, for a table stored by month; ``key`` travels as bytes."""
    together = rows.withColumn(key, packed(key)).hint("rebalance", "date_key")
    return together.withColumn(key, unpacked(key))


def _paid_activity(activity: DataFrame, months: DataFrame, employees: DataFrame) -> DataFrame:
    salaries = employees.where(F.col("base_salary").isNotNull()).select("employee_key", "base_salary")
    month = months.select(
        "year", "month", "date_key", F.col("total_working_days_in_month").alias("working_days_in_month")
    )
    return activity.join(F.broadcast(month), ["year", "month"]).join(salaries, "employee_key")


def _cost_rows(paid: DataFrame, category: Column) -> DataFrame:
    """Price the activity rows by cost kind; ``category`` may explode a row into one per kind."""
    salary = safe_divide(F.col("base_salary") * F.col("days_worked"), "working_days_in_month")
    hours = F.col("total_overtime_hours").cast("decimal(9,2)") * F.lit(OVERTIME_FACTOR).cast("decimal(2,1)")
    overtime = safe_divide(F.col("base_salary") * hours, F.col("working_days_in_month") * HOURS_PER_DAY)
    is_salary = F.col("cost_category_key") == SALARY
    return (
        paid.withColumn("cost_category_key", category)
        .withColumn("cost_actual", F.when(is_salary, amount(salary)).otherwise(amount(overtime)))
        .withColumn("prorated_salary", F.when(is_salary, F.col("cost_actual")))
        .withColumn("project_bonus", F.lit(None).cast(MONEY))
        .withColumn("overtime_cost", F.when(~is_salary, F.col("cost_actual")))
        .withColumn("cost_forecast", F.when(is_salary, F.col("base_salary")))
        .withColumn(
            "cost_monthly_key", surrogate_key("date_key", "employee_key", "project_key", "cost_category_key")
        )
        .select(*COST_COLUMNS)
    )


def fct_cost_salary(activity: DataFrame, months: DataFrame, employees: DataFrame) -> DataFrame:
    """Salary share of the days worked on a project."""
    return _cost_rows(_paid_activity(activity, months, employees), F.lit(SALARY))


def fct_cost_overtime(activity: DataFrame, months: DataFrame, employees: DataFrame) -> DataFrame:
    """Overtime at one and a half times the hourly salary, where there is any."""
    overtime = activity.where(F.col("total_overtime_hours") > 0)
    return _cost_rows(_paid_activity(overtime, months, employees), F.lit(OVERTIME))


def fct_cost_monthly(
    activity: DataFrame, months: DataFrame, employees: DataFrame, by_month: bool = False
) -> DataFrame:
    """Salary and overtime cost per (month, employee, project, kind), from one read of the activity.

    ``by_month`` brings the rows of a month together, for a table stored by month, before they get keys and kinds.
    """
    paid = _paid_activity(activity, months, employees)
    if by_month:
        paid = _gathered(paid, "employee_key")
    kinds = F.array(F.lit(SALARY), F.when(F.col("total_overtime_hours") > 0, F.lit(OVERTIME)))
    return _cost_rows(paid, F.explode(F.array_compact(kinds)))


def _names_any(words: tuple[str, ...]) -> Column:
    name = F.lower("project_name")
    return reduce(lambda a, b: a | b, [name.contains(w) for w in words])


def headcount_flags(assignments: DataFrame) -> DataFrame:
    """Per (month, employee): any HR, pool or training project, told by its name."""
    return assignments.groupBy("year", "month", "employee_key").agg(
        F.bool_or(_names_any(HR_WORDS)).alias("is_hr_project"),
        F.bool_or(_names_any(POOL_WORDS)).alias("is_pool"),
        F.bool_or(_names_any(TRAINING_WORDS)).alias("is_training"),
    )


def fct_headcount_monthly(
    presence: DataFrame, assignments: DataFrame, months: DataFrame, employees: DataFrame
) -> DataFrame:
    """One row per (month, active employee); missing flags are false."""
    who = employees.select("employee_key", "base_salary", "billing_rate", "employment_type")
    value = F.when(F.col("employment_type") == PART_TIME, F.lit(PART_TIME_VALUE)).otherwise(F.lit("1.0"))
    return (
        presence.join(headcount_flags(assignments), ["year", "month", "employee_key"], "left")
        .join(F.broadcast(months.select("year", "month", "date_key")), ["year", "month"])
        .join(who, "employee_key")
        .select(
            surrogate_key("date_key", "employee_key").alias("headcount_monthly_key"),
            "date_key",
            "employee_key",
            "org_key",
            F.lit(True).alias("is_active"),
            F.col("has_billable_work").alias("is_billable"),
            *[F.coalesce(f, F.lit(False)).alias(f) for f in ("is_hr_project", "is_pool", "is_training")],
            F.col("base_salary").alias("total_salary"),
            "billing_rate",
            value.cast("decimal(2,1)").alias("headcount_value"),
        )
    )


REVENUE_COLUMNS = [
    "revenue_monthly_key",
    "date_key",
    "project_key",
    "org_key",
    "revenue_type",
    "contract_revenue",
    "complete_rate_plan",
    "complete_rate_actual",
    "headcount_rate",
    "total_hours_forecast",
    "total_hours_actual",
    "revenue_forecast",
    "revenue_actual",
]


def fct_revenue_fixcost(projects: DataFrame, month_starts: DataFrame, by_month: bool = False) -> DataFrame:
    """Contract times completion rate of each fixed-price project, in every month.

    The rate is the project's cumulative one, so the amount repeats; ``metrics.fixcost_revenue_delta``
    gives the month's increase.
    """
    fixed = projects.where(
        (F.col("project_type") == FIX_COST_TYPE) & F.col("total_sales_amount").isNotNull()
    ).select("project_key", "total_sales_amount", "plan_complete_rate", "actual_complete_rate")
    contract = F.col("total_sales_amount")
    rows = per_month(fixed, month_starts.select("date_key"))
    return (
        (_gathered(rows, "project_key") if by_month else rows)
        .select(
            surrogate_key("date_key", "project_key").alias("revenue_monthly_key"),
            "date_key",
            "project_key",
            F.lit(None).cast("string").alias("org_key"),
            F.lit(FIX_COST).alias("revenue_type"),
            contract.alias("contract_revenue"),
            F.col("plan_complete_rate").alias("complete_rate_plan"),
            F.col("actual_complete_rate").alias("complete_rate_actual"),
            F.lit(None).cast(MONEY).alias("headcount_rate"),
            F.lit(None).cast(MONEY).alias("total_hours_forecast"),
            F.lit(None).cast(MONEY).alias("total_hours_actual"),
            amount(contract * F.col("plan_complete_rate")).alias("revenue_forecast"),
            amount(contract * F.col("actual_complete_rate")).alias("revenue_actual"),
        )
    )


def fct_revenue_teambase(members: DataFrame, by_month: bool = False) -> DataFrame:
    """Rate times hours of each time-and-material project, from ``metrics.teambase_member_revenue``."""
    sums = members.groupBy("date_key", "project_key").agg(
        F.sum("forecast_hours").cast(MONEY).alias("total_hours_forecast"),
        F.sum("actual_hours").cast(MONEY).alias("total_hours_actual"),
        F.sum("revenue_forecast").cast(AMOUNT).alias("revenue_forecast"),
        F.sum("revenue_actual").cast(AMOUNT).alias("revenue_actual"),
    )
    return (
        (_gathered(sums, "project_key") if by_month else sums)
        .select(
            surrogate_key("date_key", "project_key").alias("revenue_monthly_key"),
            "date_key",
            "project_key",
            F.lit(None).cast("string").alias("org_key"),
            F.lit(TEAM_BASE).alias("revenue_type"),
            F.lit(None).cast(MONEY).alias("contract_revenue"),
            F.lit(None).cast("decimal(14,6)").alias("complete_rate_plan"),
            F.lit(None).cast("decimal(14,6)").alias("complete_rate_actual"),
            F.lit(None).cast(MONEY).alias("headcount_rate"),
            "total_hours_forecast",
            "total_hours_actual",
            "revenue_forecast",
            "revenue_actual",
        )
    )


def fct_revenue_monthly(
    projects: DataFrame, month_starts: DataFrame, members: DataFrame | None = None, by_month: bool = False
) -> DataFrame:
    """Revenue per (month, project): fixed-price projects, and team-based ones if member rows are given.

    ``by_month`` brings the rows of a month together, for a table stored by month, before they get their keys.
    """
    fixed = fct_revenue_fixcost(projects, month_starts, by_month)
    return fixed if members is None else fixed.unionByName(fct_revenue_teambase(members, by_month))
