"""Metrics given as formulas.

``members`` rows are at (month, employee, project) grain: date_key, employee_key, project_key,
division, effort_rate, performance_rate, employee_rate (hourly), actual_days, plan_days, actual_hours,
overtime_hours, direct_cost, project_bonus, base_salary, working_days_in_month. A metric reads only
the columns its formula names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.functions import amount, date_key, money, safe_divide
from lakemart.functions.measures import AMOUNT
from lakemart.plans.facts import HOURS_PER_DAY

MONTH_MEMBER = ["date_key", "employee_key", "project_key"]

# The classes of work projects are sorted into.
BILLABLE = "billable"
HR = "hr"
TRAINING = "training"
PRESALE = "presale"
POOL = "pool"


def contract_revenue(projects: DataFrame, contracts: DataFrame) -> DataFrame:
    """Contract value per project, the project's sales amount where no contract is known."""
    return projects.join(contracts, "project_key", "left").select(
        "project_key", F.coalesce("contract_value", "total_sales_amount").alias("contract_revenue")
    )


def fixcost_revenue_delta(completion: DataFrame) -> DataFrame:
    """Contract times this month's rise of the cumulative completion rate.

    ``completion``: project_key, date_key, contract_revenue, complete_rate_plan, complete_rate_actual,
    one row per (project, month), so the window holds one row per month of a project. Before a
    project's first month the rate is zero.
    """
    by_month = Window.partitionBy("project_key").orderBy("date_key")

    def rise(rate: str) -> Column:
        return F.col(rate) - F.lag(rate, 1, 0).over(by_month)

    contract = F.col("contract_revenue")
    return completion.select(
        "project_key",
        "date_key",
        "contract_revenue",
        "complete_rate_plan",
        "complete_rate_actual",
        amount(contract * rise("complete_rate_plan")).alias("revenue_forecast"),
        amount(contract * rise("complete_rate_actual")).alias("revenue_actual"),
    )


def teambase_member_revenue(members: DataFrame) -> DataFrame:
    """Forecast: rate times eight hours per planned day. Actual: rate times hours worked."""
    known = [c for c in ("division",) if c in members.columns]
    return members.select(
        *MONTH_MEMBER,
        *known,
        "employee_rate",
        _planned_hours().alias("forecast_hours"),
        "actual_hours",
        *[column.alias(name) for name, column in _revenue().items()],
    )


def _planned_hours() -> Column:
    return (F.col("plan_days") * HOURS_PER_DAY).cast("decimal(9,2)")


def _revenue() -> dict[str, Column]:
    rate = F.col("employee_rate")
    return {
        "revenue_forecast": amount(rate * _planned_hours()),
        "revenue_actual": amount(rate * F.col("actual_hours")),
    }


def fixcost_member_share(members: DataFrame, project_revenue: DataFrame) -> DataFrame:
    """Member's share of effort, times performance, times the project's revenue of the month.

    Total effort is a grouped sum joined back, not a window: a project with a third of all members is
    added up before the shuffle and its join partition can be split.
    """
    total = members.groupBy("date_key", "project_key").agg(
        F.sum("effort_hours").cast("decimal(18,2)").alias("total_effort_hours")
    )
    per_project = project_revenue.join(total, ["date_key", "project_key"])
    share = safe_divide(
        F.col("effort_hours").cast("decimal(8,2)")
        * F.col("performance_rate").cast("decimal(4,2)")
        * F.col("project_revenue").cast("decimal(18,2)"),
        "total_effort_hours",
    )
    return members.join(per_project, ["date_key", "project_key"]).select(
        *MONTH_MEMBER, "effort_hours", "total_effort_hours", amount(share).alias("member_revenue")
    )


def total_effort(members: DataFrame) -> DataFrame:
    """Working days times eight times effort rate, over an employee's projects of the month."""
    effort = F.col("working_days_in_month") * HOURS_PER_DAY * F.col("effort_rate")
    return members.groupBy("date_key", "employee_key").agg(F.sum(effort).cast("decimal(18,2)").alias("total_effort"))


def member_cost(members: DataFrame) -> DataFrame:
    """Direct cost and bonus by planned and by actual days; the actual side adds overtime at salary."""
    return members.select(*MONTH_MEMBER, "division", *[column.alias(name) for name, column in _cost().items()])


def _cost() -> dict[str, Column]:
    base = F.col("direct_cost") + F.coalesce(F.col("project_bonus"), F.lit(0))
    month = F.col("working_days_in_month")
    worked = base * F.col("actual_days") * HOURS_PER_DAY
    overtime = F.col("base_salary") * F.coalesce(F.col("overtime_hours"), F.lit(0))
    return {
        "cost_forecast": amount(safe_divide(base * F.col("plan_days"), month)),
        "cost_actual": amount(safe_divide(worked + overtime, month * HOURS_PER_DAY)),
    }


def project_cost(member_costs: DataFrame, packages: DataFrame) -> DataFrame:
    """Member cost of each (month, project), plus the package share of fixed-price projects.

    ``packages``: date_key, project_key, package_cost, working_days, working_days_in_month. A project with a
    package in any month is a fixed-price one in all of them, others are team-based. A package month without
    member cost still counts.
    """
    members = member_costs.groupBy("date_key", "project_key").agg(F.sum("cost_actual").alias("member_cost"))
    share = safe_divide(F.col("package_cost") * F.col("working_days"), "working_days_in_month")
    package = packages.groupBy("date_key", "project_key").agg(F.sum(amount(share)).alias("package_cost"))
    spent = F.coalesce("member_cost", F.lit(0)) + F.coalesce("package_cost", F.lit(0))
    fixed = package.groupBy("project_key").agg(F.lit(True).alias("fixed"))
    return (
        members.join(package, ["date_key", "project_key"], "full")
        .join(fixed, "project_key", "left")
        .select(
            "date_key",
            "project_key",
            F.when(F.col("fixed"), "fix_cost").otherwise("teambase").alias("cost_type"),
            amount(spent).alias("project_cost"),
        )
    )


def production_cost(project_costs: DataFrame, divisions: DataFrame) -> DataFrame:
    """Project cost per (month, division); ``divisions`` maps project_key to division_name."""
    mapped = project_costs.join(divisions.select("project_key", "division_name"), "project_key", "left")
    return mapped.groupBy("date_key", "division_name").agg(F.sum("project_cost").alias("production_cost"))


def operational_cost(work: DataFrame) -> DataFrame:
    """Cost of HR, training and presale hours and of pool salaries per (month, division).

    ``work``: date_key, division, employee_key, work_class, employee_rate, hours, base_salary. A pool
    employee's salary counts once a month, however many rows they have.
    """
    cost = F.col("employee_rate") * F.col("hours")
    kind = F.col("work_class")
    per_employee = work.groupBy("date_key", "division", "employee_key").agg(
        F.sum(F.when(kind == HR, cost)).alias("hr_cost"),
        F.sum(F.when(kind == TRAINING, cost)).alias("training_cost"),
        F.sum(F.when(kind == PRESALE, cost)).alias("presale_cost"),
        F.max(F.when(kind == POOL, F.col("base_salary"))).alias("resource_pool_cost"),
    )
    kinds = ("hr_cost", "training_cost", "presale_cost", "resource_pool_cost")
    return per_employee.groupBy("date_key", "division").agg(
        *[F.coalesce(F.sum(k), F.lit(0)).cast(AMOUNT).alias(k) for k in kinds]
    )


def daily_hours(timesheet: DataFrame, keys: Sequence[str] = ("employee_key", "project_key")) -> DataFrame:
    """Hours per day; the step that turns repeated entries of a day into one row."""
    return timesheet.groupBy(*keys, "day").agg(F.sum("hours").cast("decimal(18,2)").alias("hours"))


def working_days(timesheet: DataFrame, calendar: DataFrame, spans: DataFrame) -> DataFrame:
    """Actual and planned working days and overtime per (month, employee, project).

    ``timesheet``: employee_key, project_key, day, hours; ``spans``: project_key, start_day, end_day.
    Actual: distinct working days with hours. Overtime: hours above eight a day. Planned: working days
    of the month inside the project's span, as the difference of two positions in the month's running
    count, so two equi joins do what a range join would; none if the month lies outside the span.
    """
    days = calendar.select(F.col("date_actual").alias("day"), "is_working_day", "month_start_date", "month_end_date")
    month = ["month_start_date", "month_end_date"]
    above = F.greatest(F.col("hours") - HOURS_PER_DAY, F.lit(0))
    worked = (
        daily_hours(timesheet)
        .join(F.broadcast(days), "day")
        .groupBy("employee_key", "project_key", *month)
        .agg(
            F.count_if("is_working_day").alias("actual_working_days"),
            F.sum(above).cast("decimal(18,2)").alias("overtime_hours"),
        )
    )
    planned = planned_days(worked.join(spans, "project_key", "left"), calendar)
    return planned.select(
        date_key("month_start_date").alias("date_key"),
        "employee_key",
        "project_key",
        "actual_working_days",
        F.col("plan_days").alias("plan_working_days"),
        "overtime_hours",
    )


def planned_days(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """``rows`` with ``plan_days``: working days of their month between their ``start_day`` and ``end_day``.

    ``rows`` have month_start_date and month_end_date too; an open end does not bound the span. The days are the
    difference of two positions in the month's running count, so two equi joins do what a range join would.
    """
    # one row per calendar day: working days of the month up to and including it
    so_far = Window.partitionBy("year", "month").orderBy("date_actual")
    running = calendar.select(
        F.col("date_actual").alias("_day"),
        F.count_if("is_working_day").over(so_far).alias("_upto"),
        F.col("is_working_day").cast("int").alias("_self"),
    )
    first = running.select(F.col("_day").alias("_first"), (F.col("_upto") - F.col("_self")).alias("_before"))
    last = running.select(F.col("_day").alias("_last"), F.col("_upto").alias("_through"))
    planned = F.when(F.col("_first") <= F.col("_last"), F.col("_through") - F.col("_before"))
    spanned = rows.withColumn("_first", F.greatest("start_day", "month_start_date"))
    return (
        spanned.withColumn("_last", F.least("end_day", "month_end_date"))
        .join(F.broadcast(first), "_first", "left")
        .join(F.broadcast(last), "_last", "left")
        .withColumn("plan_days", F.coalesce(planned, F.lit(0)))
        .drop("_first", "_last", "_before", "_through")
    )


def target_variance(actuals: DataFrame, targets: DataFrame) -> DataFrame:
    """Actual against target revenue and cost per month; a month without a target has no variance."""
    return actuals.join(targets, "date_key", "left").select(
        "date_key",
        "revenue_actual",
        "revenue_target",
        (F.col("revenue_actual") - F.col("revenue_target")).alias("revenue_variance"),
        "cost_actual",
        "cost_target",
        (F.col("cost_actual") - F.col("cost_target")).alias("cost_variance"),
    )


def pnl_ratio(members: DataFrame, keys: Sequence[str] = ("date_key", "division")) -> DataFrame:
    """Cost as a percentage of revenue, forecast and actual; revenue and cost of a member are summed in one grouping."""
    sides = {**_revenue(), **_cost()}
    summed = members.groupBy(*keys).agg(*[F.sum(column).alias(name) for name, column in sides.items()])

    def ratio(spent: str, earned: str) -> Column:
        return F.when(
            F.col(earned) > 0, F.col(spent).cast("double") / F.col(earned).cast("double") * F.lit(100.0)
        )

    return summed.select(
        *keys,
        ratio("cost_forecast", "revenue_forecast").alias("pnl_forecast"),
        ratio("cost_actual", "revenue_actual").alias("pnl_actual"),
    )


def rates_by_division(work: DataFrame) -> DataFrame:
    """Billable and busy rate (percent), pool and training headcount per (month, division).

    Employees are reduced to one row of flags per month first, so heads are counted once. Busy is
    billable or HR work; presale, internal and training work alone is not.
    """
    kind = F.col("work_class")
    heads = work.groupBy("date_key", "division", "employee_key").agg(
        *[F.bool_or(kind == c).alias(f"_{c}") for c in (BILLABLE, HR, POOL, TRAINING)]
    )
    counted = heads.groupBy("date_key", "division").agg(
        F.count(F.lit(1)).alias("total_headcount"),
        F.count_if(F.col("_billable")).alias("billable_headcount"),
        F.count_if(F.col("_billable") | F.col("_hr")).alias("busy_headcount"),
        F.count_if(F.col("_pool")).alias("available_headcount"),
        F.count_if(F.col("_training")).alias("training_headcount"),
    )
    return counted.select(
        *counted.columns,
        (F.col("billable_headcount") / F.col("total_headcount") * 100).alias("billable_rate"),
        (F.col("busy_headcount") / F.col("total_headcount") * 100).alias("busy_rate"),
    )


def _heads(presence: DataFrame, *extra: Column) -> DataFrame:
    """One row per (month, division, employee)."""
    return presence.groupBy("date_key", "division", "employee_key").agg(*extra)


def dev_avg_salary(presence: DataFrame) -> DataFrame:
    """Total salary over headcount per (month, division); an unknown salary lowers the average."""
    heads = _heads(presence, F.max("base_salary").alias("salary"))
    totals = heads.groupBy("date_key", "division").agg(
        F.sum("salary").alias("total_salary"), F.count(F.lit(1)).alias("total_headcount")
    )
    average = F.col("total_salary").cast("double") / F.col("total_headcount").cast("double")
    return totals.select(*totals.columns, average.alias("dev_avg_salary"))


def turnover(presence: DataFrame) -> DataFrame:
    """Departed over average headcount, percent, per (month, division).

    Departed in a month: there the month before and not in it. Average: of the two months. One pass:
    each (division, employee) is a window of at most one row per month, and every presence counts for
    its own month and for the next.
    """
    number = (F.floor(F.col("date_key") / 10000) * 12 + F.floor(F.col("date_key") / 100) % 100 - 1).cast("int")
    heads = presence.select("division", "employee_key", number.alias("_month")).distinct()
    follow = F.lead("_month").over(Window.partitionBy("division", "employee_key").orderBy("_month"))
    left = F.coalesce(follow != F.col("_month") + 1, F.lit(True)).cast("int")
    zero, one = F.lit(0), F.lit(1)

    def row(month: Column, now: Column, before: Column, departed: Column) -> Column:
        return F.struct(
            month.alias("_month"), now.alias("_now"), before.alias("_before"), departed.alias("_departed")
        )

    both = F.array(row(F.col("_month"), one, zero, zero), row(F.col("_month") + 1, zero, one, F.col("_left")))
    counted = (
        heads.withColumn("_left", left)
        .select("division", F.explode(both).alias("_row"))
        .groupBy("division", "_row._month")
        .agg(
            F.sum("_row._now").alias("headcount"),
            F.sum("_row._before").alias("headcount_before"),
            F.sum("_row._departed").alias("departed"),
        )
    )
    last = heads.select(F.max("_month")).scalar()
    average = (F.col("headcount") + F.col("headcount_before")) / F.lit(2.0)
    year = F.floor(F.col("_month") / 12)
    return counted.where(F.col("_month") <= last).select(
        (year * 10000 + (F.col("_month") % 12 + 1) * 100 + 1).cast("int").alias("date_key"),
        "division",
        "headcount",
        "headcount_before",
        "departed",
        (F.col("departed") / average * 100).alias("turnover_rate"),
    )


def headcount_class(presence: DataFrame, outsource_types: Sequence[str]) -> DataFrame:
    """Outsourced and internal heads per (month, division), by employment type."""
    heads = _heads(presence, F.max("employment_type").alias("_type"))
    outside = F.coalesce(F.col("_type").isin(*outsource_types), F.lit(False))
    return heads.groupBy("date_key", "division").agg(
        F.count_if(outside).alias("outsource_hc"), F.count_if(~outside).alias("internal_hc")
    )


def employee_performance(members: DataFrame) -> DataFrame:
    """Revenue, cost and profit contribution per (month, employee, project).

    Revenue: rate times effort times performance. Cost: direct cost by days worked.
    """
    revenue = amount(F.col("employee_rate") * F.col("effort_rate") * F.col("performance_rate"))
    cost = amount(safe_divide(F.col("direct_cost") * F.col("actual_days"), "working_days_in_month"))
    effort = money(F.col("working_days_in_month") * HOURS_PER_DAY * F.col("effort_rate"))
    return members.select(
        *MONTH_MEMBER,
        "effort_rate",
        "performance_rate",
        effort.alias("total_effort_hours"),
        "actual_hours",
        revenue.alias("revenue_contribution"),
        cost.alias("cost_contribution"),
        (revenue - cost).alias("profit_contribution"),
    )
