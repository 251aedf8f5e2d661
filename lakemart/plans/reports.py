"""Report tables over the facts. Facts are reduced to report grain before they meet a month list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.functions import count_where, mean, packed, ratio_if_positive, sum_or_zero, sum_where
from lakemart.functions.measures import MONEY
from lakemart.plans.calendar import per_month
from lakemart.plans.facts import FIX_COST, OVERTIME, SALARY, TEAM_BASE


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def _none(name: str, kind: str = MONEY) -> Column:
    return F.lit(None).cast(kind).alias(name)


def rpt_monthly_pnl(months: DataFrame, revenue: DataFrame, cost: DataFrame) -> DataFrame:
    """Revenue, cost, gross profit and margin of each month; months without facts are zero."""
    kind = F.col("revenue_type")
    earned = revenue.groupBy("date_key").agg(
        sum_or_zero("revenue_actual", kind == TEAM_BASE).alias("revenue_teambase_actual"),
        sum_or_zero("revenue_forecast", kind == TEAM_BASE).alias("revenue_teambase_forecast"),
        sum_or_zero("revenue_actual", kind == FIX_COST).alias("revenue_fixcost_actual"),
        sum_or_zero("revenue_forecast", kind == FIX_COST).alias("revenue_fixcost_forecast"),
    )
    category = F.col("cost_category_key")
    spent = cost.groupBy("date_key").agg(
        sum_or_zero("cost_actual", category == SALARY).alias("cost_salary_actual"),
        sum_or_zero("cost_forecast", category == SALARY).alias("cost_salary_forecast"),
        sum_or_zero("cost_actual", category == OVERTIME).alias("cost_overtime_actual"),
        sum_or_zero("cost_actual").alias("total_cost_actual"),
        sum_or_zero("cost_forecast").alias("total_cost_forecast"),
    )
    filled = months.join(earned, "date_key", "left").join(spent, "date_key", "left")
    measures = [c for c in (*earned.columns, *spent.columns) if c != "date_key"]
    totals = filled.select(*months.columns, *[_zero(c) for c in measures])
    for when in ("actual", "forecast"):
        revenue_total = F.col(f"revenue_teambase_{when}") + F.col(f"revenue_fixcost_{when}")
        totals = totals.withColumn(f"total_revenue_{when}", revenue_total).withColumn(
            f"gross_profit_{when}", revenue_total - F.col(f"total_cost_{when}")
        )
    return totals.withColumn("gross_margin_pct", ratio_if_positive("gross_profit_actual", "total_revenue_actual"))


def rpt_rate_metrics(months: DataFrame, headcount: DataFrame) -> DataFrame:
    """Headcount and utilisation rates of each month; busy is billable or on an HR project."""
    billable, hr = F.col("is_billable"), F.col("is_hr_project")
    counts = (
        headcount.where("is_active")
        .groupBy("date_key")
        .agg(
            F.count(F.lit(1)).alias("total_headcount"),
            F.sum("headcount_value").alias("total_hc_value"),
            count_where(billable).alias("billable_count"),
            count_where(billable | hr).alias("busy_count"),
            count_where(F.col("is_pool")).alias("available_pool"),
            count_where(F.col("is_training")).alias("training_count"),
            mean("total_salary").alias("avg_salary"),
            F.sum("total_salary").alias("total_salary_cost"),
        )
    )
    zero_filled = (
        "total_headcount",
        "total_hc_value",
        "billable_count",
        "busy_count",
        "available_pool",
        "training_count",
        "total_salary_cost",
    )
    return (
        months.drop("total_working_days_in_month")
        .join(counts, "date_key", "left")
        .select(
            "date_key",
            "month_date",
            "year",
            "month",
            *[_zero(c) for c in zero_filled],
            ratio_if_positive("billable_count", "total_headcount").alias("billable_rate"),
            ratio_if_positive("busy_count", "total_headcount").alias("busy_rate"),
            "avg_salary",
        )
    )


def _with_share(df: DataFrame, value: str, name: str) -> DataFrame:
    """Share of the month's total. ``df`` is reduced already: a month holds one row per type or category."""
    total = F.sum(value).over(Window.partitionBy("year", "month"))
    return df.withColumn(name, ratio_if_positive(value, total))


def rpt_revenue_mix(revenue: DataFrame, calendar: DataFrame) -> DataFrame:
    """Revenue of each (month, type) and its share of the month."""
    by_type = revenue.groupBy("date_key", "revenue_type").agg(
        F.sum("revenue_actual").alias("revenue_actual"), F.sum("revenue_forecast").alias("revenue_forecast")
    )
    days = calendar.select("date_key", "year", "month", F.col("month_start_date").alias("month_date"))
    per_type = (
        by_type.join(F.broadcast(days), "date_key")
        .groupBy("year", "month", "month_date", "revenue_type")
        .agg(F.sum("revenue_actual").alias("revenue_actual"), F.sum("revenue_forecast").alias("revenue_forecast"))
    )
    return _with_share(per_type, "revenue_actual", "revenue_pct")


def rpt_cost_mix(cost: DataFrame, calendar: DataFrame, categories: DataFrame) -> DataFrame:
    """Cost of each (month, category) with its labels and its share of the month."""
    by_category = cost.groupBy("date_key", "cost_category_key").agg(
        F.sum("cost_actual").alias("cost_actual"), F.sum("cost_forecast").alias("cost_forecast")
    )
    days = calendar.select("date_key", "year", "month", F.col("month_start_date").alias("month_date"))
    labels = categories.select("cost_category_key", "cost_category", "cost_group")
    per_category = (
        by_category.join(F.broadcast(days), "date_key")
        .groupBy("year", "month", "month_date", "cost_category_key")
        .agg(F.sum("cost_actual").alias("cost_actual"), F.sum("cost_forecast").alias("cost_forecast"))
        .join(F.broadcast(labels), "cost_category_key", "left")
    )
    return _with_share(per_category, "cost_actual", "cost_pct")


def _grid(months: DataFrame, organization: DataFrame) -> DataFrame:
    orgs = organization.select("org_key", "company_name", "division_name")
    return per_month(orgs, months.select("date_key", "month_date", "year", "month"))


def rpt_cost_summary(
    months: DataFrame,
    organization: DataFrame,
    cost: DataFrame,
    operational: DataFrame | None = None,
    by_division: bool = False,
) -> DataFrame:
    """Every month times every department, with production cost.

    Cost kinds without a source are null; pass ``operational`` (date_key, org_key and any of hr_cost,
    training_cost, presale_cost, resource_pool_cost) to fill the actual side. The total is production
    cost. ``by_division`` adds the departments of a division up.
    """
    member = F.col("cost_category_key").isin(SALARY, OVERTIME)
    spent = cost.groupBy("date_key", "org_key").agg(
        sum_where("cost_actual", member).alias("production_cost_actual"),
        sum_where("cost_forecast", member).alias("production_cost_forecast"),
    )
    rows = _grid(months, organization).join(spent, ["date_key", "org_key"], "left")
    kinds = ("hr_cost", "training_cost", "presale_cost", "resource_pool_cost")
    given = [] if operational is None else [k for k in kinds if k in operational.columns]
    if given:
        rows = rows.join(operational.select("date_key", "org_key", *given), ["date_key", "org_key"], "left")
    other = []
    for kind in kinds:
        other += [
            F.col(kind).alias(f"{kind}_actual") if kind in given else _none(f"{kind}_actual"),
            _none(f"{kind}_forecast"),
        ]
    actual, forecast = _zero("production_cost_actual"), _zero("production_cost_forecast")
    report = rows.select(
        "month_date",
        "year",
        "month",
        "company_name",
        "division_name",
        actual,
        forecast,
        *other,
        actual.alias("total_cost_actual"),
        forecast.alias("total_cost_forecast"),
    )
    if not by_division:
        return report
    keys = ["month_date", "year", "month", "company_name", "division_name"]
    return report.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in report.columns if c not in keys])


def rpt_hr_summary(months: DataFrame, organization: DataFrame, headcount: DataFrame) -> DataFrame:
    """Every month times every department, with its headcount figures."""
    counts = (
        headcount.where("is_active")
        .groupBy("date_key", "org_key")
        .agg(
            F.count(F.lit(1)).alias("total_hc"),
            F.sum("headcount_value").alias("total_hc_value"),
            count_where(F.col("is_pool")).alias("available_hc"),
            count_where(F.col("is_training")).alias("training_hc"),
            mean("total_salary").alias("dev_avg_salary"),
            F.sum("total_salary").alias("total_salary"),
        )
    )
    return (
        _grid(months, organization)
        .join(counts, ["date_key", "org_key"], "left")
        .select(
            "date_key",
            "month_date",
            "year",
            "month",
            "company_name",
            "division_name",
            _zero("total_hc"),
            _zero("total_hc_value"),
            _none("outsource_hc", "int"),
            _none("internal_hc", "int"),
            _zero("training_hc"),
            _zero("available_hc"),
            _none("turnover_rate"),
            "dev_avg_salary",
            _zero("total_salary"),
        )
    )


def rpt_revenue_by_project(
    revenue: DataFrame, months: DataFrame, projects: DataFrame, divisions: DataFrame | None = None
) -> DataFrame:
    """Revenue detail with the project's attributes; ``divisions`` maps project_key to division_name."""
    details = projects.select("project_key", "project_id", "project_name", "project_type", "market", "_source")
    if divisions is None:
        details = details.withColumn("division", F.lit(None).cast("string"))
    else:
        mapped = divisions.select("project_key", F.col("division_name").alias("division"))
        details = details.join(mapped, "project_key", "left")
    month = months.select("date_key", "month_date", "year", "month")
    # the key travels as bytes, and months are met where the rows arrive
    details = details.withColumn("_key", packed("project_key")).drop("project_key")
    return (
        revenue.withColumn("_key", packed("project_key"))
        .join(details, "_key")
        .join(F.broadcast(month), "date_key")
        .select(
            "month_date",
            "year",
            "month",
            "project_id",
            "project_name",
            "project_type",
            "market",
            "division",
            "_source",
            "revenue_type",
            "contract_revenue",
            "complete_rate_plan",
            "complete_rate_actual",
            "headcount_rate",
            "total_hours_forecast",
            "total_hours_actual",
            "revenue_forecast",
            "revenue_actual",
            _none("headcount", "int"),
        )
    )


def _member_detail(
    rows: DataFrame, months: DataFrame, employees: DataFrame, projects: DataFrame, columns: list[str]
) -> DataFrame:
    month = months.select("date_key", "month_date", "year", "month")
    return (
        rows.join(F.broadcast(month), "date_key")
        .join(projects.withColumnRenamed("_source", "_project_source"), "project_key", "left")
        .join(employees.withColumnRenamed("_source", "_employee_source"), "employee_key", "left")
        .select("month_date", "year", "month", *columns)
    )


def rpt_revenue_by_member(
    allocation: DataFrame, months: DataFrame, employees: DataFrame, projects: DataFrame
) -> DataFrame:
    """Effort and revenue per (month, employee, project); unknown employees and projects stay as nulls."""
    columns = ["employee_id", "employee_name", "department", "project_id", "project_name", "project_type", "market"]
    measures = [
        "effort_days",
        "effort_hours",
        "performance_rate",
        "employee_rate",
        "revenue_actual",
        "revenue_forecast",
    ]
    return _member_detail(allocation, months, employees, projects, columns + measures)


def rpt_employee_performance(
    performance: DataFrame, months: DataFrame, employees: DataFrame, projects: DataFrame
) -> DataFrame:
    """Effort and contribution to revenue, cost and profit per (month, employee, project)."""
    columns = [
        "employee_id",
        "employee_name",
        "department",
        "employment_type",
        "base_salary",
        "project_id",
        "project_name",
        "project_type",
    ]
    measures = [
        "effort_rate",
        "performance_rate",
        "total_effort_hours",
        "actual_hours",
        "revenue_contribution",
        "cost_contribution",
        "profit_contribution",
    ]
    return _member_detail(performance, months, employees, projects, columns + measures)
