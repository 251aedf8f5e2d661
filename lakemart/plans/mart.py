"""The whole mart in one call: dimensions, then facts, then reports, each written once and read back."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakemart.operators import quality
from lakemart.plans import calendar as cal
from lakemart.plans import facts, reports
from lakemart.plans.checks import DECLARED
from lakemart.sources.store import write_models

# Monthly facts are stored by month, so a cut-off or a single month reads only its folders.
BY_MONTH = {"fct_cost_monthly": "date_key", "fct_headcount_monthly": "date_key", "fct_revenue_monthly": "date_key"}


@dataclass(frozen=True)
class MartInputs:
    """What the mart is built from; see ``dims`` and ``facts`` for the columns."""

    calendar: DataFrame
    employees: DataFrame
    organization: DataFrame
    projects: DataFrame
    categories: DataFrame
    activity: DataFrame
    presence: DataFrame
    assignments: DataFrame
    team_revenue: DataFrame | None = None
    allocation: DataFrame | None = None
    performance: DataFrame | None = None


def build_dims(inputs: MartInputs, root: str) -> dict[str, DataFrame]:
    return write_models(
        {
            "dim_date": inputs.calendar,
            "dim_employee": inputs.employees,
            "dim_organization": inputs.organization,
            "dim_project": inputs.projects,
            "dim_cost_category": inputs.categories,
        },
        root,
    )


def build_facts(inputs: MartInputs, dims: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    months, employees = cal.month_spine(dims["dim_date"]), dims["dim_employee"]
    starts = cal.month_starts(dims["dim_date"])
    return write_models(
        {
            "fct_cost_monthly": facts.fct_cost_monthly(inputs.activity, months, employees, by_month=True),
            "fct_headcount_monthly": facts.fct_headcount_monthly(
                inputs.presence, inputs.assignments, months, employees
            ),
            "fct_revenue_monthly": facts.fct_revenue_monthly(
                dims["dim_project"], starts, inputs.team_revenue, by_month=True
            ),
        },
        root,
        BY_MONTH,
        gathered=("fct_cost_monthly", "fct_revenue_monthly"),
    )


def build_reports(
    inputs: MartInputs, tables: dict[str, DataFrame], root: str, as_of: dt.date | None = None
) -> dict[str, DataFrame]:
    calendar, organization = tables["dim_date"], tables["dim_organization"]
    employees, projects = tables["dim_employee"], tables["dim_project"]
    cost, headcount, revenue = (tables[f"fct_{n}_monthly"] for n in ("cost", "headcount", "revenue"))
    months, all_months = cal.month_spine(calendar, as_of), cal.month_spine(calendar)
    out = {
        "rpt_monthly_pnl": reports.rpt_monthly_pnl(months, revenue, cost),
        "rpt_rate_metrics": reports.rpt_rate_metrics(months, headcount),
        "rpt_revenue_mix": reports.rpt_revenue_mix(revenue, calendar),
        "rpt_cost_mix": reports.rpt_cost_mix(cost, calendar, tables["dim_cost_category"]),
        "rpt_cost_summary": reports.rpt_cost_summary(months, organization, cost),
        "rpt_hr_summary": reports.rpt_hr_summary(months, organization, headcount),
        "rpt_revenue_by_project": reports.rpt_revenue_by_project(revenue, all_months, projects),
    }
    if inputs.allocation is not None:
        out["rpt_revenue_by_member"] = reports.rpt_revenue_by_member(inputs.allocation, months, employees, projects)
    if inputs.performance is not None:
        out["rpt_employee_performance"] = reports.rpt_employee_performance(
            inputs.performance, months, employees, projects
        )
    return write_models(out, root)


def build_mart(
    spark: SparkSession, inputs: MartInputs, root: str, as_of: dt.date | None = None
) -> dict[str, DataFrame]:
    """Every table of the mart by name, as stored under ``root``."""
    dims = build_dims(inputs, root)
    tables = {**dims, **build_facts(inputs, dims, root)}
    return {**tables, **build_reports(inputs, tables, root, as_of)}


def check_mart(tables: dict[str, DataFrame]) -> DataFrame:
    """Results of every declared check of the tables given; a failing check stops nothing."""
    return quality.run_declared(tables, {name: DECLARED[name] for name in tables if name in DECLARED})
