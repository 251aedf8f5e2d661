"""Dimensions: employee, organization, project."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import money, surrogate_key
from lakemart.functions.measures import MONEY
from lakemart.operators import join_path_contains, newest_per_key

RATE = "decimal(14,6)"


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def latest_contracts(contracts: DataFrame, tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """Newest submitted contract per employee."""
    submitted = contracts.where(F.col("docstatus") == 1)
    return newest_per_key(submitted, ["employee"], ["modified", *tie_breakers])


def dim_employee(
    time_employees: DataFrame,
    erp_employees: DataFrame,
    contracts: DataFrame,
    sources: tuple[str, str] = ("timesheet", "erp"),
    tie_breakers: Sequence[str | Column] = (),
) -> DataFrame:
    """Employees of both systems; only the second knows salaries, from the latest contract."""
    time_source, erp_source = sources
    from_time = time_employees.select(
        F.col("id").cast("string").alias("employee_id"),
        F.col("name").alias("employee_name"),
        _null("string").alias("department"),
        _null("string").alias("employment_type"),
        _null(MONEY).alias("base_salary"),
        F.lit(time_source).alias("_source"),
    )
    salary = latest_contracts(contracts, tie_breakers).select(
        F.col("employee").alias("name"), money("base_salary").alias("base_salary")
    )
    from_erp = erp_employees.join(salary, "name", "left").select(
        F.col("name").cast("string").alias("employee_id"),
        "employee_name",
        "department",
        "employment_type",
        "base_salary",
        F.lit(erp_source).alias("_source"),
    )
    return from_time.unionByName(from_erp).select(
        surrogate_key("employee_id", "_source").alias("employee_key"),
        "employee_id",
        "employee_name",
        "department",
        _null("string").alias("division"),
        "employment_type",
        "base_salary",
        _null(MONEY).alias("billing_rate"),
        F.col("department").alias("cost_center"),
        "_source",
    )


def dim_organization(
    units: DataFrame,
    departments: DataFrame,
    erp_departments: DataFrame,
    company: str,
    sources: tuple[str, str] = ("crm", "erp"),
    nearest: bool = False,
) -> DataFrame:
    """Departments of both systems, the first with the unit its path runs through.

    A path through several units repeats the department, unless ``nearest`` keeps the deepest unit.
    Group departments of the second system are left out.
    """
    crm_source, erp_source = sources
    unit = units.select(
        F.col("id").cast("string").alias("unit_id"),
        F.col("name").alias("division_name"),
        F.col("department_id").cast("string").alias("division_code"),
    )
    dept = departments.select(
        F.col("id").cast("string").alias("department_code"), F.col("name").alias("department_name"), "parent_path"
    )
    from_crm = join_path_contains(dept, unit, "parent_path", "unit_id", nearest).select(
        F.lit(company).alias("company_name"),
        "division_name",
        "division_code",
        "department_name",
        "department_code",
        F.lit(crm_source).alias("_source"),
    )
    from_erp = erp_departments.where(F.coalesce("is_group", F.lit(0)) == 0).select(
        F.coalesce("company", F.lit(company)).alias("company_name"),
        F.col("parent_department").alias("division_name"),
        _null("string").alias("division_code"),
        "department_name",
        F.col("name").alias("department_code"),
        F.lit(erp_source).alias("_source"),
    )
    both = from_crm.unionByName(from_erp)
    return both.select(surrogate_key("department_code", "_source").alias("org_key"), *both.columns)


def mean_completion(packages: DataFrame) -> DataFrame:
    """Mean planned and actual completion of a project's packages."""
    return (
        packages.where(F.col("parent").isNotNull())
        .groupBy(F.col("parent").cast("string").alias("project_id"))
        .agg(
            F.avg(F.col("plan_complete_rate").cast("decimal(10,2)")).cast(RATE).alias("plan_complete_rate"),
            F.avg(F.col("actual_complete_rate").cast("decimal(10,2)")).cast(RATE).alias("actual_complete_rate"),
        )
    )


def dim_project(
    time_projects: DataFrame,
    erp_projects: DataFrame,
    packages: DataFrame,
    sources: tuple[str, str] = ("timesheet", "erp"),
) -> DataFrame:
    """Projects of both systems; the second has contract amounts and completion rates.

    ``erp_projects`` may carry a ``project_type``; it is null otherwise.
    """
    time_source, erp_source = sources
    from_time = time_projects.select(
        F.col("id").cast("string").alias("project_id"),
        F.col("name").alias("project_name"),
        "project_type",
        F.col("unit_name").alias("market"),
        F.col("status").alias("project_status"),
        _null(MONEY).alias("total_sales_amount"),
        _null(RATE).alias("plan_complete_rate"),
        _null(RATE).alias("actual_complete_rate"),
        F.lit(time_source).alias("_source"),
    )
    kind = F.col("project_type") if "project_type" in erp_projects.columns else _null("string")
    from_erp = (
        erp_projects.select(
            F.col("name").cast("string").alias("project_id"),
            "project_name",
            kind.alias("project_type"),
            _null("string").alias("market"),
            F.col("status").alias("project_status"),
            money("total_sales_amount").alias("total_sales_amount"),
            F.lit(erp_source).alias("_source"),
        )
        .join(mean_completion(packages), "project_id", "left")
    )
    return from_time.unionByName(from_erp).select(
        surrogate_key("project_id", "_source").alias("project_key"),
        "project_id",
        "project_name",
        "project_type",
        "market",
        "project_status",
        "total_sales_amount",
        _null(MONEY).alias("gross_margin"),
        "plan_complete_rate",
        "actual_complete_rate",
        "_source",
    )


def project_divisions(projects: DataFrame, units: DataFrame, organization: DataFrame) -> DataFrame:
    """Division of each project: through its unit, else through its department.

    ``projects``: project_key, unit_id, department; ``units``: unit_id, division_name;
    ``organization``: department_code, division_name (one row per department).
    """
    by_unit = units.select("unit_id", F.col("division_name").alias("_by_unit"))
    by_department = organization.select(
        F.col("department_code").alias("department"), F.col("division_name").alias("_by_department")
    )
    return (
        projects.join(by_unit, "unit_id", "left")
        .join(by_department, "department", "left")
        .select("project_key", F.coalesce("_by_unit", "_by_department").alias("division_name"))
    )
