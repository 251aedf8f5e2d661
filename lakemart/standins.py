"""The bundled test tables, seen as the inputs the mart expects.

Each function reads the given tables whole. ``CUT`` splits the events into what a target already
holds and what arrives next; ``AS_OF`` is the day reports are cut off at.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.functions import money, month_key, safe_divide, surrogate_key
from lakemart.plans import calendar as cal
from lakemart.plans import dims, facts, metrics
from lakemart.sources.folders import stamp

FIRST_DAY, LAST_DAY = dt.date(1995, 1, 1), dt.date(2001, 12, 31)
AS_OF = dt.date(2000, 6, 15)
CUT = "2024-01-20 00:00:00"
EVENT_SOURCES = ("click", "error", "purchase", "signup", "view")
COMPANY = "Headquarters"
OUTSOURCE_TYPES = ("Outsource",)
TIMESHEET, ERP, CRM = "timesheet", "erp", "crm"

# The class of work a product word stands for; other words are billable work.
WORK_CLASSES = {
    "ring": metrics.HR,
    "bolt": metrics.POOL,
    "gear": metrics.TRAINING,
    "gizmo": metrics.PRESALE,
    "anvil": "internal",
}
# The project names those words stand for.
PROJECT_NAMES = {
    "ring": "Interview panel",
    "bolt": "Bench Pool",
    "gear": "Training camp",
    "gizmo": "Presale support",
    "anvil": "Resource Pool",
}


_built: dict[tuple, DataFrame] = {}
_stamps: dict[tuple, tuple] = {}


def look_again(spark: SparkSession, sf_dir: str) -> None:
    """Forget what was built from tables that have changed since; every query calls this first."""
    place = (spark.sparkContext.applicationId, id(spark), sf_dir)
    now = stamp(spark, sf_dir)
    if _stamps.get(place) != now:
        _stamps[place] = now
        for key in [key for key in _built if key[1:4] == place]:
            del _built[key]


def once(build: Callable) -> Callable:
    """Build an input once as long as its tables do not change: queries then share schema, plan and stored tables."""

    @functools.wraps(build)
    def get(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
        key = (build.__name__, spark.sparkContext.applicationId, id(spark), sf_dir, *more)
        if key not in _built:
            _built[key] = build(spark, sf_dir, *more)
        return _built[key]

    return get


@once
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _decimal(name: str, kind: str = "decimal(12,2)") -> Column:
    return F.col(name).cast(kind)


# --- raw history of several sources -------------------------------------------------------------


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), "event_id", "value", "props", F.col("ts").alias("_load_id"), "event_type"
    )


def event_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One table per event type."""
    rows = event_rows(spark, sf_dir)
    return {s: rows.where(F.col("event_type") == s).drop("event_type") for s in EVENT_SOURCES}


def before_cut(df: DataFrame, column: str = "_load_id") -> DataFrame:
    return df.where(F.col(column) < F.lit(CUT).cast("timestamp_ntz"))


def from_cut(df: DataFrame, column: str = "_load_id") -> DataFrame:
    return df.where(F.col(column) >= F.lit(CUT).cast("timestamp_ntz"))


def uneven_landing(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What a second load brings where the source has not just grown, by the last digit of the user.

    0: deleted at the source. 1: only rows from before the cut, with another value. 2: all rows, without a load id.
    """
    digit, value = F.coalesce(F.col("id") % 10, F.lit(0)), F.col("value")  # without a user: as if deleted
    out = {}
    for source, rows in event_sources(spark, sf_dir).items():
        early = F.col("_load_id") < F.lit(CUT).cast("timestamp_ntz")
        rows = rows.where((digit != 0) & ((digit != 1) | early))
        rows = rows.withColumn("value", F.when(digit == 1, -value).otherwise(value))
        # apart, so that a comparison with the load id reaches the scan of the rows that have one
        unmarked = rows.where(digit == 2).withColumn("_load_id", F.lit(None).cast(rows.schema["_load_id"].dataType))
        out[source] = rows.where(digit != 2).unionByName(unmarked)
    return out


# --- calendar and dimensions ----------------------------------------------------------------------


@once
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders on the first of a month mark the holidays."""
    holidays = (
        table(spark, sf_dir, "orders")
        .where((F.col("o_orderpriority") == "1-URGENT") & (F.dayofmonth("o_orderdate") == 1))
        .select(F.col("o_orderdate").alias("holiday_date"))
    )
    return cal.dim_date(spark, holidays, FIRST_DAY, LAST_DAY)


@once
def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("employee"),
        money("l_extendedprice").alias("base_salary"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("docstatus"),
        F.col("l_shipdate").alias("modified"),
    )


@once
def erp_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (
        F.when(F.col("s_acctbal") < 0, "Part-time").when(F.col("s_acctbal") >= 9000, "Outsource").otherwise("Full-time")
    )
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("name"),
        F.col("s_name").alias("employee_name"),
        F.col("s_nationkey").cast("string").alias("department"),
        kind.alias("employment_type"),
    )


@once
def dim_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    time_employees = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return dims.dim_employee(
        time_employees,
        erp_employees(spark, sf_dir),
        contracts(spark, sf_dir),
        (TIMESHEET, ERP),
        tie_breakers=["base_salary"],
    )


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("id"),
        F.col("r_name").alias("name"),
        (F.col("r_regionkey") + 100).alias("department_id"),
    )


@once
def dim_organization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations are departments; their path starts without a slash, so only the second segment counts."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    departments = nation.select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.col("n_regionkey").cast("string"), F.lit("/"), F.col("n_nationkey").cast("string"), F.lit("/")).alias(
            "parent_path"
        ),
    )
    leaves = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_name").alias("name"),
        F.col("n_name").alias("department_name"),
        F.when(F.col("n_regionkey") > 0, "Branch office").alias("company"),
        F.col("r_name").alias("parent_department"),
        F.when(F.col("n_nationkey") >= 5, 0).alias("is_group"),
    )
    groups = region.select(
        F.col("r_name").alias("name"),
        F.col("r_name").alias("department_name"),
        F.lit("Branch office").alias("company"),
        F.lit(None).cast("string").alias("parent_department"),
        F.lit(1).alias("is_group"),
    )
    return dims.dim_organization(
        _units(spark, sf_dir), departments, leaves.unionByName(groups), COMPANY, (CRM, ERP)
    )


def _project_type() -> Column:
    return F.when(F.col("p_type") == "ECONOMY", facts.FIX_COST_TYPE).otherwise("Teambase")


@once
def dim_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    status = F.when(F.col("p_size") > 25, "Open").otherwise("Closed")
    time_projects = part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        _project_type().alias("project_type"),
        F.col("p_brand").alias("unit_name"),
        status.alias("status"),
    )
    erp_projects = part.select(
        F.col("p_partkey").alias("name"),
        F.col("p_name").alias("project_name"),
        _project_type().alias("project_type"),
        status.alias("status"),
        F.col("p_retailprice").alias("total_sales_amount"),
    )
    packages = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("parent"),
        F.col("l_discount").alias("plan_complete_rate"),
        F.col("l_tax").alias("actual_complete_rate"),
    )
    return dims.dim_project(time_projects, erp_projects, packages, (TIMESHEET, ERP))


# --- timesheet ------------------------------------------------------------------------------------


def _homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of each supplier, digested once per supplier and not once per timesheet row."""
    suppliers = table(spark, sf_dir, "supplier").where("s_suppkey IS NOT NULL")
    return suppliers.select(
        F.col("s_suppkey").alias("l_suppkey"),
        surrogate_key(F.col("s_suppkey"), F.lit(ERP)).alias("employee_key"),
        surrogate_key(F.col("s_nationkey"), F.lit(CRM)).alias("org_key"),
    )


# A task that groups lines in several steps holds about so many, whatever the size of the table.
LINES_PER_TASK = 200_000


@once
def _tasks_for_lines(spark: SparkSession, sf_dir: str) -> int:
    return -(-table(spark, sf_dir, "lineitem").count() // LINES_PER_TASK)


def _lines_by_key(lines: DataFrame, sf_dir: str, column: str, source: str, name: str) -> DataFrame:
    """Lines with a ``column``, shuffled by the key made of it but without it; the key is added where they arrive.

    Groups and joins by that key, alone or with other columns, then need no further shuffle. As one task does all
    those steps, large tables get a number of tasks that grows with them; small ones leave it to Spark.
    """
    spark = lines.sparkSession
    key, tasks = surrogate_key(F.col(column), F.lit(source)), _tasks_for_lines(spark, sf_dir)
    known = lines.where(F.col(column).isNotNull())
    if tasks <= 4:
        return known.repartition(key).withColumn(name, key)
    tasks = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return known.repartition(tasks, key).withColumn(name, key)


def _month_days(days: DataFrame) -> DataFrame:
    return days.select(
        F.col("date_actual").alias("day"),
        "year",
        "month",
        month_key().alias("date_key"),
        "is_working_day",
        F.col("total_working_days_in_month").alias("working_days_in_month"),
    )


@once
def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and hours per (month, employee, project), a project being a product type.

    Entries of a day are added up first. Lines are shuffled once by supplier, and both steps and the supplier's keys
    are found there.
    """
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lines = table(spark, sf_dir, "lineitem").join(part, "l_partkey")
    daily = (
        _lines_by_key(lines, sf_dir, "l_suppkey", ERP, "employee_key")
        .groupBy("employee_key", "p_type", F.to_date("l_shipdate").alias("day"))
        .agg(F.sum(_decimal("l_quantity", "decimal(8,2)")).alias("hours"))
    )
    monthly = (
        daily.join(F.broadcast(_month_days(calendar(spark, sf_dir))), "day")
        .groupBy("employee_key", "p_type", "year", "month")
        .agg(
            F.count_if("is_working_day").cast("int").alias("days_worked"),
            F.sum("hours").cast("decimal(18,2)").alias("total_hours"),
            F.sum(F.greatest(F.col("hours") - facts.HOURS_PER_DAY, F.lit(0)))
            .cast("decimal(18,2)")
            .alias("total_overtime_hours"),
        )
    )
    return monthly.join(_homes(spark, sf_dir), "employee_key").select(
        "year",
        "month",
        "employee_key",
        surrogate_key(F.col("p_type"), F.lit(TIMESHEET)).alias("project_key"),
        "org_key",
        "days_worked",
        "total_hours",
        "total_overtime_hours",
    )


def _word() -> Column:
    return F.element_at(F.split("p_name", " "), -1)


def _by_word(mapping: dict[str, str], other: Column) -> Column:
    out = None
    for word, value in mapping.items():
        out = F.when(_word() == word, value) if out is None else out.when(_word() == word, value)
    return out.otherwise(other)


@once
def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    billable = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    monthly = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))
        .agg(F.bool_or(billable).alias("has_billable_work"), F.sum(_decimal("l_quantity")).alias("total_hours"))
    )
    return monthly.join(_homes(spark, sf_dir), "l_suppkey").select(
        "year",
        "month",
        "employee_key",
        "org_key",
        "has_billable_work",
        "total_hours",
    )


@once
def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _by_word(PROJECT_NAMES, F.col("p_name")).alias("project_name")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), name)
    lines = table(spark, sf_dir, "lineitem").join(part, "l_partkey")
    monthly = (
        _lines_by_key(lines, sf_dir, "l_suppkey", ERP, "employee_key")
        .groupBy("employee_key", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "project_name")
        .agg(F.sum(_decimal("l_quantity")).alias("hours_on_project"))
    )
    keys = _homes(spark, sf_dir).select("employee_key")
    return monthly.join(keys, "employee_key").select("year", "month", "employee_key", "project_name", "hours_on_project")


# --- facts ----------------------------------------------------------------------------------------


def cost_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return activity(spark, sf_dir), cal.month_spine(calendar(spark, sf_dir)), dim_employee(spark, sf_dir)


@once
def fct_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fct_cost_monthly(*cost_inputs(spark, sf_dir))


@once
def fct_headcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = cal.month_spine(calendar(spark, sf_dir))
    return facts.fct_headcount_monthly(
        presence(spark, sf_dir), assignments(spark, sf_dir), months, dim_employee(spark, sf_dir)
    )


@once
def fct_revenue_fixcost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fct_revenue_fixcost(dim_project(spark, sf_dir), cal.month_starts(calendar(spark, sf_dir)))


@once
def fct_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    team = metrics.teambase_member_revenue(team_members(spark, sf_dir))
    starts = cal.month_starts(calendar(spark, sf_dir))
    return facts.fct_revenue_monthly(dim_project(spark, sf_dir), starts, team)


@once
def months_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.month_spine(calendar(spark, sf_dir), AS_OF)


# --- members of projects --------------------------------------------------------------------------


@once
def divisions_of_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region of each supplier's nation."""
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), F.col("r_name").alias("division"))
    )


@once
def salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.latest_contracts(contracts(spark, sf_dir), ["base_salary"]).select(
        F.col("employee").alias("l_suppkey"), "base_salary"
    )


@once
def member_months(spark: SparkSession, sf_dir: str, kind: str = "all") -> DataFrame:
    """One row per (month, supplier, part): time, hourly rate, effort and performance.

    ``kind`` keeps the ``team`` or the ``fixed`` price projects, before anything is added up. Lines are shuffled once,
    by part: days, months and the span of each part are found there.
    """
    lines = table(spark, sf_dir, "lineitem")
    if kind != "all":
        economy = F.col("p_type") == "ECONOMY"
        parts = table(spark, sf_dir, "part").where(economy if kind == "fixed" else ~economy)
        lines = lines.join(parts.select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_semi")
    daily = (
        _lines_by_key(lines, sf_dir, "l_partkey", TIMESHEET, "project_key")
        .groupBy("l_suppkey", "l_partkey", "project_key", F.to_date("l_shipdate").alias("day"))
        .agg(
            F.sum(_decimal("l_quantity", "decimal(8,2)")).alias("hours"),
            F.sum(_decimal("l_extendedprice")).alias("price"),
            F.max(_decimal("l_discount", "decimal(4,2)")).alias("discount"),
            F.max(_decimal("l_tax", "decimal(4,2)")).alias("tax"),
        )
    )
    # a project is planned from the first to the last day it was worked on
    whole = Window.partitionBy("project_key")
    daily = daily.withColumns({"start_day": F.min("day").over(whole), "end_day": F.max("day").over(whole)})
    above = F.greatest(F.col("hours") - facts.HOURS_PER_DAY, F.lit(0))
    monthly = (
        daily.join(F.broadcast(_month_days(calendar(spark, sf_dir))), "day")
        .groupBy("l_suppkey", "l_partkey", "project_key", "date_key", "working_days_in_month")
        .agg(
            F.count_if("is_working_day").cast("int").alias("actual_days"),
            F.sum("hours").cast("decimal(18,2)").alias("actual_hours"),
            F.sum(above).cast("decimal(18,2)").alias("overtime_hours"),
            F.sum("price").cast("decimal(18,2)").alias("price"),
            F.max("discount").alias("discount"),
            F.max("tax").alias("tax"),
            # the same in every row of a part
            F.min("start_day").alias("start_day"),
            F.max("end_day").alias("end_day"),
        )
    )
    first = F.make_date(F.floor(F.col("date_key") / 10000).cast("int"), (F.floor(F.col("date_key") / 100) % 100).cast("int"), F.lit(1))
    monthly = monthly.withColumn("month_start_date", first).withColumn("month_end_date", F.last_day("month_start_date"))
    monthly = metrics.planned_days(monthly, calendar(spark, sf_dir))
    performance = F.least(F.lit("0.30").cast("decimal(4,2)"), F.col("tax") + F.lit("0.10").cast("decimal(4,2)"))
    effort = (F.col("discount") * 10).cast("decimal(4,1)")
    return monthly.select(
        "date_key",
        "l_suppkey",
        "l_partkey",
        surrogate_key(F.col("l_suppkey"), F.lit(ERP)).alias("employee_key"),
        "project_key",
        "working_days_in_month",
        "actual_days",
        F.col("plan_days").cast("int").alias("plan_days"),
        "actual_hours",
        "overtime_hours",
        money(safe_divide("price", "actual_hours")).alias("employee_rate"),
        "discount",
        effort.alias("effort_rate"),
        performance.cast("decimal(4,2)").alias("performance_rate"),
        (F.col("working_days_in_month") * facts.HOURS_PER_DAY * effort).cast("decimal(8,2)").alias("effort_hours"),
    )


@once
def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with the employee's division, salary and bonus."""
    homes = divisions_of_employees(spark, sf_dir).select("l_suppkey", "division")
    return (
        member_months(spark, sf_dir)
        .join(homes, "l_suppkey")
        .join(salaries(spark, sf_dir), "l_suppkey", "left")
        .withColumn("direct_cost", F.col("base_salary"))
        .withColumn("project_bonus", (F.col("base_salary") * F.col("discount")).cast("decimal(18,4)"))
    )


def team_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return member_months(spark, sf_dir, "team")


def fixed_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return member_months(spark, sf_dir, "fixed")


@once
def completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative completion of each fixed-price part: actual by quantity shipped, plan by month count."""
    part = table(spark, sf_dir, "part").where(F.col("p_type") == "ECONOMY")
    parts = part.select(F.col("p_partkey").alias("l_partkey"), money("p_retailprice").alias("contract_revenue"))
    # at most one row per month and part from here on, so the windows are short
    monthly = (
        table(spark, sf_dir, "lineitem")
        .join(parts, "l_partkey")
        .groupBy("l_partkey", "contract_revenue", month_key(F.year("l_shipdate"), F.month("l_shipdate")).alias("date_key"))
        .agg(F.sum(_decimal("l_quantity")).alias("quantity"))
    )
    whole = Window.partitionBy("l_partkey")
    so_far = whole.orderBy("date_key")
    rate = "decimal(9,6)"
    actual = F.sum("quantity").over(so_far).cast("decimal(18,2)") / F.sum("quantity").over(whole).cast("decimal(18,2)")
    plan = F.row_number().over(so_far).cast("decimal(9,0)") / F.count("*").over(whole).cast("decimal(9,0)")
    return monthly.select(
        F.col("l_partkey").alias("project_key"),
        "date_key",
        "contract_revenue",
        plan.cast(rate).alias("complete_rate_plan"),
        actual.cast(rate).alias("complete_rate_actual"),
    )


@once
def classed_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours per (month, employee, class of work)."""
    kind = _by_word(WORK_CLASSES, F.lit(metrics.BILLABLE)).alias("work_class")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), kind)
    monthly = (
        table(spark, sf_dir, "lineitem")
        .join(part, "l_partkey")
        .groupBy(
            "l_suppkey", "work_class", month_key(F.year("l_shipdate"), F.month("l_shipdate")).alias("date_key")
        )
        .agg(
            F.sum(_decimal("l_quantity")).cast("decimal(18,2)").alias("hours"),
            F.sum(_decimal("l_extendedprice")).cast("decimal(18,2)").alias("price"),
        )
    )
    return (
        monthly.join(divisions_of_employees(spark, sf_dir), "l_suppkey")
        .join(salaries(spark, sf_dir), "l_suppkey", "left")
        .select(
            "date_key",
            "division",
            F.col("l_suppkey").alias("employee_key"),
            "work_class",
            money(safe_divide("price", "hours")).alias("employee_rate"),
            "hours",
            "base_salary",
        )
    )


@once
def heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees with returned open work in a month."""
    rows = (
        table(spark, sf_dir, "lineitem")
        .where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))
        .select("l_suppkey", month_key(F.year("l_shipdate"), F.month("l_shipdate")).alias("date_key"))
        .distinct()
    )
    kinds = erp_employees(spark, sf_dir).select(F.col("name").alias("l_suppkey"), "employment_type")
    return (
        rows.join(divisions_of_employees(spark, sf_dir), "l_suppkey")
        .join(salaries(spark, sf_dir), "l_suppkey", "left")
        .join(kinds, "l_suppkey")
        .select("date_key", "division", F.col("l_suppkey").alias("employee_key"), "base_salary", "employment_type")
    )


# --- run log --------------------------------------------------------------------------------------


@once
def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as runs: the user is the source, an error is a failed run."""
    job = F.when(F.col("event_type") == "purchase", "stg2sil__web__").otherwise("src2brz__web__")
    user = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").select(
        F.concat(job, user).alias("dag_id"),
        user.alias("source"),
        F.lit("web").alias("data_subject"),
        F.col("event_type").alias("table_name"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("row_count"),
        F.col("ts").alias("finished_at"),
    )
