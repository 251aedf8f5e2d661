import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakemart.plans import calendar as cal
from lakemart.plans import cards, dims, facts, metrics, reports
from lakemart.sources import seed

DAY = dt.date


@pytest.fixture(scope="module")
def year(spark):
    """2024; every working day of February is a holiday, so February has none."""
    feb = [(DAY(2024, 2, d),) for d in range(1, 30)]
    more = [(None,), (DAY(2024, 1, 1),), (DAY(2024, 1, 1),), (DAY(2023, 1, 1),)]
    holidays = spark.createDataFrame(feb + more, "holiday_date date")
    return cal.dim_date(spark, holidays, DAY(2024, 1, 1), DAY(2024, 12, 31)).cache()


def test_standard_calendar_has_4018_days(spark):
    days = cal.dim_date(spark)
    assert days.count() == 4018
    assert days.where("is_holiday").count() == 0


def test_calendar_row(year):
    row = year.where("date_key = 20240102").first()
    assert (row.year, row.quarter, row.month, row.month_name, row.day_of_week, row.day_name) == (
        2024, 1, 1, "January", 2, "Tuesday",
    )
    assert (row.is_weekend, row.is_holiday, row.is_working_day, row.working_day_of_month) == (False, False, True, 1)
    assert row.total_working_days_in_month == 22
    assert (row.month_start_date, row.month_end_date, row.quarter_start_date) == (
        DAY(2024, 1, 1), DAY(2024, 1, 31), DAY(2024, 1, 1),
    )
    assert year.where("date_key = 20240101").first().working_day_of_month is None


def test_repeated_holidays_do_not_repeat_days(year):
    assert year.count() == 366


def test_month_without_working_day_is_not_in_the_spine(year):
    months = cal.month_spine(year)
    assert [r.month for r in months.orderBy("month").collect()] == [1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    assert cal.month_spine(year, DAY(2024, 3, 1)).count() == 2
    assert cal.month_starts(year).count() == 12


def test_employee_takes_latest_submitted_contract(spark):
    time_employees = spark.createDataFrame([(1, "Ann")], "id long, name string")
    erp = spark.createDataFrame(
        [("E1", "Bo", "Dev", "Full-time"), ("E2", "Cy", "HR", "Part-time")],
        "name string, employee_name string, department string, employment_type string",
    )
    contracts = spark.createDataFrame(
        [("E1", 10.0, 1, DAY(2024, 1, 1)), ("E1", 20.0, 1, DAY(2024, 2, 1)), ("E1", 99.0, 0, DAY(2024, 3, 1)),
         ("E1", 7.0, 1, None), ("E9", 1.0, 1, DAY(2024, 1, 1))],
        "employee string, base_salary double, docstatus int, modified date",
    )
    out = dims.dim_employee(time_employees, erp, contracts)
    assert rows(out, "employee_id", "department", "base_salary", "cost_center", "_source") == [
        ("1", None, None, None, "timesheet"),
        ("E1", "Dev", D("20.00"), "Dev", "erp"),
        ("E2", "HR", None, "HR", "erp"),
    ]
    assert out.select("employee_key").distinct().count() == 3


def test_project_completion_is_the_mean_of_its_packages(spark):
    time_projects = spark.createDataFrame([(1, "T", "Fix Cost", "EU", "Open")], "id long, name string, project_type string, unit_name string, status string")
    erp = spark.createDataFrame([("P", "Erp", "Open", 100.0), ("Q", "None", "Open", None)], "name string, project_name string, status string, total_sales_amount double")
    packages = spark.createDataFrame([("P", 0.5, 0.25), ("P", 1.0, None), (None, 0.1, 0.1)], "parent string, plan_complete_rate double, actual_complete_rate double")
    out = dims.dim_project(time_projects, erp, packages)
    assert rows(out, "project_id", "project_type", "total_sales_amount", "plan_complete_rate", "actual_complete_rate") == [
        ("1", "Fix Cost", None, None, None),
        ("P", None, D("100.00"), D("0.750000"), D("0.250000")),
        ("Q", None, None, None, None),
    ]


def organization(spark, nearest=False):
    units = spark.createDataFrame([(5, "Five", 50), (9, "Nine", 90)], "id long, name string, department_id long")
    departments = spark.createDataFrame([(11, "Web", "1/5/11/"), (12, "Ops", "5/12/")], "id long, name string, parent_path string")
    erp = spark.createDataFrame(
        [("D1", "Sales", None, "All", None), ("D2", "Group", "Co", None, 1), ("D3", "Lab", "Co", "All", 0)],
        "name string, department_name string, company string, parent_department string, is_group int",
    )
    return dims.dim_organization(units, departments, erp, "Home", nearest=nearest)


def test_organization(spark):
    assert rows(organization(spark), "department_code", "company_name", "division_name", "_source") == [
        ("11", "Home", "Five", "crm"),
        ("12", "Home", None, "crm"),
        ("D1", "Home", "All", "erp"),
        ("D3", "Co", "All", "erp"),
    ]


def test_path_through_two_units_repeats_the_department_unless_nearest(spark):
    units = spark.createDataFrame([(5, "Five", 50), (9, "Nine", 90)], "id long, name string, department_id long")
    departments = spark.createDataFrame([(11, "Web", "1/5/9/11/")], "id long, name string, parent_path string")
    none = spark.createDataFrame([], "name string, department_name string, company string, parent_department string, is_group int")
    twice = dims.dim_organization(units, departments, none, "Home")
    assert rows(twice, "division_name") == [("Five",), ("Nine",)]
    assert rows(dims.dim_organization(units, departments, none, "Home", nearest=True), "division_name") == [("Nine",)]


ACTIVITY = (
    "year int, month int, employee_key string, project_key string, org_key string, days_worked int, "
    "total_hours decimal(18,2), total_overtime_hours decimal(18,2)"
)


@pytest.fixture(scope="module")
def cost(spark, year):
    activity = spark.createDataFrame(
        [
            (2024, 1, "e1", "p1", "o1", 11, D(88), D(0)),
            (2024, 1, "e1", "p2", "o1", 1, D(10), D(2)),
            (2024, 1, "unpaid", "p1", "o1", 5, D(40), D(9)),
            (2024, 2, "e1", "p1", "o1", 1, D(8), D(1)),
            (2024, 3, "e1", "p1", "o1", None, None, None),
        ],
        ACTIVITY,
    )
    employees = spark.createDataFrame([("e1", D("2200.00")), ("unpaid", None)], "employee_key string, base_salary decimal(18,2)")
    return facts.fct_cost_monthly(activity, cal.month_spine(year), employees).cache()


def test_cost_fact(cost):
    got = rows(cost, "date_key", "project_key", "cost_category_key", "cost_actual", "cost_forecast", "overtime_cost")
    assert got == [
        (20240101, "p1", "member_salary", D("1100.000000"), D("2200.00"), None),
        (20240101, "p2", "member_overtime", D("37.500000"), None, D("37.500000")),
        (20240101, "p2", "member_salary", D("100.000000"), D("2200.00"), None),
        (20240301, "p1", "member_salary", None, D("2200.00"), None),
    ]
    assert cost.select("cost_monthly_key").distinct().count() == 4


def test_headcount_fact(spark, year):
    presence = spark.createDataFrame(
        [(2024, 1, "e1", "o1", True, D(8)), (2024, 1, "e2", "o1", None, D(8)), (2024, 1, "ghost", "o1", True, D(8))],
        "year int, month int, employee_key string, org_key string, has_billable_work boolean, total_hours decimal(18,2)",
    )
    assignments = spark.createDataFrame(
        [(2024, 1, "e1", "Resource Pool"), (2024, 1, "e1", "INTERVIEW desk"), (2024, 1, "e3", "Training")],
        "year int, month int, employee_key string, project_name string",
    )
    employees = spark.createDataFrame(
        [("e1", D("10.00"), None, "Part-time"), ("e2", None, None, None)],
        "employee_key string, base_salary decimal(18,2), billing_rate decimal(18,2), employment_type string",
    )
    fact = facts.fct_headcount_monthly(presence, assignments, cal.month_spine(year), employees)
    assert rows(fact, "employee_key", "is_billable", "is_hr_project", "is_pool", "is_training", "headcount_value") == [
        ("e1", True, True, True, True, D("0.5")),
        ("e2", None, False, False, False, D("1.0")),
    ]
    rates = reports.rpt_rate_metrics(cal.month_spine(year, DAY(2024, 3, 31)), fact)
    columns = ("total_headcount", "billable_count", "busy_count", "billable_rate", "busy_rate", "avg_salary", "total_salary_cost")
    assert rows(rates.where("month = 1"), *columns) == [(2, 1, 1, 0.5, 0.5, 10.0, D("10.00"))]
    assert rows(rates.where("month = 3"), *columns) == [(0, 0, 0, None, None, None, D("0.00"))]


@pytest.fixture(scope="module")
def revenue(spark, year):
    projects = spark.createDataFrame(
        [
            ("p1", "Fix Cost", D("100.00"), D("0.500000"), D("0.250000")),
            ("p2", "Teambase", D("9.00"), D("1.000000"), D("1.000000")),
            ("p3", "Fix Cost", None, D("1.000000"), D("1.000000")),
            ("p4", "Fix Cost", D("10.00"), None, None),
        ],
        "project_key string, project_type string, total_sales_amount decimal(18,2), "
        "plan_complete_rate decimal(14,6), actual_complete_rate decimal(14,6)",
    )
    return facts.fct_revenue_monthly(projects, cal.month_starts(year)).cache()


def test_fixed_price_revenue_in_every_month(revenue):
    assert revenue.count() == 24
    assert rows(revenue.where("project_key = 'p1'").select("revenue_forecast", "revenue_actual").distinct()) == [
        (D("50.000000"), D("25.000000"))
    ]
    assert revenue.where("project_key = 'p4' and revenue_actual is null").count() == 12


def test_monthly_pnl(year, revenue, cost):
    pnl = reports.rpt_monthly_pnl(cal.month_spine(year, DAY(2024, 4, 1)), revenue, cost)
    got = rows(pnl, "month", "total_revenue_actual", "total_cost_actual", "gross_profit_actual", "gross_margin_pct")
    assert [r[0] for r in got] == [1, 3, 4]
    assert got[0] == (1, D("25.000000"), D("1237.500000"), D("-1212.500000"), -48.5)
    assert got[2] == (4, D("25.000000"), D("0.000000"), D("25.000000"), 1.0)
    kpi = cards.card_revenue_kpi(pnl).first()
    assert (kpi.total_revenue, kpi.margin) == (D("25.000000"), 1.0)


def test_margin_is_null_without_revenue(spark, year, revenue, cost):
    pnl = reports.rpt_monthly_pnl(cal.month_spine(year, DAY(2024, 1, 31)), revenue.where("false"), cost)
    assert rows(pnl, "total_revenue_actual", "gross_margin_pct") == [(D("0.000000"), None)]
    assert cards.card_revenue_kpi(pnl).count() == 0


def test_cost_mix_shares_add_up(spark, year, cost):
    mix = reports.rpt_cost_mix(cost, year, seed.cost_categories(spark))
    january = mix.where("month = 1")
    assert rows(january, "cost_category", "cost_group") == [("Member Salary", "Member Cost"), ("Overtime", "Member Cost")]
    assert abs(sum(r.cost_pct for r in january.collect()) - 1) < 1e-12
    assert mix.where("month = 3").first().cost_pct is None
    top = cards.card_cost_pct(mix).first()
    assert top.cost_category == "Member Salary"


def test_grid_reports_hold_every_month_and_department(spark, year, cost):
    months, org = cal.month_spine(year, DAY(2024, 4, 1)), organization(spark)
    report = reports.rpt_cost_summary(months, org, cost)
    assert report.count() == 3 * 4
    assert {r[0] for r in report.select("total_cost_actual").distinct().collect()} == {D("0.000000")}
    mine = cost.withColumn("org_key", F.lit(org.where("department_code = 'D3'").first().org_key))
    january = reports.rpt_cost_summary(months, org, mine).where("month = 1 and total_cost_actual > 0")
    assert rows(january, "company_name", "production_cost_actual", "hr_cost_actual") == [("Co", D("1237.500000"), None)]
    operational = spark.createDataFrame(
        [(20240101, org.where("department_code = 'D3'").first().org_key, D("5.000000"))],
        "date_key int, org_key string, hr_cost decimal(20,6)",
    )
    filled = reports.rpt_cost_summary(months, org, mine, operational).where("hr_cost_actual is not null")
    assert rows(filled, "month", "hr_cost_actual", "training_cost_actual") == [(1, D("5.000000"), None)]


def test_member_report_keeps_unknown_employees_and_projects(spark, year):
    allocation = spark.createDataFrame(
        [(20240101, "nobody", "nothing", 1)], "date_key int, employee_key string, project_key string, effort_days int"
    )
    for c in ("effort_hours", "performance_rate", "employee_rate", "revenue_actual", "revenue_forecast"):
        allocation = allocation.withColumn(c, F.lit(None).cast("double"))
    employees = spark.createDataFrame([], "employee_key string, employee_id string, employee_name string, department string, _source string")
    projects = spark.createDataFrame([], "project_key string, project_id string, project_name string, project_type string, market string, _source string")
    out = reports.rpt_revenue_by_member(allocation, cal.month_spine(year), employees, projects)
    assert rows(out, "month", "employee_id", "project_id", "effort_days") == [(1, None, None, 1)]


def test_revenue_delta_starts_from_zero(spark):
    completion = spark.createDataFrame(
        [("p", 20240101, D("100.00"), D("0.2"), D("0.1")), ("p", 20240301, D("100.00"), D("0.5"), D("0.1"))],
        "project_key string, date_key int, contract_revenue decimal(18,2), complete_rate_plan decimal(9,6), complete_rate_actual decimal(9,6)",
    )
    out = metrics.fixcost_revenue_delta(completion)
    assert rows(out, "date_key", "revenue_forecast", "revenue_actual") == [
        (20240101, D("20.000000"), D("10.000000")),
        (20240301, D("30.000000"), D("0.000000")),
    ]


def test_planned_days_end_with_the_project(spark, year):
    sheet = spark.createDataFrame(
        [("e", "p", DAY(2024, 1, 2), D(5)), ("e", "p", DAY(2024, 1, 2), D(6)), ("e", "p", DAY(2024, 1, 6), D(9)), ("e", "p", DAY(2024, 3, 1), D(1))],
        "employee_key string, project_key string, day date, hours decimal(8,2)",
    )
    spans = spark.createDataFrame([("p", DAY(2024, 1, 6), DAY(2024, 3, 5))], "project_key string, start_day date, end_day date")
    out = metrics.working_days(sheet, year, spans)
    # January from the 6th: 22 working days less the four of the first week; March up to the 5th: three
    assert rows(out, "date_key", "actual_working_days", "plan_working_days", "overtime_hours") == [
        (20240101, 1, 18, D("4.00")),
        (20240301, 1, 3, D("0.00")),
    ]


def test_turnover(spark):
    presence = spark.createDataFrame(
        [(20231201, "d", "a"), (20231201, "d", "b"), (20240101, "d", "a"), (20240101, "d", "a"), (20240301, "d", "b")],
        "date_key int, division string, employee_key string",
    )
    out = metrics.turnover(presence)
    assert rows(out, "date_key", "headcount", "headcount_before", "departed", "turnover_rate") == [
        (20231201, 2, 0, 0, 0.0),
        (20240101, 1, 2, 1, 1 / 1.5 * 100),
        (20240201, 0, 1, 1, 200.0),
        (20240301, 1, 0, 0, 0.0),
    ]


def test_operational_cost_counts_a_pool_salary_once(spark):
    work = spark.createDataFrame(
        [(1, "d", "a", "pool", D("2.00"), D("3.00"), D("100.00")), (1, "d", "a", "pool", D("2.00"), D("3.00"), D("100.00")),
         (1, "d", "b", "hr", D("2.00"), D("3.00"), D("50.00"))],
        "date_key int, division string, employee_key string, work_class string, employee_rate decimal(18,2), hours decimal(18,2), base_salary decimal(18,2)",
    )
    row = metrics.operational_cost(work).first()
    assert (row.hr_cost, row.training_cost, row.resource_pool_cost) == (D("6.000000"), D("0.000000"), D("100.000000"))


def test_share_of_zero_effort_is_null(spark):
    members = spark.createDataFrame([(1, "e", "p", D("0.00"), D("0.20"))], "date_key int, employee_key string, project_key string, effort_hours decimal(8,2), performance_rate decimal(4,2)")
    earned = spark.createDataFrame([(1, "p", D("10.00"))], "date_key int, project_key string, project_revenue decimal(18,2)")
    assert metrics.fixcost_member_share(members, earned).first().member_revenue is None


def test_division_through_unit_then_department(spark):
    projects = spark.createDataFrame([("p", 1, "x"), ("q", 9, "x"), ("r", None, None)], "project_key string, unit_id int, department string")
    units = spark.createDataFrame([(1, "U")], "unit_id int, division_name string")
    org = spark.createDataFrame([("x", "X")], "department_code string, division_name string")
    assert rows(dims.project_divisions(projects, units, org)) == [("p", "U"), ("q", "X"), ("r", None)]
