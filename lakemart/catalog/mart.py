"""Calendar, dimensions, facts, reports and cards."""

from __future__ import annotations

from lakemart import standins as si
from lakemart.catalog.ctes import with_views
from lakemart.plans import calendar as cal
from lakemart.plans import cards, facts, mart, metrics, reports
from lakemart.session import new_table_path
from lakemart.sources import seed


def mart_inputs(spark, sf_dir):
    return mart.MartInputs(
        calendar=si.calendar(spark, sf_dir),
        employees=si.dim_employee(spark, sf_dir),
        organization=si.dim_organization(spark, sf_dir),
        projects=si.dim_project(spark, sf_dir),
        categories=seed.cost_categories(spark),
        activity=si.activity(spark, sf_dir),
        presence=si.presence(spark, sf_dir),
        assignments=si.assignments(spark, sf_dir),
        team_revenue=metrics.teambase_member_revenue(si.team_members(spark, sf_dir)),
    )


@si.once
def stored(spark, sf_dir):
    """The mart's tables, built and written once for all reports and cards."""
    return mart.build_mart(spark, mart_inputs(spark, sf_dir), new_table_path(spark, "mart"), si.AS_OF)


def _stored(name):
    return lambda spark, sf_dir: stored(spark, sf_dir)[name]


def _card(card, name):
    return lambda spark, sf_dir: card(stored(spark, sf_dir)[name])


def _cost_by_division(spark, sf_dir):
    tables = stored(spark, sf_dir)
    months = cal.month_spine(tables["dim_date"], si.AS_OF)
    summary = reports.rpt_cost_summary(months, tables["dim_organization"], tables["fct_cost_monthly"], by_division=True)
    return summary.select("month_date", "company_name", "division_name", "total_cost_actual", "total_cost_forecast")


def _revenue_by_member(spark, sf_dir):
    team = si.team_members(spark, sf_dir)
    allocation = team.select(
        "date_key",
        "employee_key",
        "project_key",
        team["actual_days"].alias("effort_days"),
        team["effort_hours"],
        "performance_rate",
        "employee_rate",
        (team["employee_rate"] * team["actual_hours"]).cast("decimal(20,6)").alias("revenue_actual"),
        (team["employee_rate"] * team["plan_days"] * facts.HOURS_PER_DAY).cast("decimal(20,6)").alias("revenue_forecast"),
    )
    return reports.rpt_revenue_by_member(
        allocation, si.months_as_of(spark, sf_dir), si.dim_employee(spark, sf_dir), si.dim_project(spark, sf_dir)
    )


def _employee_performance(spark, sf_dir):
    return reports.rpt_employee_performance(
        metrics.employee_performance(si.members(spark, sf_dir)),
        si.months_as_of(spark, sf_dir),
        si.dim_employee(spark, sf_dir),
        si.dim_project(spark, sf_dir),
    )


QUERIES = {
    "dim_date": si.calendar,
    "month_spine": lambda spark, sf_dir: cal.month_spine(si.calendar(spark, sf_dir)),
    "dim_employee": si.dim_employee,
    "dim_organization": si.dim_organization,
    "dim_project": si.dim_project,
    "fct_cost_salary": lambda spark, sf_dir: facts.fct_cost_salary(*si.cost_inputs(spark, sf_dir)),
    "fct_cost_overtime": lambda spark, sf_dir: facts.fct_cost_overtime(*si.cost_inputs(spark, sf_dir)),
    "fct_cost_monthly": si.fct_cost,
    "headcount_flags": lambda spark, sf_dir: facts.headcount_flags(si.assignments(spark, sf_dir)),
    "fct_headcount_monthly": si.fct_headcount,
    "fct_revenue_fixcost": si.fct_revenue_fixcost,
    "fct_revenue_monthly": si.fct_revenue,
    "rpt_monthly_pnl": _stored("rpt_monthly_pnl"),
    "rpt_rate_metrics": _stored("rpt_rate_metrics"),
    "rpt_revenue_mix": _stored("rpt_revenue_mix"),
    "rpt_cost_mix": _stored("rpt_cost_mix"),
    "rpt_cost_summary": _stored("rpt_cost_summary"),
    "rpt_cost_by_division": _cost_by_division,
    "rpt_hr_summary": _stored("rpt_hr_summary"),
    "rpt_revenue_by_project": _stored("rpt_revenue_by_project"),
    "rpt_revenue_by_member": _revenue_by_member,
    "rpt_employee_performance": _employee_performance,
    "card_revenue_kpi": _card(cards.card_revenue_kpi, "rpt_monthly_pnl"),
    "card_pnl_kpi": _card(cards.card_pnl_kpi, "rpt_monthly_pnl"),
    "card_busy_rate": _card(cards.card_busy_rate, "rpt_rate_metrics"),
    "card_billable_rate": _card(cards.card_billable_rate, "rpt_rate_metrics"),
    "card_revenue_by_month": _card(cards.card_revenue_by_month, "rpt_monthly_pnl"),
    "card_pnl_by_month": _card(cards.card_pnl_by_month, "rpt_monthly_pnl"),
    "card_revenue_pct": _card(cards.card_revenue_pct, "rpt_revenue_mix"),
    "card_cost_pct": _card(cards.card_cost_pct, "rpt_cost_mix"),
}


def _double(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n.split('.')[-1]}" for n in names)


_NONE = "CAST(NULL AS {}) AS {}"


def _none(kind: str, *names: str) -> str:
    return ", ".join(_NONE.format(kind, n) for n in names)


_COST = f"""
    SELECT cost_monthly_key, date_key, employee_key, project_key, org_key, cost_category_key,
           wd AS working_days_in_month, days_worked, CAST(pay * 0.01 AS DOUBLE) AS base_salary,
           CAST(prorated AS DOUBLE) AS prorated_salary, {_none('DOUBLE', 'project_bonus')},
           CAST(overtime AS DOUBLE) AS overtime_cost, CAST(actual AS DOUBLE) AS cost_actual,
           CAST(forecast * 0.01 AS DOUBLE) AS cost_forecast FROM """
_REVENUE = f"""
    SELECT revenue_monthly_key, date_key, project_key, {_none('VARCHAR', 'org_key')}, revenue_type,
           CAST(contract AS DOUBLE) AS contract_revenue, CAST(plan_rate AS DOUBLE) AS complete_rate_plan,
           CAST(done_rate AS DOUBLE) AS complete_rate_actual, {_none('DOUBLE', 'headcount_rate')},
           CAST(hours_forecast AS DOUBLE) AS total_hours_forecast, CAST(hours_actual AS DOUBLE) AS total_hours_actual,
           CAST(forecast AS DOUBLE) AS revenue_forecast, CAST(actual AS DOUBLE) AS revenue_actual FROM revenue"""
_MIX = """
    SELECT x.y AS year, x.m AS month, make_date(x.y, x.m, 1) AS month_date, {labels},
           CAST(a AS DOUBLE) AS {kind}_actual, CAST(f AS DOUBLE) AS {kind}_forecast,
           CASE WHEN t > 0 THEN CAST(a AS DOUBLE) / CAST(t AS DOUBLE) END AS {kind}_pct
    FROM (SELECT y, m, {by}, sum(actual) AS a, sum({forecast}) AS f
          FROM {fact} JOIN cal USING (date_key) GROUP BY y, m, {by}) x
    JOIN (SELECT y, m, sum(actual) AS t FROM {fact} JOIN cal USING (date_key) GROUP BY y, m) w
      ON x.y = w.y AND x.m = w.m"""
_REVENUE_MIX = _MIX.format(labels="revenue_type", kind="revenue", by="revenue_type", forecast="forecast", fact="revenue")
_COST_MIX = (
    _MIX.format(
        labels="x.cost_category_key, cost_category, cost_group",
        kind="cost",
        by="cost_category_key",
        forecast="forecast * 0.01",
        fact="cost",
    )
    + " LEFT JOIN category g ON x.cost_category_key = g.cost_category_key"
)
_PNL_MONEY = (
    "revenue_teambase_actual revenue_teambase_forecast revenue_fixcost_actual revenue_fixcost_forecast "
    "total_revenue_actual total_revenue_forecast cost_salary_actual cost_salary_forecast cost_overtime_actual "
    "total_cost_actual total_cost_forecast"
).split()
_MARGIN = """CASE WHEN total_revenue_actual > 0 THEN CAST(total_revenue_actual - total_cost_actual AS DOUBLE)
             / CAST(total_revenue_actual AS DOUBLE) END"""
_LATEST_PNL = "FROM pnl WHERE month_date = (SELECT max(month_date) FROM pnl WHERE total_revenue_actual > 0)"
_LATEST_RATES = "FROM rates WHERE month_date = (SELECT max(month_date) FROM rates WHERE total_headcount > 0)"
_OTHER_COSTS = [f"{k}_cost_{w}" for k in ("hr", "training", "presale", "resource_pool") for w in ("actual", "forecast")]
_GRID_COST = """
    FROM shown CROSS JOIN organization o
    LEFT JOIN (SELECT date_key, org_key, sum(actual) AS a, sum(forecast * 0.01) AS f FROM cost GROUP BY 1, 2) c
      ON c.date_key = mk AND c.org_key = o.org_key"""

ORACLE = {
    "dim_date": """
        SELECT date_key, d AS date_actual, y AS year, quarter(d) AS quarter, m AS month,
               strftime(d, '%B') AS month_name, isodow(d) AS day_of_week, strftime(d, '%A') AS day_name,
               weekend AS is_weekend, off AS is_holiday, working AS is_working_day,
               CASE WHEN working THEN (SELECT count(*) FROM cal b WHERE b.mk = a.mk AND b.d <= a.d AND b.working) END
                   AS working_day_of_month,
               CAST((SELECT count(*) FROM cal b WHERE b.mk = a.mk AND b.working) AS INTEGER) AS total_working_days_in_month,
               CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
               CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date, y AS fiscal_year, quarter(d) AS fiscal_quarter
        FROM cal a""",
    "month_spine": "SELECT mk AS date_key, month_date, y AS year, m AS month, wd AS total_working_days_in_month FROM months",
    "dim_employee": f"""
        SELECT employee_key, employee_id, employee_name, department, {_none('VARCHAR', 'division')}, employment_type,
               CAST(pay * 0.01 AS DOUBLE) AS base_salary, {_none('DOUBLE', 'billing_rate')}, department AS cost_center,
               _source FROM employee""",
    "dim_organization": "SELECT * FROM organization",
    "dim_project": f"""
        SELECT project_key, project_id, project_name, project_type, market, project_status,
               CAST(amount AS DOUBLE) AS total_sales_amount, {_none('DOUBLE', 'gross_margin')},
               CAST(plan_rate AS DOUBLE) AS plan_complete_rate, CAST(done_rate AS DOUBLE) AS actual_complete_rate,
               _source FROM project""",
    "fct_cost_salary": _COST + "cost_salary",
    "fct_cost_overtime": _COST + "cost_overtime",
    "fct_cost_monthly": _COST + "cost",
    "headcount_flags": """
        SELECT mk // 10000 AS year, (mk // 100) % 100 AS month, md5(concat_ws(chr(31), CAST(sup AS VARCHAR), 'erp')) AS employee_key,
               hr AS is_hr_project, pool AS is_pool, training AS is_training FROM flags""",
    "fct_headcount_monthly": f"""
        SELECT md5(concat_ws(chr(31), CAST(date_key AS VARCHAR), employee_key)) AS headcount_monthly_key, date_key,
               employee_key, org_key, true AS is_active, billable AS is_billable, hr AS is_hr_project, pool AS is_pool,
               training AS is_training, CAST(pay * 0.01 AS DOUBLE) AS total_salary, {_none('DOUBLE', 'billing_rate')},
               CAST(value AS DOUBLE) AS headcount_value FROM headcount""",
    "fct_revenue_fixcost": _REVENUE + " WHERE revenue_type = 'fix_cost'",
    "fct_revenue_monthly": _REVENUE,
    "rpt_monthly_pnl": f"""
        SELECT date_key, month_date, year, month, total_working_days_in_month, {_double(*_PNL_MONEY)},
               CAST(total_revenue_actual - total_cost_actual AS DOUBLE) AS gross_profit_actual,
               CAST(total_revenue_forecast - total_cost_forecast AS DOUBLE) AS gross_profit_forecast,
               {_MARGIN} AS gross_margin_pct FROM pnl""",
    "rpt_rate_metrics": """
        SELECT * REPLACE (CAST(total_hc_value AS DOUBLE) AS total_hc_value,
                          CAST(total_salary_cost AS DOUBLE) AS total_salary_cost) FROM rates""",
    "rpt_revenue_mix": _REVENUE_MIX,
    "rpt_cost_mix": _COST_MIX,
    "rpt_cost_summary": f"""
        SELECT month_date, y AS year, m AS month, company_name, division_name,
               CAST(coalesce(a, 0) AS DOUBLE) AS production_cost_actual,
               CAST(coalesce(f, 0) AS DOUBLE) AS production_cost_forecast, {_none('DOUBLE', *_OTHER_COSTS)},
               CAST(coalesce(a, 0) AS DOUBLE) AS total_cost_actual, CAST(coalesce(f, 0) AS DOUBLE) AS total_cost_forecast
        {_GRID_COST}""",
    "rpt_cost_by_division": f"""
        SELECT month_date, company_name, division_name, CAST(sum(coalesce(a, 0)) AS DOUBLE) AS total_cost_actual,
               CAST(sum(coalesce(f, 0)) AS DOUBLE) AS total_cost_forecast
        {_GRID_COST} GROUP BY month_date, company_name, division_name""",
    "rpt_hr_summary": f"""
        SELECT mk AS date_key, month_date, y AS year, m AS month, company_name, division_name,
               coalesce(n, 0) AS total_hc, CAST(coalesce(v, 0) AS DOUBLE) AS total_hc_value,
               {_none('INTEGER', 'outsource_hc', 'internal_hc')}, coalesce(train, 0) AS training_hc,
               coalesce(pools, 0) AS available_hc, {_none('DOUBLE', 'turnover_rate')},
               CASE WHEN paid > 0 THEN CAST(pays * 0.01 AS DOUBLE) / CAST(paid AS DOUBLE) END AS dev_avg_salary,
               CAST(coalesce(pays * 0.01, 0) AS DOUBLE) AS total_salary
        FROM shown CROSS JOIN organization o
        LEFT JOIN (SELECT date_key, org_key, count(*) AS n, sum(value) AS v, count(*) FILTER (training) AS train,
                          count(*) FILTER (pool) AS pools, sum(pay) AS pays, count(pay) AS paid
                   FROM headcount GROUP BY 1, 2) h ON h.date_key = mk AND h.org_key = o.org_key""",
    "rpt_revenue_by_project": f"""
        SELECT month_date, y AS year, m AS month, project_id, project_name, project_type, market,
               {_none('VARCHAR', 'division')}, _source, revenue_type, CAST(contract AS DOUBLE) AS contract_revenue,
               CAST(r.plan_rate AS DOUBLE) AS complete_rate_plan, CAST(r.done_rate AS DOUBLE) AS complete_rate_actual,
               {_none('DOUBLE', 'headcount_rate')}, CAST(hours_forecast AS DOUBLE) AS total_hours_forecast,
               CAST(hours_actual AS DOUBLE) AS total_hours_actual, CAST(forecast AS DOUBLE) AS revenue_forecast,
               CAST(actual AS DOUBLE) AS revenue_actual, {_none('INTEGER', 'headcount')}
        FROM revenue r JOIN months ON date_key = mk JOIN project p ON r.project_key = p.project_key""",
    "rpt_revenue_by_member": """
        SELECT month_date, y AS year, m AS month, employee_id, employee_name, department, project_id, project_name,
               project_type, market, CAST(days AS INTEGER) AS effort_days, CAST(t.wd * 8 * disc * 0.1 AS DOUBLE) AS effort_hours,
               CAST(perf * 0.01 AS DOUBLE) AS performance_rate, CAST(rate AS DOUBLE) AS employee_rate,
               CAST(actual AS DOUBLE) AS revenue_actual, CAST(forecast AS DOUBLE) AS revenue_forecast
        FROM team t JOIN shown s ON t.mk = s.mk LEFT JOIN employee e ON t.employee_key = e.employee_key
        LEFT JOIN project p ON t.project_key = p.project_key""",
    "rpt_employee_performance": """
        SELECT month_date, y AS year, m AS month, employee_id, employee_name, department, employment_type,
               CAST(base AS DOUBLE) AS base_salary, project_id, project_name, project_type,
               CAST(disc * 0.1 AS DOUBLE) AS effort_rate, CAST(perf * 0.01 AS DOUBLE) AS performance_rate,
               CAST(wd * 8 * disc * 0.1 AS DOUBLE) AS total_effort_hours, CAST(hours AS DOUBLE) AS actual_hours,
               CAST(earned AS DOUBLE) AS revenue_contribution, CAST(spent AS DOUBLE) AS cost_contribution,
               CAST(earned - spent AS DOUBLE) AS profit_contribution
        FROM (SELECT month_date, y, m, employee_id, employee_name, department, employment_type, e.pay * 0.01 AS base,
                     project_id, project_name, project_type, disc, perf, t.wd, hours,
                     CAST(rate * (disc * 0.1) * (perf * 0.01) AS DECIMAL(20,6)) AS earned,
                     SPENT AS spent
              FROM member t JOIN shown s ON t.mk = s.mk LEFT JOIN employee e ON t.employee_key = e.employee_key
              LEFT JOIN project p ON t.project_key = p.project_key)""".replace(
        "SPENT", "(CAST((2 * CAST(t.pay * days AS HUGEINT) * 1000000 + t.wd * 100) // (2 * t.wd * 100) AS DECIMAL(18,0)) * 0.000001)"
    ),
    "card_revenue_kpi": f"""
        SELECT CAST(total_revenue_actual AS DOUBLE) AS total_revenue, CAST(total_revenue_forecast AS DOUBLE) AS forecast,
               {_MARGIN} AS margin {_LATEST_PNL}""",
    "card_pnl_kpi": f"""
        SELECT CAST(total_revenue_actual - total_cost_actual AS DOUBLE) AS gross_profit,
               CAST(total_revenue_actual AS DOUBLE) AS revenue, CAST(total_cost_actual AS DOUBLE) AS cost {_LATEST_PNL}""",
    "card_busy_rate": f"""
        SELECT round(coalesce(busy_rate, 0) * 100, 1) AS busy_rate_pct, busy_count AS busy,
               total_headcount AS total_hc {_LATEST_RATES}""",
    "card_billable_rate": f"""
        SELECT round(coalesce(billable_rate, 0) * 100, 1) AS billable_rate_pct, billable_count AS billable,
               total_headcount AS total_hc {_LATEST_RATES}""",
    "card_revenue_by_month": """
        SELECT month_date AS month, CAST(total_revenue_actual AS DOUBLE) AS actual,
               CAST(total_revenue_forecast AS DOUBLE) AS forecast FROM pnl ORDER BY 1""",
    "card_pnl_by_month": """
        SELECT month_date AS month, CAST(total_revenue_actual AS DOUBLE) AS revenue,
               CAST(total_cost_actual AS DOUBLE) AS cost,
               CAST(total_revenue_actual - total_cost_actual AS DOUBLE) AS profit FROM pnl ORDER BY 1""",
    "card_revenue_pct": """
        SELECT revenue_type, CAST(sum(actual) AS DOUBLE) AS revenue FROM revenue JOIN cal USING (date_key)
        GROUP BY 1 ORDER BY 2 DESC""",
    "card_cost_pct": """
        SELECT coalesce(g.cost_category, c.cost_category_key) AS cost_category, CAST(sum(actual) AS DOUBLE) AS cost
        FROM cost c JOIN cal USING (date_key) LEFT JOIN category g ON c.cost_category_key = g.cost_category_key
        GROUP BY 1 ORDER BY 2 DESC""",
}
ORACLE = {name: with_views(sql) for name, sql in ORACLE.items()}
