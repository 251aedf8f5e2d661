"""Named SQL views of the test tables, shared by the comparison queries.

They state the expected rows independently of the Spark code: integer arithmetic for rounded
quotients, LIKE for the path join, plain joins for shares of a total.
"""

from __future__ import annotations

import re


def key(*parts: str) -> str:
    """Digest over the parts."""
    texts = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '<null>')" for p in parts)
    return f"md5(concat_ws(chr(31), {texts}))"


def quotient(num: str, den: str, digits: int = 6) -> str:
    """``num / den`` rounded half up to ``digits`` digits; both are whole and not negative."""
    up = f"(2 * CAST({num} AS HUGEINT) * {10 ** digits} + {den}) // (2 * nullif({den}, 0))"
    unit = f"CAST({10 ** -digits:.{digits}f} AS DECIMAL({digits + 1},{digits}))"
    return f"(CAST({up} AS DECIMAL(18,0)) * {unit})"


def cents(money: str) -> str:
    return f"CAST(CAST({money} AS DECIMAL(18,2)) * 100 AS BIGINT)"


_FIX = "p_type = 'ECONOMY'"
_WORD = "split_part(p_name, ' ', 2)"
_MONTH = "year({d}) * 10000 + month({d}) * 100 + 1"

VIEWS = {
    "cal": f"""
        SELECT d, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, year(d) AS y, month(d) AS m,
               {_MONTH.format(d='d')} AS mk, isodow(d) IN (6, 7) AS weekend, h IS NOT NULL AS off,
               isodow(d) NOT IN (6, 7) AND h IS NULL AS working
        FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
        LEFT JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS h FROM orders
                   WHERE o_orderpriority = '1-URGENT' AND day(o_orderdate) = 1) ON d = h""",
    "months": """
        SELECT mk, make_date(y, m, 1) AS month_date, y, m, CAST(sum(working::INT) AS INTEGER) AS wd
        FROM cal GROUP BY mk, y, m HAVING sum(working::INT) > 0""",
    "shown": "SELECT * FROM months WHERE month_date <= DATE '2000-06-15'",
    "contract": f"""
        SELECT l_suppkey AS sup, {cents('l_extendedprice')} AS pay, l_shipdate AS modified
        FROM lineitem WHERE l_linestatus = 'F'
        QUALIFY row_number() OVER (PARTITION BY l_suppkey
                                   ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC) = 1""",
    "employee": f"""
        SELECT {key('c_custkey', "'timesheet'")} AS employee_key, CAST(c_custkey AS VARCHAR) AS employee_id,
               c_name AS employee_name, CAST(NULL AS VARCHAR) AS department, CAST(NULL AS VARCHAR) AS employment_type,
               CAST(NULL AS BIGINT) AS pay, 'timesheet' AS _source
        FROM customer
        UNION ALL
        SELECT {key('s_suppkey', "'erp'")}, CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR),
               CASE WHEN s_acctbal < 0 THEN 'Part-time' WHEN s_acctbal >= 9000 THEN 'Outsource' ELSE 'Full-time' END,
               pay, 'erp'
        FROM supplier LEFT JOIN contract ON s_suppkey = sup""",
    "organization": f"""
        SELECT {key('n_nationkey', "'crm'")} AS org_key, 'Headquarters' AS company_name, r_name AS division_name,
               CAST(r_regionkey + 100 AS VARCHAR) AS division_code, n_name AS department_name,
               CAST(n_nationkey AS VARCHAR) AS department_code, 'crm' AS _source
        FROM nation LEFT JOIN region
          ON (n_regionkey || '/' || n_nationkey || '/') LIKE ('%/' || r_regionkey || '/%')
        UNION ALL
        SELECT {key('n_name', "'erp'")}, CASE WHEN n_regionkey > 0 THEN 'Branch office' ELSE 'Headquarters' END,
               r_name, NULL, n_name, n_name, 'erp'
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "packages": f"""
        SELECT l_partkey AS part_id, count(*) AS n,
               CAST(sum(CAST(l_discount AS DECIMAL(10,2))) * 100 AS BIGINT) AS plan,
               CAST(sum(CAST(l_tax AS DECIMAL(10,2))) * 100 AS BIGINT) AS done
        FROM lineitem GROUP BY l_partkey""",
    "project": f"""
        SELECT {key('p_partkey', "'timesheet'")} AS project_key, CAST(p_partkey AS VARCHAR) AS project_id,
               p_name AS project_name, CASE WHEN {_FIX} THEN 'Fix Cost' ELSE 'Teambase' END AS project_type,
               p_brand AS market, CASE WHEN p_size > 25 THEN 'Open' ELSE 'Closed' END AS project_status,
               CAST(NULL AS DECIMAL(18,2)) AS amount, CAST(NULL AS DECIMAL(14,6)) AS plan_rate,
               CAST(NULL AS DECIMAL(14,6)) AS done_rate, 'timesheet' AS _source
        FROM part
        UNION ALL
        SELECT {key('p_partkey', "'erp'")}, CAST(p_partkey AS VARCHAR), p_name,
               CASE WHEN {_FIX} THEN 'Fix Cost' ELSE 'Teambase' END, NULL,
               CASE WHEN p_size > 25 THEN 'Open' ELSE 'Closed' END, CAST(p_retailprice AS DECIMAL(18,2)),
               CAST({quotient('plan', 'n * 100')} AS DECIMAL(14,6)),
               CAST({quotient('done', 'n * 100')} AS DECIMAL(14,6)), 'erp'
        FROM part LEFT JOIN packages ON p_partkey = part_id""",
    "worked": """
        SELECT l_suppkey AS sup, p_type, CAST(l_shipdate AS DATE) AS d, CAST(sum(l_quantity) AS BIGINT) AS hours
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "activity": f"""
        SELECT y, m, sup, {key('sup', "'erp'")} AS employee_key, {key('p_type', "'timesheet'")} AS project_key,
               {key('s_nationkey', "'crm'")} AS org_key, CAST(count(*) FILTER (working) AS INTEGER) AS days_worked,
               CAST(sum(hours) AS BIGINT) AS hours, CAST(sum(greatest(hours - 8, 0)) AS BIGINT) AS extra
        FROM worked JOIN cal USING (d) JOIN supplier ON sup = s_suppkey
        GROUP BY y, m, sup, p_type, s_nationkey""",
    "cost_salary": f"""
        SELECT {key('mk', 'a.employee_key', 'project_key', "'member_salary'")} AS cost_monthly_key, mk AS date_key,
               a.employee_key, project_key, org_key, 'member_salary' AS cost_category_key, wd, days_worked, pay,
               {quotient('pay * days_worked', '(wd * 100)')} AS prorated, CAST(NULL AS DECIMAL(25,6)) AS overtime,
               {quotient('pay * days_worked', '(wd * 100)')} AS actual, pay AS forecast
        FROM activity a JOIN months USING (y, m) JOIN employee e ON a.employee_key = e.employee_key
        WHERE pay IS NOT NULL""",
    "cost_overtime": f"""
        SELECT {key('mk', 'a.employee_key', 'project_key', "'member_overtime'")} AS cost_monthly_key, mk AS date_key,
               a.employee_key, project_key, org_key, 'member_overtime' AS cost_category_key, wd, days_worked, pay,
               CAST(NULL AS DECIMAL(25,6)) AS prorated, {quotient('pay * 3 * extra', '(wd * 1600)')} AS overtime,
               {quotient('pay * 3 * extra', '(wd * 1600)')} AS actual, CAST(NULL AS BIGINT) AS forecast
        FROM activity a JOIN months USING (y, m) JOIN employee e ON a.employee_key = e.employee_key
        WHERE pay IS NOT NULL AND extra > 0""",
    "cost": "SELECT * FROM cost_salary UNION ALL SELECT * FROM cost_overtime",
    "named": f"""
        SELECT l_suppkey AS sup, {_MONTH.format(d='l_shipdate')} AS mk,
               CASE {_WORD} WHEN 'ring' THEN 'Interview panel' WHEN 'bolt' THEN 'Bench Pool'
                            WHEN 'gear' THEN 'Training camp' WHEN 'gizmo' THEN 'Presale support'
                            WHEN 'anvil' THEN 'Resource Pool' ELSE p_name END AS project_name,
               l_returnflag = 'R' AND l_linestatus = 'O' AS billable
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "flags": """
        SELECT sup, mk, count(*) FILTER (project_name ILIKE '%hr%' OR project_name ILIKE '%interview%') > 0 AS hr,
               count(*) FILTER (project_name ILIKE '%pool%') > 0 AS pool,
               count(*) FILTER (project_name ILIKE '%training%' OR project_name ILIKE '%resource pool%') > 0 AS training,
               count(*) FILTER (billable) > 0 AS billable
        FROM named GROUP BY sup, mk""",
    "headcount": f"""
        SELECT mk AS date_key, f.sup, {key('f.sup', "'erp'")} AS employee_key, {key('s_nationkey', "'crm'")} AS org_key,
               billable, hr, pool, training, pay,
               CASE WHEN s_acctbal < 0 THEN 0.5 ELSE 1.0 END AS value
        FROM flags f JOIN months USING (mk) JOIN supplier ON f.sup = s_suppkey LEFT JOIN contract c ON c.sup = f.sup""",
    "day_work": """
        SELECT l_suppkey AS sup, l_partkey AS part_id, CAST(l_shipdate AS DATE) AS d,
               CAST(sum(l_quantity) AS BIGINT) AS hours, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS price,
               CAST(max(CAST(l_discount AS DECIMAL(4,2))) * 100 AS BIGINT) AS disc,
               CAST(max(CAST(l_tax AS DECIMAL(4,2))) * 100 AS BIGINT) AS tax
        FROM lineitem GROUP BY ALL""",
    "division": """
        SELECT s_suppkey AS sup, r_name AS division FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "planned": """
        SELECT part_id, k.mk, count(*) FILTER (working) AS pd
        FROM (SELECT part_id, min(d) AS first, max(d) AS last FROM day_work GROUP BY part_id) s
        JOIN cal k ON k.d BETWEEN first AND last GROUP BY part_id, k.mk""",
    "member_month": f"""
        SELECT mk, sup, part_id, {key('sup', "'erp'")} AS employee_key, {key('part_id', "'timesheet'")} AS project_key,
               wd, pd, days, hours, extra, rate, disc, least(tax + 10, 30) AS perf
        FROM (SELECT c.mk, sup, part_id, wd, CAST(count(*) FILTER (working) AS BIGINT) AS days,
                     CAST(sum(hours) AS BIGINT) AS hours, CAST(sum(greatest(hours - 8, 0)) AS BIGINT) AS extra,
                     {quotient('CAST(sum(price) * 100 AS BIGINT)', '(CAST(sum(hours) AS BIGINT) * 100)', 2)} AS rate,
                     max(disc) AS disc, max(tax) AS tax
              FROM day_work JOIN cal c USING (d) JOIN months mo ON c.mk = mo.mk
              GROUP BY c.mk, sup, part_id, wd)
        JOIN planned USING (part_id, mk)""",
    "member": "SELECT * FROM member_month JOIN division USING (sup) LEFT JOIN contract USING (sup)",
    "team": f"""
        SELECT m.*, CAST(rate * (pd * 8) AS DECIMAL(20,6)) AS forecast, CAST(rate * hours AS DECIMAL(20,6)) AS actual
        FROM member_month m JOIN part ON part_id = p_partkey WHERE NOT {_FIX}""",
    "revenue": f"""
        SELECT {key('date_key', 'project_key')} AS revenue_monthly_key, date_key, project_key,
               'fix_cost' AS revenue_type, amount AS contract, plan_rate, done_rate,
               CAST(NULL AS BIGINT) AS hours_forecast, CAST(NULL AS BIGINT) AS hours_actual,
               CAST(amount * plan_rate AS DECIMAL(20,6)) AS forecast,
               CAST(amount * done_rate AS DECIMAL(20,6)) AS actual
        FROM project, (SELECT date_key FROM cal WHERE day(d) = 1)
        WHERE project_type = 'Fix Cost' AND amount IS NOT NULL
        UNION ALL
        SELECT {key('mk', 'project_key')}, mk, project_key, 'teambase', NULL, NULL, NULL,
               CAST(sum(pd * 8) AS BIGINT), CAST(sum(hours) AS BIGINT), sum(forecast), sum(actual)
        FROM team GROUP BY mk, project_key""",
    "pnl": """
        SELECT mk AS date_key, month_date, y AS year, m AS month, wd AS total_working_days_in_month,
               coalesce(team_a, 0) AS revenue_teambase_actual, coalesce(team_f, 0) AS revenue_teambase_forecast,
               coalesce(fix_a, 0) AS revenue_fixcost_actual, coalesce(fix_f, 0) AS revenue_fixcost_forecast,
               coalesce(team_a, 0) + coalesce(fix_a, 0) AS total_revenue_actual,
               coalesce(team_f, 0) + coalesce(fix_f, 0) AS total_revenue_forecast,
               coalesce(sal_a, 0) AS cost_salary_actual, coalesce(sal_f, 0) AS cost_salary_forecast,
               coalesce(ot_a, 0) AS cost_overtime_actual, coalesce(all_a, 0) AS total_cost_actual,
               coalesce(all_f, 0) AS total_cost_forecast
        FROM shown
        LEFT JOIN (SELECT date_key AS mk, sum(actual) FILTER (revenue_type = 'teambase') AS team_a,
                          sum(forecast) FILTER (revenue_type = 'teambase') AS team_f,
                          sum(actual) FILTER (revenue_type = 'fix_cost') AS fix_a,
                          sum(forecast) FILTER (revenue_type = 'fix_cost') AS fix_f
                   FROM revenue GROUP BY date_key) USING (mk)
        LEFT JOIN (SELECT date_key AS mk, sum(actual) FILTER (cost_category_key = 'member_salary') AS sal_a,
                          sum(forecast * 0.01) FILTER (cost_category_key = 'member_salary') AS sal_f,
                          sum(actual) FILTER (cost_category_key = 'member_overtime') AS ot_a,
                          sum(actual) AS all_a, sum(forecast * 0.01) AS all_f
                   FROM cost GROUP BY date_key) USING (mk)""",
    "rates": """
        SELECT mk AS date_key, month_date, y AS year, m AS month, coalesce(n, 0) AS total_headcount,
               coalesce(v, 0) AS total_hc_value, coalesce(bill, 0) AS billable_count, coalesce(busy, 0) AS busy_count,
               coalesce(pools, 0) AS available_pool, coalesce(train, 0) AS training_count,
               CASE WHEN n > 0 THEN CAST(bill AS DOUBLE) / CAST(n AS DOUBLE) END AS billable_rate,
               CASE WHEN n > 0 THEN CAST(busy AS DOUBLE) / CAST(n AS DOUBLE) END AS busy_rate,
               CASE WHEN paid > 0 THEN CAST(pays * 0.01 AS DOUBLE) / CAST(paid AS DOUBLE) END AS avg_salary,
               coalesce(pays * 0.01, 0) AS total_salary_cost
        FROM shown
        LEFT JOIN (SELECT date_key AS mk, count(*) AS n, sum(value) AS v, count(*) FILTER (billable) AS bill,
                          count(*) FILTER (billable OR hr) AS busy, count(*) FILTER (pool) AS pools,
                          count(*) FILTER (training) AS train, sum(pay) AS pays, count(pay) AS paid
                   FROM headcount GROUP BY date_key) USING (mk)""",
    "classed": f"""
        SELECT mk, division, sup, kind, hours, pay,
               {quotient('CAST(price * 100 AS BIGINT)', '(hours * 100)', 2)} AS rate
        FROM (SELECT l_suppkey AS sup, {_MONTH.format(d='l_shipdate')} AS mk,
                     CASE {_WORD} WHEN 'ring' THEN 'hr' WHEN 'bolt' THEN 'pool' WHEN 'gear' THEN 'training'
                                  WHEN 'gizmo' THEN 'presale' WHEN 'anvil' THEN 'internal' ELSE 'billable' END AS kind,
                     CAST(sum(l_quantity) AS BIGINT) AS hours, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS price
              FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
        JOIN division USING (sup) LEFT JOIN contract USING (sup)""",
    "head": f"""
        SELECT mk, division, sup, pay,
               CASE WHEN s_acctbal < 0 THEN 'Part-time' WHEN s_acctbal >= 9000 THEN 'Outsource' ELSE 'Full-time' END AS kind
        FROM (SELECT DISTINCT l_suppkey AS sup, {_MONTH.format(d='l_shipdate')} AS mk FROM lineitem
              WHERE l_returnflag = 'R' AND l_linestatus = 'O')
        JOIN division USING (sup) JOIN supplier ON sup = s_suppkey LEFT JOIN contract USING (sup)""",
    "version": """
        SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
        FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM events)
        WHERE was IS DISTINCT FROM event_type""",
    "run": """
        SELECT (CASE WHEN event_type = 'purchase' THEN 'stg2sil__web__' ELSE 'src2brz__web__' END) || user_id AS dag_id,
               CAST(user_id AS VARCHAR) AS source, 'web' AS data_subject, event_type AS table_name,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
               CASE WHEN event_type <> 'error' THEN event_id END AS row_count, ts AS finished_at
        FROM events""",
    "category": """
        SELECT * FROM (VALUES
            ('member_salary', 'Member Salary', 'Member Cost'), ('member_bonus', 'Project Bonus', 'Member Cost'),
            ('member_overtime', 'Overtime', 'Member Cost'), ('project_expense', 'Project Expense', 'Project Expense'),
            ('op_hr', 'HR / Interviews', 'Operational'), ('op_training', 'Training / Resource Pool', 'Operational'),
            ('op_presale', 'Presale', 'Operational')) AS t(cost_category_key, cost_category, cost_group)""",
}


def with_views(sql: str) -> str:
    """Put the views a query names, and those they name, in front of it."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in needed) + "\n" + sql
