"""The metrics given as formulas."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart import standins as si
from lakemart.catalog.ctes import key, quotient, with_views
from lakemart.functions import money, month_key, surrogate_key
from lakemart.plans import dims, levels, metrics


def m_contract_revenue(spark, sf_dir):
    """Large parts have a contract of their own; the rest fall back to the sales amount."""
    part = si.table(spark, sf_dir, "part")
    contracts = part.where(F.col("p_size") > 25).select(
        F.col("p_partkey").alias("project_key"), money(F.col("p_retailprice") * F.col("p_size")).alias("contract_value")
    )
    projects = part.select(F.col("p_partkey").alias("project_key"), money("p_retailprice").alias("total_sales_amount"))
    return metrics.contract_revenue(projects, contracts)


def m_fixcost_revenue_delta(spark, sf_dir):
    return metrics.fixcost_revenue_delta(si.completion(spark, sf_dir))


def m_teambase_revenue(spark, sf_dir):
    return metrics.teambase_member_revenue(si.team_members(spark, sf_dir))


def m_fixcost_member_share(spark, sf_dir):
    earned = metrics.fixcost_revenue_delta(si.completion(spark, sf_dir)).select(
        "date_key",
        surrogate_key(F.col("project_key"), F.lit(si.TIMESHEET)).alias("project_key"),
        money("revenue_actual").alias("project_revenue"),
    )
    return metrics.fixcost_member_share(si.fixed_members(spark, sf_dir), earned)


def m_total_effort(spark, sf_dir):
    return metrics.total_effort(si.members(spark, sf_dir))


def m_member_cost(spark, sf_dir):
    return metrics.member_cost(si.members(spark, sf_dir))


def _project_costs(spark, sf_dir):
    """Packages: the part's price, by the working days it was worked on."""
    part = si.table(spark, sf_dir, "part").where(F.col("p_type") == "ECONOMY")
    parts = part.select(F.col("p_partkey").alias("l_partkey"), money("p_retailprice").alias("package_cost"))
    days = si.calendar(spark, sf_dir).where("is_working_day").select(
        F.col("date_actual").alias("day"),
        month_key().alias("date_key"),
        F.col("total_working_days_in_month").alias("working_days_in_month"),
    )
    packages = (
        si.table(spark, sf_dir, "lineitem")
        .select("l_partkey", F.to_date("l_shipdate").alias("day"))
        .distinct()
        .join(F.broadcast(days), "day")
        .groupBy("l_partkey", "date_key", "working_days_in_month")
        .agg(F.count(F.lit(1)).cast("int").alias("working_days"))
        .join(parts, "l_partkey")
        .withColumn("project_key", surrogate_key(F.col("l_partkey"), F.lit(si.TIMESHEET)))
    )
    return metrics.project_cost(metrics.member_cost(si.members(spark, sf_dir)), packages)


def _brand_of_project(spark, sf_dir):
    return si.table(spark, sf_dir, "part").select(
        surrogate_key(F.col("p_partkey"), F.lit(si.TIMESHEET)).alias("project_key"), F.col("p_brand").alias("division_name")
    )


def m_production_cost(spark, sf_dir):
    return metrics.production_cost(_project_costs(spark, sf_dir), _brand_of_project(spark, sf_dir))


def m_operational_cost(spark, sf_dir):
    return metrics.operational_cost(si.classed_work(spark, sf_dir))


def m_working_days(spark, sf_dir):
    """Employee supplier, project part; a project runs for 200 days from the day of the order of its number.

    Much work lies outside its project's span.
    """
    lines = si.table(spark, sf_dir, "lineitem")
    timesheet = lines.select(
        F.col("l_suppkey").alias("employee_key"),
        F.col("l_partkey").alias("project_key"),
        F.to_date("l_shipdate").alias("day"),
        F.col("l_quantity").cast("decimal(8,2)").alias("hours"),
    )
    first = F.to_date("o_orderdate")
    spans = si.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("project_key"), first.alias("start_day"), F.date_add(first, 200).alias("end_day")
    )
    return metrics.working_days(timesheet, si.calendar(spark, sf_dir), spans)


def m_target_variance(spark, sf_dir):
    """Targets from the orders of the month: revenue their total, cost four fifths of it."""
    orders = si.table(spark, sf_dir, "orders")
    month = month_key(F.year("o_orderdate"), F.month("o_orderdate")).alias("date_key")
    total = F.sum(money("o_totalprice")).cast("decimal(20,2)")
    targets = orders.groupBy(month).agg(
        total.alias("revenue_target"), (total * F.lit("0.8").cast("decimal(2,1)")).alias("cost_target")
    )
    earned = metrics.teambase_member_revenue(si.team_members(spark, sf_dir))
    spent = si.fct_cost(spark, sf_dir).groupBy("date_key").agg(F.sum("cost_actual").alias("cost_actual"))
    actuals = earned.groupBy("date_key").agg(F.sum("revenue_actual").alias("revenue_actual"))
    actuals = actuals.join(spent, "date_key", "full")
    return metrics.target_variance(actuals, targets)


def m_pnl_ratio(spark, sf_dir):
    return metrics.pnl_ratio(si.members(spark, sf_dir))


def m_rates_by_division(spark, sf_dir):
    return metrics.rates_by_division(si.classed_work(spark, sf_dir))


def m_dev_avg_salary(spark, sf_dir):
    return metrics.dev_avg_salary(si.heads(spark, sf_dir))


def m_turnover(spark, sf_dir):
    return metrics.turnover(si.heads(spark, sf_dir))


def m_headcount_class(spark, sf_dir):
    return metrics.headcount_class(si.heads(spark, sf_dir), si.OUTSOURCE_TYPES)


def dim_project_division(spark, sf_dir):
    """Small parts name a unit by their size, all parts a department by their type."""
    part = si.table(spark, sf_dir, "part")
    projects = part.select(
        F.col("p_partkey").alias("project_key"), F.col("p_size").alias("unit_id"), F.col("p_type").alias("department")
    )
    units = si.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("division_name")
    )
    departments = (
        part.where(F.col("p_type") != "PROMO")
        .select(F.col("p_type").alias("department_code"), F.concat(F.lit("DIV-"), "p_type").alias("division_name"))
        .distinct()
    )
    return dims.project_divisions(projects, units, departments)


def rpt_cost_summary_full(spark, sf_dir):
    """All kinds of cost, for divisions and the company."""
    return levels.cost_summary(metrics.member_cost(si.members(spark, sf_dir)), si.classed_work(spark, sf_dir))


def rpt_hr_summary_full(spark, sf_dir):
    """All head counts and rates, for divisions and the company."""
    return levels.hr_summary(si.classed_work(spark, sf_dir), si.heads(spark, sf_dir), si.OUTSOURCE_TYPES)


QUERIES = {
    "m_contract_revenue": m_contract_revenue,
    "m_fixcost_revenue_delta": m_fixcost_revenue_delta,
    "m_teambase_revenue": m_teambase_revenue,
    "m_fixcost_member_share": m_fixcost_member_share,
    "m_total_effort": m_total_effort,
    "m_member_cost": m_member_cost,
    "m_project_cost": _project_costs,
    "m_production_cost": m_production_cost,
    "m_operational_cost": m_operational_cost,
    "m_working_days": m_working_days,
    "m_target_variance": m_target_variance,
    "m_pnl_ratio": m_pnl_ratio,
    "m_rates_by_division": m_rates_by_division,
    "m_dev_avg_salary": m_dev_avg_salary,
    "m_turnover": m_turnover,
    "m_headcount_class": m_headcount_class,
    "dim_project_division": dim_project_division,
    "rpt_cost_summary_full": rpt_cost_summary_full,
    "rpt_hr_summary_full": rpt_hr_summary_full,
}

_COMPLETION = f"""
    SELECT part_id, mk, price, CAST({quotient('ordinal', 'n')} AS DECIMAL(9,6)) AS plan,
           CAST({quotient('CAST(cum AS BIGINT)', 'CAST(total AS BIGINT)')} AS DECIMAL(9,6)) AS done
    FROM (SELECT l_partkey AS part_id, year(l_shipdate) * 10000 + month(l_shipdate) * 100 + 1 AS mk,
                 any_value(CAST(p_retailprice AS DECIMAL(18,2))) AS price, sum(sum(l_quantity)) OVER w AS cum,
                 sum(sum(l_quantity)) OVER (PARTITION BY l_partkey) AS total,
                 row_number() OVER w AS ordinal, count(*) OVER (PARTITION BY l_partkey) AS n
          FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type = 'ECONOMY' GROUP BY 1, 2
          WINDOW w AS (PARTITION BY l_partkey ORDER BY year(l_shipdate) * 10000 + month(l_shipdate) * 100 + 1))"""
_DELTA = f"""
    SELECT part_id, mk, price, plan, done,
           CAST(price * (plan - coalesce(lag(plan) OVER v, 0)) AS DECIMAL(20,6)) AS forecast,
           CAST(price * (done - coalesce(lag(done) OVER v, 0)) AS DECIMAL(20,6)) AS actual
    FROM ({_COMPLETION}) WINDOW v AS (PARTITION BY part_id ORDER BY mk)"""
# pay in cents; bonus is pay times a whole percentage, so base is in hundredths of a cent
_MEMBER_COST = f"""
    SELECT mk, employee_key, project_key, division, part_id,
           {quotient('(pay * 100 + pay * disc) * pd', '(wd * 10000)')} AS forecast,
           {quotient('((pay * 100 + pay * disc) * days * 8 + pay * 100 * extra)', '(wd * 80000)')} AS actual
    FROM member"""
_PACKAGE = f"""
    SELECT part_id, mk, {quotient('CAST(p_retailprice * 100 AS BIGINT) * count(*)', '(wd * 100)')} AS package
    FROM (SELECT DISTINCT l_partkey AS part_id, CAST(l_shipdate AS DATE) AS d FROM lineitem)
    JOIN cal USING (d) JOIN months USING (mk) JOIN part ON part_id = p_partkey
    WHERE working AND p_type = 'ECONOMY' GROUP BY part_id, mk, wd, p_retailprice"""
_PROJECT_COST = f"""
    SELECT coalesce(a.mk, b.mk) AS date_key, coalesce(a.part_id, b.part_id) AS part_id,
           CASE WHEN coalesce(a.part_id, b.part_id) IN (SELECT part_id FROM ({_PACKAGE})) THEN 'fix_cost'
                ELSE 'teambase' END AS cost_type,
           coalesce(members, 0) + coalesce(package, 0) AS cost
    FROM (SELECT mk, part_id, sum(actual) AS members FROM ({_MEMBER_COST}) GROUP BY mk, part_id) a
    FULL JOIN ({_PACKAGE}) b ON a.mk = b.mk AND a.part_id = b.part_id"""

ORACLE = {
    "m_contract_revenue": """
        SELECT p_partkey AS project_key,
               CAST(CAST(CASE WHEN p_size > 25 THEN CAST(p_retailprice AS DECIMAL(18,2)) * p_size ELSE p_retailprice END
                         AS DECIMAL(18,2)) AS DOUBLE) AS contract_revenue FROM part""",
    "m_fixcost_revenue_delta": f"""
        SELECT part_id AS project_key, mk AS date_key, CAST(price AS DOUBLE) AS contract_revenue,
               CAST(plan AS DOUBLE) AS complete_rate_plan, CAST(done AS DOUBLE) AS complete_rate_actual,
               CAST(forecast AS DOUBLE) AS revenue_forecast, CAST(actual AS DOUBLE) AS revenue_actual FROM ({_DELTA})""",
    "m_teambase_revenue": """
        SELECT mk AS date_key, employee_key, project_key, CAST(rate AS DOUBLE) AS employee_rate,
               CAST(pd * 8 AS DOUBLE) AS forecast_hours, CAST(hours AS DOUBLE) AS actual_hours,
               CAST(forecast AS DOUBLE) AS revenue_forecast, CAST(actual AS DOUBLE) AS revenue_actual FROM team""",
    "m_fixcost_member_share": f"""
        SELECT mk AS date_key, employee_key, project_key, CAST(wd * 8 * disc * 0.1 AS DOUBLE) AS effort_hours,
               CAST(total * 0.1 AS DOUBLE) AS total_effort_hours,
               CAST({quotient('(wd * 8 * disc * perf * cents)', '(total * 10000)')} AS DOUBLE) AS member_revenue
        FROM member_month JOIN (SELECT mk, part_id, CAST(CAST(actual AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents FROM ({_DELTA}))
             USING (mk, part_id)
        JOIN (SELECT mk, part_id, CAST(sum(wd * 8 * disc) AS BIGINT) AS total FROM member_month GROUP BY mk, part_id)
             USING (mk, part_id)""",
    "m_total_effort": """
        SELECT mk AS date_key, employee_key, CAST(sum(wd * 8 * disc) * 0.1 AS DOUBLE) AS total_effort
        FROM member GROUP BY mk, employee_key""",
    "m_member_cost": f"""
        SELECT mk AS date_key, employee_key, project_key, division, CAST(forecast AS DOUBLE) AS cost_forecast,
               CAST(actual AS DOUBLE) AS cost_actual FROM ({_MEMBER_COST})""",
    "m_project_cost": f"""
        SELECT date_key, {key('part_id', "'timesheet'")} AS project_key, cost_type, CAST(cost AS DOUBLE) AS project_cost
        FROM ({_PROJECT_COST})""",
    "m_production_cost": f"""
        SELECT date_key, p_brand AS division_name, CAST(sum(cost) AS DOUBLE) AS production_cost
        FROM ({_PROJECT_COST}) JOIN part ON part_id = p_partkey GROUP BY date_key, p_brand""",
    "m_operational_cost": """
        SELECT date_key, division, CAST(coalesce(hr, 0) AS DOUBLE) AS hr_cost,
               CAST(coalesce(training, 0) AS DOUBLE) AS training_cost, CAST(coalesce(presale, 0) AS DOUBLE) AS presale_cost,
               CAST(coalesce(pool, 0) * 0.01 AS DOUBLE) AS resource_pool_cost
        FROM (SELECT mk AS date_key, division, sum(rate * hours) FILTER (kind = 'hr') AS hr,
                     sum(rate * hours) FILTER (kind = 'training') AS training,
                     sum(rate * hours) FILTER (kind = 'presale') AS presale, sum(pay) FILTER (kind = 'pool') AS pool
              FROM classed GROUP BY mk, division)""",
    "m_working_days": """
        SELECT c.mk AS date_key, sup AS employee_key, w.part_id AS project_key,
               count(*) FILTER (working) AS actual_working_days,
               any_value((SELECT count(*) FROM cal k WHERE k.mk = c.mk AND k.working
                          AND k.d >= coalesce(first, k.d) AND k.d <= coalesce(last, k.d))) AS plan_working_days,
               CAST(sum(greatest(hours - 8, 0)) AS DOUBLE) AS overtime_hours
        FROM day_work w JOIN cal c USING (d)
        LEFT JOIN (SELECT o_orderkey AS part_id, CAST(o_orderdate AS DATE) AS first, CAST(o_orderdate AS DATE) + 200 AS last
              FROM orders) s ON w.part_id = s.part_id
        GROUP BY c.mk, sup, w.part_id, first, last""",
    "m_target_variance": """
        SELECT mk AS date_key, CAST(earned AS DOUBLE) AS revenue_actual, CAST(target AS DOUBLE) AS revenue_target,
               CAST(earned - target AS DOUBLE) AS revenue_variance, CAST(spent AS DOUBLE) AS cost_actual,
               CAST(target * 0.8 AS DOUBLE) AS cost_target, CAST(spent - target * 0.8 AS DOUBLE) AS cost_variance
        FROM (SELECT mk, sum(actual) AS earned FROM team GROUP BY mk) e
        FULL JOIN (SELECT date_key AS mk, sum(actual) AS spent FROM cost GROUP BY 1) s USING (mk)
        LEFT JOIN (SELECT year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 AS mk,
                          sum(CAST(o_totalprice AS DECIMAL(18,2))) AS target FROM orders GROUP BY 1) t USING (mk)""",
    "m_pnl_ratio": f"""
        SELECT mk AS date_key, division,
               CASE WHEN rf > 0 THEN CAST(cf AS DOUBLE) / CAST(rf AS DOUBLE) * 100 END AS pnl_forecast,
               CASE WHEN ra > 0 THEN CAST(ca AS DOUBLE) / CAST(ra AS DOUBLE) * 100 END AS pnl_actual
        FROM (SELECT mk, division, sum(rate * (pd * 8)) AS rf, sum(rate * hours) AS ra FROM member GROUP BY 1, 2)
        FULL JOIN (SELECT mk, division, sum(forecast) AS cf, sum(actual) AS ca FROM ({_MEMBER_COST}) GROUP BY 1, 2)
             USING (mk, division)""",
    "m_rates_by_division": """
        SELECT mk AS date_key, division, n AS total_headcount, b AS billable_headcount, busy AS busy_headcount,
               pool AS available_headcount, train AS training_headcount, b / n * 100 AS billable_rate,
               busy / n * 100 AS busy_rate
        FROM (SELECT mk, division, count(DISTINCT sup) AS n, count(DISTINCT sup) FILTER (kind = 'billable') AS b,
                     count(DISTINCT sup) FILTER (kind IN ('billable', 'hr')) AS busy,
                     count(DISTINCT sup) FILTER (kind = 'pool') AS pool,
                     count(DISTINCT sup) FILTER (kind = 'training') AS train FROM classed GROUP BY mk, division)""",
    "m_dev_avg_salary": """
        SELECT mk AS date_key, division, CAST(sum(pay) * 0.01 AS DOUBLE) AS total_salary, count(*) AS total_headcount,
               CAST(sum(pay) * 0.01 AS DOUBLE) / CAST(count(*) AS DOUBLE) AS dev_avg_salary FROM head GROUP BY 1, 2""",
    "m_turnover": """
        WITH n AS (SELECT (mk // 10000) * 12 + (mk // 100) % 100 - 1 AS i, division, sup FROM head),
             total AS (SELECT i, division, count(*) AS c FROM n GROUP BY 1, 2),
             gone AS (SELECT i + 1 AS i, division, count(*) AS g FROM n a
                      WHERE NOT EXISTS (FROM n b WHERE b.i = a.i + 1 AND b.sup = a.sup AND b.division = a.division)
                      GROUP BY 1, 2),
             slot AS (SELECT i, division FROM total UNION
                      SELECT i + 1, division FROM total WHERE i < (SELECT max(i) FROM total))
        SELECT CAST((i // 12) * 10000 + (i % 12 + 1) * 100 + 1 AS INTEGER) AS date_key, division,
               coalesce(t.c, 0) AS headcount, coalesce(p.c, 0) AS headcount_before, coalesce(g, 0) AS departed,
               coalesce(g, 0) / ((coalesce(t.c, 0) + coalesce(p.c, 0)) / 2.0::DOUBLE) * 100 AS turnover_rate
        FROM slot LEFT JOIN total t USING (i, division) LEFT JOIN (SELECT i + 1 AS i, division, c FROM total) p USING (i, division)
        LEFT JOIN gone USING (i, division)""",
    "m_headcount_class": """
        SELECT mk AS date_key, division, count(*) FILTER (kind = 'Outsource') AS outsource_hc,
               count(*) FILTER (kind <> 'Outsource') AS internal_hc FROM head GROUP BY 1, 2""",
    "rpt_cost_summary_full": f"""
        WITH made AS (SELECT mk, division, sum(forecast) AS pf, sum(actual) AS pa FROM ({_MEMBER_COST}) GROUP BY 1, 2),
             spent AS (SELECT mk, division, coalesce(sum(rate * hours) FILTER (kind = 'hr'), 0) AS hr,
                              coalesce(sum(rate * hours) FILTER (kind = 'training'), 0) AS training,
                              coalesce(sum(rate * hours) FILTER (kind = 'presale'), 0) AS presale,
                              coalesce(sum(pay) FILTER (kind = 'pool'), 0) * 0.01 AS pool FROM classed GROUP BY 1, 2),
             rows AS (SELECT mk, division, coalesce(pf, 0) AS pf, coalesce(pa, 0) AS pa, coalesce(hr, 0) AS hr,
                             coalesce(training, 0) AS training, coalesce(presale, 0) AS presale, coalesce(pool, 0) AS pool
                      FROM made FULL JOIN spent USING (mk, division))
        SELECT mk AS date_key, CASE grouping(division) WHEN 1 THEN 'company' ELSE 'division' END AS level, division,
               CAST(sum(pf) AS DOUBLE) AS production_cost_forecast, CAST(sum(pa) AS DOUBLE) AS production_cost_actual,
               CAST(sum(hr) AS DOUBLE) AS hr_cost_actual, CAST(sum(training) AS DOUBLE) AS training_cost_actual,
               CAST(sum(presale) AS DOUBLE) AS presale_cost_actual, CAST(sum(pool) AS DOUBLE) AS resource_pool_cost_actual,
               CAST(sum(pa) + sum(hr) + sum(training) + sum(presale) + sum(pool) AS DOUBLE) AS total_cost_actual
        FROM rows GROUP BY GROUPING SETS ((mk, division), (mk))""",
    "rpt_hr_summary_full": """
        WITH w AS (SELECT mk, 'division' AS level, division, sup, kind FROM classed
                   UNION ALL SELECT mk, 'company', NULL, sup, kind FROM classed),
             at_work AS (
                 SELECT mk, level, division, count(DISTINCT sup) AS n,
                        count(DISTINCT sup) FILTER (kind = 'billable') AS b,
                        count(DISTINCT sup) FILTER (kind IN ('billable', 'hr')) AS busy,
                        count(DISTINCT sup) FILTER (kind = 'pool') AS pool,
                        count(DISTINCT sup) FILTER (kind = 'training') AS train FROM w GROUP BY ALL),
             h AS (SELECT (mk // 10000) * 12 + (mk // 100) % 100 - 1 AS i, * FROM (
                       SELECT mk, 'division' AS level, division, sup, pay, kind FROM head
                       UNION ALL SELECT mk, 'company', NULL, sup, any_value(pay), any_value(kind) FROM head GROUP BY mk, sup)),
             total AS (SELECT i, level, division, count(*) AS c, count(*) FILTER (kind = 'Outsource') AS outsource,
                              sum(pay) * 0.01 AS salary FROM h GROUP BY ALL),
             gone AS (SELECT i + 1 AS i, level, division, count(*) AS g FROM h a
                      WHERE NOT EXISTS (FROM h b WHERE b.i = a.i + 1 AND b.sup = a.sup AND b.level = a.level
                                        AND b.division IS NOT DISTINCT FROM a.division) GROUP BY ALL),
             slot AS (SELECT i, level, division FROM total UNION
                      SELECT i + 1, level, division FROM total WHERE i < (SELECT max(i) FROM total)),
             there AS (
                 SELECT CAST((s.i // 12) * 10000 + (s.i % 12 + 1) * 100 + 1 AS INTEGER) AS mk, s.level, s.division,
                        coalesce(t.c, 0) AS c, coalesce(t.outsource, 0) AS outsource, t.salary,
                        coalesce(g, 0) AS departed,
                        coalesce(g, 0) / ((coalesce(t.c, 0) + coalesce(p.c, 0)) / 2.0::DOUBLE) * 100 AS rate
                 FROM slot s
                 LEFT JOIN total t ON t.i = s.i AND t.level = s.level AND t.division IS NOT DISTINCT FROM s.division
                 LEFT JOIN total p ON p.i = s.i - 1 AND p.level = s.level AND p.division IS NOT DISTINCT FROM s.division
                 LEFT JOIN gone ON gone.i = s.i AND gone.level = s.level AND gone.division IS NOT DISTINCT FROM s.division)
        SELECT coalesce(w.mk, p.mk) AS date_key, coalesce(w.level, p.level) AS level, coalesce(w.division, p.division) AS division,
               coalesce(n, 0) AS total_hc, coalesce(b, 0) AS billable_hc, coalesce(busy, 0) AS busy_hc,
               coalesce(pool, 0) AS available_hc, coalesce(train, 0) AS training_hc,
               b / n * 100 AS billable_rate, busy / n * 100 AS busy_rate, coalesce(c, 0) AS headcount,
               coalesce(outsource, 0) AS outsource_hc, coalesce(c, 0) - coalesce(outsource, 0) AS internal_hc,
               coalesce(departed, 0) AS departed, rate AS turnover_rate, CAST(coalesce(salary, 0) AS DOUBLE) AS total_salary,
               CASE WHEN c > 0 THEN CAST(salary AS DOUBLE) / CAST(c AS DOUBLE) END AS dev_avg_salary
        FROM at_work w FULL JOIN there p
             ON w.mk = p.mk AND w.level = p.level AND w.division IS NOT DISTINCT FROM p.division""",
    "dim_project_division": """
        SELECT p_partkey AS project_key,
               coalesce(n_name, CASE WHEN p_type <> 'PROMO' THEN 'DIV-' || p_type END) AS division_name
        FROM part LEFT JOIN nation ON p_size = n_nationkey""",
}


def _with_views(sql: str) -> str:
    """A query with its own WITH keeps it, after the shared views."""
    text = sql.strip()
    if not text.startswith("WITH "):
        return with_views(sql)
    shared = with_views(text[5:])
    return shared.replace("\n" + text[5:], ",\n" + text[5:]) if shared != text[5:] else text


ORACLE = {name: _with_views(sql) for name, sql in ORACLE.items()}
