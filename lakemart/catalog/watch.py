"""Data-quality checks and monitoring queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakemart import operators as op
from lakemart import standins as si
from lakemart.catalog.ctes import with_views
from lakemart.catalog.mart import mart_inputs, stored
from lakemart.operators import monitor, quality
from lakemart.plans import calendar as cal
from lakemart.plans import mart
from lakemart.plans.checks import DECLARED, KEYED
from lakemart.session import new_table_path
from lakemart.sources import meta, seed

CLOCK = dt.datetime(2024, 1, 31)
SHOP_CLOCK = dt.date(2001, 8, 1)


def dq_not_null(spark, sf_dir):
    """The columns declared for employees, plus one that is known to hold nulls."""
    columns = [*DECLARED["dim_employee"]["not_null"], "base_salary"]
    lines = quality.not_null(si.table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_partkey", "l_shipdate"])
    return quality.suite([quality.not_null(si.dim_employee(spark, sf_dir), "dim_employee", columns), lines])


def dq_unique(spark, sf_dir):
    return quality.suite(
        [
            quality.unique(si.table(spark, sf_dir, "orders"), "orders", ["o_orderkey"]),
            quality.unique(si.table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey"]),
            quality.unique(si.dim_employee(spark, sf_dir), "dim_employee", ["employee_key"]),
        ]
    )


def dq_unique_composite(spark, sf_dir):
    lines = si.table(spark, sf_dir, "lineitem")
    return quality.unique(lines, "lineitem", ["l_orderkey", "l_linenumber"])


def dq_relationships(spark, sf_dir):
    """All parts known, then only the larger ones."""
    lines, part = si.table(spark, sf_dir, "lineitem"), si.table(spark, sf_dir, "part")
    large = part.where(F.col("p_size") > 10)
    return quality.suite(
        [
            quality.relationships(lines, "lineitem", "l_partkey", part, "p_partkey"),
            quality.relationships(lines, "large_parts", "l_partkey", large, "p_partkey"),
        ]
    )


def dq_orphan_rows(spark, sf_dir):
    lines = si.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    large = si.table(spark, sf_dir, "part").where(F.col("p_size") > 10)
    return quality.orphan_rows(lines, "l_partkey", large, "p_partkey")


def dq_accepted_values(spark, sf_dir):
    lines = si.table(spark, sf_dir, "lineitem")
    return quality.suite(
        [
            quality.accepted_values(lines, "lineitem", "l_returnflag", ["A", "N", "R"]),
            quality.accepted_values(lines, "strict", "l_returnflag", ["A"]),
        ]
    )


def mart_tables(spark, sf_dir):
    """The whole mart built and stored; the rows of each of its tables."""
    tables = mart.build_mart(spark, mart_inputs(spark, sf_dir), new_table_path(spark, "mart"), si.AS_OF)
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(n)) for n, df in tables.items()]
    return quality.suite(counts)


def dq_declared_suite(spark, sf_dir):
    """Every declared check: dimensions, facts and reports as stored, and a keyed table of several sources."""
    tables = stored(spark, sf_dir)
    keyed = {"silver_event": op.current_rows(si.event_sources(spark, sf_dir), ["id"], ["event_id"])}
    results = mart.check_mart(tables).unionByName(quality.run_declared(keyed, {"silver_event": KEYED}))
    kept = meta.store_results(results, new_table_path(spark, "results"), "1")
    return kept.select("test_name", "status", "failures")


def dq_results_stored(spark, sf_dir):
    """Results of two runs in one table, read back."""
    path = new_table_path(spark, "results")
    meta.store_results(dq_unique(spark, sf_dir), path, "1")
    meta.store_results(dq_accepted_values(spark, sf_dir), path, "2")
    stored = meta.read(spark, path, meta.TEST_RESULT_SCHEMA)
    return stored.select("run_id", "test_name", "status", "failures", "message")


def dq_out_of_calendar(spark, sf_dir):
    """Rows dated outside the calendar, which facts leave out."""
    lines = si.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    early = lines.select(F.add_months("day", -300).alias("day"))
    calendar = si.calendar(spark, sf_dir)
    return quality.suite(
        [
            quality.relationships(lines, "lineitem", "day", calendar, "date_actual"),
            quality.relationships(early, "early", "day", calendar, "date_actual"),
        ]
    )


def _mixed_results(spark, sf_dir):
    return quality.suite([f(spark, sf_dir) for f in (dq_not_null, dq_unique, dq_relationships, dq_accepted_values)])


def dq_summary(spark, sf_dir):
    return quality.summary(_mixed_results(spark, sf_dir))


def dq_daily_trend(spark, sf_dir):
    """Events as check results of their day."""
    status = F.when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "signup", "warn").otherwise("pass")
    results = si.table(spark, sf_dir, "events").select(status.alias("status"), F.col("ts").alias("created_at"))
    return quality.daily_trend(results)


THRESHOLDS = [("0", "web", 24, 1), ("1", "web", 2, 1), ("2", "web", 48, 1), ("3", "web", 1, 0), ("never", "web", 24, 1)]


def freshness_check(spark, sf_dir):
    thresholds = spark.createDataFrame(
        THRESHOLDS, "source_name string, data_subject string, max_stale_hours int, active int"
    )
    return monitor.freshness(si.audit(spark, sf_dir), thresholds.coalesce(1), CLOCK)


def audit_row_counts(spark, sf_dir):
    return monitor.row_count_history(si.audit(spark, sf_dir))


LIMITS = [("F", "sales", "public", 365, 1), ("O", "sales", "public", 730, 1), ("P", "sales", "public", 30, 0)]


def retention_plan(spark, sf_dir):
    """Order days as day files of three sources; re-run files of the first of a month have an unreadable name."""
    orders = si.table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "dd-MM-yyyy")
    rerun = (F.col("o_orderpriority") == "5-LOW") & (F.dayofmonth("o_orderdate") == 1)
    listing = orders.select(
        F.col("o_orderstatus").alias("source_name"),
        F.lit("sales").alias("data_subject"),
        F.lit("public").alias("source_schema"),
        F.col("o_orderpriority").alias("table_name"),
        F.when(rerun, F.concat(day, F.lit("(1)"))).otherwise(day).alias("_name"),
    ).distinct()
    limits = spark.createDataFrame(
        LIMITS, "source_name string, data_subject string, source_schema string, retention_days int, active int"
    )
    named = listing.withColumn("load_date", monitor.partition_day(F.col("_name")))
    return monitor.retention_plan(named, limits.coalesce(1), SHOP_CLOCK)


def active_months(spark, sf_dir):
    """Months of the calendar that have shipments, and those that have none."""
    months = cal.month_spine(si.calendar(spark, sf_dir))
    shipped = (
        si.table(spark, sf_dir, "lineitem")
        .groupBy(cal.month_date(F.year("l_shipdate"), F.month("l_shipdate")).alias("month_date"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    return months.select("month_date").join(shipped, "month_date", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))


QUERIES = {
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_unique_composite": dq_unique_composite,
    "dq_relationships": dq_relationships,
    "dq_orphan_rows": dq_orphan_rows,
    "dq_accepted_values": dq_accepted_values,
    "dq_declared_suite": dq_declared_suite,
    "dq_results_stored": dq_results_stored,
    "dq_out_of_calendar": dq_out_of_calendar,
    "mart_tables": mart_tables,
    "dq_summary": dq_summary,
    "dq_daily_trend": dq_daily_trend,
    "freshness_check": freshness_check,
    "audit_row_counts": audit_row_counts,
    "retention_plan": retention_plan,
    "month_activity": active_months,
}


def _row(name: str, failures: str, severity: str = "fail") -> str:
    return f"""SELECT '{name}' AS test_name, CASE WHEN ({failures}) = 0 THEN 'pass' ELSE '{severity}' END AS status,
       CAST(({failures}) AS BIGINT) AS failures"""


def _nulls(table: str, column: str, source: str | None = None, expr: str | None = None) -> str:
    return _row(f"not_null_{table}_{column}", f"SELECT count(*) FILTER ({expr or column} IS NULL) FROM {source or table}")


def _repeats(table: str, *columns: str, source: str | None = None, expr: str | None = None) -> str:
    cols = expr or ", ".join(columns)
    return _row(
        f"unique_{table}_{'_'.join(columns)}",
        f"SELECT count(*) FROM (SELECT {cols} FROM {source or table} GROUP BY {cols} HAVING count(*) > 1)",
    )


def _orphans(label: str, where: str) -> str:
    return _row(
        f"relationships_{label}_l_partkey",
        f"SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part{where})",
    )


def _others(label: str, values: str) -> str:
    return _row(
        f"accepted_values_{label}_l_returnflag",
        f"SELECT count(DISTINCT l_returnflag) FROM lineitem WHERE l_returnflag NOT IN ({values})",
        "warn",
    )


_ALL = " UNION ALL "
_NOT_NULL = _ALL.join(
    [_nulls("dim_employee", c, "employee") for c in ("employee_key", "employee_id", "employee_name", "_source")]
    + [_nulls("dim_employee", "base_salary", "employee", "pay")]
    + [_nulls("lineitem", c) for c in ("l_orderkey", "l_partkey", "l_shipdate")]
)
_UNIQUE = _ALL.join(
    [
        _repeats("orders", "o_orderkey"),
        _repeats("lineitem", "l_orderkey"),
        _repeats("dim_employee", "employee_key", source="employee"),
    ]
)
_RELATIONSHIPS = _ALL.join([_orphans("lineitem", ""), _orphans("large_parts", " WHERE p_size > 10")])
_ACCEPTED = _ALL.join([_others("lineitem", "'A', 'N', 'R'"), _others("strict", "'A'")])

# table -> (view, {column: expression where the view names it differently})
_VIEWS = {
    "dim_date": ("cal", {"date_actual": "d", "year": "y", "month": "m", "is_working_day": "working",
                         "total_working_days_in_month": "mk"}),
    "dim_organization": ("organization", {}),
    "dim_project": ("project", {}),
    "dim_employee": ("employee", {}),
    "fct_revenue_monthly": ("revenue", {}),
    "fct_cost_monthly": ("cost", {}),
    "fct_headcount_monthly": (
        "headcount",
        {"headcount_monthly_key": "(date_key, employee_key)", "is_active": "sup", "is_billable": "billable",
         "headcount_value": "value"},
    ),
}


_GRID = "SELECT (SELECT count(*) FROM shown) * (SELECT count(*) FROM organization)"
_COUNTS = {
    "dim_cost_category": "SELECT count(*) FROM category",
    **{table: f"SELECT count(*) FROM {view}" for table, (view, _) in _VIEWS.items()},
    "rpt_monthly_pnl": "SELECT count(*) FROM shown",
    "rpt_rate_metrics": "SELECT count(*) FROM shown",
    "rpt_revenue_mix": "SELECT count(*) FROM (SELECT DISTINCT date_key, revenue_type FROM revenue)",
    "rpt_cost_mix": "SELECT count(*) FROM (SELECT DISTINCT date_key, cost_category_key FROM cost)",
    "rpt_cost_summary": _GRID,
    "rpt_hr_summary": _GRID,
    "rpt_revenue_by_project": "SELECT count(*) FROM revenue r JOIN months ON date_key = mk",
}


def _declared_sql() -> str:
    parts = []
    for table, (view, names) in _VIEWS.items():
        checks = DECLARED[table]
        parts += [_nulls(table, c, view, names.get(c)) for c in checks.get("not_null", ())]
        parts += [_repeats(table, c, source=view, expr=names.get(c)) for c in checks.get("unique", ())]
        for column, parent, parent_column in checks.get("relationships", ()):
            source = {"dim_project": "project", "dim_employee": "employee", "dim_cost_category": "category"}[parent]
            parts.append(
                _row(
                    f"relationships_{table}_{column}",
                    f"SELECT count(*) FROM {view} c ANTI JOIN {source} p ON c.{column} = p.{parent_column}",
                )
            )
        for column, values in checks.get("accepted_values", ()):
            listed = ", ".join(f"'{v}'" for v in values)
            parts.append(
                _row(
                    f"accepted_values_{table}_{column}",
                    f"SELECT count(DISTINCT {column}) FROM {view} WHERE {column} NOT IN ({listed})",
                    "warn",
                )
            )
    return _ALL.join(parts)


def _report_sql() -> str:
    """The declared checks of the reports, on the views they are made of."""
    parts = []
    for table in ("rpt_monthly_pnl", "rpt_rate_metrics"):
        parts += [_nulls(table, "date_key", "shown", "mk"), _nulls(table, "month_date", "shown")]
        parts.append(_repeats(table, "month_date", source="shown"))
    parts.append(_nulls("rpt_revenue_mix", "revenue_type", "revenue"))
    parts += [_nulls(table, "month_date", "shown") for table in ("rpt_hr_summary", "rpt_cost_summary")]
    by_project = "(SELECT month_date, project_name FROM revenue r JOIN months ON date_key = mk LEFT JOIN project p USING (project_key))"
    parts += [_nulls("rpt_revenue_by_project", c, by_project) for c in ("month_date", "project_name")]
    newest = "(SELECT DISTINCT user_id AS id, event_type AS _source FROM events)"
    parts += [_nulls("silver_event", c, newest) for c in ("id", "_source")]
    return _ALL.join([*parts, _repeats("silver_event", "id", "_source", source=newest)])


def _run_of(run: str, results: str) -> str:
    return f"""
        SELECT '{run}' AS run_id, *, CASE WHEN failures > 0 THEN failures || ' failing' END AS message FROM ({results})"""


_OUTSIDE = "SELECT count(*) FROM (SELECT CAST(l_shipdate AS DATE) {shift} AS d FROM lineitem) ANTI JOIN cal USING (d)"

ORACLE = {
    "dq_not_null": _NOT_NULL,
    "dq_unique": _UNIQUE,
    "dq_unique_composite": _repeats("lineitem", "l_orderkey", "l_linenumber"),
    "dq_relationships": _RELATIONSHIPS,
    "dq_orphan_rows": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""",
    "dq_accepted_values": _ACCEPTED,
    "dq_declared_suite": _ALL.join([_declared_sql(), _report_sql()]),
    "dq_results_stored": _ALL.join([_run_of("1", _UNIQUE), _run_of("2", _ACCEPTED)]),
    "dq_out_of_calendar": _ALL.join(
        [
            _row("relationships_lineitem_day", _OUTSIDE.format(shift="")),
            _row("relationships_early_day", _OUTSIDE.format(shift="- INTERVAL 300 MONTH")),
        ]
    ),
    "mart_tables": _ALL.join(f"SELECT '{table}' AS table_name, ({count}) AS rows" for table, count in _COUNTS.items()),
    "dq_summary": f"""
        SELECT count(*) FILTER (status = 'pass') AS passed, count(*) FILTER (status = 'fail') AS failed,
               count(*) FILTER (status = 'warn') AS warned, count(*) AS total
        FROM ({_ALL.join([_NOT_NULL, _UNIQUE, _RELATIONSHIPS, _ACCEPTED])})""",
    "dq_daily_trend": """
        SELECT CAST(ts AS DATE) AS run_date, count(*) FILTER (event_type NOT IN ('error', 'signup')) AS passed,
               count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1 ORDER BY 1 DESC""",
    "freshness_check": """
        SELECT s AS source_name, 'web' AS data_subject,
               CASE WHEN hours <= h THEN 'fresh' ELSE 'stale' END AS status, h AS max_stale_hours,
               hours AS hours_since_load, done_at AS last_loaded_at
        FROM (VALUES ('0', 24), ('1', 2), ('2', 48), ('never', 24)) t(s, h)
        LEFT JOIN (SELECT source, max(finished_at) AS done_at, round(epoch(TIMESTAMP '2024-01-31' - max(finished_at)) / 3600, 1) AS hours
                   FROM run WHERE status = 'success' AND dag_id LIKE 'src2brz%' GROUP BY source) ON s = source""",
    "audit_row_counts": """
        SELECT source, data_subject, table_name, row_count, status, finished_at FROM run
        WHERE row_count IS NOT NULL ORDER BY finished_at DESC""",
    "retention_plan": """
        SELECT o_orderstatus AS source_name, 'sales' AS data_subject,
               count(*) FILTER (NOT odd AND d < DATE '2001-08-01' - n) AS deleted,
               count(*) FILTER (NOT odd AND d >= DATE '2001-08-01' - n) AS kept, count(*) FILTER (odd) AS errors
        FROM (SELECT DISTINCT o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS d,
                     o_orderpriority = '5-LOW' AND day(o_orderdate) = 1 AS odd,
                     CASE o_orderstatus WHEN 'F' THEN 365 ELSE 730 END AS n
              FROM orders WHERE o_orderstatus IN ('F', 'O'))
        GROUP BY o_orderstatus""",
    "month_activity": """
        SELECT month_date, count(l_orderkey) AS lines
        FROM months LEFT JOIN lineitem ON date_trunc('month', l_shipdate) = month_date GROUP BY 1""",
}
ORACLE = {name: with_views(sql) for name, sql in ORACLE.items()}
