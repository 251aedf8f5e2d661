"""Checks declared for the mart's tables, and for keyed tables."""

from __future__ import annotations

# Which columns must be filled, unique, known to a parent or from a list.
DECLARED = {
    "dim_date": {
        "not_null": ["date_key", "date_actual", "year", "month", "is_working_day", "total_working_days_in_month"],
        "unique": ["date_key", "date_actual"],
    },
    "dim_organization": {"not_null": ["org_key", "company_name", "_source"], "unique": ["org_key"]},
    "dim_project": {"not_null": ["project_key", "project_id", "project_name", "_source"], "unique": ["project_key"]},
    "dim_employee": {
        "not_null": ["employee_key", "employee_id", "employee_name", "_source"],
        "unique": ["employee_key"],
    },
    "fct_revenue_monthly": {
        "not_null": ["revenue_monthly_key", "date_key", "project_key", "revenue_type"],
        "unique": ["revenue_monthly_key"],
        "relationships": [("project_key", "dim_project", "project_key")],
        "accepted_values": [("revenue_type", ["fix_cost", "teambase"])],
    },
    "fct_cost_monthly": {
        "not_null": ["cost_monthly_key", "date_key", "employee_key", "cost_category_key"],
        "unique": ["cost_monthly_key"],
        "relationships": [("cost_category_key", "dim_cost_category", "cost_category_key")],
    },
    "fct_headcount_monthly": {
        "not_null": ["headcount_monthly_key", "date_key", "employee_key", "is_active", "is_billable", "headcount_value"],
        "unique": ["headcount_monthly_key"],
        "relationships": [("employee_key", "dim_employee", "employee_key")],
    },
    "rpt_monthly_pnl": {"not_null": ["date_key", "month_date"], "unique": ["month_date"]},
    "rpt_rate_metrics": {"not_null": ["date_key", "month_date"], "unique": ["month_date"]},
    "rpt_revenue_mix": {"not_null": ["revenue_type"]},
    "rpt_hr_summary": {"not_null": ["month_date"]},
    "rpt_revenue_by_project": {"not_null": ["month_date", "project_name"]},
    "rpt_cost_summary": {"not_null": ["month_date"]},
}

# A keyed table of several sources: the key is unique within its source.
KEYED = {"not_null": ["id", "_source"], "unique_together": ["id", "_source"]}
