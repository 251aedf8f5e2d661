"""Dashboard queries over the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import percent


def _latest_month(report: DataFrame, active: str) -> DataFrame:
    """The newest month in which ``active`` is positive; the report holds one row per month."""
    return report.where(F.col(active) > 0).orderBy(F.col("month_date").desc()).limit(1)


def card_revenue_kpi(pnl: DataFrame) -> DataFrame:
    return _latest_month(pnl, "total_revenue_actual").select(
        F.col("total_revenue_actual").alias("total_revenue"),
        F.col("total_revenue_forecast").alias("forecast"),
        F.col("gross_margin_pct").alias("margin"),
    )


def card_pnl_kpi(pnl: DataFrame) -> DataFrame:
    return _latest_month(pnl, "total_revenue_actual").select(
        F.col("gross_profit_actual").alias("gross_profit"),
        F.col("total_revenue_actual").alias("revenue"),
        F.col("total_cost_actual").alias("cost"),
    )


def card_busy_rate(rates: DataFrame) -> DataFrame:
    return _latest_month(rates, "total_headcount").select(
        percent("busy_rate").alias("busy_rate_pct"),
        F.col("busy_count").alias("busy"),
        F.col("total_headcount").alias("total_hc"),
    )


def card_billable_rate(rates: DataFrame) -> DataFrame:
    return _latest_month(rates, "total_headcount").select(
        percent("billable_rate").alias("billable_rate_pct"),
        F.col("billable_count").alias("billable"),
        F.col("total_headcount").alias("total_hc"),
    )


def card_revenue_by_month(pnl: DataFrame) -> DataFrame:
    return pnl.select(
        F.col("month_date").alias("month"),
        F.col("total_revenue_actual").alias("actual"),
        F.col("total_revenue_forecast").alias("forecast"),
    ).orderBy("month")


def card_pnl_by_month(pnl: DataFrame) -> DataFrame:
    return pnl.select(
        F.col("month_date").alias("month"),
        F.col("total_revenue_actual").alias("revenue"),
        F.col("total_cost_actual").alias("cost"),
        F.col("gross_profit_actual").alias("profit"),
    ).orderBy("month")


def card_revenue_pct(mix: DataFrame) -> DataFrame:
    by_type = mix.groupBy("revenue_type").agg(F.sum("revenue_actual").alias("revenue"))
    return by_type.orderBy(F.col("revenue").desc())


def card_cost_pct(mix: DataFrame) -> DataFrame:
    label = F.coalesce("cost_category", "cost_category_key").alias("cost_category")
    return mix.groupBy(label).agg(F.sum("cost_actual").alias("cost")).orderBy(F.col("cost").desc())
