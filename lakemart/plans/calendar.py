"""Working-day calendar and the month lists made from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.functions import date_key, iso_weekday, month_date, month_key

# First and last day of the standard calendar.
FIRST_DAY = dt.date(2020, 1, 1)
LAST_DAY = dt.date(2030, 12, 31)


def dim_date(
    spark: SparkSession,
    holidays: DataFrame | None = None,
    first: dt.date = FIRST_DAY,
    last: dt.date = LAST_DAY,
) -> DataFrame:
    """One row per day. ``holidays`` has a ``holiday_date``; nulls and repeats are allowed."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date_actual"))
    if holidays is None:
        marked = days.withColumn("is_holiday", F.lit(False))
    else:
        # distinct days inside the calendar: no more rows than the calendar has
        off = (
            holidays.select(F.to_date("holiday_date").alias("date_actual"))
            .where(F.col("date_actual").between(first, last))
            .distinct()
            .withColumn("_off", F.lit(True))
        )
        marked = days.join(F.broadcast(off), "date_actual", "left").withColumn(
            "is_holiday", F.coalesce("_off", F.lit(False))
        )
    weekday = iso_weekday("date_actual")
    month = Window.partitionBy("year", "month")
    return (
        marked.withColumn("year", F.year("date_actual"))
        .withColumn("quarter", F.quarter("date_actual"))
        .withColumn("month", F.month("date_actual"))
        .withColumn("day_of_week", weekday)
        .withColumn("is_weekend", weekday.isin(6, 7))
        .withColumn("is_working_day", ~F.col("is_weekend") & ~F.col("is_holiday"))
        .withColumn("total_working_days_in_month", F.count_if("is_working_day").over(month))
        .withColumn(
            "working_day_of_month",
            F.when(
                F.col("is_working_day"),
                F.row_number().over(
                    Window.partitionBy("year", "month", "is_working_day").orderBy("date_actual")
                ),
            ),
        )
        .select(
            date_key("date_actual").alias("date_key"),
            "date_actual",
            "year",
            "quarter",
            "month",
            F.date_format("date_actual", "MMMM").alias("month_name"),
            "day_of_week",
            F.date_format("date_actual", "EEEE").alias("day_name"),
            "is_weekend",
            "is_holiday",
            "is_working_day",
            "working_day_of_month",
            F.col("total_working_days_in_month").cast("int").alias("total_working_days_in_month"),
            F.trunc("date_actual", "month").alias("month_start_date"),
            F.last_day("date_actual").alias("month_end_date"),
            F.trunc("date_actual", "quarter").alias("quarter_start_date"),
            F.col("year").alias("fiscal_year"),
            F.col("quarter").alias("fiscal_quarter"),
        )
    )


def month_spine(calendar: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """One row per month that has a working day, up to the month of ``as_of``."""
    months = (
        calendar.where("is_working_day")
        .select("year", "month", "total_working_days_in_month")
        .distinct()
        .select(
            month_key().alias("date_key"),
            month_date().alias("month_date"),
            "year",
            "month",
            "total_working_days_in_month",
        )
    )
    return months if as_of is None else months.where(F.col("month_date") <= F.lit(as_of))


def month_starts(calendar: DataFrame) -> DataFrame:
    """The first day of every month, working day or not."""
    return calendar.where(F.col("date_actual") == F.col("month_start_date")).select("date_key", "year", "month")


def per_month(df: DataFrame, months: DataFrame) -> DataFrame:
    """Every row of ``df`` once per month.

    The month list is short by nature; it is folded into one array and exploded next to each row, so
    the grid needs neither a join nor a shuffle of ``df``.
    """
    listed = months.agg(F.sort_array(F.collect_list(F.struct(*months.columns)))).scalar()
    return df.withColumn("_month", F.explode(listed)).select(*df.columns, "_month.*")
