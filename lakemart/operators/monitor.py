"""Queries over the run log and the partition listing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.dates import elapsed_hours

# Fixed value: the job-name prefix of source loads in the run log.
SOURCE_LOAD = "src2brz"


def freshness(audit: DataFrame, thresholds: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Per (source, subject): time of the last successful source load and whether it is stale.

    ``thresholds`` is the short configured list and is the broadcast side; the log is reduced to one
    row per source first. Hours are rounded to one digit and then compared, strictly. Never loaded
    is stale.
    """
    last = (
        audit.where((F.col("status") == "success") & F.col("dag_id").startswith(SOURCE_LOAD))
        .groupBy(F.col("source").alias("source_name"), "data_subject")
        .agg(F.max("finished_at").alias("last_loaded_at"))
    )
    now = F.lit(as_of.isoformat(sep=" "))
    hours = elapsed_hours(F.col("last_loaded_at"), now)
    fresh = F.col("hours_since_load") <= F.col("max_stale_hours")
    return (
        thresholds.where(F.col("active") == 1)
        .join(last, ["source_name", "data_subject"], "left")
        .withColumn("hours_since_load", hours)
        .select(
            "source_name",
            "data_subject",
            F.when(fresh, "fresh").otherwise("stale").alias("status"),
            "max_stale_hours",
            "hours_since_load",
            "last_loaded_at",
        )
    )


def partition_day(name: Column) -> Column:
    """The date a day-file name stands for, null if it is not a plain ``dd-MM-yyyy``."""
    plain = F.when(name.rlike(r"^\d{2}-\d{2}-\d{4}$"), name)
    return F.to_date(F.try_to_timestamp(plain, F.lit("dd-MM-yyyy")))


def retention_plan(listing: DataFrame, limits: DataFrame, as_of: dt.date) -> DataFrame:
    """Partitions to keep and to drop per source.

    ``listing`` has source_name, data_subject, source_schema, table_name, load_date; a null load_date
    is a name that could not be read: counted as an error and kept. A day exactly at the cutoff stays.
    """
    cutoff = F.date_sub(F.lit(as_of), F.col("retention_days"))
    return (
        listing.join(limits.where(F.col("active") == 1), ["source_name", "data_subject", "source_schema"])
        .groupBy("source_name", "data_subject")
        .agg(
            F.count_if(F.col("load_date") < cutoff).alias("deleted"),
            F.count_if(F.col("load_date") >= cutoff).alias("kept"),
            F.count_if(F.col("load_date").isNull()).alias("errors"),
        )
    )


def within_retention(rows: DataFrame, loaded_on: str, as_of: dt.date, days: int) -> DataFrame:
    """Landing rows loaded on or after the cutoff day, and rows without a date."""
    cutoff = as_of - dt.timedelta(days=days)
    return rows.where(F.col(loaded_on).isNull() | (F.col(loaded_on) >= F.lit(cutoff)))


def row_count_history(audit: DataFrame) -> DataFrame:
    """Row count of each table load, newest first."""
    return (
        audit.where(F.col("row_count").isNotNull())
        .select("source", "data_subject", "table_name", "row_count", "status", "finished_at")
        .orderBy(F.col("finished_at").desc_nulls_last())
    )


def load_summary(results: DataFrame) -> DataFrame:
    """Tables and rows per load status."""
    mark = (
        F.when(F.col("status") == "loaded", "OK").when(F.col("status") == "failed", "FAIL").otherwise("SKIP")
    )
    return results.groupBy(mark.alias("result")).agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum("files").cast("long").alias("files"),
        F.sum("row_count").cast("long").alias("rows"),
    )
