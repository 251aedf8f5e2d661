"""Seed tables from CSV, and the cost categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COST_CATEGORY_SCHEMA = T.StructType(
    [
        T.StructField("cost_category_key", T.StringType(), False),
        T.StructField("cost_category", T.StringType()),
        T.StructField("cost_group", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

# Keys, labels and groups that reports show.
COST_CATEGORIES = [
    ("member_salary", "Member Salary", "Member Cost", "Salary for the days worked"),
    ("member_bonus", "Project Bonus", "Member Cost", "Bonus paid through a project"),
    ("member_overtime", "Overtime", "Member Cost", "Hours above the daily norm"),
    ("project_expense", "Project Expense", "Project Expense", "Packages bought for a project"),
    ("op_hr", "HR / Interviews", "Operational", "Interview and people work"),
    ("op_training", "Training / Resource Pool", "Operational", "Training and unassigned time"),
    ("op_presale", "Presale", "Operational", "Work before a contract"),
]


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV with a header and a known schema; nothing is inferred."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def write_seed(df: DataFrame, path: str) -> None:
    """One CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def cost_categories(spark: SparkSession) -> DataFrame:
    """The seven cost categories; small by definition, so joins may broadcast it."""
    return spark.createDataFrame(COST_CATEGORIES, COST_CATEGORY_SCHEMA).coalesce(1)
