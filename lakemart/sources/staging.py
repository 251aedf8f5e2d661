"""Newest snapshot of each table into staging, replacing what was there."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.sources.bronze import DAY, read_latest
from lakemart.sources.folders import partition_values
from lakemart.sources.tables import replace_table
from lakemart.sources.together import run_together

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("files", T.IntegerType(), False),
        T.StructField("message", T.StringType(), False),
        T.StructField("row_count", T.LongType(), False),
    ]
)


class NothingToStage(RuntimeError):
    """No table of the group has a snapshot."""


def stage_table(spark: SparkSession, bronze_path: str, target: str) -> int:
    """Replace one staging table by the newest snapshot; returns its rows. ``tables.read_table`` reads it.

    Readers keep the old table until the new one is finished.

    The snapshot's own schema is what gets written, so a column added or dropped at the source
    resets the staging table instead of failing on the old layout.
    """
    newest = read_latest(spark, bronze_path)
    if newest is None:
        raise FileNotFoundError("no snapshot")
    seen = Observation()
    snapshot = newest.observe(seen, F.count(F.lit(1)).alias("rows"))
    replace_table(snapshot, target)
    return seen.get["rows"]


def stage_group(spark: SparkSession, bronze_paths: Mapping[str, str], target_root: str) -> DataFrame:
    """Stage the tables of one group; one result row per table.

    A table without a snapshot is skipped and a failing table does not stop the others. If no table
    has a snapshot the group fails.
    """
    present = {name: bool(partition_values(spark, path, DAY)) for name, path in bronze_paths.items()}
    if bronze_paths and not any(present.values()):
        raise NothingToStage(f"no snapshot for any of {sorted(bronze_paths)}")

    def stage(name: str) -> tuple:
        if not present[name]:
            return (name, "skipped", 0, "no snapshot", 0)
        try:
            return (name, "loaded", 1, "", stage_table(spark, bronze_paths[name], f"{target_root}/{name}"))
        except Exception as error:  # noqa: BLE001 - the result row carries it
            return (name, "failed", 0, str(error).splitlines()[0], 0)

    results = list(run_together({name: partial(stage, name) for name in bronze_paths}).values())
    return spark.createDataFrame(results, RESULT_SCHEMA)
