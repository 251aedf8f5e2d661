"""Append-only run log, check results and freshness results."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.sources.bronze import table_exists

_text, _time = T.StringType(), T.TimestampType()

AUDIT_SCHEMA = T.StructType(
    [T.StructField(n, _text) for n in ("run_id", "dag_id", "task_id", "layer", "source", "data_subject", "table_name")]
    + [
        T.StructField("status", _text, False),
        T.StructField("row_count", T.LongType()),
        T.StructField("error_message", _text),
        T.StructField("started_at", _time),
        T.StructField("finished_at", _time),
    ]
)
TEST_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", _text),
        T.StructField("test_name", _text),
        T.StructField("status", _text),
        T.StructField("failures", T.LongType()),
        T.StructField("execution_time", T.DoubleType()),
        T.StructField("message", _text),
        T.StructField("created_at", _time),
    ]
)
FRESHNESS_SCHEMA = T.StructType(
    [
        T.StructField("source_name", _text),
        T.StructField("data_subject", _text),
        T.StructField("status", _text),
        T.StructField("max_stale_hours", T.IntegerType()),
        T.StructField("hours_since_load", T.DoubleType()),
        T.StructField("last_loaded_at", _time),
        T.StructField("checked_at", _time),
    ]
)


def append(rows: DataFrame, path: str, schema: T.StructType) -> None:
    """Append in the table's schema; the first append creates it, a missing column is null."""
    have = set(rows.columns)
    shaped = rows.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
    shaped.write.mode("append").parquet(path)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, empty if nothing was appended yet."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def store_results(results: DataFrame, path: str, run_id: str, created_at: dt.datetime | None = None) -> DataFrame:
    """Run the checks once, append their results and return those of the run as stored.

    The message counts what failed; the time is that of the whole run, divided evenly.
    """
    started = time.monotonic()
    rows = results.collect()  # one row per check
    spent = (time.monotonic() - started) / max(1, len(rows))
    spark, at = results.sparkSession, created_at or dt.datetime.now(dt.timezone.utc)
    values = [
        (run_id, r["test_name"], r["status"], r["failures"], spent, f"{r['failures']} failing" if r["failures"] else None, at)
        for r in rows
    ]
    append(spark.createDataFrame(values, TEST_RESULT_SCHEMA).coalesce(1), path, TEST_RESULT_SCHEMA)
    return read(spark, path, TEST_RESULT_SCHEMA).where(F.col("run_id") == run_id)


def audited(
    spark: SparkSession,
    log: str,
    work: Callable[[], int | None],
    now: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc),
    **labels: str,
) -> dict[str, Any]:
    """Run one load and append its log row, also when it fails.

    ``work`` returns its row count; zero stays zero. The error's first line is logged and the error is
    returned, so the caller decides whether to go on. A log that cannot be written does not stop a run.
    """
    started, rows, error = now(), None, None
    try:
        rows = work()
    except Exception as caught:  # noqa: BLE001 - logged and returned
        error = caught
    row = {
        **labels,
        "status": "failed" if error else "success",
        "row_count": rows,
        "error_message": str(error).splitlines()[0] if error and str(error) else None,
        "started_at": started,
        "finished_at": now(),
    }
    values = tuple(row.get(f.name) for f in AUDIT_SCHEMA.fields)
    try:
        append(spark.createDataFrame([values], AUDIT_SCHEMA).coalesce(1), log, AUDIT_SCHEMA)
    except Exception as caught:  # noqa: BLE001
        print(f"run log not written: {caught}")
    return {**row, "error": error}


def audited_all(
    spark: SparkSession, log: str, works: Sequence[tuple[dict[str, str], Callable[[], int | None]]]
) -> list[dict[str, Any]]:
    """Several loads, one log row each."""
    return [audited(spark, log, work, **labels) for labels, work in works]
