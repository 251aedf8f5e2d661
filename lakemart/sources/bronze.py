"""Dated Parquet partitions: one ``load_date`` per day, one ``run_seq`` per run of that day."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.keys import source_of
from lakemart.sources import folders
from lakemart.sources.folders import partition_values
from lakemart.sources.together import run_together

DAY = "load_date"
RUN = "run_seq"
# Loader bookkeeping tables; never counted as data.
BOOKKEEPING = "_"
# Markers of runs that were landed together, and of the groups that are complete.
GROUP, GROUPS = "_group-", "_groups"


def table_path(root: str, subject: str, source: str, schema: str, table: str) -> str:
    """Folder of one source table."""
    return f"{root.rstrip('/')}/{subject}/{source}/{schema}/{table}"


def write_days(df: DataFrame, path: str, partition: str = DAY) -> None:
    """Replace the days present in ``df``; other days stay.

    ``rebalance`` gathers a day into few files of even size and splits a day too large for one task.
    """
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def write_day(df: DataFrame, path: str, day: dt.date) -> int:
    """Replace one day, also by no rows; returns the number of rows written, counted by the write itself.

    The day is written beside the old one and takes its place when it is finished.
    """
    seen, spark = Observation(), df.sparkSession
    draft = f"{path.rstrip('/')}/_{day.isoformat()}-{uuid.uuid4().hex}"
    counted = df.drop(DAY).observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.parquet(draft)
    folders.swap(spark, draft, _day_folder(path, day))
    return seen.get["rows"]


def next_run(spark: SparkSession, path: str, day: dt.date) -> int:
    """Number of the next run of a day, starting at 0."""
    earlier = partition_values(spark, _day_folder(path, day), RUN)
    return 1 + max((int(v) for v in earlier), default=-1)


def write_run(
    df: DataFrame, path: str, day: dt.date, run: int | None = None, group: str | None = None
) -> tuple[int, int]:
    """Add a run to a day and keep the earlier ones; returns its number and its rows.

    A run counts when it is marked as done; a run of a group when the group is.
    """
    run = next_run(df.sparkSession, path, day) if run is None else run
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    folder = f"{_day_folder(path, day)}/{RUN}={run}"
    counted.write.mode("overwrite").parquet(folder)
    folders.touch(df.sparkSession, f"{folder}/{GROUP}{group}" if group else f"{folder}/{folders.DONE}")
    return run, seen.get["rows"]


def _day_folder(path: str, day: dt.date) -> str:
    return f"{path.rstrip('/')}/{DAY}={day.isoformat()}"


def land_group(
    tables: Mapping[str, DataFrame], root: str, day: dt.date, attempts: int = 3, pause: float = 5.0
) -> dict[str, int]:
    """Land the tables of one source as a run of a day, all of them or none; returns rows per table.

    All runs become visible at once, by one marker that is written last; if the driver is lost before, none is.
    The whole group is tried again after a failure. A failed attempt leaves no run behind, and earlier
    runs of the day stay as they were.
    """
    paths = {name: f"{root}/{name}" for name in tables}
    for attempt in range(1, attempts + 1):
        group = uuid.uuid4().hex
        runs = {name: next_run(df.sparkSession, paths[name], day) for name, df in tables.items()}
        work = {name: partial(write_run, df, paths[name], day, runs[name], group) for name, df in tables.items()}
        try:
            landed = {name: rows for name, (_, rows) in run_together(work).items()}
            for df in list(tables.values())[:1]:
                folders.touch(df.sparkSession, f"{root}/{GROUPS}/{group}")
            return landed
        except Exception:
            for name, df in tables.items():
                folders.drop(df.sparkSession, f"{_day_folder(paths[name], day)}/{RUN}={runs[name]}")
            if attempt == attempts:
                raise
            time.sleep(pause)
    return {}


def finished_runs(spark: SparkSession, path: str, day: dt.date) -> list[int]:
    """Runs of a day that count, oldest first."""
    groups = set(folders.names(spark, f"{path.rstrip('/').rpartition('/')[0]}/{GROUPS}"))
    done = []
    for run in sorted(int(v) for v in partition_values(spark, _day_folder(path, day), RUN)):
        for name in folders.names(spark, f"{_day_folder(path, day)}/{RUN}={run}"):
            if name == folders.DONE or name.startswith(GROUP) and name.removeprefix(GROUP) in groups:
                done.append(run)
    return done


def latest_snapshot(bronze: DataFrame) -> DataFrame:
    """Rows of the newest day, and of its newest run if runs are kept.

    The day is compared as a date, in a scalar subquery, so only that partition's files are read.
    """
    newest = bronze.where(F.col(DAY) == bronze.select(F.max(DAY)).scalar())
    if RUN not in bronze.columns:
        return newest
    return newest.where(F.col(RUN) == newest.select(F.max(RUN)).scalar())


def stored_days(spark: SparkSession, path: str) -> tuple[list[dt.date], int]:
    """Days a table has, from its folder names, and the number of names that are no date."""
    days, unreadable = [], 0
    for value in partition_values(spark, path, DAY):
        try:
            days.append(dt.date.fromisoformat(value))
        except ValueError:
            unreadable += 1
    return sorted(days), unreadable


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest day (and run) of a table by path, or None if there is none.

    Days compare as dates, never as text. Only the newest folder is listed and read, with its own schema.
    """
    for day in reversed(stored_days(spark, path)[0]):
        folder = _day_folder(path, day)
        if not partition_values(spark, folder, RUN):
            return spark.read.parquet(folder)
        if runs := finished_runs(spark, path, day):
            return spark.read.parquet(f"{folder}/{RUN}={runs[-1]}")
    return None


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All days of a table; columns added on later days are null on earlier ones."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything was written there."""
    return bool(folders.names(spark, path))


def drop_days(spark: SparkSession, path: str, days: Iterable[dt.date]) -> int:
    """Delete whole day partitions; returns how many were there. Touches folders, never rows."""
    return sum(folders.drop(spark, _day_folder(path, day)) for day in days)


def purge(
    spark: SparkSession, paths: Mapping[str, str], as_of: dt.date, retention_days: int
) -> dict[str, tuple[int, int, int]]:
    """Drop the days of each table strictly older than the cutoff; returns (dropped, kept, unreadable).

    A folder whose day cannot be read is kept.
    """
    cutoff = as_of - dt.timedelta(days=retention_days)

    def one(path: str) -> tuple[int, int, int]:
        days, unreadable = stored_days(spark, path)
        old = [day for day in days if day < cutoff]
        return drop_days(spark, path, old), len(days) - len(old), unreadable

    return {name: one(path) for name, path in paths.items()}


def write_counted(tables: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    """Write a group of tables and return their row counts, without a second scan.

    Bookkeeping tables are written but not counted.
    """

    def write(name: str) -> int:
        seen = Observation()
        counted = tables[name].observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(f"{root}/{name}")
        return seen.get["rows"]

    counts = run_together({name: partial(write, name) for name in tables})
    return {name: rows for name, rows in counts.items() if not name.startswith(BOOKKEEPING)}


def listing_from_paths(paths: DataFrame, path_column: str = "path") -> DataFrame:
    """Partition listing from folder paths ``subject/source/schema/table/load_date=…``.

    A last part that is not a date gives a null ``load_date``.
    """
    parts = F.split(path_column, "/")
    day = F.regexp_extract(F.element_at(parts, -1), rf"^{DAY}=(\d{{4}}-\d{{2}}-\d{{2}})$", 1)
    return paths.select(
        source_of(F.element_at(parts, -4)).alias("source_name"),
        F.element_at(parts, -5).alias("data_subject"),
        F.element_at(parts, -3).alias("source_schema"),
        F.element_at(parts, -2).alias("table_name"),
        F.to_date(F.try_to_timestamp(F.nullif(day, F.lit("")))).alias(DAY),
    )
