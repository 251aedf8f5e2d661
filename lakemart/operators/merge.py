"""Incremental merge into a keyed table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.newest import LOAD_ID, SOURCE, newest_per_key


def past_marks(
    landing: DataFrame, marks: Mapping[str, object], load_id: str = LOAD_ID, watermark: str = "per_source"
) -> DataFrame:
    """Rows loaded after the newest load id of their source, or of all sources for ``global``.

    A source without a mark passes whole. The marks, one per source system, become literals: in each
    source's branch of a union only its own comparison is left, and it is pushed into the scan.
    """
    if not marks:
        return landing

    def after(mark: object) -> Column:
        return F.col(load_id) > F.lit(mark).cast(landing.schema[load_id].dataType)

    if watermark == "global":
        return landing.where(after(max(marks.values())))
    past = ~F.col(SOURCE).isin(list(marks))
    for source, mark in marks.items():
        past = past | ((F.col(SOURCE) == source) & after(mark))
    return landing.where(past)


def rows_past_watermark(
    landing: DataFrame, target: DataFrame, load_id: str = LOAD_ID, watermark: str = "per_source"
) -> DataFrame:
    """Rows of ``landing`` loaded after everything in ``target``.

    ``per_source`` compares each source with its own newest batch, so a late batch of one source is
    not lost behind another's. ``global`` uses one mark for all. An empty target, or a source the
    target has never seen, lets every row through.
    """
    newest = target.groupBy(SOURCE).agg(F.max(load_id).alias("mark")).where("mark is not null")
    return past_marks(landing, {r[SOURCE]: r["mark"] for r in newest.collect()}, load_id, watermark)


def upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``delta`` replace rows of ``target`` with the same key; other rows stay.

    ``delta`` must hold one row per key. Columns only one side has are kept and null on the other, so
    a new source column is appended. Rows deleted in the source are never deleted here.
    """
    kept = target.join(delta.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(delta, allowMissingColumns=True)


def merge_incremental(
    target: DataFrame,
    landing: DataFrame,
    keys: Sequence[str],
    tie_breakers: Sequence[str | Column] = (),
    load_id: str = LOAD_ID,
    watermark: str = "per_source",
) -> DataFrame:
    """The next state of a keyed table: watermark filter, newest row per (key, source), which replaces the stored one.

    Landing and target go through one ranking in which what has landed comes first, so each is read and shuffled once.
    """
    fresh = rows_past_watermark(landing, target, load_id, watermark).withColumn("_fresh", F.lit(1))
    both = target.withColumn("_fresh", F.lit(0)).unionByName(fresh, allowMissingColumns=True)
    return newest_per_key(both, [*keys, SOURCE], ["_fresh", load_id, *tie_breakers]).drop("_fresh")


def insert_newer(fact: DataFrame, rows: DataFrame, created: str) -> DataFrame:
    """Append rows created after the newest row of the fact; nothing is updated.

    The newest time is a subquery of the plan: no job runs while the plan is made, and the comparison reaches the scan of
    ``rows`` with its value. An empty fact takes every row that has a time.
    """
    kind = fact.schema[created].dataType
    newest = fact.agg(F.coalesce(F.max(created), F.lit(_least(kind)).cast(kind)).alias("newest"))
    fresh = rows.where(F.col(created) > newest.scalar())
    return fact.unionByName(fresh, allowMissingColumns=True)


def _least(kind: T.DataType) -> object:
    """A value before all others of a type that orders rows in time."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "0001-01-01"
    if isinstance(kind, T.IntegralType):
        return {T.ByteType: -(1 << 7), T.ShortType: -(1 << 15), T.IntegerType: -(1 << 31)}.get(type(kind), -(1 << 63))
    if isinstance(kind, T.DecimalType):
        return "-" + "9" * (kind.precision - kind.scale) + "." + "9" * kind.scale
    if isinstance(kind, T.FractionalType):
        return float("-inf")
    if isinstance(kind, T.StringType):
        return ""
    raise TypeError(f"rows cannot be ordered in time by {kind.simpleString()}")
