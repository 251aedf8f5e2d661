"""Data-quality checks as Spark jobs; each check is one result row.

A check never stops a run. ``failures`` counts rows for ``not_null`` and ``relationships`` and
distinct values for ``unique`` and ``accepted_values``; nulls only fail ``not_null``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _result(test_name: Column, failures: Column, severity: str) -> list[Column]:
    failures = F.coalesce(failures.cast("long"), F.lit(0).cast("long"))
    return [
        test_name.alias("test_name"),
        F.when(failures == 0, "pass").otherwise(severity).alias("status"),
        failures.alias("failures"),
    ]


def not_null(df: DataFrame, table: str, columns: Sequence[str], severity: str = "fail") -> DataFrame:
    """All not-null checks of a table in one scan and one aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    name = F.concat(F.lit(f"not_null_{table}_"), F.col("column"))
    return counts.unpivot([], list(columns), "column", "failures").select(
        *_result(name, F.col("failures"), severity)
    )


# Keys of at most so many bytes are counted as they are; two numbers of 64 bits.
NARROW = 16


def unique(
    df: DataFrame,
    table: str,
    columns: Sequence[str],
    name: str | None = None,
    severity: str = "fail",
    fingerprint: Callable[..., Column] = F.xxhash64,
) -> DataFrame:
    """Number of values (or value combinations) that occur more than once; a null part exempts a row.

    Of wide keys, such as text, only a fingerprint of 64 bits is shuffled and counted. Keys whose fingerprint
    occurs more than once, the repeated ones and the few that share one by chance, are then counted themselves.
    """
    present = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    count = F.count(F.lit(1)).alias("_n")
    if not _narrow([df.schema[c].dataType for c in columns]):
        marked = present.select(*columns, fingerprint(*columns).alias("_mark"))
        again = marked.groupBy("_mark").agg(count).where("_n > 1").select("_mark")
        present = marked.join(again, "_mark", "left_semi")
    repeated = present.groupBy(*columns).agg(count).where("_n > 1")
    label = name or f"unique_{table}_{'_'.join(columns)}"
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        *_result(F.lit(label), F.col("failures"), severity)
    )


def _narrow(kinds: Sequence[T.DataType]) -> bool:
    fixed = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4}
    eight = (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)
    sizes = [8 if isinstance(k, eight) else fixed.get(type(k), NARROW + 1) for k in kinds]
    return sum(sizes) <= NARROW


def relationships(
    child: DataFrame,
    table: str,
    column: str,
    parent: DataFrame,
    parent_column: str,
    severity: str = "fail",
) -> DataFrame:
    """Child rows whose key the parent lacks.

    The child is counted per key before the join, so a hot key is one row in the shuffle.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.select(F.col(parent_column).alias("_known"))
    orphans = keys.join(known, keys[column] == known["_known"], "left_anti")
    return orphans.agg(F.sum("_n").alias("failures")).select(
        *_result(F.lit(f"relationships_{table}_{column}"), F.col("failures"), severity)
    )


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The child rows themselves whose key the parent lacks."""
    known = parent.select(F.col(parent_column).alias("_known"))
    return child.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_known"), "left_anti")


def accepted_values(
    df: DataFrame, table: str, column: str, values: Sequence[str], severity: str = "warn"
) -> DataFrame:
    """Number of distinct values outside the list."""
    other = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).select(column).distinct()
    return other.agg(F.count(F.lit(1)).alias("failures")).select(
        *_result(F.lit(f"accepted_values_{table}_{column}"), F.col("failures"), severity)
    )


def suite(results: Sequence[DataFrame]) -> DataFrame:
    """Results of several checks as one DataFrame."""
    return reduce(DataFrame.unionByName, results)


def run_declared(tables: Mapping[str, DataFrame], declared: Mapping[str, Mapping]) -> DataFrame:
    """Run the checks declared for each table.

    ``declared[table]`` may hold ``not_null``: columns, ``unique``: columns, ``unique_together``: columns that
    are unique as a whole, ``relationships``: (column, parent table, parent column) and ``accepted_values``:
    (column, values).
    """
    results = []
    for table, checks in declared.items():
        df = tables[table]
        if checks.get("not_null"):
            results.append(not_null(df, table, checks["not_null"]))
        results += [unique(df, table, [c]) for c in checks.get("unique", ())]
        if checks.get("unique_together"):
            results.append(unique(df, table, checks["unique_together"]))
        results += [
            relationships(df, table, column, tables[parent], parent_column)
            for column, parent, parent_column in checks.get("relationships", ())
        ]
        results += [accepted_values(df, table, c, values) for c, values in checks.get("accepted_values", ())]
    return suite(results)


def summary(results: DataFrame) -> DataFrame:
    """Pass, fail and warn counts; an ``error`` counts as a failure."""
    status = F.col("status")
    return results.agg(
        F.count_if(status == "pass").alias("passed"),
        F.count_if(status.isin("fail", "error")).alias("failed"),
        F.count_if(status == "warn").alias("warned"),
        F.count(F.lit(1)).alias("total"),
    )


def daily_trend(results: DataFrame, created_at: str = "created_at") -> DataFrame:
    """Passed and failed checks per day, newest day first."""
    status = F.col("status")
    return (
        results.groupBy(F.to_date(created_at).alias("run_date"))
        .agg(F.count_if(status == "pass").alias("passed"), F.count_if(status == "fail").alias("failed"))
        .orderBy(F.col("run_date").desc())
    )
