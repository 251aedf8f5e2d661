"""Tables of a relational source through JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How to cut one table into parallel reads.

    ``column`` with bounds gives equal-width ranges. Where values bunch up, ``predicates`` (one WHERE
    clause per task, together covering every row once) cut by count instead.
    """

    column: str | None = None
    lower: str | int | None = None
    upper: str | int | None = None
    partitions: int = 1
    predicates: Sequence[str] = ()


@dataclass(frozen=True)
class Connection:
    url: str
    driver: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        out = {**self.properties, "fetchsize": str(self.fetch_size)}
        if self.driver:
            out["driver"] = self.driver
        return out


def read_table(
    spark: SparkSession, connection: Connection, schema: str, table: str, split: Split | None = None
) -> DataFrame:
    """One table as a lazy DataFrame; filters and columns are pushed to the database."""
    name = f"{schema}.{table}" if schema else table
    split = split or Split()
    if split.predicates:
        return spark.read.jdbc(
            connection.url, name, predicates=list(split.predicates), properties=connection.options()
        )
    if split.column:
        return spark.read.jdbc(
            connection.url,
            name,
            column=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=split.partitions,
            properties=connection.options(),
        )
    return spark.read.jdbc(connection.url, name, properties=connection.options())


def read_group(
    spark: SparkSession,
    connection: Connection,
    schema: str,
    tables: Sequence[str],
    splits: Mapping[str, Split] | None = None,
) -> dict[str, DataFrame]:
    """The tables of one source schema by name."""
    splits = splits or {}
    return {t: read_table(spark, connection, schema, t, splits.get(t)) for t in tables}
