"""Union of sources and newest row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SOURCE = "_source"
LOAD_ID = "_load_id"


def stamp(df: DataFrame, source: str, load_id: Column | None = None) -> DataFrame:
    """Add the source name and, if given, the load id of the batch."""
    out = df.withColumn(SOURCE, F.lit(source))
    return out if load_id is None else out.withColumn(LOAD_ID, load_id)


def union_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Union by column name, each row stamped with its source; a column one source lacks is null there."""
    stamped = [stamp(df, name) for name, df in sources.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), stamped)


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by ``order``; plain names mean newest first, nulls last.

    The rank is compared with 1, so Spark keeps one row per key and task *before* the shuffle: a key
    that holds a third of the table sends no more rows than there are map tasks.
    """
    by = [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def current_rows(
    sources: Mapping[str, DataFrame],
    keys: Sequence[str],
    tie_breakers: Sequence[str | Column] = (),
    load_id: str = LOAD_ID,
) -> DataFrame:
    """Newest row per (key, source) over several sources.

    ``tie_breakers`` order rows that share a load id; without them such a tie is settled arbitrarily.
    """
    return newest_per_key(union_sources(sources), [*keys, SOURCE], [load_id, *tie_breakers])
