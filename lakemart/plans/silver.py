"""Keyed tables of the second layer, declared by name, key and sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from lakemart.operators import union_sources
from lakemart.sources.bucketed import BucketedTable
from lakemart.sources.together import run_together


@dataclass(frozen=True)
class SilverModel:
    """A staging table of one or more sources, kept as one row per (key, source)."""

    name: str
    table: str
    sources: Sequence[str]
    key: str = "id"
    tie_breakers: Sequence[str] = ()


def refresh_silver(
    spark: SparkSession,
    models: Sequence[SilverModel],
    staging: Mapping[tuple[str, str], DataFrame],
    root: str,
    buckets: int = 16,
) -> dict[str, DataFrame]:
    """Merge what is staged into every model's table; returns the tables.

    ``staging`` maps (source, table) to its rows, which carry ``_load_id``. Models do not depend on
    each other.
    """

    def refresh(model: SilverModel) -> DataFrame:
        table = BucketedTable(spark, f"{root}/{model.name}", [model.key], model.tie_breakers, buckets=buckets)
        table.refresh(union_sources({s: staging[s, model.table] for s in model.sources}))
        return table.read()

    return run_together({model.name: partial(refresh, model) for model in models})
