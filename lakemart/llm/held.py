"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns``, computed once however often they are used.

    The optimizer replaces the name of a projected column by its expression, even within a function that runs per
    array element; what a generator has put out stays.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))
