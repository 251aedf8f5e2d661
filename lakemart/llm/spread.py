"""Joins of many rows with one row per key, where a few keys may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000  # a key is hot from this part of all rows on, so there are at most as many


def spread_join(rows: DataFrame, keyed: DataFrame, on: Sequence[str], weight: str) -> DataFrame:
    """``rows`` with the columns of ``keyed``, which has every key once and in ``weight`` its number of rows.

    At most ``HOT_KEYS`` keys can have a ``HOT_KEYS``-th of all rows each. They are broadcast, so their rows stay where
    they are; rows of all other keys are shuffled. Keys must not be null. Both sides should be stored tables.
    """
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT_KEYS >= F.lit(total)
    few = F.broadcast(keyed.where(hot))
    near = rows.join(few, list(on))
    far = rows.join(few.select(*on), list(on), "left_anti").join(keyed.where(~hot), list(on))
    return near.unionByName(far)
