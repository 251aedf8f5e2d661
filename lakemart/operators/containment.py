"""Join a path such as ``1/5/9/`` to the units it runs through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.newest import newest_per_key


def join_path_contains(
    paths: DataFrame, units: DataFrame, path: str, unit: str, nearest: bool = False
) -> DataFrame:
    """Left join on "the path holds ``/unit/``", written as an equi join on the path's segments.

    A segment counts when a slash stands on both sides of it, so the first segment of ``1/5/9/``
    does not. A path through several units gives one row for each; ``nearest`` keeps the deepest.
    """
    parts = F.split(F.col(path), "/")
    inner = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))
    segments = (
        paths.select(path)
        .where(F.col(path).isNotNull())
        .distinct()
        .select(path, F.posexplode(F.array_distinct(inner)).alias("_depth", "_segment"))
    )
    pairs = segments.join(units, segments["_segment"] == units[unit].cast("string")).drop("_segment")
    if nearest:
        pairs = newest_per_key(pairs, [path], ["_depth"])
    return paths.join(pairs.drop("_depth"), path, "left")
