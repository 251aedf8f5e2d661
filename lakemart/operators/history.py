"""Version history of a changing table (validity intervals per key)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.session import new_table_path

# Key and slice as one column: it is never null, so windows, sums and plain equi joins share one partitioning.
PLACE = "_place"
HOT = "_hot"
# positions that are looked at per slice, and how many cuts one step of the search passes over
PER_SLICE, STRIDE = 32, 64


def _cuts(rows: DataFrame, keys: Sequence[str], position: Column, slices: int) -> DataFrame:
    """For keys with more than about two of ``slices`` equal parts of all rows, the positions where they are cut.

    A fixed part of all (key, position) pairs, chosen by their hash, stands for the rows; its expected size is at most
    ``2 * slices * PER_SLICE`` whatever the size of the table, and there are ``PER_SLICE`` times fewer cuts.
    """
    key = F.struct(*keys)
    share = F.greatest(rows.agg((F.count("*") / (slices * PER_SLICE)).cast("long")).scalar(), F.lit(1))
    looked_at = rows.select(key.alias("_cut_key"), position.alias("_at")).distinct()
    looked_at = looked_at.where(F.pmod(F.xxhash64("_cut_key", "_at"), share) == 0)
    places = looked_at.groupBy("_cut_key").agg(F.sort_array(F.collect_list("_at")).alias("_at"))
    places = places.where(F.size("_at") >= 2 * PER_SLICE)
    last = F.size("_at") - 1
    cuts = F.transform(F.sequence(F.lit(PER_SLICE), last, F.lit(PER_SLICE)), lambda n: F.get("_at", n))
    # in blocks, so that finding a row's slice takes few comparisons
    blocks = F.transform(
        F.sequence(F.lit(0), F.size("_cuts") - 1, F.lit(STRIDE)), lambda n: F.slice(F.col("_cuts"), n + 1, F.lit(STRIDE))
    )
    return places.select("_cut_key", cuts.alias("_cuts")).select("_cut_key", blocks.alias("_blocks"))


def _slice(position: Column) -> Column:
    """How many of a key's cuts lie at or before ``position``; 0 for keys that are not cut."""
    passed = F.size(F.filter("_blocks", lambda block: F.get(block, F.lit(0)) <= position))
    block = F.get("_blocks", F.greatest(passed, F.lit(1)) - 1)
    within = F.size(F.filter(block, lambda cut: cut <= position))
    return F.when(F.col("_blocks").isNull(), 0).otherwise((F.greatest(passed, F.lit(1)) - 1) * STRIDE + within)


def cut_hot_keys(rows: DataFrame, keys: Sequence[str], position: Sequence[str], slices: int) -> tuple[DataFrame, bool]:
    """``rows`` with their place (key and slice), and whether any key is cut into slices.

    Slices of a key follow each other in the order of ``position``; a slice holds about one ``slices``-th of all rows.
    All other keys have one slice. Only rows of the same position are never separated. The cuts are found by one job
    over keys and positions and stored, so that every part of a plan, and a task that is run again, sees the same.
    """
    at = F.struct(*position)
    path = new_table_path(rows.sparkSession, "cuts")
    _cuts(rows, keys, at, slices).coalesce(1).write.parquet(path)
    cuts = rows.sparkSession.read.parquet(path)
    rows = rows.withColumn("_key", F.struct(*keys))
    if cuts.isEmpty():
        place = F.struct(F.col("_key").alias("key"), F.lit(0).alias("slice"))
        return rows.withColumns({PLACE: place, HOT: F.lit(False)}).drop("_key"), False
    cut = rows.join(F.broadcast(cuts), F.col("_key") == F.col("_cut_key"), "left")
    place = F.struct(F.col("_key").alias("key"), _slice(at).alias("slice"))
    return cut.withColumns({PLACE: place, HOT: F.col("_blocks").isNotNull()}).drop("_key", "_cut_key", "_blocks"), True


def _with_edge(rows: DataFrame, source: DataFrame, edge: Column, name: str, neighbour: Callable) -> DataFrame:
    """``rows`` with ``name``: ``edge`` of the same key's neighbouring slice in ``source``.

    Only keys that are cut have neighbours: one row per slice, and there are at most about as many slices as asked for.
    """
    edges = source.where(HOT).groupBy(PLACE).agg(edge.alias("_edge"))
    by_slice = Window.partitionBy(F.col(PLACE)["key"]).orderBy(F.col(PLACE)["slice"])
    edges = edges.select(F.col(PLACE).alias("_edge_of"), neighbour("_edge").over(by_slice).alias(name))
    return rows.join(F.broadcast(edges), F.col(PLACE) == F.col("_edge_of"), "left").drop("_edge_of")


def build_history(
    rows: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    updated_at: str,
    tie_breakers: Sequence[str] = (),
    strategy: str = "check",
    slices: int | None = None,
) -> DataFrame:
    """One row per version: keys, tracked columns, ``valid_from``, ``valid_to``, ``is_current``.

    Rows of a key in (updated_at, tie_breakers) order. With ``check`` neighbours with equal tracked values are
    one version; with ``timestamp`` every time of a key opens a version, with the last row of that time.
    A version ends where the next begins; the open one has no end.

    A key that holds much of the table is cut into slices along its order, wherever its rows lie in time, so that a
    task sorts about one of ``slices`` parts of all rows (by default as many as shuffle partitions); slices are joined
    up at their edges by one row each. Rows are shuffled once. One job, over keys and positions only, looks for such
    keys first.
    """
    if strategy not in ("check", "timestamp"):
        raise ValueError(f"unknown strategy {strategy!r}")
    slices = slices or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    position = [updated_at, *tie_breakers]
    wanted = rows.select(*keys, *tracked, updated_at, *tie_breakers)
    if strategy == "timestamp":
        # rows of one time stay together; one without a time opens no version
        sliced, any_cut = cut_hot_keys(wanted.where(F.col(updated_at).isNotNull()), keys, [updated_at], slices)
    else:
        sliced, any_cut = cut_hot_keys(wanted, keys, position, slices)
    in_slice = Window.partitionBy(PLACE).orderBy(*position)
    if strategy == "timestamp":
        after = F.lead(updated_at).over(in_slice)
        timed = sliced.withColumn("_after", after)
        starts = timed.where(F.col("_after").isNull() | (F.col("_after") > F.col(updated_at)))
    else:
        value = F.struct(*tracked)
        before = F.lag(value).over(in_slice)
        if any_cut:
            sliced = _with_edge(sliced, sliced, F.max_by(value, F.struct(*position)), "_carried", F.lag)
            before = F.coalesce(before, F.col("_carried"))
        starts = sliced.withColumn("_before", before).where(~F.col("_before").eqNullSafe(value))
    valid_to = F.lead(updated_at).over(in_slice)
    if any_cut:
        starts = _with_edge(starts, starts, F.min(updated_at), "_next", F.lead)
        valid_to = F.coalesce(valid_to, F.col("_next"))
    return starts.select(
        *keys,
        *tracked,
        F.col(updated_at).alias("valid_from"),
        valid_to.alias("valid_to"),
        valid_to.isNull().alias("is_current"),
    )


def changed_versions(
    open_versions: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    updated_at: str,
    tie_breakers: Sequence[str] = (),
    **how: str,
) -> DataFrame:
    """What the open versions become with one more batch: the ones it closes, and the open ones.

    A new key is inserted, a change closes the open version and opens the next. The batch must be newer than
    all that the open versions have seen; rows not newer than a key's open version are ignored. ``HistoryTable``
    keeps what it has seen and takes batches in any order.
    """
    open_rows = open_versions.select(*keys, *tracked, F.col("valid_from").alias(updated_at))
    since = open_rows.select(*keys, F.col(updated_at).alias("_since"))
    newer = (
        batch.select(*keys, *tracked, updated_at, *tie_breakers)
        .join(since, list(keys), "left")
        .where(F.col("_since").isNull() | (F.col(updated_at) > F.col("_since")))
        .drop("_since")
    )
    rows = open_rows.unionByName(newer, allowMissingColumns=True)
    return build_history(rows, keys, tracked, updated_at, tie_breakers, **how)


def apply_batch(history: DataFrame, batch: DataFrame, keys: Sequence[str], *shape, **how: str) -> DataFrame:
    """The history after one more batch; see ``changed_versions``. Closed versions pass without a shuffle."""
    closed = history.where(~F.col("is_current"))
    return closed.unionByName(changed_versions(current_versions(history), batch, keys, *shape, **how))


def current_versions(history: DataFrame) -> DataFrame:
    """The open version of each key."""
    return history.where("is_current")


def lookup_current(fact: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a fact to the open versions; facts without one keep nulls."""
    return fact.join(current_versions(history).drop("valid_to", "is_current"), list(keys), "left")
