"""Load strategies: full, incremental by cursor, append."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakemart.functions.dates import cursor_start
from lakemart.sources import folders
from lakemart.sources.bronze import table_exists

# Newest cursor value seen per table and run; append-only, so a lost run leaves the last good value.
STATE_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("cursor_value", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("run_id", T.StringType()),
    ]
)
# What a run leaves with its rows: its result, and the folders that make up the table after it.
RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("strategy", T.StringType(), False),
        T.StructField("row_count", T.LongType(), False),
        T.StructField("cursor_value", T.StringType()),
        T.StructField("folders", T.ArrayType(T.StringType()), False),
        # fingerprints of the rows at the newest cursor value, and the columns they are made of
        T.StructField("boundary", T.StringType()),
        T.StructField("identity", T.ArrayType(T.StringType())),
    ]
)
RUNS = "_runs"


@dataclass(frozen=True)
class LoadResult:
    strategy: str
    rows: int
    cursor_value: str | None = None


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """The table as the newest finished run left it; columns added later are null before."""
    last = _last_run(spark, target)
    if last is None:
        raise FileNotFoundError(f"nothing was loaded to {target}")
    return spark.read.option("mergeSchema", "true").parquet(*[f"{target}/{folder}" for folder in last["folders"]])


def load_full(source: DataFrame, target: str, run_id: str = "") -> LoadResult:
    """Every row, replacing the target."""
    return _run(source, target, "full", run_id, replace=True)


def load_append(source: DataFrame, target: str, run_id: str = "") -> LoadResult:
    """Every row, added to the target."""
    return _run(source, target, "append", run_id, replace=False)


def load_incremental(
    source: DataFrame,
    target: str,
    table: str,
    cursor: str,
    state: str,
    run_id: str,
    initial_value: str | None = None,
    identity: Sequence[str] | None = None,
) -> LoadResult:
    """Rows at or past the stored cursor that no run has loaded yet, added to the target.

    The first run has no state and loads everything. Without a stored value ``initial_value`` is the
    start. Rows equal to the stored value are read again, because more of them may have arrived; those that were
    loaded before are left out. A run therefore keeps a fingerprint of every row at its newest value and how often it was
    there: a row that comes more often than before is new as often as that. ``identity`` names the columns that tell
    rows apart, by default all that the source had when the value was first seen; columns that come later do not make a
    loaded row new. If one of these columns is gone, rows at the value cannot be told apart and all come again.

    The filter reaches the source scan, and the new cursor value is observed during the write. Rows, fingerprints and
    cursor are committed together; ``state`` is the log of all tables, written after that.
    """
    spark = source.sparkSession
    before = _last_run(spark, target)
    first_run = before is None and not table_exists(spark, state)
    kind = source.schema[cursor].dataType.simpleString()
    fresh, edge = source, _Edge(cursor, list(identity or source.columns))
    if not first_run:
        last = _newest_run(spark, target)
        start = last["cursor_value"] if last else _stored_cursor(spark, state, table)
        if start is not None:
            fresh = source.where(F.col(cursor) >= F.lit(start).cast(kind))
        elif initial_value:
            fresh = source.where(F.col(cursor) >= cursor_start(F.lit(initial_value)).cast(kind))
        if last and last["boundary"] and set(last["identity"]) <= set(source.columns):
            seen = spark.read.schema(EDGE_SCHEMA).parquet(f"{target}/{last['boundary']}")
            edge = _Edge(cursor, last["identity"], start, seen)
            fresh = edge.not_seen(source, F.lit(start).cast(kind))
    strategy = "full" if first_run else "incremental"
    result = _run(fresh, target, strategy, run_id, replace=first_run, edge=edge)
    if not _logged(spark, state, table, run_id):
        row = (table, result.cursor_value, result.rows, run_id)
        spark.createDataFrame([row], STATE_SCHEMA).coalesce(1).write.mode("append").parquet(state)
    return result


EDGE_SCHEMA = T.StructType(
    [T.StructField("f1", T.LongType()), T.StructField("f2", T.LongType()), T.StructField("times", T.LongType())]
)


@dataclass(frozen=True)
class _Edge:
    """Rows at the newest cursor value, known by 128 bits of their identity and by how often they are there."""

    cursor: str
    identity: Sequence[str]
    value: str | None = None
    seen: DataFrame | None = None

    @property
    def newest(self) -> Column:
        return F.max(self.cursor).cast("string").alias("newest")

    def _marked(self, rows: DataFrame) -> DataFrame:
        # hashes pass over nulls, so which columns are null counts too; maps have no hash of their own
        columns = [F.to_json(c) if isinstance(rows.schema[c].dataType, T.MapType) else F.col(c) for c in self.identity]
        nulls = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in self.identity])
        return rows.withColumns({f"f{n}": F.xxhash64(F.lit(n), nulls, *columns) for n in (1, 2)})

    def not_seen(self, source: DataFrame, value: Column) -> DataFrame:
        """Rows past ``value``, and those at it that are not among the ones seen; only the latter are shuffled."""
        at = self._marked(source.where(F.col(self.cursor) == value))
        nth = F.row_number().over(Window.partitionBy("f1", "f2").orderBy("f1"))
        new = at.withColumn("nth", nth).join(self.seen, ["f1", "f2"], "left")
        new = new.where(F.col("nth") > F.coalesce("times", F.lit(0)))
        return source.where(F.col(self.cursor) > value).unionByName(new.select(*source.columns))

    def write(self, rows: DataFrame, newest: str, path: str) -> None:
        """Fingerprints of the rows at ``newest``, with those seen before if the value is still the same."""
        kind = rows.schema[self.cursor].dataType.simpleString()
        counts = self._marked(rows.where(F.col(self.cursor) == F.lit(newest).cast(kind)))
        counts = counts.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("times"))
        if self.seen is not None and newest == self.value:
            counts = counts.unionByName(self.seen).groupBy("f1", "f2").agg(F.sum("times").alias("times"))
        counts.write.mode("overwrite").parquet(path)


def load(
    source: DataFrame,
    target: str,
    strategy: str,
    *,
    table: str = "",
    cursor: str | None = None,
    state: str | None = None,
    run_id: str = "",
    initial_value: str | None = None,
    identity: Sequence[str] | None = None,
) -> LoadResult:
    """Load by strategy name; ``incremental`` without a cursor column is an append of everything."""
    if strategy == "full":
        return load_full(source, target, run_id)
    if strategy == "incremental" and cursor and state:
        return load_incremental(source, target, table, cursor, state, run_id, initial_value, identity)
    return load_append(source, target, run_id)


def _run(
    source: DataFrame, target: str, strategy: str, run_id: str, replace: bool, edge: _Edge | None = None
) -> LoadResult:
    """Write a run's rows to a folder of their own, then the record that makes them part of the table.

    A run that is repeated under its id, because its end was not seen, finds its record and adds nothing. A run that
    failed before its record left nothing that readers see.
    """
    spark = source.sparkSession
    done = folders.finished_versions(spark, f"{target}/{RUNS}")
    records = _records(spark, target, done)
    if run_id and (known := [row for row in records if row["run_id"] == run_id]):
        return LoadResult(known[0]["strategy"], known[0]["row_count"], known[0]["cursor_value"])
    number = done[-1] + 1 if done else 0
    folder, seen = f"rows-{number:08d}", Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *([edge.newest] if edge else [])]
    source.observe(seen, *metrics).write.mode("overwrite").parquet(f"{target}/{folder}")
    got = seen.get
    kept = [] if replace or not records else records[-1]["folders"]
    newest, boundary = got.get("newest"), None
    if edge and newest is not None:
        boundary = f"boundary-{number:08d}"
        edge.write(spark.read.schema(source.schema).parquet(f"{target}/{folder}"), newest, f"{target}/{boundary}")
    row = (run_id, strategy, got["rows"], newest, [*kept, folder], boundary, list(edge.identity) if boundary else None)
    record = f"{target}/{RUNS}/version={number}"
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("overwrite").parquet(record)
    folders.touch(spark, f"{record}/{folders.DONE}")
    return LoadResult(strategy, got["rows"], newest)


def _records(spark: SparkSession, target: str, versions: Sequence[int]) -> list[Row]:
    """What the runs left, oldest first; one row per run."""
    if not versions:
        return []
    paths = [f"{target}/{RUNS}/version={n}" for n in versions]
    rows = spark.read.schema(RUN_SCHEMA).option("basePath", f"{target}/{RUNS}").parquet(*paths)
    return rows.withColumn("n", F.col("_metadata.file_path")).orderBy(F.regexp_extract("n", r"version=(\d+)", 1).cast("long")).collect()


def _last_run(spark: SparkSession, target: str) -> Row | None:
    version = folders.newest_version(spark, f"{target}/{RUNS}")
    return None if version is None else _records(spark, target, [version])[0]


def _newest_run(spark: SparkSession, target: str) -> Row | None:
    """The newest run that saw a row: its cursor, and what was there at that value."""
    done = folders.finished_versions(spark, f"{target}/{RUNS}")
    seen = [row for row in _records(spark, target, done) if row["cursor_value"] is not None]
    return seen[-1] if seen else None


def _logged(spark: SparkSession, state: str, table: str, run_id: str) -> bool:
    if not run_id or not table_exists(spark, state):
        return False
    log = spark.read.schema(STATE_SCHEMA).parquet(state)
    return not log.where((F.col("table_name") == table) & (F.col("run_id") == run_id)).isEmpty()


def _stored_cursor(spark: SparkSession, state: str, table: str) -> str | None:
    """Newest value as text: by number where it is one, else as text, which orders ISO times."""
    mine = spark.read.schema(STATE_SCHEMA).parquet(state).where(F.col("table_name") == table)
    number = F.expr("try_cast(cursor_value as decimal(38,10))")
    newest = mine.agg(F.max_by("cursor_value", number).alias("number"), F.max("cursor_value").alias("text")).first()
    return newest["number"] or newest["text"]
