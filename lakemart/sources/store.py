"""Finished tables: models written once and read back, keyed tables and histories that grow by batches."""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.history import build_history, changed_versions
from lakemart.operators.merge import past_marks, upsert
from lakemart.operators.newest import LOAD_ID, SOURCE, newest_per_key
from lakemart.sources import folders
from lakemart.sources.tables import read_table, replace_table
from lakemart.sources.together import run_together

VERSION = "version"
BUCKET = "bucket"


def write_model(df: DataFrame, path: str, partition_by: str | None = None, gathered: bool = False) -> DataFrame:
    """Replace a model's table and return it as stored.

    Readers keep the old table until the new one is finished. Later reads with a filter on the partition
    column skip the other folders.
    """
    replace_table(df, path, partition_by, gathered)
    return read_table(df.sparkSession, path, df.schema)


def write_models(
    models: Mapping[str, DataFrame],
    root: str,
    partitioned: Mapping[str, str] | None = None,
    gathered: Collection[str] = (),
) -> dict[str, DataFrame]:
    """Write models that do not depend on each other and return them as stored.

    What follows reads the stored tables and computes nothing twice. ``gathered`` names those whose rows lie together
    by partition already.
    """
    partitioned = partitioned or {}
    return run_together(
        {
            name: partial(write_model, df, f"{root}/{name}", partitioned.get(name), name in gathered)
            for name, df in models.items()
        }
    )


@dataclass(frozen=True)
class _State:
    """What a version's commit record says; one row, read once per refresh."""

    version: int
    homes: list[int | None]  # for each bucket the version that holds it
    schema: T.StructType
    marks: dict[str, Any]  # newest load id per source
    batches: dict[str, int] = field(default_factory=dict)  # last batch taken of each stream

    @property
    def buckets(self) -> int:
        return len(self.homes)


@dataclass(frozen=True)
class KeyedTable:
    """One row per (key, source), cut into buckets by a hash of the key.

    A merge writes a new version that holds only the buckets its batch touches; the other buckets stay where they
    are and are neither read nor written. Each version has a commit record, written last: number of
    buckets, the version that holds each, columns, newest load id per source and last batch per stream. What has no
    record is not there, so a merge that failed or is repeated never shows half a table, and finding a watermark
    or a bucket lists no folders and scans no rows. Choose ``buckets`` for some hundred megabytes each; it counts
    for a new table only, ``rebucket`` changes it later.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    tie_breakers: Sequence[str] = ()
    load_id: str = LOAD_ID
    buckets: int = 16

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    @property
    def _commits(self) -> str:
        return f"{self.path}/commits"

    @property
    def _keyed(self) -> list[str]:
        return [*self.keys, SOURCE]

    @property
    def _order(self) -> list[str]:
        return [self.load_id, *self.tie_breakers]

    def versions(self) -> list[int]:
        return folders.finished_versions(self.spark, self._commits)

    def read(self, before: int | None = None) -> DataFrame | None:
        """The newest state, or the newest one older than version ``before``; None if there is none."""
        state = self._state(before)
        return None if state is None else self._read_buckets(state, range(state.buckets))

    def refresh(self, landing: DataFrame, watermark: str = "per_source") -> int:
        """Merge the rows of ``landing`` past the watermark; the first refresh takes all. Returns the version.

        If nothing is past the watermark, no version is written, except the first, which may be empty.
        """
        state = self._state()
        fresh = past_marks(landing, state.marks if state else {}, self.load_id, watermark)
        return self._merge(fresh, state, late=False)

    def merge_batch(self, batch: DataFrame, stream: str, number: int) -> int:
        """Merge one batch of a stream; a row older than the stored one is ignored. Returns the version.

        Batches of a stream are numbered; one that was merged before is recognised and changes nothing.
        """
        state = self._state()
        if state and state.batches.get(stream, -1) >= number:
            return state.version
        return self._merge(batch, state, late=True, batches={stream: number})

    def rebucket(self, buckets: int) -> int:
        """Write the whole table anew with another number of buckets; returns the version."""
        state = self._state()
        if state is None:
            raise FileNotFoundError(f"no table at {self.path}")
        version = state.version + 1
        rows = self._read_buckets(state, range(state.buckets))
        self._write_buckets(rows, buckets, version)
        present = folders.partition_values(self.spark, f"{self._data}/{VERSION}={version}", BUCKET)
        homes = [version if str(b) in present else None for b in range(buckets)]
        return self._commit(_State(version, homes, state.schema, state.marks, state.batches))

    def keep(self, count: int) -> int:
        """Drop what none of the newest ``count`` versions reads; returns the number of buckets that went."""
        versions = self.versions()
        if not versions:
            return 0
        used = {(v, b) for n in versions[-count:] for b, v in enumerate(self._state(n + 1).homes)}
        dropped = 0
        for v in (int(x) for x in folders.partition_values(self.spark, self._data, VERSION)):
            folder = f"{self._data}/{VERSION}={v}"
            held = [int(b) for b in folders.partition_values(self.spark, folder, BUCKET)]
            if v > versions[-1]:
                continue  # not committed; a merge may be writing it
            for b in held:
                if (v, b) not in used:
                    dropped += folders.drop(self.spark, f"{folder}/{BUCKET}={b}")
            if not any((v, b) in used for b in held):
                folders.drop(self.spark, folder)
        for v in versions[:-count]:
            folders.drop(self.spark, f"{self._commits}/{VERSION}={v}")
        return dropped

    def _state(self, before: int | None = None) -> _State | None:
        if before is None:
            version = folders.newest_version(self.spark, self._commits)
        else:
            version = max((v for v in self.versions() if v < before), default=None)
        if version is None:
            return None
        row = self.spark.read.parquet(f"{self._commits}/{VERSION}={version}").first()
        schema = T.StructType.fromJson(json.loads(row["schema"]))
        marks = {m["source"]: m["mark"] for m in row["marks"]}
        return _State(version, list(row["homes"]), schema, marks, dict(row["batches"]))

    def _read_buckets(self, state: _State, buckets: Sequence[int]) -> DataFrame:
        homes = [(state.homes[b], b) for b in buckets if state.homes[b] is not None]
        if not homes:
            return self.spark.createDataFrame([], state.schema)
        paths = [f"{self._data}/{VERSION}={v}/{BUCKET}={b}" for v, b in homes]
        return self.spark.read.schema(state.schema).parquet(*paths)

    def _bucket(self, buckets: int, schema: T.StructType) -> Column:
        """The same for equal keys whatever whole-number type they come in."""
        whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
        keys = [F.col(k).cast("bigint") if isinstance(schema[k].dataType, whole) else F.col(k) for k in self.keys]
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _merge(self, rows: DataFrame, state: _State | None, late: bool, batches: Mapping[str, int] | None = None) -> int:
        version = state.version + 1 if state else 0
        rows, known = _aligned(rows, state.schema if state else T.StructType([]), self.keys)
        buckets = state.buckets if state else self.buckets
        staged = f"{self.path}/batch/{VERSION}={version}"
        newest_per_key(rows, self._keyed, self._order).write.mode("overwrite").parquet(staged)
        # read for its buckets, its marks and the merge
        delta = self.spark.read.schema(rows.schema).parquet(staged)
        touched = sorted(r[0] for r in delta.select(self._bucket(buckets, rows.schema)).distinct().collect())
        if state and not touched and not batches:
            folders.drop(self.spark, staged)
            return state.version
        merged = delta
        if state:
            stored = self._read_buckets(_State(state.version, state.homes, known, {}), touched)
            if late:
                same = stored.join(delta.select(*self._keyed), self._keyed, "left_semi")
                both = same.unionByName(delta, allowMissingColumns=True)
                delta = newest_per_key(both, self._keyed, self._order)
            merged = upsert(stored, delta, self._keyed)
        for column in known:
            if column.name not in merged.columns:
                merged = merged.withColumn(column.name, F.lit(None).cast(column.dataType))
        if touched:
            self._write_buckets(merged, buckets, version)
        homes = list(state.homes) if state else [None] * buckets
        for b in touched:
            homes[b] = version
        marks = dict(state.marks) if state else {}
        batch = self.spark.read.schema(rows.schema).parquet(staged)
        for row in batch.groupBy(SOURCE).agg(F.max(self.load_id).alias("mark")).where("mark is not null").collect():
            marks[row[SOURCE]] = max(row["mark"], marks.get(row[SOURCE], row["mark"]))
        done = {**(state.batches if state else {}), **(batches or {})}
        self._commit(_State(version, homes, T.StructType(merged.schema.fields), marks, done))
        folders.drop(self.spark, staged)
        return version

    def _write_buckets(self, rows: DataFrame, buckets: int, version: int) -> None:
        rows = rows.withColumn(BUCKET, self._bucket(buckets, rows.schema)).hint("rebalance", BUCKET)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(BUCKET).parquet(f"{self._data}/{VERSION}={version}")

    def _commit(self, state: _State) -> int:
        marks = T.ArrayType(T.StructType().add("source", "string").add("mark", state.schema[self.load_id].dataType))
        record = (
            T.StructType()
            .add("homes", T.ArrayType(T.LongType()))
            .add("schema", T.StringType())
            .add("marks", marks)
            .add("batches", T.MapType(T.StringType(), T.LongType()))
        )
        row = (state.homes, state.schema.json(), list(state.marks.items()), state.batches)
        folder = f"{self._commits}/{VERSION}={state.version}"
        self.spark.createDataFrame([row], record).coalesce(1).write.mode("overwrite").parquet(folder)
        folders.touch(self.spark, f"{folder}/{folders.DONE}")
        return state.version


def _aligned(rows: DataFrame, known: T.StructType, keys: Sequence[str]) -> tuple[DataFrame, T.StructType]:
    """Rows and known columns in the wider of both types; text and numbers do not mix."""
    sizes = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    fields = []
    for column in known:
        kind = column.dataType
        if column.name in rows.columns and (other := rows.schema[column.name].dataType) != kind:
            if kind in sizes and other in sizes:
                kind = max(kind, other, key=sizes.index)
            elif column.name in keys:
                raise ValueError(f"key {column.name} is {kind.simpleString()}, not {other.simpleString()}")
            rows = rows.withColumn(column.name, F.col(column.name).cast(kind))
        fields.append(T.StructField(column.name, kind))
    return rows, T.StructType(fields)


@dataclass(frozen=True)
class HistoryTable:
    """Version history that grows by batches, which may come in any order.

    Closed versions never change unless a row comes late, so a batch adds the ones it closes; the open versions, one
    per key, are written anew with the last time they were seen. All rows are kept as they came (``seen``): a key with
    a row that is not newer than what it has seen is built again from them, and its closed versions of earlier
    batches no longer count (``void``). Other keys' closed versions and rows are not read by a batch.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    tracked: Sequence[str]
    updated_at: str
    tie_breakers: Sequence[str] = ()
    strategy: str = "check"

    def versions(self) -> list[int]:
        return folders.finished_versions(self.spark, f"{self.path}/open")

    def open_versions(self) -> DataFrame | None:
        number = folders.newest_version(self.spark, f"{self.path}/open")
        return None if number is None else self._part("open", number).drop("_last")

    def read(self) -> DataFrame | None:
        """Closed and open versions together."""
        versions = self.versions()
        if not versions:
            return None
        closed = self._parts("closed", versions)
        void = self._parts("void", versions).groupBy(*self.keys).agg(F.max("_batch").alias("_since"))
        void = void.select(*[F.col(k).alias(f"_v_{k}") for k in self.keys], "_since")
        same = [F.col(k).eqNullSafe(F.col(f"_v_{k}")) for k in self.keys] + [F.col("_batch") < F.col("_since")]
        open_versions = self.open_versions()
        valid = closed.join(void, same, "left_anti").select(*open_versions.columns)
        return valid.unionByName(open_versions)

    def apply(self, batch: DataFrame) -> int:
        """Add one batch; returns its number. A batch that failed half way is simply applied again."""
        newest = folders.newest_version(self.spark, f"{self.path}/open")
        number = 0 if newest is None else newest + 1
        keys, at = list(self.keys), self.updated_at
        shape = (self.keys, self.tracked, at, self.tie_breakers)
        self._write(batch.select(*keys, *self.tracked, at, *self.tie_breakers), "seen", number)
        batch = self._part("seen", number)
        last = batch.groupBy(*keys).agg(F.max(at).alias("_new"), F.min(at).alias("_first"))
        if newest is None:
            self._write(batch.select(*keys).limit(0), "void", number)
            rows, current = build_history(batch, *shape, strategy=self.strategy), None
        else:
            current = self._part("open", newest)
            late = self._known(last, current.select(*keys, "_last")).where("_first <= _last").select(*keys)
            self._write(late, "void", number)
            void = self._part("void", number)
            seen = self._parts("seen", [*self.versions(), number])
            again = build_history(self._only(seen, void, "left_semi"), *shape, strategy=self.strategy)
            ordinary = self._only(batch, void, "left_anti")
            stored = self._only(self._only(current, void, "left_anti"), last, "left_semi")
            rows = changed_versions(stored.drop("_last"), ordinary, *shape, strategy=self.strategy).unionByName(again)
        self._write(rows, "rows", number)
        rows = self._part("rows", number)
        self._write(rows.where(~F.col("is_current")), "closed", number)
        opened = self._known(rows.where("is_current"), last.select(*keys, "_new")).withColumnRenamed("_new", "_last")
        if current is not None:
            before = current.select(*keys, F.col("_last").alias("_before"))
            opened = self._known(opened, before, "left")
            opened = opened.withColumn("_last", F.greatest("_last", "_before")).drop("_before")
            opened = opened.unionByName(self._only(current, last, "left_anti"))
        # readers see the batch when this, the last write, is finished
        self._write(opened, "open", number)
        folders.touch(self.spark, f"{self.path}/open/{VERSION}={number}/{folders.DONE}")
        folders.drop(self.spark, f"{self.path}/rows/{VERSION}={number}")
        return number

    def keep(self, count: int) -> int:
        """Drop the open versions of all but the newest ``count`` batches; what else is stored stays in use."""
        old = self.versions()[:-count]
        # the numbers of batches are still read from their folders
        for n in old:
            for name in folders.names(self.spark, f"{self.path}/open/{VERSION}={n}"):
                if name != folders.DONE:
                    folders.drop(self.spark, f"{self.path}/open/{VERSION}={n}/{name}")
        return len(old)

    def _write(self, df: DataFrame, part: str, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{part}/{VERSION}={number}")

    def _part(self, part: str, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{part}/{VERSION}={number}")

    def _parts(self, part: str, numbers: Sequence[int]) -> DataFrame:
        """Several batches' rows with the number of their batch; unfinished batches are not among them."""
        paths = [f"{self.path}/{part}/{VERSION}={n}" for n in numbers]
        rows = self.spark.read.option("basePath", f"{self.path}/{part}").parquet(*paths)
        return rows.withColumnRenamed(VERSION, "_batch")

    def _only(self, rows: DataFrame, keyed: DataFrame, how: str) -> DataFrame:
        """Rows whose key is (``left_semi``) or is not (``left_anti``) in ``keyed``; null keys are equal."""
        other = keyed.select(*[F.col(k).alias(f"_o_{k}") for k in self.keys])
        return rows.join(other, [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in self.keys], how)

    def _known(self, rows: DataFrame, values: DataFrame, how: str = "inner") -> DataFrame:
        """``rows`` with the other columns of ``values``, by key; null keys are equal."""
        other = values.select(*[F.col(c).alias(f"_o_{c}") if c in self.keys else F.col(c) for c in values.columns])
        same = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in self.keys]
        return rows.join(other, same, how).drop(*[f"_o_{k}" for k in self.keys])
