"""Keyed tables as ordinary bucketed Parquet tables.

A table is clustered by its key, so a merge brings the batch to the buckets and reads the stored side where it lies,
without a shuffle. Every merge writes a whole new version beside the old one, as ``replace_table`` does for models; readers keep the
old version until the new one is finished. Choose it where a batch touches most of a table; ``KeyedTable`` leaves
untouched buckets where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.merge import rows_past_watermark
from lakemart.operators.newest import LOAD_ID, SOURCE, newest_per_key
from lakemart.sources import folders
from lakemart.sources.tables import KEPT, VERSION


@dataclass(frozen=True)
class BucketedTable:
    """One row per (key, source). A row without a key equals no other: every batch that brings one adds it."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    tie_breakers: Sequence[str] = ()
    load_id: str = LOAD_ID
    buckets: int = 16

    @property
    def _keyed(self) -> list[str]:
        return [*self.keys, SOURCE]

    def _name(self, version: int) -> str:
        return f"lakemart_{hashlib.md5(self.path.encode()).hexdigest()}_{version}"

    def read(self) -> DataFrame | None:
        """The newest finished version, known to Spark as clustered; None if there is none."""
        version = folders.newest_version(self.spark, self.path)
        if version is None:
            return None
        name, folder = self._name(version), f"{self.path}/{VERSION}={version}"
        if not self.spark.catalog.tableExists(name):  # written by another session
            columns = self.spark.read.parquet(folder).schema
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
            by = ", ".join(f"`{c}`" for c in self._keyed)
            buckets = self._stored_buckets()
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{folder}'"
            )
        return self.spark.table(name)

    def _stored_buckets(self) -> int:
        """How many buckets the newest version has: the name of a marker beside its files."""
        version = folders.newest_version(self.spark, self.path)
        return int(folders.names(self.spark, f"{self.path}/{VERSION}={version}/{folders.DONE}s")[0])

    def merged(self, landing: DataFrame, watermark: str = "per_source") -> DataFrame:
        """The next state: the newest landed row past the watermark of each key replaces the stored one.

        Columns that only one side has are null on the other; rows deleted at the source stay.
        """
        stored, order = self.read(), [self.load_id, *self.tie_breakers]
        if stored is None:
            return newest_per_key(landing, self._keyed, order)
        delta = newest_per_key(rows_past_watermark(landing, stored, self.load_id, watermark), self._keyed, order)
        # dealt as the stored side is, so the join moves neither
        delta = delta.repartition(self._stored_buckets(), *self._keyed)
        stored, delta = stored.withColumn("_old", F.lit(True)).alias("s"), delta.withColumn("_new", F.lit(True)).alias("d")
        same = [F.col(f"s.{c}") == F.col(f"d.{c}") for c in self._keyed]
        # the batch side is never broadcast, which a full join could not use
        both = stored.join(delta.hint("merge"), same, "full")
        old, new = ([c for c in df.columns if c not in ("_old", "_new")] for df in (stored, delta))
        taken = F.col("d._new").isNotNull()

        def value(column: str):
            if column not in new:
                return F.when(~taken, F.col(f"s.{column}")).alias(column)
            if column not in old:
                return F.col(f"d.{column}").alias(column)
            return F.when(taken, F.col(f"d.{column}")).otherwise(F.col(f"s.{column}")).alias(column)

        return both.select(*[value(c) for c in [*old, *[c for c in new if c not in old]]])

    def refresh(self, landing: DataFrame, watermark: str = "per_source") -> int:
        """Merge and write the next version; returns its number."""
        rows = self.merged(landing, watermark)
        numbers = [int(v) for v in folders.partition_values(self.spark, self.path, VERSION)]
        version = 1 + max(numbers, default=-1)
        name, folder = self._name(version), f"{self.path}/{VERSION}={version}"
        writer = rows.write.mode("overwrite").format("parquet").option("path", folder)
        writer.bucketBy(self.buckets, *self._keyed).sortBy(*self._keyed).saveAsTable(name)
        folders.touch(self.spark, f"{folder}/{folders.DONE}s/{self.buckets}")
        folders.touch(self.spark, f"{folder}/{folders.DONE}")
        for old in folders.finished_versions(self.spark, self.path)[:-KEPT]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(old)}")
            folders.drop(self.spark, f"{self.path}/{VERSION}={old}")
        return version
