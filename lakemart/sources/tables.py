"""Tables that are replaced as a whole: a new version is written beside the old one and then takes its place."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.sources import folders

VERSION = "version"
# the version readers may still be using when the next one is finished
KEPT = 2


def replace_table(df: DataFrame, path: str, partition_by: str | None = None, gathered: bool = False) -> str:
    """Write the next version and mark it done; returns its folder.

    Until then readers see the version before; a write that fails half way changes nothing. Versions older than the
    one before are dropped. ``gathered`` says that the rows of a partition lie together already.
    """
    spark = df.sparkSession
    numbers = [int(v) for v in folders.partition_values(spark, path, VERSION)]
    number = 1 + max(numbers, default=-1)
    folder = f"{path}/{VERSION}={number}"
    # a partition gets few files; one too large for a task is split
    writer: DataFrameWriter = (df.hint("rebalance", partition_by) if partition_by and not gathered else df).write
    # digests in hex do not get smaller without entropy coding
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
    folders.touch(spark, f"{folder}/{folders.DONE}")
    done = folders.finished_versions(spark, path)
    for old in done[:-KEPT]:
        folders.drop(spark, f"{path}/{VERSION}={old}")
    return folder


def current_folder(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest finished version."""
    number = folders.newest_version(spark, path)
    return None if number is None else f"{path}/{VERSION}={number}"


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The newest finished version."""
    folder = current_folder(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no finished version under {path}")
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(folder)
    return df.select(*[F.col(f"`{f.name}`") for f in schema]) if schema else df
