"""Folder names of partitioned tables; nothing here opens a file."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _file_system(spark, path)
    return bool(files.exists(folder))


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly under a folder; nothing if there is no such folder."""
    files, folder = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def stamp(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of what lies directly under a folder; it changes when a table there does."""
    files, folder = _file_system(spark, path)
    found = files.listStatus(folder) if files.exists(folder) else []
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found))


def partition_values(spark: SparkSession, path: str, partition: str) -> list[str]:
    """Values of a partition column, one per ``partition=value`` folder."""
    return [n.split("=", 1)[1] for n in names(spark, path) if n.startswith(f"{partition}=")]


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, with the folders above it. It is there or it is not, so it can mark the end of a write."""
    files, place = _file_system(spark, path)
    files.create(place, True).close()


DONE = "_done"


def finished_versions(spark: SparkSession, path: str, partition: str = "version") -> list[int]:
    """Numbered versions that were marked as done, oldest first; job marker files are not relied on."""
    numbers = sorted(int(v) for v in partition_values(spark, path, partition))
    return [n for n in numbers if exists(spark, f"{path}/{partition}={n}/{DONE}")]


def newest_version(spark: SparkSession, path: str, partition: str = "version") -> int | None:
    """The newest version that is done; unfinished ones after it cost a look each."""
    for n in sorted((int(v) for v in partition_values(spark, path, partition)), reverse=True):
        if exists(spark, f"{path}/{partition}={n}/{DONE}"):
            return n
    return None


def drop(spark: SparkSession, path: str) -> bool:
    """Delete a folder; whether it was there."""
    files, folder = _file_system(spark, path)
    return bool(files.delete(folder, True))


def swap(spark: SparkSession, new: str, target: str) -> None:
    """Put a finished folder in the place of another."""
    files, folder = _file_system(spark, target)
    files.delete(folder, True)
    files.mkdirs(folder.getParent())
    if not files.rename(_file_system(spark, new)[1], folder):
        raise OSError(f"{new} could not be moved to {target}")
