"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# What a job of this library expects; keywords of ``build_session`` override them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even where that costs a later shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}

_local_folders: dict[str, str] = {}


def build_session(app: str = "lakemart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets one new temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # a local cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="lakemart-")
    return _local_folders[app]


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/lakemart/{uuid.uuid4().hex}/{name}"
