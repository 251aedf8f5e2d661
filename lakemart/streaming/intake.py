"""Landed files as a stream into a keyed table.

The stream's checkpoint remembers which files were taken, so a missed day is caught up and no file is
read twice. Each micro-batch becomes one version of the table. A batch that is retried after a lost executor is
recognised by the stream's id, which lies in the checkpoint, and its number; a new checkpoint is a new stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from lakemart.sources.store import KeyedTable


def run_available(table: KeyedTable, inbox: str, schema: StructType, checkpoint: str, max_files: int = 10_000) -> None:
    """Merge everything that has arrived since the last call, then stop."""

    def merge(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        table.merge_batch(batch, query, number)

    stream = table.spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(inbox)
    (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
