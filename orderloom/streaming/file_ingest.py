"""Incremental Bronze load from files that arrive in a folder.

The same rows and run columns as the batch load. Which files are new is kept in
the stream's checkpoint instead of a high-water mark, so late rows in new files
are loaded as well; a repeated batch is removed by Silver deduplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderloom.context import RunContext
from orderloom.sources.bronze import incremental_batch
from orderloom.sources.lake import Lake


def ingest_new_files(
    lake: Lake,
    folder: str,
    schema: T.StructType,
    table: str,
    watermark: str,
    checkpoint: str,
    run: RunContext,
) -> None:
    """Load every file not seen before, then stop; ``checkpoint`` must be on shared storage."""
    arriving = lake.spark.readStream.schema(schema).parquet(folder)

    def append(batch: DataFrame, _batch_id: int) -> None:
        lake.append_days(run.stamp_bronze(incremental_batch(batch, watermark, None)), table)

    query = (
        arriving.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
