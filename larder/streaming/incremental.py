"""Incremental staging loads: the ``append`` disposition for files that keep arriving.

Structured Streaming reads each file of a JSON-lines folder once and appends its rows to the staging
table. Each batch is appended by the same write as a batch load, so both may share a folder.
Progress is in the checkpoint folder: a restarted run skips no file. A batch that is run again after a failure repeats its
rows, which ``assemble`` reduces to one for each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.plans.ingest import RESOURCES
from larder.sources.tables import write_staging


def append_new_files(
    spark: SparkSession, name: str, source_dir: str, staging_path: str, checkpoint: str, files_per_batch: int = 1000
) -> None:
    """Append the files that arrived since the last call, then stop. JSON resources only."""
    resource = RESOURCES[name]
    if resource.is_csv:
        raise ValueError("a CSV resource is deduplicated as a whole; load it with ingest()")
    rows = (
        spark.readStream.schema(resource.schema)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(source_dir)
    )

    def append(batch: DataFrame, _: int) -> None:
        write_staging(resource.stage(batch), staging_path, "append")

    query = rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
