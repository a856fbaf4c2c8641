"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Spark does the planning; these only leave it room to: adaptive plans, skewed joins split at run time,
# many initial shuffle partitions that are merged down to the advisory size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Merged down to the advisory size; 200, the default of Spark, would be half a terabyte a task at 100 TB.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app: str = "larder",
    master: str | None = None,
    initial_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session from the given master, else ``SPARK_MASTER_URL``, else what spark-submit or local mode gives.

    ``initial_partitions`` bounds the shuffle width before adaptive merging: about input bytes / 128 MB on
    a cluster, a small multiple of the cores in local mode.
    """
    builder = SparkSession.builder.appName(app)
    master = master or os.environ.get("SPARK_MASTER_URL")
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if initial_partitions:
        settings["spark.sql.shuffle.partitions"] = str(initial_partitions)
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="run-larder-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Local mode may go without the setting and gets a temporary folder; a cluster may not, because its
    executors share no local disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = _local_scratch()
    return f"{base.rstrip('/')}/larder/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, path: str | None = None, name: str = "table", compression: str | None = None) -> DataFrame:
    """Write the frame as Parquet and read it back: the lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later step reads, wherever the shared folder is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def local_rows(spark: SparkSession, rows: Sequence, schema: StructType) -> DataFrame:
    """A few rows as a table that the optimizer folds; no task reads them."""
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    types = to_arrow_schema(schema)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types, strict=True)], schema=types), schema)


def concurrently(spark: SparkSession, jobs: Sequence[Callable[[], object]]) -> None:
    """Run independent jobs side by side, so the last tasks of one leave no executor idle. A failure is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for running in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            running.result()
