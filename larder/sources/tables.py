"""Table sinks, file layout, views and materialisation on Parquet."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MODES = {"replace": "overwrite", "append": "append"}
# Codec of stored tables: texts take a third less than by the default, and by this level a fifteenth less than by its own.
CODEC = "zstd"
STORED = {"compression": CODEC, "parquet.compression.codec.zstd.level": "9"}

TASK_BYTES = 128 * 1024 * 1024
# Stored bytes of texts that a task takes apart into their words or grams.
TEXT_BYTES = 8 * 1024 * 1024
# The optimizer knows no size of some inputs and puts the largest long in its place, scaled by the columns that are left.
UNKNOWN_BYTES = 1 << 55


def sink_width(n_bytes: int, least: int, task_bytes: int = TASK_BYTES) -> int:
    """Tasks for a range-partitioned write of that many bytes: one for each ``task_bytes``, ``least`` at least."""
    return least if n_bytes >= UNKNOWN_BYTES else max(least, -(-n_bytes // task_bytes))


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size of the frame: file sizes carried through the plan, known before anything runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def clustered(df: DataFrame, by: Sequence[str], n_bytes: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted on the columns, so files and row groups cover narrow ranges.

    Readers then skip files by Parquet min/max statistics. End the list with a unique column: range
    bounds fall inside the rows of a frequent value too, and no task gets all of them. The bounds come
    from a sample, a second pass over the input: ``materialise`` a costly input first.

    The width follows the bytes of the input (``n_bytes``, default: as planned), as adaptive execution merges small
    ranges but does not split large ones. Up to the session's shuffle width that setting holds.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = sink_width(planned_bytes(df) if n_bytes is None else n_bytes, least)
    ranged = df.repartitionByRange(width, *by) if width > least else df.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


def write_staging(df: DataFrame, path: str, disposition: str = "replace") -> None:
    """``append`` adds files and may repeat known keys; readers deduplicate by key."""
    df.write.mode(MODES[disposition]).options(**STORED).parquet(path)


def _file_options(rows_per_file: int, lookup: Sequence[str]) -> dict[str, str]:
    options = STORED | ({"maxRecordsPerFile": str(rows_per_file)} if rows_per_file else {})
    if lookup:
        options["parquet.bloom.filter.adaptive.enabled"] = "true"
        options |= {f"parquet.bloom.filter.enabled#{column}": "true" for column in lookup}
    return options


def write_clustered(
    df: DataFrame, path: str, by: Sequence[str], rows_per_file: int = 0, lookup: Sequence[str] = (), n_bytes: int | None = None
) -> None:
    """``lookup`` names columns that get bloom filters: equality on them skips row groups in any order of rows."""
    clustered(df, by, n_bytes).write.mode("overwrite").options(**_file_options(rows_per_file, lookup)).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition: str,
    by: Sequence[str],
    rows_per_file: int = 0,
    lookup: Sequence[str] = (),
    n_bytes: int | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """One folder per partition value, each clustered on ``by``.

    Ranges run over (partition, by), so a folder with most of the rows is written by many tasks and a
    task writes to few folders. Null is a folder of its own and reads back as null. ``finish`` gives the rows that are
    written from those that move, in their order.
    """
    writer = finish(clustered(df, [partition, *by], n_bytes)).write.mode("overwrite")
    writer.options(**_file_options(rows_per_file, lookup)).partitionBy(partition).parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan a Parquet table; a missing one is a plain FileNotFoundError.

    With a schema no file is opened before the query runs, and the columns come in its order.
    """
    try:
        if schema is not None:
            return spark.read.schema(schema).parquet(path).select(*schema.names)
        return spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from err
        raise


def export(df: DataFrame, path: str, **options) -> DataFrame:
    """Write a query result as Parquet and return the written table."""
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register_views(frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def pin(df: DataFrame) -> DataFrame:
    """Keep a hot table on the executors, spilling to their disks; a lost block is computed again.

    The caller gives the space back with ``unpersist`` when it is done.
    """
    pinned = df.persist(StorageLevel.MEMORY_AND_DISK)
    pinned.count()
    return pinned
