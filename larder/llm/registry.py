"""The queries of this package: a Spark callable by name and, where SQL can say it, the same result as DuckDB SQL."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

import public_tokenizers
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

import larder

Run = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=4)
def _shipped(context: SparkContext) -> str:
    """Send this package to the executors, which need not have it installed."""
    folder = Path(larder.__file__).parent
    # Executors fetch it from the driver for as long as the session lives.
    archive = Path(tempfile.mkdtemp(prefix="run-larder-"), f"{folder.name}-code.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for module in sorted(folder.rglob("*.py")):
            file.write(module, module.relative_to(folder.parent))
    context.addPyFile(str(archive))
    return archive.name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _shipped(spark.sparkContext)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
