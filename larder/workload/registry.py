"""The registered queries: a Spark callable and, where SQL can say it, the same result as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, body: str | None = None, *ctes: str) -> Callable[[Run], Run]:
    """Register ``run(spark, sf_dir)``; ``body`` is the oracle's SELECT over the named CTE texts."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if body is not None:
            ORACLES[name] = (f"WITH {', '.join(ctes)} " if ctes else "") + body
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

