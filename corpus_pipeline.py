"""The corpus pipeline: raw documents to token files. Each stage is one operator of ``larder.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontaminate, mixing, shingles, token_files, toxicity
from larder.llm.registry import TOKENIZER, table
from larder.session import materialise

END_ID = 1


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, as learned from the labelled ones that are not held out."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the least doc_id.

    SimHash fingerprints link, as in ``op1``; what they link is checked exactly (0.8 of the five-word shingles), and what they
    miss of that likeness is found by the shingles.
    """
    return shingles.keep_one(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, edited or not."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs, F.array("source"))


def to_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_files.write_and_read(docs, TOKENIZER, END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_copies),
    ("mixing", mix_sources),
    ("token_files", to_token_files),
]

# No SQL for transducers, alignment or token files; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name=name)
    return STAGES[-1][1](spark, docs, sf_dir)
