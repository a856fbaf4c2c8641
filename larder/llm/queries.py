"""One registered query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontaminate, lines, mixing, repeats, runs, simhash, spellings, spotsigs, token_counts, token_files, toxicity, url_aliases, warc_audit
from larder.llm.common import n_bytes
from larder.llm.registry import TOKENIZER, Run, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of every document: doc_id, fingerprint, component_id."""
    found = simhash.clusters(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and both likenesses."""
    return spotsigs.edits(table(spark, sf_dir, "documents"))


def op3_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated 400-byte strings: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared."""
    return repeats.report(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document in seekable files, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_files.write_and_read(table(spark, sf_dir, "documents"), TOKENIZER, end_id=1)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from rows that are not held out: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.with_scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    predicted = F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", toxicity.is_held_out("doc_id").alias("held_out"), "score", predicted)


def op6_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's archive record against a replica with planted damage: where it lies, its hash, its status."""
    pages = table(spark, sf_dir, "pages")
    return warc_audit.report(pages, warc_audit.damaged_copy(pages))


def op7_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by rules, or else by its aliases: page_id, host, path, rule, verdict."""
    return url_aliases.verdicts(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, edited or not: doc_id, item_id, similarity, end_word."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document: doc_id, n_bytes, n_tokens, over_limit."""
    counted = token_counts.with_token_counts(table(spark, sf_dir, "documents"), TOKENIZER, limit=2048)
    return counted.select("doc_id", n_bytes("text").alias("n_bytes"), "n_tokens", "over_limit")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in the mix: doc_id, size, source_size, target, taken."""
    return mixing.report(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that many hold: doc_id, n_lines, n_dropped, kept_sha256."""
    return lines.report(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the frequent spelling it stands for: word, form, root, n, n_near, form_n."""
    return spellings.report(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs of words, some planted, the greatest one and digests of all and of what is left."""
    return runs.report(table(spark, sf_dir, "documents"))


# fmt: off
QUERIES: dict[str, Run] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_spotsigs, op3_suffix_repeats, op4_token_files, op5_toxicity, op6_warc_audit,
        op7_url_aliases, op8_decontaminate, op9_token_counts, op10_mixing,
        op11_line_dedup, op12_spelling_variants, op13_periodic_runs,
    )
}
# fmt: on
ORACLES: dict[str, str] = {"op6_warc_audit": warc_audit.ORACLE, "op7_url_aliases": url_aliases.ORACLE, "op11_line_dedup": lines.ORACLE}
