"""The catalog's expressions as SQL functions, for users who write ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from larder.constants import SCORE_BANDS, SCORE_TOP, TIME_BANDS, TIME_MISSING, TIME_TOP
from larder.functions.text import WHITESPACE, WHITESPACE_CLASS


def _bands_sql(arg: str, op: str, bounds, top: str, missing: str) -> str:
    whens = " ".join(f"WHEN {arg} {op} {bound} THEN '{label}'" for bound, label in bounds)
    return f"CASE WHEN {arg} IS NULL THEN {missing} {whens} ELSE '{top}' END"


def register_sql_functions(spark: SparkSession) -> None:
    """Temporary SQL functions ``normalize_title``, ``nutri_score`` and ``cook_time_cat``."""
    spaces = "".join(f"\\u{ord(ch):04x}" for ch in WHITESPACE)
    bodies = {
        "normalize_title(t STRING) RETURNS STRING": (
            f"btrim(lower(array_join(regexp_extract_all(coalesce(t, ''), r'[a-zA-Z0-9{WHITESPACE_CLASS}]+', 0), '')), '{spaces}')"
        ),
        "nutri_score(kcal DOUBLE) RETURNS STRING": _bands_sql("kcal", "<", SCORE_BANDS, SCORE_TOP, "NULL"),
        "cook_time_cat(minutes BIGINT) RETURNS STRING": _bands_sql(
            "minutes", "<=", TIME_BANDS, TIME_TOP, f"'{TIME_MISSING}'"
        ),
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
