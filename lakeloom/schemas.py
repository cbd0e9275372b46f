"""Schemas, statuses, and tables of violations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

# The task statuses, and those that end a task.
UNFINISHED = ("PENDING", "FETCHING", "RETRY_WAIT")
TERMINAL = ("SUCCESS", "FAILED", "TOO_LARGE", "UNSUPPORTED", "EMPTY_CONTENT", "ROBOTS_DENIED", "NEEDS_JS", "NEEDS_OCR")

CORPUS_SCHEMA = StructType(
    [
        StructField("doc_id", LongType(), False),
        StructField("url", StringType(), False),
        StructField("final_url", StringType()),
        StructField("domain", StringType(), False),
        StructField("content_type", StringType()),
        StructField("title", StringType()),
        StructField("text", StringType()),
        StructField("language", StringType()),
        StructField("content_hash", StringType()),
        StructField("http_status", IntegerType()),
        StructField("crawl_status", StringType(), False),
        StructField("text_chars", IntegerType(), False),
        StructField("bytes_downloaded", LongType(), False),
    ]
)
CURATED_SCHEMA = StructType(
    [f for f in CORPUS_SCHEMA if f.name != "bytes_downloaded"] + [StructField("raw_text_chars", IntegerType()), StructField("removed_chars", IntegerType()), StructField("curation_status", StringType())]
)
TIMING_SCHEMA = StructType([StructField("fetch_key", StringType()), StructField("domain", StringType()), StructField("attempt", IntegerType()), StructField("status", StringType()), StructField("elapsed_seconds", DoubleType())])
VIOLATIONS = "check string, severity string, key string, detail string"


def violation(df: DataFrame, check: str, key, detail, severity: str = "error") -> DataFrame:
    """Rows of ``df`` as rows of the violations table ``(check, severity, key, detail)``."""
    return df.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def assert_schema(df: DataFrame, expected: StructType) -> None:
    """Names and types in order; nullability is the writer's affair."""
    have = [(f.name, f.dataType) for f in df.schema]
    want = [(f.name, f.dataType) for f in expected]
    if have != want:
        raise ValueError(f"schema differs: {sorted(map(str, set(have) ^ set(want)))}")


def assert_clean(violations: DataFrame) -> None:
    bad = violations.filter("severity = 'error'").limit(5).collect()
    if bad:
        raise ValueError("; ".join(f"{r['check']} {r['key']}: {r['detail']}" for r in bad))
