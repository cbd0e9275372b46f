"""Sinks; a rerun replaces what it wrote before."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.schemas import CORPUS_SCHEMA, CURATED_SCHEMA, assert_schema


def write_corpus(rows: DataFrame, path: str, rows_per_file: int = 10_000) -> None:
    """Corpus shards of bounded size; the committer makes the write atomic."""
    assert_schema(rows, CORPUS_SCHEMA)
    rows.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_curated(rows: DataFrame, path: str, rows_per_file: int = 10_000) -> None:
    """Curated records: only CLEAN ones, in the curated schema, in shards of bounded size."""
    clean = rows.filter("curation_status = 'CLEAN'").select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in CURATED_SCHEMA))
    clean.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)


def _facts(spark: SparkSession, path: str, **facts: object) -> None:
    spark.createDataFrame([(json.dumps(facts, sort_keys=True, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_chunks(chunks: DataFrame, path: str, missing: DataFrame | None = None, version: str = "v1", rows_per_file: int = 50_000) -> None:
    """``chunks``, ``manifest`` (counts and tokens) and, with ``missing``, ``missing`` identifiers as JSON lines, below ``path``."""
    spark = chunks.sparkSession
    chunks.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/chunks")
    done = spark.read.parquet(f"{path}/chunks")
    stats = done.agg(F.count(F.lit(1)).alias("n_chunks"), F.count_distinct("doc_id").alias("n_docs"), F.sum("token_count").alias("n_tokens")).first().asDict()
    if missing is not None:
        missing.select("doc_id").distinct().write.mode("overwrite").json(f"{path}/missing")
        stats["n_missing"] = spark.read.schema("doc_id long").json(f"{path}/missing").count()
    _facts(spark, f"{path}/manifest", version=version, **stats)


def write_partitions(assigned: DataFrame, path: str, rows_per_file: int = 500_000, spread: int = 16) -> None:
    """``links``, a folder a worker of files of bounded size, and ``summary``, a row a worker.

    A worker's rows are written by ``spread`` tasks, so that no worker is one task.
    """
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(spread))
    assigned.repartition("worker_id", salt).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("worker_id").parquet(f"{path}/links")
    done = assigned.sparkSession.read.parquet(f"{path}/links")
    done.groupBy("worker_id").agg(F.count(F.lit(1)).alias("n_urls"), F.count_distinct("domain").alias("n_domains")).coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{path}/summary")


def write_merged(winners: DataFrame, conflicts: DataFrame, path: str, rows_per_file: int = 10_000) -> None:
    """A merged corpus: ``corpus`` shards, ``conflicts`` as JSON lines, ``summary`` by status."""
    write_corpus(winners, f"{path}/corpus", rows_per_file)
    conflicts.write.mode("overwrite").json(f"{path}/conflicts")
    done = winners.sparkSession.read.parquet(f"{path}/corpus")
    done.groupBy("crawl_status").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("text_chars").cast("long")).alias("chars")).coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def write_hits(hits: DataFrame, path: str) -> None:
    """Parquet, and CSV with six places of the score."""
    hits.write.mode("overwrite").parquet(f"{path}/parquet")
    hits.withColumn("score", F.format_string("%.6f", F.col("score"))).write.mode("overwrite").option("header", "true").csv(f"{path}/csv")
