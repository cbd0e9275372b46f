"""Sources: each reads one of the pipeline's inputs and says what it does with bad rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeloom.functions import columns as C
from lakeloom.schemas import CORPUS_SCHEMA, TIMING_SCHEMA


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of ``paths`` that exist, on any file system Spark can reach."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    return [p for p in paths if (path := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(path)]


def corpus(spark: SparkSession, *paths: str, only_success: bool = True) -> DataFrame:
    """The corpus of several folders; those that are missing are passed over, broken files skipped."""
    there = existing(spark, list(paths))
    if not there:
        return spark.createDataFrame([], CORPUS_SCHEMA)
    rows = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").schema(CORPUS_SCHEMA).parquet(*there)
    return rows.filter("crawl_status = 'SUCCESS'") if only_success else rows


def unread_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``(path)`` of Parquet files below ``paths`` that gave no row: broken or empty ones, which :func:`corpus` passes over."""
    there = existing(spark, list(paths))
    if not there:
        return spark.createDataFrame([], "path string")
    option = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}
    listed = spark.read.format("binaryFile").options(**option).load(there).select("path")
    rows = spark.read.options(ignoreCorruptFiles="true", **option).schema(CORPUS_SCHEMA).parquet(*there)
    return listed.withColumn("plain", F.regexp_replace("path", "^file:/+", "/")).join(rows.select(F.regexp_replace(F.input_file_name(), "^file:/+", "/").alias("plain")).distinct(), "plain", "left_anti").select("path")


def searchable(rows: DataFrame, min_chars: int = 50) -> DataFrame:
    """``(doc_id, title, text)`` of good records with enough text or a title, stripped."""
    good = rows.filter("doc_id is not null and crawl_status = 'SUCCESS'")
    if "curation_status" in rows.columns:
        good = good.filter("curation_status <> 'LOW_QUALITY'")
    out = good.select("doc_id", C.strip(F.coalesce("title", F.lit(""))).alias("title"), C.strip(F.coalesce("text", F.lit(""))).alias("text"))
    return out.filter((F.length("text") >= min_chars) | (F.col("title") != "")).dropDuplicates(["doc_id"])


def links(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` of a link table ``(id or doc_id, url)``; rejected rows have a ``reason``."""
    name = "doc_id" if "doc_id" in rows.columns else "id"
    kind = dict(rows.dtypes)[name]
    raw, whole = F.col(name), F.expr(f"try_cast(`{name}` as bigint)")
    reason = F.when(raw.isNull(), "id is null").when(F.lit(kind == "boolean"), "id is a boolean")
    if kind in ("double", "float"):
        reason = reason.when(raw != F.floor(raw), "id is no integer")
    reason = reason.when(whole.isNull(), "id is no integer").when(C.strip(F.coalesce("url", F.lit(""))) == "", "url is empty")
    checked = rows.select(raw.alias("raw_id"), F.lit(None).cast("long").alias("doc_id") if kind == "boolean" else whole.alias("doc_id"), C.strip(F.col("url")).alias("url"), reason.alias("reason"))
    return checked.filter("reason is null").select("doc_id", "url"), checked.filter("reason is not null").select(F.col("raw_id").cast("string").alias("raw_id"), "url", "reason")


def query_set(rows: DataFrame) -> DataFrame:
    """``(query_id, query)`` from either naming of the columns."""
    q = "query_id" if "query_id" in rows.columns else "id"
    t = "query" if "query" in rows.columns else "query_text"
    return rows.select(F.col(q).cast("long").alias("query_id"), F.col(t).alias("query")).filter("query_id is not null")


def candidate_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ``doc_id`` from Parquet, a JSON list, ``{"doc_ids": [...]}``, or lines of digits."""
    if path.endswith(".json"):
        whole = F.expr("parse_json(value)")
        ids = F.coalesce(F.expr("try_variant_get(v, '$.doc_ids', 'array<bigint>')"), F.expr("variant_get(v, '$', 'array<bigint>')"))
        return spark.read.text(path, wholetext=True).select(whole.alias("v")).select(F.explode(ids).alias("doc_id")).distinct()
    if path.endswith(".txt"):
        return spark.read.text(path).filter(F.col("value").rlike(r"^\s*\d+\s*$")).select(F.trim("value").cast("long").alias("doc_id")).distinct()
    return spark.read.parquet(path).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def timing_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` of a JSON-lines log of attempts; rejected lines have a ``reason``.

    Repeats of an attempt fall together; attempts logged with different values are all rejected.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "").distinct()
    schema = StructType([*TIMING_SCHEMA.fields, StructField("_broken", StringType())])
    parsed = lines.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("r")).select("value", "r.*")
    reason = F.when(F.col("_broken").isNotNull(), "no record").when(F.col("fetch_key").isNull() | (F.trim("fetch_key") == ""), "no fetch_key").when(F.col("attempt").isNull() | (F.col("attempt") < 1), "no attempt number").when(F.col("elapsed_seconds") < 0, "negative seconds")
    checked = parsed.withColumn("reason", reason)
    whole = checked.filter("reason is null").select(*TIMING_SCHEMA.names).distinct()
    n = whole.groupBy("fetch_key", "attempt").agg(F.count(F.lit(1)).alias("n"))
    both = whole.join(n, ["fetch_key", "attempt"]).select(*TIMING_SCHEMA.names, "n")
    clash = both.filter("n > 1").select(F.to_json(F.struct(*TIMING_SCHEMA.names)).alias("line"), F.lit("attempt with different values").alias("reason"))
    return both.filter("n = 1").drop("n"), checked.filter("reason is not null").select(F.col("value").alias("line"), "reason").unionByName(clash)


def profile_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` of a CSV ``domain, estimated_work`` with a header, with or without a byte order mark."""
    rows = spark.read.option("header", "true").csv(path)
    named = rows.toDF(*(c.lstrip("\ufeff").strip() for c in rows.columns))
    if missing := {"domain", "estimated_work"} - set(named.columns):
        raise ValueError(f"the profile has no column {min(missing)}")
    work = F.expr("try_cast(estimated_work as double)")
    seen = named.select("domain", "estimated_work", work.alias("work"), F.count(F.lit(1)).over(Window.partitionBy("domain")).alias("n"))
    reason = F.when(F.col("domain").isNull() | (F.trim("domain") == ""), "no domain").when(F.col("work").isNull() | F.isnan("work") | (F.col("work") < 0), "no amount of work").when(F.col("n") > 1, "domain twice")
    checked = seen.withColumn("reason", reason)
    return checked.filter("reason is null").select("domain", F.col("work").alias("estimated_work")), checked.filter("reason is not null").select("domain", "estimated_work", "reason")


def hits(spark: SparkSession, path: str) -> DataFrame:
    """A ranking ``(query_id, doc_id, rank, score)``; a missing score is null."""
    rows = spark.read.parquet(path)
    score = next((c for c in ("score", "bm25_score") if c in rows.columns), None)
    return rows.select(F.col("query_id").cast("long").alias("query_id"), F.col("doc_id").cast("long").alias("doc_id"), F.col("rank").cast("int").alias("rank"), (F.col(score).cast("double") if score else F.lit(None).cast("double")).alias("score"))


def selection_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A selection of documents; repeated ids raise when the rows are read."""
    rows = spark.read.json(path)
    n = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(n, "doc_id").filter(F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("document twice: "), F.col("doc_id").cast("string"))).cast("boolean")).otherwise(True)).drop("n")


def lookup(rows: DataFrame, url: str | None = None, doc_id: int | None = None) -> DataFrame:
    """Rows of one URL or document; the filter reaches the scan."""
    return rows.filter(F.col("url") == url) if url is not None else rows.filter(F.col("doc_id") == doc_id)
