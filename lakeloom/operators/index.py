"""Persisted indexes: tokens and statistics for BM25, vectors and identifiers for dense search.

An index is a folder of Parquet tables and a one-row ``manifest``. It is built once, by
one pass over the texts, and searched without them. Opening one checks that it was made
in the way that the reader asks for.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.functions import columns as C
from lakeloom.operators import dense, lexical


def fingerprint(config: dict[str, object]) -> str:
    """First 16 hex figures of the SHA-256 of a configuration, in the order of its names."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()[:16]


def _manifest(spark: SparkSession, path: str, **facts: object) -> None:
    spark.createDataFrame([(json.dumps(facts, sort_keys=True, ensure_ascii=False),)], "manifest string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> dict[str, object]:
    return json.loads(spark.read.text(f"{path}/manifest").first().value)


def merged(docs: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """One row a document: of repeated ids the longest text counts, and the largest of equal length."""
    order = F.struct(*(F.length(F.coalesce(F.col(f), F.lit(""))) for f in reversed(fields)), *(F.coalesce(F.col(f), F.lit("")) for f in fields))
    tokens = [C.tokens(F.coalesce(F.col(f), F.lit(""))).alias(f"t_{f}") for f in fields]
    # Only tokens and the order are moved, not the rows of a table of other columns.
    return docs.filter("doc_id is not null").groupBy("doc_id").agg(F.max_by(F.struct(*(F.col(f) for f in fields)), order).alias("d")).select("doc_id", "d.*").select("doc_id", *tokens)


def build_tokens(docs: DataFrame, path: str, fields: tuple[str, ...] = ("title", "text"), rows_per_file: int = 100_000) -> None:
    """Write the token index of ``docs`` ``(doc_id, *fields)``: tokens, document frequencies, means, manifest."""
    spark = docs.sparkSession
    merged(docs, fields).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/tokens")
    rows = spark.read.parquet(f"{path}/tokens")
    each = [rows.select(F.lit(f).alias("field"), F.explode(F.array_distinct(f"t_{f}")).alias("token")) for f in fields]
    both = each[0]
    for e in each[1:]:
        both = both.unionByName(e)
    both.groupBy("field", "token").agg(F.count(F.lit(1)).alias("df")).write.mode("overwrite").partitionBy("field").parquet(f"{path}/frequencies")
    stats = rows.agg(F.count(F.lit(1)).alias("n_docs"), *(F.avg(F.size(f"t_{f}")).alias(f"avg_{f}") for f in fields)).first().asDict()
    _manifest(spark, path, kind="tokens", fields=list(fields), **stats)


@dataclass(frozen=True)
class TokenIndex:
    """An opened token index."""

    tokens: DataFrame
    frequencies: DataFrame
    facts: dict[str, object]

    def search(self, queries: DataFrame, k: int = 1000, boosts: dict[str, float] | None = None) -> DataFrame:
        """``(query_id, doc_id, score, rank)``; see :func:`lakeloom.operators.lexical.search`."""
        boosts = boosts or {"title": 2.0, "text": 1.0}
        if missing := [f for f in boosts if f not in self.facts["fields"]]:
            raise ValueError(f"the index has no field {missing[0]}")
        stats = {"n_docs": self.facts["n_docs"]} | {f"avg_{f}": self.facts[f"avg_{f}"] for f in boosts}
        rows = self.tokens.select("doc_id", *(f"t_{f}" for f in boosts))
        return lexical.score(rows, stats, lambda f: self.frequencies.filter(F.col("field") == f).select("token", "df"), queries, k, boosts)


def open_tokens(spark: SparkSession, path: str) -> TokenIndex:
    facts = manifest(spark, path)
    if facts.get("kind") != "tokens":
        raise ValueError("no token index")
    return TokenIndex(spark.read.parquet(f"{path}/tokens"), spark.read.parquet(f"{path}/frequencies"), facts)


def build_vectors(vectors: DataFrame, path: str, config: dict[str, object], key: str = "vec_id", column: str = "embedding", rows_per_file: int = 100_000) -> None:
    """Write vectors with their id map (the key and, where there, ``doc_id`` and ``chunk_index``) and the encoder's configuration."""
    spark = vectors.sparkSession
    keep = [c for c in (key, "doc_id", "chunk_index") if c in vectors.columns]
    vectors.filter(F.col(column).isNotNull()).select(*dict.fromkeys(keep), F.col(column).alias("embedding")).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/vectors")
    stats = spark.read.parquet(f"{path}/vectors").agg(F.count(F.lit(1)).alias("n"), F.min(F.size("embedding")).alias("lo"), F.max(F.size("embedding")).alias("hi")).first()
    if stats.lo != stats.hi:
        raise ValueError(f"vectors of {stats.lo} to {stats.hi} numbers")
    _manifest(spark, path, kind="vectors", key=key, n=stats.n, dim=stats.hi, config=config, fingerprint=fingerprint(config))


@dataclass(frozen=True)
class VectorIndex:
    vectors: DataFrame
    facts: dict[str, object]

    def search(self, queries: DataFrame, k: int = 500) -> DataFrame:
        """``(query_id, key, score, rank)``; see :func:`lakeloom.operators.dense.top_k`."""
        return dense.top_k(self.vectors, queries, k, key=str(self.facts["key"]))

    def ids(self) -> DataFrame:
        return self.vectors.drop("embedding")


def open_vectors(spark: SparkSession, path: str, config: dict[str, object] | None = None) -> VectorIndex:
    """Raises where ``config`` names another encoder, pooling, normalisation or prefix than the index was made with."""
    facts = manifest(spark, path)
    if facts.get("kind") != "vectors":
        raise ValueError("no vector index")
    if config is not None and fingerprint(config) != facts["fingerprint"]:
        differ = sorted(k for k in config.keys() | facts["config"].keys() if config.get(k) != facts["config"].get(k))
        raise ValueError(f"the index was made with another {', '.join(differ)}")
    return VectorIndex(spark.read.parquet(f"{path}/vectors"), facts)
