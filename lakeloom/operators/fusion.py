"""Reciprocal-rank fusion of two rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def _one_hit(hits: DataFrame, name: str) -> DataFrame:
    """One rank a query and document: of several the later (larger) rank stands."""
    return hits.groupBy("query_id", "doc_id").agg(F.max("rank").alias(f"{name}_rank"), F.max_by("score", "rank").alias(f"{name}_score"))


def fuse(lexical: DataFrame, dense: DataFrame, k: int = 60, weights: tuple[float, float] = (1.0, 1.0), top: int = 1000) -> DataFrame:
    """``Σ w / (k + rank)``; order by score, then lexical rank (absent last), then id."""
    both = _one_hit(lexical, "lexical").join(_one_hit(dense, "dense"), ["query_id", "doc_id"], "full_outer")
    part = [F.coalesce(F.lit(w) / (k + F.col(f"{n}_rank")), F.lit(0.0)) for n, w in zip(("lexical", "dense"), weights)]
    scored = both.withColumn("fused_score", F.round(part[0] + part[1], 9))
    w = Window.partitionBy("query_id").orderBy(F.desc("fused_score"), F.coalesce("lexical_rank", F.lit(999_999)), "doc_id")
    return scored.withColumn("final_rank", F.row_number().over(w)).filter(F.col("final_rank") <= top)


def fusion_stats(fused: DataFrame) -> DataFrame:
    """How many fused hits came from both rankings or one."""
    a, b = F.col("lexical_rank").isNotNull(), F.col("dense_rank").isNotNull()
    return fused.agg(F.count(F.lit(1)).alias("n_hits"), F.sum((a & b).cast("long")).alias("n_both"), F.sum((a & ~b).cast("long")).alias("n_lexical_only"), F.sum((~a & b).cast("long")).alias("n_dense_only"))


def with_sentinels(fused: DataFrame) -> DataFrame:
    """Sink form: −1 for absent ranks, 0 for absent scores."""
    return fused.na.fill({"lexical_rank": -1, "dense_rank": -1, "lexical_score": 0.0, "dense_score": 0.0})
