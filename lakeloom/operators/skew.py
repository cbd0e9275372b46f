"""Problem 3: per-key results when a few keys hold most rows.

Method: map-side combining. Every task keeps partial aggregates by key, and only these
compact states shuffle, so a hot key costs the reducer one row a task and not one row a
record. All aggregates here are algebraic (count, sum, min, max), which Spark's hash
aggregate combines before the exchange and spills when its table grows; there is nothing to
salt. A count of distinct values goes through a second combined level.

Defined results: the empty string is a key of its own; null keys form one group; nulls in
measures count as nothing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def keyed_totals(df: DataFrame, key: str, measures: dict[str, F.Column]) -> DataFrame:
    """``key`` with its rows (``n_rows``) and the sums of ``measures``, combined map-side."""
    sums = [F.sum(F.coalesce(c.cast("long"), F.lit(0))).alias(name) for name, c in measures.items()]
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def keyed_distinct(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``key`` with its number of distinct non-null values, in two combined levels.

    The first level is keyed by key and value, so no task holds one key's values.
    """
    return df.select(key, value).distinct().groupBy(key).agg(F.count(value).alias(name))


def domain_profile(corpus: DataFrame) -> DataFrame:
    """Records, characters and statuses of every domain: ``(domain, n_rows, n_chars, n_with_text, n_success, n_failed)``."""
    ok = (F.col("crawl_status") == "SUCCESS").cast("int")
    return keyed_totals(
        corpus,
        "domain",
        {"n_chars": F.length("text"), "n_with_text": F.col("text").isNotNull().cast("int"), "n_success": ok, "n_failed": 1 - ok},
    )


def domain_statuses(corpus: DataFrame) -> DataFrame:
    """Rows of every domain by status: ``(domain, crawl_status, n_rows)``."""
    return corpus.groupBy("domain", "crawl_status").agg(F.count(F.lit(1)).alias("n_rows"))


def hot_keys(df: DataFrame, key: str, share: float = 0.05) -> DataFrame:
    """Keys that hold at least ``share`` of all rows.

    The total is the sum of the combined counts, read beside them: one pass over ``df``.
    At most ``1 / share`` keys can qualify, so the threshold is met by the largest of them.
    """
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    top = per.orderBy(F.desc("n_rows"), F.asc(key)).limit(int(1 / share) + 1)
    total = df.agg(F.count(F.lit(1)).alias("total"))  # counted from the files' footers
    return top.filter(F.col("n_rows") >= F.lit(share) * total.scalar()).select(key)
