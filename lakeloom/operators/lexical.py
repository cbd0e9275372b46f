"""BM25 ranking of a stated query set against all documents.

``k1 = 1.2``, ``b = 0.75``, ``idf = ln(1 + (N − df + 0.5) / (df + 0.5))``; the fields title and
body are scored apart and summed with their boosts; repeated query tokens count. Scores are
rounded to six places and ties go to the smaller id.

Documents are scored in blocks beside the broadcast queries (their size is checked), and a
block passes on its best ``k`` a query only: no posting is joined or shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakeloom.functions import columns as C
from lakeloom.session import ship, written

K1, B = 1.2, 0.75
#: Most query tokens that are broadcast at once; larger sets are searched in parts.
MAX_QUERY_TOKENS = 2_000_000
#: Queries scored at a time.
QUERY_BLOCK = 256
HITS = "query_id long, doc_id long, score double"


def search(docs: DataFrame, queries: DataFrame, k: int = 1000, boosts: dict[str, float] | None = None) -> DataFrame:
    """``(query_id, doc_id, score, rank)``: the best ``k`` documents a query.

    ``docs`` has ``doc_id`` and the boosted fields, ``queries`` has ``query_id, query``. A
    query without tokens has no hits; a document with score 0 is no hit. Documents are tokenised once,
    into the shared folder; :mod:`lakeloom.operators.index` keeps that for later searches.
    """
    boosts = boosts or {"title": 2.0, "text": 1.0}
    rows = written(docs.select("doc_id", *(C.tokens(F.coalesce(F.col(f), F.lit(""))).alias(f"t_{f}") for f in boosts)), "tokens")
    stats = rows.agg(F.count(F.lit(1)).alias("n_docs"), *(F.avg(F.size(f"t_{f}")).alias(f"avg_{f}") for f in boosts)).first().asDict()

    def frequencies(field: str) -> DataFrame:
        return rows.select(F.explode(F.array_distinct(f"t_{field}")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))

    return score(rows, stats, frequencies, queries, k, boosts)


def score(rows: DataFrame, stats: dict[str, object], frequencies: Callable[[str], DataFrame], queries: DataFrame, k: int, boosts: dict[str, float]) -> DataFrame:
    """Search over tokenised documents ``(doc_id, t_<field> …)`` with their statistics."""
    fields = tuple(boosts)
    spark = rows.sparkSession
    ship(spark)
    asked = queries.select("query_id", F.explode(C.tokens(F.col("query"))).alias("token")).groupBy("query_id", "token").agg(F.count(F.lit(1)).alias("uses"))
    n_asked = asked.count()
    if n_asked > MAX_QUERY_TOKENS:
        raise ValueError("too many query tokens for one search; search in parts")
    wanted = asked.collect()
    terms = spark.createDataFrame([(t,) for t in sorted({r.token for r in wanted})] or [("",)], "token string")
    n = stats["n_docs"]
    idf: dict[str, dict[str, float]] = {}
    for f in fields:
        df = frequencies(f).join(terms, "token", "left_semi").collect()
        idf[f] = {r.token: float(np.log(1 + (n - r.df + 0.5) / (r.df + 0.5))) for r in df}
    ids = sorted({r.query_id for r in wanted})
    at = {q: i for i, q in enumerate(ids)}
    # Blocks of queries, so that a batch's table of scores stays small; in each its terms by number and who uses them.
    blocks = []
    for a in range(0, len(ids), QUERY_BLOCK):
        uses: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for r in wanted:
            if a <= at[r.query_id] < a + QUERY_BLOCK:
                uses[r.token].append((at[r.query_id] - a, r.uses))
        vocabulary = {t: i for i, t in enumerate(sorted(uses))}
        ends = np.cumsum([0] + [len(uses[t]) for t in vocabulary])
        asking = np.array([i for t in vocabulary for i, _ in sorted(uses[t])], dtype=np.int64)
        times = np.array([c for t in vocabulary for _, c in sorted(uses[t])], dtype=float)
        weights = {f: np.array([boosts[f] * idf[f].get(t, 0.0) for t in vocabulary]) for f in fields}
        blocks.append((min(QUERY_BLOCK, len(ids) - a), vocabulary, ends, asking, times, weights))
    shared = spark.sparkContext.broadcast((np.array(ids, dtype=np.int64), blocks, {f: stats[f"avg_{f}"] or 1.0 for f in fields}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, blocks, mean = shared.value
        best = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)) for _ in blocks]
        for batch in batches:
            m = batch.num_rows
            if not m or not len(ids):
                continue
            key = batch.column(0).to_numpy().astype(np.int64)
            flat = []
            for column in batch.columns[1:]:
                size = column.value_lengths().to_numpy(zero_copy_only=False)
                words = column.flatten().dictionary_encode()
                flat.append((size, words.dictionary.to_pylist(), words.indices.to_numpy() if len(words) else np.empty(0, dtype=np.int64)))
            for b, (width, vocabulary, ends, asking, times, weights) in enumerate(blocks):
                table = np.zeros((width, m))
                for f, (size, dictionary, indices) in zip(weights, flat):
                    number = np.array([vocabulary.get(w, -1) for w in dictionary], dtype=np.int64)
                    term = number[indices] if len(indices) else np.empty(0, dtype=np.int64)
                    doc = np.repeat(np.arange(m), size)[term >= 0]
                    pair, tf = np.unique(doc * max(1, len(vocabulary)) + term[term >= 0], return_counts=True)
                    doc, term = np.divmod(pair, max(1, len(vocabulary)))
                    norm = K1 * (1 - B + B * size[doc] / mean[f])
                    part = weights[f][term] * tf * (K1 + 1) / (tf + norm)
                    n = ends[term + 1] - ends[term]  # queries of each pair's term
                    row = np.repeat(np.arange(len(pair)), n)
                    slot = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[term], n)
                    np.add.at(table, (asking[slot], doc[row]), part[row] * times[slot])
                table = np.round(table, 6)
                query, doc = np.nonzero(table > 0)
                q, d, s = (np.concatenate(x) for x in zip(best[b], (query, key[doc], table[query, doc])))
                order = np.lexsort((d, -s, q))
                q, d, s = q[order], d[order], s[order]
                start = np.searchsorted(q, q)  # the first place of each row's query
                keep = np.arange(len(q)) - start < k
                best[b] = q[keep], d[keep], s[keep]
        for b, (q, d, s) in enumerate(best):
            yield pa.RecordBatch.from_arrays([pa.array(ids[q + b * QUERY_BLOCK] if len(q) else np.empty(0, dtype=np.int64)), pa.array(d), pa.array(s)], names=["query_id", "doc_id", "score"])

    parts = rows.select("doc_id", *(f"t_{f}" for f in fields)).mapInArrow(run, HITS)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return parts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def level_stats(hits: DataFrame, levels: tuple[int, ...] = (1, 5, 10, 100, 1000)) -> DataFrame:
    """Per level k: hits, distinct documents and their ratio."""
    rows = hits.withColumn("k", F.explode(F.array(*(F.lit(k) for k in levels)))).filter(F.col("rank") <= F.col("k"))
    per = rows.groupBy("k", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("k").agg(F.sum("n").alias("n_hits"), F.count(F.lit(1)).alias("n_docs")).withColumn("unique_ratio", F.col("n_docs") / F.col("n_hits"))


def union_candidates(hits: DataFrame) -> DataFrame:
    """One row a document found by any query: matches, best rank and score, and its queries in order."""
    return hits.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("match_count"), F.min("rank").alias("best_rank"), F.max("score").alias("best_score"), F.array_sort(F.collect_set("query_id")).alias("query_ids"),
        F.array_sort(F.collect_list(F.struct("rank", "query_id", "score"))).alias("query_matches"),
    )
