"""Vectors: encoding, exact inner-product search in blocks, and aggregation to documents."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, FloatType

from lakeloom.session import ship

#: Most query vectors that are broadcast at once, in numbers.
MAX_QUERY_FLOATS = 64_000_000
#: Queries scored at a time, so a block of scores stays small.
QUERY_BLOCK = 256


def hashing_encoder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """A deterministic encoder without a model: signed hashed words, unit length."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for i, t in enumerate(texts):
            for w in re.findall(r"\w+", (t or "").lower()):
                h = xxhash.xxh3_64_intdigest(w)
                out[i, h % dim] += 1.0 if h >> 63 else -1.0
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)

    return encode


def pooled(token_vectors: np.ndarray, mask: np.ndarray, how: str = "mean") -> np.ndarray:
    """One vector a text from its tokens' ``(texts, tokens, dim)``: their mean, the first (``cls``) or the last one of the mask."""
    if how == "mean":
        return (token_vectors * mask[:, :, None]).sum(axis=1) / np.maximum(mask.sum(axis=1), 1)[:, None]
    if how == "cls":
        return token_vectors[:, 0]
    if how == "last":
        return token_vectors[np.arange(len(mask)), np.maximum(mask.shape[1] - 1 - mask[:, ::-1].argmax(axis=1), 0)]
    raise ValueError(f"unknown pooling {how}")


def encode(df: DataFrame, column: str, to: str = "vector", encoder: Callable[[list[str]], np.ndarray] | None = None, done: DataFrame | None = None, key: str = "doc_id", prefix: str = "", normalise: bool = True) -> DataFrame:
    """``df`` with a vector of ``column``; rows whose ``key`` is in ``done`` are skipped (resume).

    ``prefix`` (an instruction, for queries) stands before each text; a null text has a null vector.
    Vectors have unit length with ``normalise``; a zero vector stays.
    """
    ship(df.sparkSession)
    made = encoder or hashing_encoder()

    @F.pandas_udf(ArrayType(FloatType()))
    def run(texts: pd.Series) -> pd.Series:
        known = texts.notna()
        v = np.asarray(made([prefix + t for t in texts[known]]), dtype=np.float32) if known.any() else np.empty((0, 1), dtype=np.float32)
        if normalise:
            size = np.linalg.norm(v, axis=1, keepdims=True)
            v = v / np.where(size > 0, size, 1)
        made_in_order = iter(v)
        return pd.Series([next(made_in_order) if k else None for k in known], dtype=object)

    if done is not None:
        df = df.join(done.select(key), key, "left_anti")
    return df.withColumn(to, run(F.col(column)))


def encode_in_parts(df: DataFrame, path: str, column: str, parts: int, key: str = "doc_id", **options) -> int:
    """Encode ``df`` into ``path`` in ``parts`` by the hash of ``key``; parts that are complete are not made again. Their number."""
    spark = df.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    made = 0
    for p in range(parts):
        place = f"{path}/part={p}"
        done = fs_path(f"{place}/_SUCCESS")
        if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
            continue
        encode(df.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == p), column, **options).write.mode("overwrite").parquet(place)
        made += 1
    return made


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``(query_id, vec_id, score, rank)`` by exact inner product; ties go to the smaller id.

    Every task scores its rows block by block against the broadcast queries and passes on its
    best ``k`` a query. Null vectors and vectors of another length are left out.
    """
    ship(vectors.sparkSession)
    asked = queries.filter(F.col(column).isNotNull()).select("query_id", column)
    if (asked.agg(F.sum(F.size(column))).first()[0] or 0) > MAX_QUERY_FLOATS:
        raise ValueError("too many query vectors for one search; search in parts")
    rows = asked.collect()
    dim = len(rows[0][column]) if rows else 0
    shared = vectors.sparkSession.sparkContext.broadcast((np.array([r.query_id for r in rows], dtype=np.int64), np.array([r[column] for r in rows], dtype=np.float64).reshape(len(rows), dim)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        best_s, best_i = np.empty((len(ids), 0)), np.empty((len(ids), 0), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            v, keys = flat.reshape(-1, q.shape[1]), batch.column(0).to_numpy()
            new_s, new_i = [], []
            for a in range(0, len(ids), QUERY_BLOCK):
                s = np.round(q[a : a + QUERY_BLOCK] @ v.T, 6)
                s = np.concatenate((best_s[a : a + QUERY_BLOCK], s), axis=1)
                i = np.concatenate((best_i[a : a + QUERY_BLOCK], np.broadcast_to(keys, (len(s), len(keys)))), axis=1)
                order = np.lexsort((i, -s), axis=1)[:, :k]
                new_s.append(np.take_along_axis(s, order, axis=1))
                new_i.append(np.take_along_axis(i, order, axis=1))
            best_s, best_i = np.concatenate(new_s), np.concatenate(new_i)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, best_s.shape[1])), pa.array(best_i.ravel()), pa.array(best_s.ravel())], names=["query_id", key, "score"])

    good = vectors.filter(F.col(column).isNotNull() & (F.size(column) == dim)).select(F.col(key).cast("long").alias(key), column)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(key))
    return good.mapInArrow(run, f"query_id long, {key} long, score double").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def best_chunk_per_document(hits: DataFrame, chunk: str = "vec_id", document: str = "doc_id", k: int | None = None) -> DataFrame:
    """``(query_id, doc_id, score, best_chunk, rank)``: a document scores as its best chunk, the earlier rank on ties."""
    per = hits.groupBy("query_id", document).agg(F.max("score").alias("score"), F.min_by(F.col(chunk), F.struct((-F.col("score")).alias("s"), "rank")).alias("best_chunk"))
    ranked = per.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(document))))
    return ranked.filter(F.col("rank") <= k) if k else ranked


def second_best_apart(hits: DataFrame, index: str = "chunk_index", document: str = "doc_id", apart: int = 2) -> DataFrame:
    """Per query and document the best chunk and the next best at least ``apart`` positions away."""
    w = Window.partitionBy("query_id", document)
    first = hits.withColumn("first_index", F.min_by(F.col(index), F.struct((-F.col("score")).alias("s"), F.col(index))).over(w))
    far = first.filter(F.abs(F.col(index) - F.col("first_index")) >= apart)
    return far.groupBy("query_id", document).agg(F.min("first_index").alias("first_index"), F.min_by(F.col(index), F.struct((-F.col("score")).alias("s"), F.col(index))).alias("second_index"))


def snippets(chunks: DataFrame, least_words: int = 120, most_chars: int = 1200) -> DataFrame:
    """``(doc_id, chunk_index, snippet)``: a chunk, with the next one if it has fewer than ``least_words`` words, cut to ``most_chars``."""
    following = chunks.select("doc_id", (F.col("chunk_index") - 1).alias("chunk_index"), F.col("text").alias("following"))
    words = F.size(F.split(F.trim(F.coalesce("text", F.lit(""))), r"\s+"))
    joined = chunks.join(following, ["doc_id", "chunk_index"], "left")
    whole = F.when((words < least_words) & F.col("following").isNotNull(), F.concat_ws(" ", "text", "following")).otherwise(F.coalesce("text", F.lit("")))
    return joined.select("doc_id", "chunk_index", F.substring(whole, 1, most_chars).alias("snippet"))


def rerank(hits: DataFrame, scorer: Callable[[DataFrame], DataFrame], top: int = 200, keep: int = 100) -> DataFrame:
    """The first ``top`` hits in the order of a plug-in score: ``scorer`` adds the column ``rerank_score``."""
    scored = scorer(hits.filter(F.col("rank") <= top))
    w = Window.partitionBy("query_id").orderBy(F.desc("rerank_score"), "rank", "doc_id")
    return scored.withColumn("final_rank", F.row_number().over(w)).filter(F.col("final_rank") <= keep)
