"""Problem 4: splitting oversized texts at natural boundaries.

Method: a recursive hierarchy of separators - section, paragraph, line, sentence, word,
character. Pieces are packed greedily up to the limit and end at the coarsest boundary that
fills them well; each piece after the first repeats a trailing overlap of the one before,
from a sentence's or word's start.

Defined results: null and empty texts have no pieces; a text within the limit, blank ones
included, is one piece; the pieces without their overlaps join to the whole text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from lakeloom.operators.copies import one_per_key
from lakeloom.session import ship

KINDS = ("section", "paragraph", "line", "sentence", "word")
_CUTS = (
    re.compile(r"\n[^\S\n]*(?=#{1,6} )|\n\s*\n\s*\n"),
    re.compile(r"\n[^\S\n]*\n\s*"),
    re.compile(r"\n"),
    re.compile(r"[.!?…]+[\"'”’)\]]*\s+|[。！？]+[”’」』）】]*\s*"),
    re.compile(r"\s+|(?<=[，、；：])"),
)
_EXTENDS = re.compile("[̀-ͯ︀-️‍⃐-⃿]")
SPAN = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("kind", StringType())]))


def spans(text: str, limit: int = 4000, overlap: int = 200) -> list[tuple[int, int, str]]:
    """``(start, end, kind of boundary at the end)`` of each piece, in order."""
    if not 0 <= overlap < limit / 2:
        raise ValueError("the overlap must be under half of the limit")
    n = len(text)
    if n <= limit:
        return [(0, n, "end")] if n else []
    ends = [[m.end() for m in cut.finditer(text)] for cut in _CUTS]

    def furthest(level: int, low: int, high: int) -> int:
        i = bisect_right(ends[level], high)
        return ends[level][i - 1] if i and ends[level][i - 1] > low else 0

    out, start, done = [], 0, 0
    while True:
        high = start + limit
        if high >= n:
            out.append((start, n, "end"))
            return out
        found = [(furthest(k, done, high), kind) for k, kind in enumerate(KINDS)]
        # The coarsest boundary that fills half of the piece, else the coarsest there is.
        end, kind = next(((e, k) for e, k in found if e > done and e - start >= limit // 2), next(((e, k) for e, k in found if e > done), (0, "")))
        if not end:
            end, kind = high, "character"
            while end > done + 1 and _EXTENDS.match(text[end]):
                end -= 1
        out.append((start, end, kind))
        done, start = end, end
        for level in (3, 4):
            i = bisect_left(ends[level], end - overlap)
            if i < len(ends[level]) and ends[level][i] < end:
                start = ends[level][i]
                break


def with_spans(df: DataFrame, limit: int = 4000, overlap: int = 200, column: str = "text") -> DataFrame:
    """``df`` with an array ``spans`` of the pieces' places in ``column``."""
    ship(df.sparkSession)

    @F.pandas_udf(SPAN)
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([[] if t is None else [{"start": a, "end": b, "kind": k} for a, b, k in spans(t, limit, overlap)] for t in texts])

    return df.withColumn("spans", cut(F.col(column)))


def pieces(df: DataFrame, limit: int = 4000, overlap: int = 200, key: str = "doc_id") -> DataFrame:
    """``(doc_id, piece_no, start, end, kind, piece)`` of every text; pieces count from 1.

    ``start`` and ``end`` are character offsets; exact copies of a row give their pieces once,
    and of an id with blank and other texts the others count.
    """
    rows = df.select(key, "text").filter(F.length("text") > 0).withColumn("full", F.col("text").rlike(r"\S"))
    texts = one_per_key(rows.filter("full").drop("full"), key)
    blank = one_per_key(rows.filter("not full").drop("full"), key).join(texts.select(key), key, "left_anti")
    rows = with_spans(texts.unionByName(blank), limit, overlap).select(key, "text", F.posexplode("spans").alias("at", "span"))
    return rows.select(
        key, (F.col("at") + 1).alias("piece_no"), F.col("span.start").alias("start"), F.col("span.end").alias("end"), F.col("span.kind").alias("kind"),
        F.expr("substring(text, span.start + 1, span.end - span.start)").alias("piece"),
    )
