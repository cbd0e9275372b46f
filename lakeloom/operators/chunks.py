"""Token-budgeted chunks of whole sentences for retrieval."""

from __future__ import annotations

import re
import unicodedata as ud
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeloom.operators.copies import one_per_key
from lakeloom.session import ship

# Abbreviations whose full stop ends no sentence.
ABBREVIATIONS = frozenset(
    ("bs", "ts", "pgs", "gs", "ths", "th.s", "bs.cki", "bs.ckii", "dr", "prof", "mr", "mrs", "ms", "e.g", "i.e", "etc", "v.v", "al", "tp", "p", "q", "no", "vs", "fig", "bv", "cdc", "who")
)
_STOP = re.compile(r"[。！？；]+[”’\"'）)》\]]*|[.!?;]+[”’\"')\]]*(?=\s|$|[“\"'‘])")
_HAN = re.compile(r"[㐀-鿿]")
CHUNKS = "doc_id long, chunk_id string, chunk_index int, title string, heading string, text string, embed_text string, token_count int"


def count_tokens(text: str) -> int:
    """Han characters and a quarter more than the other words; at least 1."""
    return max(1, len(_HAN.findall(text)) + int(1.25 * len(_HAN.sub(" ", text).split())))


def truncate(text: str, budget: int, count: Callable[[str], int] = count_tokens) -> str:
    """The longest run of leading words within ``budget`` tokens."""
    words = text.split()
    low, high = 0, len(words)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if count(" ".join(words[:mid])) <= budget else (low, mid - 1)
    return " ".join(words[:low])


def split_sentences(text: str) -> list[str]:
    """Sentences of a text: line breaks and CJK marks always end one, western marks before a blank."""
    out = []
    for line in ud.normalize("NFC", text or "").split("\n"):
        at = 0
        for m in _STOP.finditer(line):
            if line[m.start()] == ".":
                word = re.search(r"[^\s(\[“\"]*$", line[at : m.start()]).group().lower()
                if word in ABBREVIATIONS or len(word) == 1 and word.isalpha():
                    continue
            if piece := line[at : m.end()].strip():
                out.append(piece)
            at = m.end()
        if piece := line[at:].strip():
            out.append(piece)
    return out


def chunk_document(title: str | None, text: str | None, target: int = 400, most: int = 512, overlap: int = 48, title_budget: int = 64, reserve: int = 8, count: Callable[[str], int] = count_tokens) -> list[tuple[str, str, int]]:
    """``(heading, chunk, tokens)``: sentences up to ``target``, with whole trailing sentences repeated.

    The room is ``most`` less the title's prefix and a reserve, 50 at least; a sentence beyond it
    is cut into windows of words. A document with a title only gives that as its chunk.
    """
    title, text = (title or "").strip(), (text or "").strip()
    if not text:
        return [("", title, count(title))] if title else []
    room = max(50, most - (count(truncate(title, title_budget, count)) if title else 0) - reserve)
    if count(text) <= room:
        return [("", text, count(text))]
    goal, units, heading = min(target, room), [], ""
    for s in split_sentences(text):
        if s.startswith("#"):
            heading = truncate(s.lstrip("# "), 32, count)
        if count(s) <= room:
            units.append((heading, s, count(s)))
            continue
        rest = s.split() if " " in s.strip() else list(s)
        glue = " " if " " in s.strip() else ""
        while rest:
            n = max(1, min(len(rest), int(goal / 1.25) if glue else goal))
            piece = glue.join(rest[:n])
            units.append((heading, piece, count(piece)))
            rest = rest[n:]
    out, now, size = [], [], 0
    for u in units:
        if now and size + u[2] > goal:
            out.append(now)
            kept, used = [], 0
            for v in reversed(now[1:]):  # never the whole chunk again
                if used + v[2] > overlap:
                    break
                kept.insert(0, v)
                used += v[2]
            now, size = (kept, used) if used + u[2] <= room else ([], 0)
        now.append(u)
        size += u[2]
    out.append(now)
    chunks = [(c[0][0], " ".join(u[1] for u in c), 0) for c in out]
    return [(h, t, count(t)) for i, (h, t, _) in enumerate(chunks) if not i or t != chunks[i - 1][1]]


def chunked(docs: DataFrame, version: str = "v1", **limits: int) -> DataFrame:
    """Chunks of ``docs`` ``(doc_id, title, text)``; exact copies of a row are chunked once.

    Rows without anything to chunk go first, so that none stands for another row of its id.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "title", "text", F.coalesce(F.col("text").rlike(r"\S"), F.lit(False)).alias("full")).filter(F.col("doc_id").isNotNull() & (F.col("full") | F.col("title").rlike(r"\S")))
    # A row with a title only counts where its id has no row with text.
    texts = one_per_key(rows.filter("full").drop("full"), "doc_id")
    rows = texts.unionByName(one_per_key(rows.filter("not full").drop("full"), "doc_id").join(texts.select("doc_id"), "doc_id", "left_anti"))

    def run(batches):
        for batch in batches:
            out = []
            for i, title, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                for n, (heading, chunk, tokens) in enumerate(chunk_document(title, text, **limits)):
                    head = " ".join(x for x in (f"[{title.strip()}]" if title and title.strip() else "", f"[{heading}]" if heading else "") if x)
                    out.append({"doc_id": i, "chunk_id": f"{i}_c{n}_{version}", "chunk_index": n, "title": title, "heading": heading, "text": chunk, "embed_text": f"{head} {chunk}".strip(), "token_count": tokens})
            yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    return rows.mapInArrow(run, CHUNKS)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("chunk_id", pa.string()), ("chunk_index", pa.int32()), ("title", pa.string()), ("heading", pa.string()), ("text", pa.string()), ("embed_text", pa.string()), ("token_count", pa.int32())])


def chunk_stats(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count_distinct("doc_id").alias("n_docs"), F.count(F.lit(1)).alias("n_chunks"), F.sum("token_count").alias("n_tokens"), F.avg("token_count").alias("mean_tokens"))


def candidate_chunks(docs: DataFrame, candidates: DataFrame, **limits: int) -> tuple[DataFrame, DataFrame]:
    """``(chunks, missing)``: chunks of the candidate documents and the ids that have no document."""
    ids = candidates.select("doc_id").distinct()
    return chunked(docs.join(ids, "doc_id", "left_semi"), **limits), ids.join(docs, "doc_id", "left_anti")


def lookup(chunks: DataFrame, wanted: DataFrame) -> DataFrame:
    """Chunks by ``wanted (chunk_id)`` or ``(doc_id)``, in order of document and index; ids without chunks give none."""
    key = "chunk_id" if "chunk_id" in wanted.columns else "doc_id"
    return chunks.join(wanted.select(key).distinct(), key, "left_semi").orderBy("doc_id", "chunk_index")


def first_chunks(chunks: DataFrame) -> DataFrame:
    """The chunk of the lowest index of each document."""
    return chunks.groupBy("doc_id").agg(F.min_by(F.struct(*chunks.columns), F.struct("chunk_index", "chunk_id")).alias("c")).select("c.*")
