"""Nested result sets: export, validation of raw JSON, diagnosis and comparison."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeloom.functions import columns as C
from lakeloom.schemas import VIOLATIONS, violation
from lakeloom.operators.selection import PREFIXES

#: Fields a result may not carry.
FORBIDDEN = ("score", "scores", "rank", "title", "metadata", "embedding", "url")


def nested(queries: DataFrame, ranked: DataFrame, selected: DataFrame, max_docs: int = 50) -> DataFrame:
    """``(id, relevant_docs, relevant_chunks)``: every query once, documents by rank without repeats."""
    docs = ranked.groupBy("query_id", "doc_id").agg(F.min("rank").alias("rank"))
    docs = docs.groupBy("query_id").agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda x: x["doc_id"]), 1, max_docs).alias("relevant_docs"))
    chunks = selected.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk_order", "doc_id", "text"))), lambda x: F.struct(x["doc_id"].alias("doc_id"), x["text"].alias("chunk_text"), x["chunk_order"].alias("chunk_order"))).alias("relevant_chunks"))
    rows = queries.select("query_id").distinct().join(docs, "query_id", "left").join(chunks, "query_id", "left")
    empty = F.expr("cast(array() as array<struct<doc_id: bigint, chunk_text: string, chunk_order: int>>)")
    return rows.select(F.col("query_id").alias("id"), F.coalesce("relevant_docs", F.expr("cast(array() as array<bigint>)")).alias("relevant_docs"), F.coalesce("relevant_chunks", empty).alias("relevant_chunks"))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Raw items ``(item_no, raw)`` of a ``.json`` array, or of the one ``.json`` member of a ZIP.

    A plain array is read and cut into items on the cluster. A ZIP holds one compressed stream, which one
    machine must unpack; it is copied to the session's shared folder member by member, not held.
    """
    if path.endswith(".zip"):
        blob = bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])
        with zipfile.ZipFile(io.BytesIO(blob)) as z:
            names = [n for n in z.namelist() if n.endswith(".json")]
            if len(z.namelist()) != 1 or len(names) != 1 or "/" in names[0]:
                raise ValueError("the archive must hold one .json file at its root")
            lines = spark.createDataFrame([(z.read(names[0]).decode("utf-8"),)], "value string")
    else:
        lines = spark.read.text(path, wholetext=True)
    items = lines.select(F.expr("try_variant_get(try_parse_json(value), '$', 'array<variant>')").alias("items"), "value")
    broken = F.raise_error(F.lit("the results must be a JSON array")).cast("array<variant>")
    return items.select(F.posexplode(F.coalesce("items", broken)).alias("item_no", "v")).select("item_no", F.to_json("v").alias("raw"))


def write_results(results: DataFrame, path: str) -> None:
    """One JSON array in a ZIP, item after item: the driver holds one partition's rows at a time."""
    rows = results.orderBy("id").select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j"))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z, z.open("results.json", "w", force_zip64=True) as out:
        out.write(b"[")
        for i, r in enumerate(rows.toLocalIterator()):
            out.write((", " if i else "").encode() + r.j.encode("utf-8"))
        out.write(b"]")


def export(queries: DataFrame, ranked: DataFrame, selected: DataFrame, max_docs: int = 50, target: int = 10, baseline: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(results, deficits)``: :func:`nested`, and ``(id, n_chunks, missing)`` of queries short of ``target`` chunks.

    With ``baseline``, results of an earlier export, its documents and the order of its chunks stand, and
    ``selected`` only gives new texts ``(query_id, doc_id, chunk_order, text)`` where it has any.
    """
    if baseline is None:
        out = nested(queries, ranked, selected, max_docs)
    else:
        chunks = baseline.select(F.col("id").alias("query_id"), F.explode("relevant_chunks").alias("c")).select("query_id", "c.doc_id", "c.chunk_order", F.col("c.chunk_text").alias("old"))
        fresh = selected.groupBy("query_id", "doc_id", "chunk_order").agg(F.max("text").alias("new"))
        kept = chunks.join(fresh, ["query_id", "doc_id", "chunk_order"], "left").select("query_id", "doc_id", "chunk_order", F.coalesce("new", "old").alias("text"))
        docs = baseline.select(F.col("id").alias("query_id"), F.posexplode("relevant_docs").alias("rank", "doc_id"))
        out = nested(queries, docs, kept, max_docs)
    n = F.size("relevant_chunks")
    return out, out.filter(n < target).select("id", n.alias("n_chunks"), (F.lit(target) - n).alias("missing"))


def validate(raw: DataFrame, queries: DataFrame, max_chunks: int = 50, per_doc: int | None = None, corpus: DataFrame | None = None) -> DataFrame:
    """Violations of raw JSON items ``(item_no, raw)``; types are those in the text, never coerced.

    With ``corpus``, documents that it does not have are warnings.
    """
    v = raw.withColumn("v", F.expr("try_parse_json(raw)"))
    kind = F.expr("schema_of_variant(variant_get(v, '$.id', 'variant'))")
    v = v.withColumn("id_kind", kind).withColumn("id", F.expr("try_variant_get(v, '$.id', 'bigint')"))
    v = v.withColumn("docs", F.expr("try_variant_get(v, '$.relevant_docs', 'array<variant>')")).withColumn("chunks", F.expr("try_variant_get(v, '$.relevant_chunks', 'array<variant>')"))
    key = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("item "), F.col("item_no").cast("string")))
    rows = v.withColumn("key", key)
    k, none = F.col("key"), F.lit("")
    out = [
        violation(rows.filter("v is null"), "not JSON", k, none),
        violation(rows.filter("v is not null and (id_kind is null or id_kind <> 'BIGINT')"), "id is no integer", k, F.col("id_kind")),
        violation(rows.filter("v is not null and docs is null"), "relevant_docs is no array", k, none),
        violation(rows.filter("v is not null and chunks is null"), "relevant_chunks is no array", k, none),
    ]
    out.append(violation(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("id is not null and n > 1"), "query twice", F.col("id"), F.col("n")))
    ids = queries.select(F.col("query_id").alias("id")).distinct()
    out.append(violation(ids.join(rows, "id", "left_anti"), "query is missing", F.col("id"), none))
    out.append(violation(rows.filter("id is not null").select("id").join(ids, "id", "left_anti"), "unknown query", F.col("id"), none))
    docs = rows.select("key", F.explode("docs").alias("d")).select("key", F.expr("schema_of_variant(d)").alias("kind"), F.expr("try_variant_get(d, '$', 'bigint')").alias("doc_id"))
    out.append(violation(docs.filter("kind <> 'BIGINT'"), "document id is no integer", k, F.col("kind")))
    out.append(violation(docs.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "document twice", k, F.col("doc_id")))
    ch = rows.select("key", F.posexplode("chunks").alias("pos", "c")).select("key", "pos", F.expr("schema_of_variant(variant_get(c, '$.doc_id', 'variant'))").alias("kind"), F.expr("try_variant_get(c, '$.doc_id', 'bigint')").alias("doc_id"), F.expr("try_variant_get(c, '$.chunk_text', 'string')").alias("text"), F.to_json("c").alias("j"))
    out.append(violation(ch.filter("kind is null or kind <> 'BIGINT'"), "chunk's document id is no integer", k, F.col("kind")))
    out.append(violation(ch.filter("text is null or trim(text) = ''"), "chunk without text", k, F.col("pos")))
    leak = F.lit(False)
    for p in PREFIXES:
        leak = leak | F.lower("text").startswith(p.lower())
    out.append(violation(ch.filter(leak), "prefix leaks", k, F.col("pos")))
    for name in FORBIDDEN:
        out.append(violation(ch.filter(F.get_json_object("j", f"$.{name}").isNotNull()), "forbidden field", k, F.lit(name)))
    known = docs.select("key", "doc_id").distinct()
    out.append(violation(ch.select("key", "doc_id").distinct().join(known, ["key", "doc_id"], "left_anti"), "chunk of no relevant document", k, F.col("doc_id"), "warning"))
    out.append(violation(ch.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_chunks), "too many chunks", k, F.col("n")))
    if corpus is not None:
        out.append(violation(known.filter("doc_id is not null").join(corpus.select("doc_id"), "doc_id", "left_anti"), "document is not in the corpus", k, F.col("doc_id"), "warning"))
    if per_doc:
        out.append(violation(ch.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > per_doc), "too many chunks of a document", k, F.col("doc_id")))
    result = out[0]
    for o in out[1:]:
        result = result.unionByName(o)
    assert result.schema.simpleString().count("string") == VIOLATIONS.count("string,") + 1
    return result


def diagnose(results: DataFrame, target: int = 10) -> DataFrame:
    """One row: queries, chunks and documents a query (min, mean, median, max), coverage and shortfall."""
    per = results.select("id", F.size("relevant_docs").alias("docs"), F.size("relevant_chunks").alias("chunks"), F.size(F.array_distinct(F.transform("relevant_chunks", lambda c: c["doc_id"]))).alias("chunk_docs"))
    return per.agg(
        F.count(F.lit(1)).alias("n_queries"), F.sum("chunks").alias("n_chunks"), F.min("chunks").alias("min_chunks"), F.avg("chunks").alias("mean_chunks"), F.median("chunks").alias("median_chunks"), F.max("chunks").alias("max_chunks"),
        F.median("chunk_docs").alias("median_chunk_docs"), F.sum((F.col("chunks") < target).cast("long")).alias("n_short"), F.sum((F.col("docs") == 0).cast("long")).alias("n_without_docs"),
    )


def chunk_distribution(results: DataFrame, cap: int = 2) -> DataFrame:
    """One row: documents with one, two, three and more chunks of a query's answer, how much of the ranked documents chunks cover, and how many documents exceed ``cap``."""
    per = results.select("id", F.size("relevant_docs").alias("docs"), F.explode_outer("relevant_chunks").alias("c")).groupBy("id", "docs", F.col("c.doc_id").alias("doc_id")).agg(F.count("c").alias("n"))
    each = per.groupBy("id", "docs").agg(*(F.sum((t & F.col("doc_id").isNotNull()).cast("long")).alias(a) for a, t in (("one", F.col("n") == 1), ("two", F.col("n") == 2), ("three", F.col("n") == 3), ("over_two", F.col("n") > 2), ("over_three", F.col("n") > 3), ("over_cap", F.col("n") > cap))), F.count("doc_id").alias("covered"))
    share = F.when(F.col("docs") > 0, F.col("covered") / F.col("docs")).otherwise(F.lit(0.0))
    return each.agg(
        F.sum("one").alias("n_one"), F.sum("two").alias("n_two"), F.sum("three").alias("n_three"), F.sum("over_two").alias("n_over_two"), F.sum("over_three").alias("n_over_three"), F.sum("over_cap").alias("n_over_cap"),
        F.round(F.avg(share), 4).alias("mean_coverage"), F.max("covered").alias("max_docs"),
    )


def compare(new: DataFrame, old: DataFrame) -> DataFrame:
    """Per query of either set: whether the ranking is the same, and the change in chunks."""
    a, b = (d.select("id", F.col("relevant_docs").alias(f"docs_{n}"), F.size("relevant_chunks").alias(f"chunks_{n}")) for d, n in ((new, "new"), (old, "old")))
    j = a.join(b, "id", "full_outer")
    change = F.coalesce("chunks_new", F.lit(0)) - F.coalesce("chunks_old", F.lit(0))
    return j.select("id", F.col("docs_new").eqNullSafe(F.col("docs_old")).alias("same_ranking"), change.alias("chunk_change"), F.when(change > 0, "more").when(change < 0, "fewer").otherwise("same").alias("verdict"))


def comparison_summary(compared: DataFrame) -> DataFrame:
    """One row of :func:`compare`: queries with more, fewer and as many chunks, the net change, and rankings that are not the same."""
    counts = [F.sum((F.col("verdict") == v).cast("long")).alias(f"n_{v}") for v in ("more", "fewer", "same")]
    return compared.agg(F.count(F.lit(1)).alias("n_queries"), *counts, F.sum("chunk_change").alias("net_change"), F.sum((~F.col("same_ranking")).cast("long")).alias("n_other_ranking"))


def passage_diagnosis(results: DataFrame, baseline: DataFrame, most: int = 1024, margin: int = 15) -> DataFrame:
    """One row: how far the passages of ``results`` have grown over those of ``baseline`` at the same place.

    Passages that grew, those that did not, by whether the old one was at the budget, the mean tokens before
    and after, passages within ``margin`` of the budget, and places whose document is not the same.
    """

    def places(r: DataFrame, name: str) -> DataFrame:
        return r.select("id", F.posexplode("relevant_chunks").alias("at", "c")).select("id", "at", F.col("c.doc_id").alias(f"doc_{name}"), F.col("c.chunk_text").alias(f"text_{name}"), C.token_count(F.coalesce("c.chunk_text", F.lit(""))).alias(f"tokens_{name}"))

    j = places(results, "new").join(places(baseline, "old"), ["id", "at"], "left")
    grew = F.coalesce((C.strip(F.col("text_new")) != C.strip(F.col("text_old"))) & (F.col("tokens_new") > F.col("tokens_old")), F.lit(False))
    held = F.col("text_old").isNotNull() & ~grew

    def n(test: Column) -> Column:
        return F.sum(F.coalesce(test, F.lit(False)).cast("long"))

    return j.agg(
        F.count(F.lit(1)).alias("n_passages"), n(grew).alias("n_grown"), n(held & (F.col("tokens_old") >= most)).alias("n_at_budget"), n(held & (F.col("tokens_old") < most)).alias("n_without_source"), n(F.col("tokens_new") >= most - margin).alias("n_near_budget"),
        n(F.col("doc_new") != F.col("doc_old")).alias("n_moved"), F.round(F.avg("tokens_old"), 2).alias("mean_before"), F.round(F.avg("tokens_new"), 2).alias("mean_after"),
    )


def token_distribution(rows: DataFrame, column: str) -> DataFrame:
    """Count, mean, median, nearest-rank 95th percentile, least and most."""
    return rows.agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.median(column).alias("median"), F.expr(f"percentile_disc(0.95) within group (order by {column})").alias("p95"), F.min(column).alias("least"), F.max(column).alias("most"))


def contained_passages(selected: DataFrame) -> DataFrame:
    """Pairs of a query's passages of one document where one holds the other.

    Joined within a query and document, whose passages the selection caps.
    """
    a = selected.select("query_id", "doc_id", F.col("chunk_id").alias("chunk_a"), F.col("text").alias("text_a"))
    b = selected.select("query_id", "doc_id", F.col("chunk_id").alias("chunk_b"), F.col("text").alias("text_b"))
    held = F.contains(F.col("text_a"), F.col("text_b")) | F.contains(F.col("text_b"), F.col("text_a"))
    return a.join(b, ["query_id", "doc_id"]).filter((F.col("chunk_a") < F.col("chunk_b")) & held).select("query_id", "doc_id", "chunk_a", "chunk_b")


def report_text(rows: DataFrame, limit: int = 20) -> str:
    """A fixed-width rendering of a small result table."""
    head = rows.columns
    body = [[("" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v)) for v in r] for r in rows.limit(limit).collect()]
    width = [max([len(h), *(len(b[i]) for b in body)]) for i, h in enumerate(head)]
    return "\n".join("  ".join(c.ljust(w) for c, w in zip(line, width)).rstrip() for line in [head, ["-" * w for w in width], *body])
