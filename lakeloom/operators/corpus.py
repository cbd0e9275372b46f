"""Merging, recovering, pruning and verifying corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.functions import columns as C
from lakeloom.schemas import TERMINAL, violation

# Which status wins when a document was fetched several times.
STATUS_RANK = {"FAILED": 1, "ROBOTS_DENIED": 2, "UNSUPPORTED": 3, "TOO_LARGE": 4, "EMPTY_CONTENT": 5, "NEEDS_JS": 6, "NEEDS_OCR": 7, "SUCCESS": 8}


def status_rank(status: Column) -> Column:
    """Statuses outside the table rank lowest instead of stopping a merge."""
    out = F.lit(0)
    for s, r in STATUS_RANK.items():
        out = F.when(status == s, r).otherwise(out)
    return out


def winners(rows: DataFrame) -> DataFrame:
    """One whole row a document: best status, then a content hash, more characters, then a stable order.

    An aggregate with map-side combining; no document's versions meet before it.
    """
    key = F.struct(status_rank(F.col("crawl_status")), F.col("content_hash").isNotNull(), F.coalesce("text_chars", F.lit(0)), F.coalesce("http_status", F.lit(0)), F.coalesce("content_hash", F.lit("")), F.coalesce("text", F.lit("")), F.col("crawl_status"), F.coalesce("bytes_downloaded", F.lit(0)))
    return rows.groupBy("doc_id").agg(F.max_by(F.struct(*rows.columns), key).alias("w")).select("w.*")


def merge_conflicts(rows: DataFrame) -> DataFrame:
    """Documents whose versions differ: ``(doc_id, n_versions, n_urls, n_statuses)``."""
    v = rows.select("doc_id", "url", "crawl_status", "content_hash").distinct()
    return v.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_versions"), F.count_distinct("url").alias("n_urls"), F.count_distinct("crawl_status").alias("n_statuses")).filter("n_versions > 1")


def recovery_merge(base: DataFrame, updates: DataFrame, order: str) -> DataFrame:
    """``base`` after ``updates`` in ``order``: an update stands unless it would demote a success."""
    columns = base.columns
    both = base.withColumn("_n", F.lit(None).cast("long")).unionByName(updates.withColumn("_n", F.col(order).cast("long")).select(*columns, "_n"))
    # The last success wins; without any, the last row does.
    key = F.struct((F.col("crawl_status") == "SUCCESS").cast("int"), F.coalesce("_n", F.lit(-1)))
    return both.groupBy("doc_id").agg(F.max_by(F.struct(*columns), key).alias("w")).select("w.*")


def prune(corpus: DataFrame, wanted: DataFrame, min_chars: int = 50) -> DataFrame:
    """Whole rows of wanted documents with enough text, one a document."""
    good = corpus.filter((F.col("crawl_status") == "SUCCESS") & (F.length("text") >= min_chars))
    return winners(good.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").select(*corpus.columns))


def missing(wanted: DataFrame, kept: DataFrame, halves: int = 2) -> DataFrame:
    """Wanted documents that are not kept, with the part of the work they fall into."""
    gone = wanted.select("doc_id").distinct().join(kept.select("doc_id"), "doc_id", "left_anti")
    return gone.withColumn("part", F.pmod(F.col("doc_id"), F.lit(halves)).cast("int"))


def verify(corpus: DataFrame, tasks: DataFrame) -> DataFrame:
    """Violations: documents without a task, finished tasks without a row, stale lengths, foreign statuses."""
    ids = corpus.select("doc_id").distinct()
    no_task = violation(ids.join(tasks, "doc_id", "left_anti"), "no task", F.col("doc_id"), F.lit(""))
    done = tasks.filter(F.col("status").isin(*TERMINAL)).select("doc_id", "status")
    no_row = violation(done.join(ids, "doc_id", "left_anti"), "no row", F.col("doc_id"), F.col("status"))
    stale = violation(corpus.filter(F.col("text_chars") != F.coalesce(F.length("text"), F.lit(0))).select("doc_id").distinct(), "stale length", F.col("doc_id"), F.lit(""), "warning")
    foreign = violation(corpus.filter(~F.col("crawl_status").isin(*TERMINAL)).select("doc_id", "crawl_status").distinct(), "foreign status", F.col("doc_id"), F.col("crawl_status"), "warning")
    return no_task.unionByName(no_row).unionByName(stale).unionByName(foreign)


# The last identifier of the Vietnamese part of the link table, hosts that belong to it, and the host of abstracts.
VIETNAMESE_UPTO = 766_441
VIETNAMESE_HOSTS = ("hellobacsi.com", "youmed.vn", "thaythuocvietnam.vn")
ABSTRACT_HOST = "pubmed.ncbi.nlm.nih.gov"


def corpus_class(doc_id: Column, url: Column) -> Column:
    """``abstract``, ``vi`` or ``zh``: the part of the corpus that a link belongs to."""
    host = F.coalesce(C.domain_from_url(url), F.lit("unknown"))
    known = host.endswith(".vn")
    for h in VIETNAMESE_HOSTS:
        known = known | F.contains(host, F.lit(h))
    return F.when(F.contains(F.lower(F.coalesce(url, F.lit(""))), F.lit(ABSTRACT_HOST)), "abstract").when((doc_id <= VIETNAMESE_UPTO) | known, "vi").otherwise("zh")


def classed_delta(wanted: DataFrame, kept: DataFrame, halves: int = 2) -> DataFrame:
    """``(doc_id, url, corpus_class, part)`` of wanted links that are not kept; abstracts are split into ``halves`` by their identifier."""
    gone = wanted.select("doc_id", "url").distinct().join(kept.select("doc_id"), "doc_id", "left_anti")
    named = gone.withColumn("corpus_class", corpus_class(F.col("doc_id"), F.col("url")))
    return named.withColumn("part", F.when(F.col("corpus_class") == "abstract", F.pmod(F.col("doc_id"), F.lit(halves))).otherwise(F.lit(0)).cast("int"))


def abstract_id(url: Column) -> Column:
    """The last segment of an abstract's URL, its identifier there."""
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def abstract_records(links: DataFrame, answers: DataFrame) -> DataFrame:
    """Corpus rows of ``links (doc_id, url)`` from ``answers (pmid, title, abstract)``, one row a link.

    The abstract is the text, else the title; without an answer the record is NOT_FOUND, without
    either EMPTY_CONTENT. Of several answers of an identifier the one with the longest abstract counts.
    """
    best = answers.filter("pmid is not null").groupBy("pmid").agg(F.max_by(F.struct("title", "abstract"), F.struct(F.length(F.coalesce("abstract", F.lit(""))), F.coalesce("abstract", F.lit("")), F.coalesce("title", F.lit("")))).alias("a"))
    rows = links.select("doc_id", "url").dropDuplicates(["doc_id"]).withColumn("pmid", abstract_id(F.col("url"))).join(best, "pmid", "left")
    found = F.col("a").isNotNull()
    title, body = F.coalesce("a.title", F.lit("")), F.coalesce("a.abstract", F.lit(""))
    text = F.when(body != "", body).otherwise(title)
    made = rows.select("doc_id", "url", F.lit(ABSTRACT_HOST).alias("domain"), title.alias("title"), text.alias("text"), found.alias("found"))
    status = F.when(~F.col("found"), "NOT_FOUND").when(F.col("text") != "", "SUCCESS").otherwise("EMPTY_CONTENT")
    return made.select(
        "doc_id", "url", F.col("url").alias("final_url"), "domain", F.lit("application/json").alias("content_type"), "title", "text", F.lit("en").alias("language"), F.sha2("text", 256).alias("content_hash"),
        F.when(F.col("found"), 200).otherwise(404).alias("http_status"), status.alias("crawl_status"), F.length("text").alias("text_chars"), F.octet_length("text").cast("long").alias("bytes_downloaded"),
    )


def merged(rows: DataFrame, tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(winners, violations)`` of a merge: rows whose URL is not their task's are rejected before it.

    Violations: such rows, rows without a task, and finished tasks without any row.
    """
    known = tasks.groupBy("doc_id").agg(F.min("url").alias("task_url"), F.max(F.col("status").isin(*TERMINAL)).alias("done"))
    j = rows.join(known, "doc_id", "left")
    foreign = F.col("task_url").isNotNull() & (F.col("task_url") != F.col("url"))
    good = j.filter(F.col("task_url").isNotNull() & ~foreign).select(*rows.columns)
    bad = violation(j.filter(foreign), "another URL than the task's", F.col("doc_id"), F.col("url"))
    lone = violation(j.filter("task_url is null"), "no task", F.col("doc_id"), F.col("url"))
    lost = violation(known.filter("done").join(good.select("doc_id"), "doc_id", "left_anti"), "no row", F.col("doc_id"), F.col("task_url"))
    return winners(good), bad.unionByName(lone).unionByName(lost)
