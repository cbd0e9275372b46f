"""Reports over tasks, timings and reviews, and small lookups between tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeloom.functions import columns as C
from lakeloom.schemas import violation

REVIEW = ("review_relevant", "review_complete", "review_clean", "review_title", "review_language")


def error_breakdown(tasks: DataFrame, n: int = 30) -> DataFrame:
    """The commonest combinations of status, error and HTTP status; spellings of an error fall together."""
    error = F.upper(F.regexp_replace(C.strip(F.coalesce("error_type", F.lit(""))), r"[\s-]+", "_"))
    per = tasks.groupBy("status", error.alias("error"), "http_status").agg(F.count(F.lit(1)).alias("n"))
    return per.orderBy(F.desc("n"), "status", "error", F.asc_nulls_first("http_status")).limit(n)


def storage_projection(tasks: DataFrame) -> DataFrame:
    """Bytes and characters of the finished successes, carried to all tasks in proportion."""
    done = F.col("status") == "SUCCESS"
    a = tasks.agg(F.count(F.lit(1)).alias("n_tasks"), F.sum(done.cast("long")).alias("n_done"), F.sum(F.when(done, F.col("bytes_downloaded"))).alias("bytes_done"), F.sum(F.when(done, F.col("text_chars")).cast("long")).alias("chars_done"))
    ratio = F.col("n_tasks") / F.nullif("n_done", F.lit(0))
    return a.select("n_tasks", "n_done", "bytes_done", "chars_done", F.round(F.col("bytes_done") * ratio, 3).alias("bytes_projected"))


def slow_domains(log: DataFrame, n: int = 20, least: int = 5) -> DataFrame:
    """Domains with the longest mean attempt, of those with ``least`` timed attempts."""
    per = log.filter("elapsed_seconds is not null").groupBy("domain").agg(F.count(F.lit(1)).alias("n_attempts"), F.avg("elapsed_seconds").alias("mean_seconds"))
    return per.filter(F.col("n_attempts") >= least).orderBy(F.desc(F.round("mean_seconds", 9)), "domain").limit(n)


def failing_domains(log: DataFrame, n: int = 20) -> DataFrame:
    """Domains with most failed attempts."""
    per = log.groupBy("domain").agg(F.sum((F.col("status") != "SUCCESS").cast("long")).alias("n_failed"), F.count(F.lit(1)).alias("n_attempts"))
    return per.filter("n_failed > 0").orderBy(F.desc("n_failed"), "domain").limit(n)


def review_summary(reviews: DataFrame) -> DataFrame:
    """Per domain and in all (``domain`` null): reviewed, accepted and failures of each criterion.

    A row counts as reviewed when every criterion is a boolean; strings such as "true" are not.
    """
    kinds = dict(reviews.dtypes)
    real = [F.col(c) if kinds.get(c) == "boolean" else F.lit(None).cast("boolean") for c in REVIEW]
    whole = F.lit(True)
    good = F.lit(True)
    for c in real:
        whole = whole & c.isNotNull()
        good = good & F.coalesce(c, F.lit(False))
    fails = [F.sum((whole & ~c).cast("long")).alias(f"n_not_{name[7:]}") for name, c in zip(REVIEW, real)]
    return reviews.rollup("domain").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(whole.cast("long")).alias("n_reviewed"), F.sum((whole & good).cast("long")).alias("n_accepted"), *fails)


def robots_decision(http_status: Column) -> Column:
    """What the status of a site's robots file means for its pages."""
    s = http_status
    return F.when(s.isNull(), "retry").when((s >= 200) & (s < 300), "read").when(s.isin(401, 403), "deny").when((s >= 400) & (s < 500), "allow").when((s >= 520) & (s < 530), "allow for an hour").otherwise("retry")


def script_language(text: Column) -> Column:
    """vi, en, zh or unknown by script and letters alone; texts under 20 characters are unknown."""
    head = text
    han = F.length(F.regexp_replace(head, r"[^\x{3400}-\x{9fff}]", ""))
    marked = F.length(F.regexp_replace(F.lower(head), "[^ăâđêôơưàảãáạằẳẵắặầẩẫấậèẻẽéẹềểễếệìỉĩíịòỏõóọồổỗốộờởỡớợùủũúụừửữứựỳỷỹýỵ]", ""))
    letters = F.length(F.regexp_replace(head, r"[^\p{L}]", ""))
    return F.when(F.coalesce(F.length(text), F.lit(0)) < 20, "unknown").when(han > 0.3 * letters, "zh").when(marked > 0.05 * letters, "vi").when(letters > 0.4 * F.length(head), "en").otherwise("unknown")


def composition(corpus: DataFrame) -> DataFrame:
    """Documents by guessed language and whether they have text."""
    rows = corpus.select("doc_id", script_language(F.col("text")).alias("language_guess"), (F.coalesce(F.length("text"), F.lit(0)) >= 50).alias("has_text")).distinct()
    return rows.groupBy("language_guess", "has_text").agg(F.count(F.lit(1)).alias("n_docs"))


def timing_gaps(log: DataFrame, tasks: DataFrame) -> DataFrame:
    """Violations: finished targets without a timing, timings of unknown targets."""
    keys = log.select("fetch_key").distinct()
    known = tasks.groupBy("fetch_key").agg(F.max(C.is_terminal(F.col("status"))).alias("done"))
    no_time = violation(known.filter("done").join(keys, "fetch_key", "left_anti"), "no timing", F.col("fetch_key"), F.lit(""))
    no_task = violation(keys.join(known, "fetch_key", "left_anti"), "unknown target", F.col("fetch_key"), F.lit(""))
    return no_time.unionByName(no_task)


def needed_chunks(chunks: DataFrame, chunk_ids: DataFrame, doc_ids: DataFrame) -> DataFrame:
    """Chunks wanted by their own id or their document's, each once."""
    by_id = chunks.join(chunk_ids.select("chunk_id").distinct(), "chunk_id", "left_semi").select(*chunks.columns)
    by_doc = chunks.join(doc_ids.select("doc_id").distinct(), "doc_id", "left_semi").select(*chunks.columns)
    return by_id.unionByName(by_doc).dropDuplicates(["chunk_id"])


def allocate_passages(hits: DataFrame, second_for: int = 25, cap: int = 100, apart: int = 2) -> DataFrame:
    """Best chunk a document, a second one at least ``apart`` positions away for the first documents.

    ``hits`` is ``(query_id, doc_id, doc_rank, chunk_index, score)``; the result adds ``slot``,
    the place in the query's answer: first chunks of the leading documents, their seconds, then
    the other documents, ``cap`` in all.
    """
    by_score = F.struct((-F.col("score")).alias("s"), F.col("chunk_index"))
    w = Window.partitionBy("query_id", "doc_id")
    rows = hits.withColumn("best", F.min_by("chunk_index", by_score).over(w))
    first = rows.filter("chunk_index = best").select("query_id", "doc_id", "doc_rank", "chunk_index", F.lit(1).alias("turn"))
    far = rows.filter((F.col("doc_rank") <= second_for) & (F.abs(F.col("chunk_index") - F.col("best")) >= apart))
    second = far.groupBy("query_id", "doc_id", "doc_rank").agg(F.min_by("chunk_index", by_score).alias("chunk_index")).withColumn("turn", F.lit(2))
    part = F.when((F.col("turn") == 1) & (F.col("doc_rank") <= second_for), 1).when(F.col("turn") == 2, 2).otherwise(3)
    both = first.unionByName(second).withColumn("part", part)
    slot = F.row_number().over(Window.partitionBy("query_id").orderBy("part", "doc_rank", "doc_id"))
    return both.withColumn("slot", slot).filter(F.col("slot") <= cap).select("query_id", "doc_id", "chunk_index", "slot")


def wide_passages(chunks: DataFrame, words: int = 600, reach: int = 4) -> DataFrame:
    """Each chunk with neighbours at +1, −1, +2, −2 … up to ``reach`` until it has ``words`` words.

    ``chunks`` is ``(doc_id, chunk_index, text)``; a document's chunks are bounded by its text.
    """
    w = Window.partitionBy("doc_id").orderBy("chunk_index")
    offsets = [o for k in range(1, reach + 1) for o in (k, -k)]
    near = F.array(F.struct(F.lit(0).alias("o"), F.col("text").alias("t")), *(F.struct(F.lit(o).alias("o"), F.lead("text", o).over(w).alias("t")) for o in offsets))
    near = F.filter(near, lambda x: x["t"].isNotNull())
    sized = F.transform(near, lambda x: F.struct(x["o"].alias("o"), x["t"].alias("t"), F.size(F.split(C.strip(x["t"]), r"(?U)\s+")).alias("n")))
    taken = F.aggregate(
        sized, F.struct(F.lit(0).alias("n"), F.slice(sized, 1, 0).alias("a")),
        lambda acc, x: F.when(acc["n"] < words, F.struct((acc["n"] + x["n"]).alias("n"), F.concat(acc["a"], F.array(x)).alias("a"))).otherwise(acc),
    )
    rows = chunks.withColumn("taken", taken)
    return rows.select("doc_id", "chunk_index", F.col("taken.n").alias("n_words"), F.array_join(F.transform(F.array_sort("taken.a"), lambda x: x["t"]), " ").alias("passage"))


def match_captures(tasks: DataFrame, index: DataFrame) -> DataFrame:
    """``(doc_id, archive_status, captured_from)``: FOUND where the index (see ``newest_captures``) has the page."""
    key = F.regexp_replace(C.task_url(F.col("url")), "^https?://", "")
    found = index.select("lookup_key", F.col("url").alias("captured_from"))
    rows = tasks.select("doc_id", key.alias("lookup_key")).join(found, "lookup_key", "left")
    return rows.select("doc_id", F.when(F.col("captured_from").isNotNull(), "FOUND").otherwise("MISS").alias("archive_status"), "captured_from")


def inspect(query_id: int, rankings: dict[str, DataFrame], n: int = 10) -> DataFrame:
    """The first hits of one query in each ranking, side by side by rank."""
    out = None
    for name, hits in rankings.items():
        one = hits.filter((F.col("query_id") == query_id) & (F.col("rank") <= n)).select("rank", F.col("doc_id").alias(name))
        out = one if out is None else out.join(one, "rank", "full_outer")
    return out.orderBy("rank")


def shard_check(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Violations between the files that ``rows`` are read from and ``expected (shard_name, row_count)``."""
    have = rows.groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("shard_name")).agg(F.count(F.lit(1)).alias("n"))
    j = have.join(expected, "shard_name", "full_outer")
    missing = violation(j.filter("n is null"), "shard is missing", F.col("shard_name"), F.col("row_count"))
    foreign = violation(j.filter("row_count is null"), "shard is unknown", F.col("shard_name"), F.col("n"))
    wrong = violation(j.filter("n <> row_count"), "row count differs", F.col("shard_name"), F.col("n"))
    return missing.unionByName(foreign).unionByName(wrong)
