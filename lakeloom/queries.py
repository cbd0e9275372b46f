"""Queries of the core operators; their SQL is in :mod:`lakeloom.oracle`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeloom import oracle
from lakeloom.functions import columns as C
from lakeloom.operators import archive, chunks, cleaning, corpus as merging, dense, extraction, fusion, lexical, planning, profile, reports, results, sampling, selection, skew, state
from lakeloom.session import table, written
from lakeloom.streaming import flows

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


@query
def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return skew.hot_keys(table(spark, sf, "corpus"), "domain", 0.05)


@query
def p3_domains(spark: SparkSession, sf: str) -> DataFrame:
    return skew.domain_profile(table(spark, sf, "corpus"))


@query
def p3_statuses(spark: SparkSession, sf: str) -> DataFrame:
    return skew.domain_statuses(table(spark, sf, "corpus"))


@query
def url_keys(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf, "corpus").select("doc_id", C.normalize_fetch_url(u).alias("normalized_url"), C.domain_from_url(u).alias("host"), C.fetch_key(u).alias("fetch_key"), C.is_pdf_like(u).alias("is_pdf")).distinct()


@query
def source_report(spark: SparkSession, sf: str) -> DataFrame:
    return profile.source_report(table(spark, sf, "crawl_tasks"))


@query
def query_params(spark: SparkSession, sf: str) -> DataFrame:
    return profile.query_params(table(spark, sf, "crawl_tasks"))


@query
def top_domains(spark: SparkSession, sf: str) -> DataFrame:
    return profile.top_values(table(spark, sf, "corpus"), "domain", 20)


@query
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.status_counts(table(spark, sf, "crawl_tasks"))


@query
def domain_status_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return profile.domain_status_matrix(table(spark, sf, "crawl_tasks"))


@query
def content_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return profile.content_duplicates(table(spark, sf, "corpus"))


@query
def fetch_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return state.fan_out(table(spark, sf, "crawl_tasks"))


@query
def target_timings(spark: SparkSession, sf: str) -> DataFrame:
    return profile.target_timings(table(spark, sf, "timing_log")).withColumn("seconds", F.round("seconds", 6))


@query
def timing_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Over the log with some first attempts logged again with another status."""
    log = table(spark, sf, "timing_log").select("fetch_key", "attempt", "status")
    again = log.filter("attempt = 1 and fetch_key like '%0'").withColumn("status", F.lit("PLANTED"))
    return profile.timing_conflicts(log.unionByName(again))


@query
def latency_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.latency_profile(table(spark, sf, "timing_log")).select("domain", "n", *(F.round(c, 9).alias(c) for c in ("median_seconds", "p95_seconds", "cost")))


@query
def domain_work(spark: SparkSession, sf: str) -> DataFrame:
    rows = profile.domain_profile(table(spark, sf, "crawl_tasks"), table(spark, sf, "timing_log"))
    return rows.select("domain", "n_urls", "sample_count", F.round("seconds_per_url", 6).alias("seconds_per_url"), F.round("estimated_work", 4).alias("estimated_work"))


@query
def risk_scores(spark: SparkSession, sf: str) -> DataFrame:
    return profile.risk_scores(table(spark, sf, "corpus")).withColumn("reasons", F.when(F.size("reasons") > 0, F.array_join(F.array_sort("reasons"), ",")))


@query
def risk_summary(spark: SparkSession, sf: str) -> DataFrame:
    return profile.risk_summary(profile.risk_scores(table(spark, sf, "corpus"))).withColumn("mean_risk", F.round("mean_risk", 6))


@query
def audit_high_risk(spark: SparkSession, sf: str) -> DataFrame:
    """The riskiest records, ten a domain at most."""
    order = [F.desc("risk"), F.asc("key"), F.asc("doc_id")]
    rows = profile.risk_scores(table(spark, sf, "corpus")).withColumn("key", C.stable_key("audit", F.col("doc_id")))
    return sampling.capped_by_order(rows, "domain", order, 10, 100).select("doc_id", "domain", "risk")


@query
def audit_stratified(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified(profile.risk_scores(table(spark, sf, "corpus")), "domain", "doc_id", 100).select("doc_id", "domain", "risk")


@query
def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "corpus").select("doc_id", "domain").distinct()
    return sampling.smallest_hashes(rows, "domain", "doc_id", 20).select("domain", "doc_id", "score", "rank_in_group")


@query
def review_interleave(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "corpus").filter("crawl_status = 'SUCCESS'").select("doc_id", "domain", "content_type").distinct()
    return sampling.interleave(rows, ["domain", "content_type"], "doc_id", 50).select("domain", "content_type", "doc_id", "turn")


@query
def spread_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "corpus").filter("text is not null").select("doc_id", "domain", F.length("text").alias("n")).distinct()
    return sampling.spread_sample(rows, "domain", "n", "doc_id").select("domain", "doc_id", "n", "place")


@query
def pilot_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.pilot(table(spark, sf, "crawl_tasks"), 100)


@query
def clean_hashes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", C.content_hash(F.col("text")).alias("content_hash"))


@query
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", C.token_count(t).alias("n_tokens"), F.size(C.tokens(t)).cast("long").alias("n_terms"))


@query
def first_words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", C.first_words(F.col("text"), 20).alias("head"), C.dedup_form(F.col("title")).alias("title_form"))


@query
def worker_plan(spark: SparkSession, sf: str) -> DataFrame:
    work = profile.domain_profile(table(spark, sf, "crawl_tasks"), table(spark, sf, "timing_log")).select("domain", "estimated_work")
    return planning.worker_summary(planning.assign(table(spark, sf, "crawl_tasks").select("doc_id", "url"), work))


@query
def merge_winners(spark: SparkSession, sf: str) -> DataFrame:
    return merging.winners(table(spark, sf, "corpus")).select("doc_id", "url", "crawl_status", "text_chars", "content_hash")


@query
def merge_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return merging.merge_conflicts(table(spark, sf, "corpus"))


@query
def recovery_states(spark: SparkSession, sf: str) -> DataFrame:
    tasks, log = table(spark, sf, "crawl_tasks"), table(spark, sf, "timing_log")
    updates = log.select("fetch_key", F.col("status").alias("crawl_status"), F.unix_micros("logged_at").alias("n")).join(tasks.select("doc_id", "fetch_key"), "fetch_key")
    return merging.recovery_merge(tasks.select("doc_id", F.col("status").alias("crawl_status")), updates, "n")


@query
def prune_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return merging.prune(table(spark, sf, "corpus"), table(spark, sf, "crawl_tasks")).select("doc_id", "url", "text_chars", F.length("text").cast("long").alias("n_chars"))


@query
def missing_delta(spark: SparkSession, sf: str) -> DataFrame:
    good = table(spark, sf, "corpus").filter((F.col("crawl_status") == "SUCCESS") & (F.length("text") >= 50)).select("doc_id")
    return merging.missing(table(spark, sf, "crawl_tasks"), good)


@query
def corpus_checks(spark: SparkSession, sf: str) -> DataFrame:
    return merging.verify(table(spark, sf, "corpus"), table(spark, sf, "crawl_tasks"))


@query
def due_tasks(spark: SparkSession, sf: str) -> DataFrame:
    return state.due(table(spark, sf, "crawl_tasks"), oracle.NOW).select("doc_id", "status", "attempts")


@query
def fair_claim(spark: SparkSession, sf: str) -> DataFrame:
    return state.fair_claim(table(spark, sf, "crawl_tasks"), oracle.NOW, 100)


@query
def claimed_state(spark: SparkSession, sf: str) -> DataFrame:
    tasks = table(spark, sf, "crawl_tasks")
    return state.claim(tasks, state.fair_claim(tasks, oracle.NOW, 100)).select("doc_id", "status", "attempts")


@query
def settled_state(spark: SparkSession, sf: str) -> DataFrame:
    outcomes = table(spark, sf, "timing_log").select("fetch_key", F.col("status").alias("outcome"), "retryable")
    return state.settle(table(spark, sf, "crawl_tasks"), outcomes, oracle.NOW).select("doc_id", "status", "attempts", F.round("next_retry_at", 3).alias("next_retry_at"))


@query
def recovery_targets(spark: SparkSession, sf: str) -> DataFrame:
    return state.recovery_targets(table(spark, sf, "crawl_tasks"), ["marrow-daily.test"], ["NEEDS_JS", "FAILED"]).select("doc_id", "domain", "status")


@query
def fetch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = flows.fetch_metrics(table(spark, sf, "timing_log"))
    return rows.select(F.unix_timestamp("window_start").alias("window_start"), "domain", "n_attempts", "n_success", F.round("mean_seconds", 9).alias("mean_seconds"))


def _bm25(spark: SparkSession, sf: str, k: int = 1000, **boosts: float) -> DataFrame:
    docs = table(spark, sf, "documents")
    asked = docs.filter("doc_id % 50 = 0 and title is not null").select(F.col("doc_id").alias("query_id"), F.col("title").alias("query"))
    return lexical.search(docs, asked, k, boosts or None)


@query
def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _bm25(spark, sf)


@query
def bm25_levels(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.level_stats(_bm25(spark, sf)).withColumn("unique_ratio", F.round("unique_ratio", 6))


@query
def bm25_union(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.union_candidates(_bm25(spark, sf)).select("doc_id", "match_count", "best_rank", "best_score", F.array_join(F.transform("query_ids", lambda x: x.cast("string")), ",").alias("query_ids"))


def _dense(spark: SparkSession, sf: str, k: int = 500) -> DataFrame:
    v = table(spark, sf, "embeddings")
    return dense.top_k(v, v.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), k)


@query
def dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _dense(spark, sf)


@query
def dense_documents(spark: SparkSession, sf: str) -> DataFrame:
    return dense.best_chunk_per_document(_dense(spark, sf).withColumn("doc_id", F.expr("vec_id div 4")), k=1000)


@query
def dense_second(spark: SparkSession, sf: str) -> DataFrame:
    hits = _dense(spark, sf).withColumn("doc_id", F.expr("vec_id div 4")).withColumn("chunk_index", F.col("vec_id") % 4)
    return dense.second_best_apart(hits)


def _fused(spark: SparkSession, sf: str) -> DataFrame:
    """The lexical ranking of the documents with that of their vectors."""
    vectors = dense.best_chunk_per_document(_dense(spark, sf).withColumn("doc_id", F.expr("vec_id div 4")), k=1000)
    return fusion.fuse(_bm25(spark, sf), vectors)


@query
def rrf_fusion(spark: SparkSession, sf: str) -> DataFrame:
    return _fused(spark, sf).select("query_id", "doc_id", "lexical_rank", "dense_rank", "fused_score", "final_rank")


@query
def rrf_stats(spark: SparkSession, sf: str) -> DataFrame:
    return fusion.fusion_stats(_fused(spark, sf))


@query
def neighbour_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "documents").filter("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("chunk_index", "text"))
    return selection.with_neighbours(lines).select("doc_id", "chunk_index", "before", "after")


@query
def curated_texts(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.curate(table(spark, sf, "corpus")).select("doc_id", "domain", "raw_text_chars", "text_chars", "removed_chars", "content_hash", "curation_status")


@query
def curation_stats(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.curation_stats(cleaning.curate(table(spark, sf, "corpus")))


@query
def extracted_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages made of the documents' titles and lines, read back as HTML."""
    d = table(spark, sf, "documents")

    def escaped(c):
        return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    body = F.concat(F.lit("<p>"), F.array_join(F.split(escaped(F.coalesce("text", F.lit(""))), "\n+"), "</p><p>"), F.lit("</p>"))
    html = F.concat(F.lit("<html><head><title>"), escaped(F.coalesce("title", F.lit(""))), F.lit("</title></head><body><nav><a href=/>Home</a></nav>"), body, F.lit("</body></html>"))
    return extraction.route(d.select("doc_id", html.cast("binary").alias("content"), F.lit("text/html").alias("content_type"))).select("doc_id", "status", "page.title", F.length("page.text").alias("n_chars"))


@query
def document_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.chunked(table(spark, sf, "documents")).select("doc_id", "chunk_id", "chunk_index", "heading", "token_count", F.length("text").alias("n_chars"))


@query
def chunk_stats(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.chunk_stats(chunks.chunked(table(spark, sf, "documents")))


def _selected(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = table(spark, sf, "documents")
    ranked = _bm25(spark, sf, 10)  # documents of an answer
    made, _ = chunks.candidate_chunks(docs, ranked, most=160, target=120)
    hits = ranked.join(made.filter("chunk_index > 0").select("doc_id", "chunk_id"), "doc_id").select("query_id", "chunk_id", F.lit(0.1).alias("score"))
    return ranked, made, selection.select_chunks(selection.chunk_sources(ranked, hits, made))


@query
def selected_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return _selected(spark, sf)[2].select("query_id", "doc_id", "chunk_id", "chunk_order", "source")


@query
def expanded_passages(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return selection.expanded(chunks.chunked(docs, most=160, target=120), docs, 300).select("doc_id", "chunk_id", "how", "passage_tokens")


def _results(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    ranked, _, chosen = _selected(spark, sf)
    asked = table(spark, sf, "documents").filter("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"))
    return asked, results.nested(asked, ranked, chosen)


@query
def nested_results(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf)[1]


@query
def result_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Validation of results with planted errors, one kind for each tenth of the queries."""
    asked = table(spark, sf, "documents").filter("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"))
    q, case = F.col("query_id").cast("string"), F.expr("(query_id div 50) % 10")

    def item(id_=q, docs=None, doc=q, text="a passage", more="") -> Column:
        docs = docs if docs is not None else F.concat(F.lit("["), q, F.lit("]"))
        return F.concat(F.lit('{"id": '), id_, F.lit(', "relevant_docs": '), docs, F.lit(', "relevant_chunks": [{"doc_id": '), doc, F.lit(f', "chunk_text": "{text}", "chunk_order": 1{more}}}]}}'))

    twice = F.concat(F.lit("["), q, F.lit(", "), q, F.lit("]"))
    raw = F.when(case == 1, item(F.concat(F.lit('"'), q, F.lit('"')))).when(case == 2, item(docs=twice)).when(case == 4, item(text=" ")).when(case == 5, item(text="Query: pain")).when(case == 6, item(more=', "score": 1.5'))
    raw = raw.when(case == 7, item(doc=(F.col("query_id") + 7).cast("string"))).when(case == 8, item(docs=F.lit("5"))).otherwise(item())
    items = asked.filter(case != 3).select(F.monotonically_increasing_id().alias("item_no"), raw.alias("raw"), case.alias("case")).withColumn("copy", F.explode(F.expr("sequence(1, if(case = 9, 2, 1))"))).select("item_no", "raw")
    extra = spark.createDataFrame([(776, '{"id": 999999999, "relevant_docs": [-1], "relevant_chunks": []}'), (777, "{broken")], "item_no long, raw string")
    return results.validate(written(items.unionByName(extra), "raw-results"), asked, corpus=table(spark, sf, "documents"))


@query
def result_diagnosis(spark: SparkSession, sf: str) -> DataFrame:
    return results.diagnose(_results(spark, sf)[1])


@query
def archive_groups(spark: SparkSession, sf: str) -> DataFrame:
    ranges = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("filename"), (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("offset"), F.col("l_quantity").cast("long").alias("length"))
    return archive.coalesce_ranges(ranges)


@query
def newest_captures(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "crawl_tasks").withColumn("captured_at", F.struct("attempts", "url", "doc_id"))
    return archive.newest_captures(rows).select("lookup_key", "doc_id")


@query
def error_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return reports.error_breakdown(table(spark, sf, "crawl_tasks"))


@query
def storage_projection(spark: SparkSession, sf: str) -> DataFrame:
    return reports.storage_projection(table(spark, sf, "crawl_tasks"))


@query
def slow_domains(spark: SparkSession, sf: str) -> DataFrame:
    return reports.slow_domains(table(spark, sf, "timing_log")).withColumn("mean_seconds", F.round("mean_seconds", 9))


@query
def failing_domains(spark: SparkSession, sf: str) -> DataFrame:
    return reports.failing_domains(table(spark, sf, "timing_log"))


@query
def robots_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "crawl_tasks").groupBy(reports.robots_decision(F.col("http_status")).alias("decision")).agg(F.count(F.lit(1)).alias("n"))


@query
def composition(spark: SparkSession, sf: str) -> DataFrame:
    return reports.composition(table(spark, sf, "corpus").filter("text is not null"))


@query
def timing_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Over the log without some targets and with some that are no task's."""
    log = table(spark, sf, "timing_log").select("fetch_key")
    foreign = log.filter("fetch_key like 'b0%'").select(F.concat(F.lit("unknown-"), "fetch_key").alias("fetch_key"))
    return reports.timing_gaps(log.filter("fetch_key not like 'a%'").unionByName(foreign), table(spark, sf, "crawl_tasks"))


@query
def allocated_passages(spark: SparkSession, sf: str) -> DataFrame:
    hits = _dense(spark, sf).withColumn("doc_id", F.expr("vec_id div 4")).withColumn("chunk_index", (F.col("vec_id") % 4).cast("int"))
    docs = dense.best_chunk_per_document(hits).select("query_id", "doc_id", F.col("rank").alias("doc_rank"))
    return reports.allocate_passages(hits.select("query_id", "doc_id", "chunk_index", "score").join(docs, ["query_id", "doc_id"]), cap=30)


@query
def wide_passages(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "documents").filter("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("chunk_index", "text"))
    return reports.wide_passages(lines.filter("trim(text) <> ''"), 60).select("doc_id", "chunk_index", "n_words", F.length("passage").alias("n_chars"))


@query
def matched_captures(spark: SparkSession, sf: str) -> DataFrame:
    tasks = table(spark, sf, "crawl_tasks")
    index = archive.newest_captures(tasks.filter("attempts >= 2").withColumn("captured_at", F.struct("attempts", "url", "doc_id")))
    return reports.match_captures(tasks, index)


@query
def token_spread(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").filter("text is not null").select(C.token_count(F.col("text")).alias("n_tokens"))
    return results.token_distribution(rows, "n_tokens").withColumn("mean", F.round("mean", 6))


@query
def first_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The first document of every source, by id."""
    return sampling.head_per_group(table(spark, sf, "documents").select("source", "doc_id"), "source", "doc_id", 3).select("source", "doc_id", "place")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": "select domain from corpus group by domain having count(*) >= 0.05 * (select count(*) from corpus)",
        "p3_domains": "select domain, count(*) as n_rows, cast(coalesce(sum(length(text)), 0) as bigint) as n_chars, count(text) as n_with_text, count(*) filter (crawl_status = 'SUCCESS') as n_success, count(*) filter (crawl_status <> 'SUCCESS') as n_failed from corpus group by domain",
        "p3_statuses": "select domain, crawl_status, count(*) as n_rows from corpus group by domain, crawl_status",
    } | oracle.sql()
