"""Profiles of link tables, tasks, timings and document quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeloom.functions import columns as C

# Phrases that hint at page chrome left in a text.
CHROME = ("all rights reserved", "cookie", "đăng nhập", "chia sẻ", "bình luận", "quảng cáo", "版权所有", "登录")
PROFILE_STATUSES = ("SUCCESS", "FAILED", "EMPTY_CONTENT", "NEEDS_JS", "ROBOTS_DENIED", "TOO_LARGE", "UNSUPPORTED", "NEEDS_OCR")


def status_counts(tasks: DataFrame, status: str = "status") -> DataFrame:
    """Rows by status, and a row ``TOTAL``."""
    return tasks.rollup(status).agg(F.count(F.lit(1)).alias("n"), F.grouping(status).alias("g")).select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col(status)).alias("status"), "n")


def source_report(links: DataFrame) -> DataFrame:
    """One row of totals of a link table ``(doc_id, url)``: distinct and repeated URLs, hosts, PDFs, invalid ones.

    Distinct URLs come from a combined level keyed by URL, so no task counts them alone.
    """
    u = links.select(C.normalize_fetch_url(F.col("url")).alias("u"), C.is_pdf_like(F.col("url")).cast("int").alias("pdf"))
    per = u.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.sum("pdf").alias("pdf"))
    valid = F.col("u").isNotNull()
    return per.agg(
        F.sum("n").alias("n_rows"), F.sum(valid.cast("long")).alias("n_urls"), F.sum(F.when(valid, F.col("n") - 1).otherwise(0)).alias("n_repeats"),
        F.sum(F.when(~valid, F.col("n")).otherwise(0)).alias("n_invalid"), F.sum(F.when(valid, F.col("pdf")).otherwise(0)).alias("n_pdf"),
    )


def scheme_counts(links: DataFrame) -> DataFrame:
    """``(scheme, n)`` of the URLs as stored; without a scheme it is empty."""
    return links.groupBy(F.lower(F.regexp_extract(C.strip(F.coalesce("url", F.lit(""))), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)).alias("scheme")).agg(F.count(F.lit(1)).alias("n"))


def invalid_urls(links: DataFrame, n: int = 20) -> DataFrame:
    """``n`` rows whose URL cannot be fetched, those of the smallest ids."""
    return links.filter(C.normalize_fetch_url(F.col("url")).isNull()).orderBy("doc_id").limit(n)


def query_params(links: DataFrame) -> DataFrame:
    """Names of query parameters with their number of uses; blank values count."""
    q = F.regexp_extract(C.normalize_fetch_url(F.col("url")), r"\?(.*)$", 1)
    return links.select(F.explode(F.split(q, "&")).alias("p")).select(F.split("p", "=")[0].alias("param")).filter("param <> ''").groupBy("param").agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` commonest values, ties by value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column)).limit(n)


def domain_status_matrix(tasks: DataFrame, domain: str = "domain", status: str = "status") -> DataFrame:
    """One row a domain, one column a status of :data:`PROFILE_STATUSES`."""
    sums = [F.sum((F.col(status) == s).cast("long")).alias(f"n_{s.lower()}") for s in PROFILE_STATUSES]
    return tasks.groupBy(domain).agg(F.count(F.lit(1)).alias("n_tasks"), *sums)


def content_duplicates(corpus: DataFrame) -> DataFrame:
    """``(content_hash, n_docs, first_doc)`` of hashes that several documents share."""
    per = corpus.filter("content_hash is not null").select("content_hash", "doc_id").distinct()
    return per.groupBy("content_hash").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc")).filter("n_docs > 1")


def clean_timings(log: DataFrame) -> DataFrame:
    """One row an attempt ``(fetch_key, attempt)``: exact repeats fall together.

    Of attempts logged several times with different values the last logged one stands.
    """
    return log.groupBy("fetch_key", "attempt").agg(F.max_by(F.struct("domain", "status", "retryable", "elapsed_seconds", "finished_at"), F.struct("logged_at", "finished_at", "elapsed_seconds")).alias("x")).select("fetch_key", "attempt", "x.*")


def timing_conflicts(log: DataFrame) -> DataFrame:
    """Attempts logged with more than one status."""
    return log.groupBy("fetch_key", "attempt").agg(F.min("status").alias("a"), F.max("status").alias("b")).filter("a <> b").select("fetch_key", "attempt")


def target_timings(log: DataFrame) -> DataFrame:
    """``(fetch_key, domain, attempts, seconds, status)``: seconds summed over a target's attempts."""
    return clean_timings(log).groupBy("fetch_key").agg(F.min("domain").alias("domain"), F.count(F.lit(1)).alias("attempts"), F.sum("elapsed_seconds").alias("seconds"), F.max_by("status", "attempt").alias("status"))


#: Steps a doubling of the value by which quantiles are narrowed down.
STEPS = 64


def quantiles(rows: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Per group ``n``, the exact median and the nearest-rank 95th percentile of ``value`` (>= 0); nulls are left out.

    A histogram over a fixed scale tells in which step each wanted rank lies; only the distinct
    values of those steps are counted and ordered. No group's values meet in one buffer.
    """
    v = F.col(value)
    step = F.when(v > 0, F.floor(F.log2(v) * STEPS)).otherwise(F.lit(-(1 << 20))).cast("long")
    seen = rows.filter(v.isNotNull()).select(*groups, v.alias("_v"), step.alias("_step"))
    keys = [F.coalesce(F.col(g).cast("string"), F.lit("\x00")).alias(f"_k{i}") for i, g in enumerate(groups)]
    names = [f"_k{i}" for i in range(len(groups))]
    seen = seen.select(*groups, *keys, "_v", "_step")
    w = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))
    bins = seen.groupBy(*groups, *names, "_step").agg(F.count(F.lit(1)).alias("_c"))
    bins = bins.withColumn("_n", F.sum("_c").over(w)).withColumn("_to", F.sum("_c").over(w.orderBy("_step"))).withColumn("_from", F.col("_to") - F.col("_c"))
    ranks = F.array(F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2), F.ceil(F.col("_n") * 0.95) - 1)
    wanted = bins.select("*", F.posexplode(ranks).alias("_which", "_rank")).filter((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    steps = wanted.select(*names, "_step").distinct()
    values = seen.join(steps, [*names, "_step"], "left_semi").groupBy(*names, "_step", "_v").agg(F.count(F.lit(1)).alias("_m"))
    upto = F.sum("_m").over(Window.partitionBy(*names, "_step").orderBy("_v"))
    values = values.withColumn("_upto", upto).withColumn("_above", upto - F.col("_m"))
    at = F.col("_rank") - F.col("_from")
    found = wanted.join(values, [*names, "_step"]).filter((at >= F.col("_above")) & (at < F.col("_upto")))

    def pick(which: int) -> Column:
        return F.max(F.when(F.col("_which") == which, F.col("_v")))

    out = found.groupBy(*groups, *names).agg(F.max("_n").alias("n"), pick(0).alias("_a"), pick(1).alias("_b"), pick(2).alias("p95"))
    return out.select(*groups, "n", ((F.col("_a") + F.col("_b")) / 2).alias("median"), "p95")


def latency_profile(log: DataFrame) -> DataFrame:
    """``(domain, n, median_seconds, p95_seconds, cost)`` of the targets' seconds."""
    per = quantiles(target_timings(log), ["domain"], "seconds").withColumnsRenamed({"median": "median_seconds", "p95": "p95_seconds"})
    return per.withColumn("cost", 0.7 * F.col("median_seconds") + 0.3 * F.col("p95_seconds"))


def domain_profile(tasks: DataFrame, log: DataFrame, prior: float = 20.0, robots_seconds: float = 0.2) -> DataFrame:
    """Expected seconds a URL and work of each domain, from status rates and shrunken latency costs.

    A domain's cost in a category weighs ``n / (n + prior)`` against the category's overall
    cost; a category without timings falls back on the cost of all of them.
    """
    done = tasks.filter(F.col("status").isin(*PROFILE_STATUSES))
    total = tasks.groupBy("domain").agg(F.count(F.lit(1)).alias("n_urls"))
    rates = done.groupBy("domain", C.cost_category(F.col("status")).alias("category")).agg(F.count(F.lit(1)).alias("k"))
    whole = rates.groupBy("domain").agg(F.sum("k").alias("sample_count"))
    t = target_timings(log).filter("seconds is not null").withColumn("category", C.cost_category(F.col("status"))).filter("category <> 'ROBOTS_DENIED'")
    cost = 0.7 * F.col("median") + 0.3 * F.col("p95")
    own = quantiles(t, ["domain", "category"], "seconds").select("domain", "category", "n", cost.alias("own_cost"))
    over = quantiles(t, ["category"], "seconds").select("category", cost.alias("category_cost"))
    every = quantiles(t, [], "seconds").agg(F.max(cost).alias("any_cost"))
    x = rates.join(whole, "domain").join(own, ["domain", "category"], "left").join(F.broadcast(over), "category", "left")  # six categories
    base = F.coalesce(F.col("category_cost"), every.scalar())
    weight = F.coalesce(F.col("n") / (F.col("n") + prior), F.lit(0.0))
    cost = F.when(F.col("category") == "ROBOTS_DENIED", F.lit(robots_seconds)).otherwise(weight * F.coalesce("own_cost", base) + (1 - weight) * base)
    per = x.groupBy("domain").agg(F.max("sample_count").alias("sample_count"), F.sum(F.col("k") / F.col("sample_count") * cost).alias("seconds_per_url"))
    return total.join(per, "domain").withColumn("estimated_work", F.col("n_urls") * F.col("seconds_per_url"))


def risk_scores(corpus: DataFrame) -> DataFrame:
    """``(doc_id, domain, text_chars, risk, reasons)``: additive quality risks of SUCCESS records, at most 100.

    Length, share of the download, repeated content, chrome phrases, title, structure, language.
    """
    raw = corpus.filter("crawl_status = 'SUCCESS'")
    text, title = F.coalesce("text", F.lit("")), F.coalesce("title", F.lit(""))
    chars = F.when(F.coalesce("text_chars", F.lit(0)) > 0, F.col("text_chars")).otherwise(F.length(text))
    lines = F.filter(F.transform(F.split(text, "\n"), C.strip), lambda x: x != "")
    blocks = F.filter(F.transform(F.split(text, r"\n\s*\n"), C.strip), lambda x: x != "")
    # Each fact once; the text itself goes no further than this stage.
    facts = raw.select(
        "doc_id", "domain", "content_hash", "language", chars.alias("chars"), (chars / F.greatest(F.lit(1), F.coalesce("bytes_downloaded", F.lit(0)))).alias("ratio"),
        F.size(F.filter(F.array(*(F.lit(x) for x in CHROME)), lambda m: F.contains(F.lower(text), m))).alias("hits"),
        C.dedup_form(F.substring(text, 1, 4000)).alias("lead"), C.dedup_form(title).alias("head"), lines.alias("lines"), blocks.alias("blocks"),
    )
    facts = facts.withColumns({"formed": F.transform(F.filter("blocks", lambda x: F.length(x) >= 30), C.dedup_form), "words": F.array_distinct(F.split("head", " "))})
    chars, ratio, lead, head, lines, blocks, formed = (F.col(x) for x in ("chars", "ratio", "lead", "head", "lines", "blocks", "formed"))
    overlap = F.size(F.array_intersect("words", F.split(lead, " "))) / F.size("words")
    structured = F.size(F.filter(lines, lambda x: x.rlike(r"^[#*|-]")))
    repeated = (F.size(formed) - F.size(F.array_distinct(formed))) / F.size(formed)
    rules = [
        ("very_short_text", 30, chars < 300), ("short_text", 20, (chars >= 300) & (chars < 600)), ("brief_text", 10, (chars >= 600) & (chars < 1000)),
        ("very_low_text_ratio", 20, ratio < 0.003), ("low_text_ratio", 10, (ratio >= 0.003) & (ratio < 0.01)), ("moderate_text_ratio", 5, (ratio >= 0.01) & (ratio < 0.02)),
        ("missing_title", 15, head == ""), ("title_body_mismatch", 10, (head != "") & ~F.contains(lead, head) & (overlap < 0.35)),
        ("list_heading_dominant", 10, (F.size(lines) >= 6) & (structured / F.size(lines) > 0.6)),
        ("no_substantial_paragraph", 15, (F.size(blocks) > 0) & (F.array_max(F.transform(blocks, F.length)) < 120)),
        ("repeated_blocks", 10, (F.size(formed) > 0) & (repeated >= 0.2)),
        ("missing_language", 5, F.coalesce("language", F.lit("")) == ""), ("extreme_length", 5, chars > 50_000),
    ]
    made = [F.when(test, F.struct(F.lit(code).alias("code"), F.lit(points).alias("points"))) for code, points, test in rules]
    made.append(F.when(F.col("hits") > 0, F.struct(F.lit("boilerplate_markers").alias("code"), F.least(F.lit(20), 5 * F.col("hits")).alias("points"))))
    own = facts.select("doc_id", "domain", chars.cast("int").alias("text_chars"), "content_hash", F.filter(F.array(*made), lambda r: r.isNotNull()).alias("own")).dropDuplicates(["doc_id"])
    same = own.filter("content_hash is not null").groupBy("content_hash").agg(F.count(F.lit(1)).alias("n_same")).filter("n_same > 1")
    twice = F.when(F.col("n_same") > 1, F.array(F.struct(F.lit("duplicate_content").alias("code"), F.lit(20).alias("points")))).otherwise(F.slice("own", 1, 0))
    rows = own.join(same, "content_hash", "left").withColumn("all", F.concat("own", twice))
    risk = F.least(F.lit(100), F.aggregate("all", F.lit(0), lambda a, r: a + r["points"]))
    return rows.select("doc_id", "domain", "text_chars", risk.alias("risk"), F.transform("all", lambda r: r["code"]).alias("reasons"))


def risk_summary(scores: DataFrame) -> DataFrame:
    """Per domain: records, mean, offset percentiles and maximum of the risk, and its commonest flags.

    The percentiles come from the histogram of the 101 possible scores, never from a domain's sorted rows.
    """
    bins = scores.groupBy("domain", "risk").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("domain")
    bins = bins.withColumn("upto", F.sum("n").over(w.orderBy("risk").rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("n").over(w))

    def at(f: float) -> Column:
        return F.min(F.when(F.col("upto") > F.floor((F.col("all") - 1) * f), F.col("risk")))

    ranks = bins.groupBy("domain").agg(F.sum("n").alias("n_docs"), (F.sum(F.col("n") * F.col("risk")) / F.sum("n")).alias("mean_risk"), at(0.5).alias("p50_risk"), at(0.9).alias("p90_risk"), F.max("risk").alias("max_risk"))
    flags = scores.groupBy("domain").agg(*(F.sum(F.array_contains("reasons", r).cast("long")).alias(f"n_{r}") for r in ("very_short_text", "duplicate_content", "missing_title", "missing_language", "boilerplate_markers", "very_low_text_ratio", "title_body_mismatch")))
    return ranks.join(flags, "domain")
