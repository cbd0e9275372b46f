"""Task state as tables: claims, outcomes and bulk edits are pure functions of ``(state, now)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lakeloom.functions import columns as C
from lakeloom.schemas import UNFINISHED


def due(tasks: DataFrame, now: float) -> DataFrame:
    """Tasks that may run: pending, or waiting for a retry whose time has come."""
    return tasks.filter((F.col("status") == "PENDING") | ((F.col("status") == "RETRY_WAIT") & (F.col("next_retry_at") <= now)))


def targets(tasks: DataFrame) -> DataFrame:
    """One row a fetch target; several documents may share it."""
    return tasks.groupBy("fetch_key").agg(
        F.min("domain").alias("domain"), F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n_docs"), F.max("attempts").alias("attempts"),
        F.max_by("status", F.struct("attempts", "status")).alias("status"), F.min("next_retry_at").alias("next_retry_at"),
    )


def fair_claim(tasks: DataFrame, now: float, limit: int, per_domain: int | None = None, closed: list[str] | None = None, in_flight: DataFrame | None = None) -> DataFrame:
    """``(fetch_key, domain, claim_no)`` of the next ``limit`` targets: due retries first, then in turn over domains.

    A domain's queue is cut to ``limit`` before ranks are compared, and domains of ``closed`` wait.
    ``in_flight`` is ``(domain, n)``: what a domain has under way counts against ``per_domain``.
    """
    ready = targets(due(tasks, now)).filter(F.col("domain").isNotNull())
    if closed:
        ready = ready.filter(~F.col("domain").isin(*closed))
    retry = F.when(F.col("status") == "RETRY_WAIT", 0).otherwise(1)
    turn = F.row_number().over(Window.partitionBy("domain").orderBy(retry, F.coalesce("next_retry_at", F.lit(0.0)), "first_doc", "fetch_key"))
    ranked = ready.withColumn("turn", turn).filter(F.col("turn") <= (per_domain or limit)).withColumn("late", retry)
    if in_flight is not None and per_domain:
        busy = in_flight.groupBy("domain").agg(F.sum("n").alias("under_way"))
        ranked = ranked.join(busy, "domain", "left").filter(F.col("turn") + F.coalesce("under_way", F.lit(0)) <= per_domain).drop("under_way")
    first = ranked.orderBy("late", "turn", "domain", "fetch_key").limit(limit)
    return first.withColumn("claim_no", F.row_number().over(Window.orderBy("late", "turn", "domain", "fetch_key"))).select("fetch_key", "domain", "claim_no")


def even_quota(tasks: DataFrame, now: float, limit: int) -> int:
    """Targets a domain may claim of ``limit`` where all domains with due tasks share it evenly, rounded up."""
    n = due(tasks, now).filter("domain is not null").agg(F.count_distinct("domain")).first()[0]
    return -(-limit // n) if n else limit


def claim(tasks: DataFrame, claimed: DataFrame) -> DataFrame:
    """State after a claim: all documents of a claimed target are being fetched, with one attempt more."""
    mark = claimed.select("fetch_key", F.lit(True).alias("taken"))
    t = tasks.join(mark, "fetch_key", "left")
    return t.withColumn("attempts", F.when(F.col("taken"), F.col("attempts") + 1).otherwise(F.col("attempts"))).withColumn("status", F.when(F.col("taken"), "FETCHING").otherwise(F.col("status"))).withColumn("next_retry_at", F.when(F.col("taken"), None).otherwise(F.col("next_retry_at"))).select(*tasks.columns)


def settle(tasks: DataFrame, outcomes: DataFrame, now: float, max_attempts: int = 3, base: float = 30.0) -> DataFrame:
    """State after outcomes ``(fetch_key, outcome, retryable)``: a retry is timed, or the status stands.

    Of several outcomes of one target the one with the largest status name counts, in any order.
    """
    o = outcomes.groupBy("fetch_key").agg(F.max_by(F.struct("outcome", "retryable"), F.struct("outcome", "retryable")).alias("o")).select("fetch_key", "o.*")
    t = tasks.join(o, "fetch_key", "left")
    hit = F.col("outcome").isNotNull() & F.col("status").isin(*UNFINISHED)
    again = hit & F.coalesce("retryable", F.lit(False)) & (F.col("attempts") < max_attempts)
    jitter = F.pmod(C.stable_int(F.col("fetch_key"), "retry"), F.lit(1000)) / 1000.0
    when = F.lit(now) + C.retry_delay(F.greatest(F.col("attempts"), F.lit(1)), base, jitter)
    return t.withColumn("next_retry_at", F.when(again, when).when(hit, None).otherwise(F.col("next_retry_at"))).withColumn("status", F.when(again, "RETRY_WAIT").when(hit, F.col("outcome")).otherwise(F.col("status"))).select(*tasks.columns)


def recover(tasks: DataFrame) -> DataFrame:
    """After a crash, tasks that were being fetched are pending again."""
    return tasks.withColumn("status", F.when(F.col("status") == "FETCHING", "PENDING").otherwise(F.col("status")))


def edit(tasks: DataFrame, where, status: str, reset: bool = False) -> DataFrame:
    """Bulk change of the status of the rows where ``where`` holds; with ``reset`` attempts start again."""
    hit = F.coalesce(where, F.lit(False))
    out = tasks.withColumn("next_retry_at", F.when(hit, None).otherwise(F.col("next_retry_at")))
    if reset:
        out = out.withColumn("attempts", F.when(hit, 0).otherwise(F.col("attempts")))
    return out.withColumn("status", F.when(hit, status).otherwise(F.col("status")))


def recovery_targets(tasks: DataFrame, domains: list[str], statuses: list[str], short_chars: int = 200) -> DataFrame:
    """Tasks worth another try: given domains or statuses, or successes with little text."""
    short = (F.col("status") == "SUCCESS") & (F.coalesce("text_chars", F.lit(0)) < short_chars)
    return tasks.filter(F.col("domain").isin(*domains) | F.col("status").isin(*statuses) | short)


def fan_out(tasks: DataFrame) -> DataFrame:
    """``(fetch_key, doc_id, n_docs)``: one row a document of each target that several documents share.

    A target's documents are rows, never one array, so that no target is too large.
    """
    rows = tasks.filter("fetch_key is not null").select("fetch_key", "doc_id").distinct()
    shared = rows.groupBy("fetch_key").agg(F.count(F.lit(1)).alias("n_docs")).filter("n_docs > 1")
    return rows.join(shared, "fetch_key").select("fetch_key", "doc_id", "n_docs")


def domain_queue(tasks: DataFrame, now: float, delay: float = 1.0) -> DataFrame:
    """``(fetch_key, domain, place, not_before)``: each domain's waiting targets in order, ``delay`` seconds apart.

    Retries that are due come first, then new targets by their first document. Places come from
    counts over slices of the order, so a domain of any size is never sorted in one task.
    """
    ready = targets(due(tasks, now)).filter("domain is not null")
    late = F.when(F.col("status") == "RETRY_WAIT", 0).otherwise(1)
    ordered = ready.select("fetch_key", "domain", late.alias("late"), F.coalesce("next_retry_at", F.lit(0.0)).alias("since"), "first_doc")
    # Retries go by time, new targets by document: both into slices that keep the order.
    part = F.when(F.col("late") == 0, F.floor(F.col("since") / 3600)).otherwise(F.floor(F.col("first_doc") / 1024))
    ordered = ordered.withColumn("slice", part.cast("long"))
    sizes = ordered.groupBy("domain", "late", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("domain").orderBy("late", "slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ordered.join(sizes.withColumn("before", before).drop("n"), ["domain", "late", "slice"])
    within = F.row_number().over(Window.partitionBy("domain", "late", "slice").orderBy("since", "first_doc", "fetch_key"))
    return placed.withColumn("place", F.col("before") + within).select("fetch_key", "domain", "place", (F.lit(now) + (F.col("place") - 1) * F.lit(delay)).alias("not_before"))
