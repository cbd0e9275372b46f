"""Work-balanced partitions of a link table over workers."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, functions as F

from lakeloom.functions import columns as C
from lakeloom.schemas import violation


def balance(work: dict[str, float], counts: dict[str, int], workers: int, threshold: float = 0.1, parts: int = 2) -> list[tuple[str, int, int, int]]:
    """``(domain, part, parts, worker)`` by largest work first onto the least loaded worker.

    A domain above the ideal load is split where that lowers the longest load by ``threshold``;
    its parts go to different workers. Input is one row a domain, already aggregated.
    """

    def place(split: set[str]) -> tuple[float, list[tuple[str, int, int, int]]]:
        units = []
        for d in sorted(work):
            k = parts if d in split else 1
            units += [(-work[d] * ((counts[d] // k) + (p < counts[d] % k)) / counts[d], d, p, k) for p in range(k)]
        loads = [(0.0, w) for w in range(workers)]
        held: dict[str, set[int]] = {}
        out = []
        for cost, d, p, k in sorted(units):
            skipped = []
            while loads and loads[0][1] in held.get(d, ()):
                skipped.append(heapq.heappop(loads))
            load, w = heapq.heappop(loads)
            held.setdefault(d, set()).add(w)
            out.append((d, p, k, w))
            heapq.heappush(loads, (load - cost, w))
            for s in skipped:
                heapq.heappush(loads, s)
        return max(x for x, _ in loads), out

    if workers < parts:
        raise ValueError("fewer workers than parts")
    ideal = sum(work.values()) / workers
    split: set[str] = set()
    longest, plan = place(split)
    while True:
        best = None
        for d in sorted(x for x in work if x not in split and work[x] > ideal and counts[x] > 1):
            m, p = place(split | {d})
            if best is None or m < best[0]:
                best = (m, d, p)
        if best is None or longest <= 0 or (longest - best[0]) / longest < threshold:
            return plan
        longest, plan = best[0], best[2]
        split.add(best[1])


#: A domain with less than this share of a worker's load is planned together with others of its bucket.
SMALL_SHARE = 1000
BUCKETS = 4096


def assign(links: DataFrame, work: DataFrame, workers: int = 6) -> DataFrame:
    """``links`` with ``worker_id`` and ``split_part``; ``work`` is ``(domain, estimated_work)``.

    The driver plans ``workers * SMALL_SHARE`` large domains at most and ``BUCKETS`` buckets of
    small ones, however many domains there are; a domain stays with one worker unless it is
    split. A split domain's rows go to its parts by the stable hash of their id, so routing
    needs no order.
    """
    rows = links.withColumn("domain", C.domain_from_url(F.col("url"))).filter("domain is not null")
    sums = rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).join(work, "domain", "left").select("domain", "n", F.coalesce(F.col("estimated_work"), F.col("n").cast("double")).alias("w"))
    total = sums.agg(F.sum("w")).first()[0] or 0.0
    small = F.concat(F.lit("#"), F.pmod(F.xxhash64("domain"), F.lit(BUCKETS)).cast("string"))
    is_small = F.col("w") < total / (workers * SMALL_SHARE)
    large = F.broadcast(sums.filter(~is_small).select("domain", F.col("domain").alias("own")))  # at most workers * SMALL_SHARE rows
    sums = sums.withColumn("unit", F.when(is_small, small).otherwise(F.col("domain")))
    units = sums.groupBy("unit").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).collect()
    plan = balance({r.unit: r.w for r in units}, {r.unit: r.n for r in units}, workers)
    table = links.sparkSession.createDataFrame(plan, "unit string, split_part int, split_parts int, worker_id int")
    # A row's unit is its domain if that is large, else its bucket: no row moves for it.
    routed = rows.join(large, "domain", "left").withColumn("unit", F.coalesce("own", small)).drop("own").join(F.broadcast(table.groupBy("unit").agg(F.first("split_parts").alias("k"))), "unit")
    routed = routed.withColumn("split_part", F.pmod(C.stable_int(F.col("doc_id"), "route"), F.col("k")).cast("int")).drop("k")
    return routed.join(F.broadcast(table.drop("split_parts")), ["unit", "split_part"]).drop("unit")


def worker_summary(assigned: DataFrame) -> DataFrame:
    per = assigned.groupBy("worker_id", "domain").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("worker_id").agg(F.sum("n").alias("n_urls"), F.count(F.lit(1)).alias("n_domains"), F.max("n").alias("largest_domain"))


def check_assignment(links: DataFrame, assigned: DataFrame, plan: DataFrame | None = None) -> DataFrame:
    """Violations: rows lost, invented or assigned twice, and domains at more workers than they have parts.

    ``plan`` is ``(worker_id, n_urls)``: workers whose number of rows differs are violations too.
    """
    a, b = links.select("doc_id"), assigned.select("doc_id")
    lost = violation(a.join(b, "doc_id", "left_anti"), "not assigned", F.col("doc_id"), F.lit(""))
    new = violation(b.join(a, "doc_id", "left_anti"), "not in the links", F.col("doc_id"), F.lit(""))
    twice = violation(b.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "assigned twice", F.col("doc_id"), F.col("n"))
    homes = assigned.select("domain", "split_part", "worker_id").distinct().groupBy("domain", "split_part").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    out = lost.unionByName(new).unionByName(twice).unionByName(violation(homes, "part at several workers", F.col("domain"), F.col("n")))
    if plan is not None:
        have = assigned.groupBy("worker_id").agg(F.count(F.lit(1)).alias("have"))
        differ = have.join(plan.select("worker_id", "n_urls"), "worker_id", "full_outer").filter("coalesce(have, 0) <> coalesce(n_urls, 0)")
        out = out.unionByName(violation(differ, "worker's total differs", F.col("worker_id"), F.coalesce("have", F.lit(0))))
    return out
