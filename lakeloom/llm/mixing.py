"""Problem 9: mixing sources to target weights.

Method: min-cost flow. Documents are aggregated by the set of sources they count for (their
membership pattern); a pattern's tokens are routed to the quotas of its sources, where the
k-th use of a document costs more than the one before (convex repetition costs), so flow
repeats nothing before all fresh tokens are used. Then documents are chosen in a seeded order.

The flow sees patterns and sources only: its size is the number of different patterns, which
is checked against ``max_patterns``; documents never leave the cluster.

Defined results: the total is the largest at which every source with weight and tokens gets
its share within its repeats (or ``total`` where given and smaller). Sources without weight
or without tokens get nothing and are reported; targets are relative to the sources that can
be served. Documents without tokens or source are never chosen. A document of several sources
is given to one of them in each pass, its uses over all of them capped by the largest of their
repeats. Within a source and pattern the quota is met to within one document.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F

from lakeloom.session import written

#: Slices of a pattern's seeded order; prefix sums run over slices, then within one.
SLICES = 4096
#: Rows of a plan up to which it is broadcast; a longer one is joined by a shuffle.
MAX_BROADCAST = 20_000
_AND = "\x1f"


@dataclass
class _Graph:
    """Residual graph for successive shortest paths."""

    n: int
    to: list[int] = field(default_factory=list)
    cap: list[float] = field(default_factory=list)
    cost: list[float] = field(default_factory=list)
    out: list[list[int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.out = [[] for _ in range(self.n)]

    def edge(self, a: int, b: int, cap: float, cost: float) -> int:
        for x, y, c, w in ((a, b, cap, cost), (b, a, 0.0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.cap.append(c)
            self.cost.append(w)
        return len(self.to) - 2

    def flow(self, s: int, t: int, want: float) -> float:
        """Send up to ``want`` at least cost; the amount sent."""
        potential, sent = [0.0] * self.n, 0.0
        while want - sent > 1e-9:
            dist, via = [float("inf")] * self.n, [-1] * self.n
            dist[s] = 0.0
            heap = [(0.0, s)]
            while heap:
                d, a = heapq.heappop(heap)
                if d > dist[a] + 1e-12:
                    continue
                for e in self.out[a]:
                    if self.cap[e] > 1e-9:
                        nd = d + self.cost[e] + potential[a] - potential[self.to[e]]
                        if nd < dist[self.to[e]] - 1e-9:
                            dist[self.to[e]], via[self.to[e]] = nd, e
                            heapq.heappush(heap, (nd, self.to[e]))
            if via[t] < 0:
                break
            potential = [p + (d if d < float("inf") else 0.0) for p, d in zip(potential, dist)]
            push, a = want - sent, t
            while a != s:
                push, a = min(push, self.cap[via[a]]), self.to[via[a] ^ 1]
            a = t
            while a != s:
                self.cap[via[a]] -= push
                self.cap[via[a] ^ 1] += push
                a = self.to[via[a] ^ 1]
            sent += push
        return sent


def route(patterns: dict[tuple[str, ...], float], weights: dict[str, float], repeats: dict[str, int], total: float | None = None) -> tuple[float, dict[tuple[tuple[str, ...], str], float]]:
    """``(total, {(pattern, source): tokens})``: tokens that each pattern gives to each source.

    ``patterns`` maps a sorted tuple of sources to the tokens of the documents that count for
    exactly these; a document's uses over all its sources are capped by the largest
    ``repeats`` among them.
    """
    live = {s: w for s, w in weights.items() if w > 0 and any(s in p and n > 0 for p, n in patterns.items())}
    if not live:
        return 0.0, {}
    whole = sum(live.values())
    names = sorted(live)
    keys = sorted(p for p, n in patterns.items() if n > 0 and any(s in live for s in p))

    def attempt(size: float) -> tuple[bool, dict[tuple[tuple[str, ...], str], float]]:
        g = _Graph(2 + len(keys) + len(names))
        at = {s: 2 + len(keys) + i for i, s in enumerate(names)}
        links = {}
        for i, p in enumerate(keys):
            for use in range(max(repeats[s] for s in p if s in live)):
                g.edge(0, 2 + i, patterns[p], float(use * use))
            for s in p:
                if s in live:
                    links[p, s] = g.edge(2 + i, at[s], patterns[p] * repeats[s], 0.0)
        for s in names:
            g.edge(at[s], 1, size * live[s] / whole, 0.0)
        sent = g.flow(0, 1, size)
        return sent >= size * (1 - 1e-7), {k: g.cap[e ^ 1] for k, e in links.items() if g.cap[e ^ 1] > 1e-6}

    high = min(sum(n * repeats[s] for p, n in patterns.items() if s in p) * whole / w for s, w in live.items())
    size = min(high, total) if total is not None else high
    ok, plan = attempt(size)
    low = 0.0
    if not ok:  # sources share documents: find the largest total that fits
        for _ in range(40):
            mid = (low + size) / 2
            fits, found = attempt(mid)
            low, size, plan = (mid, size, found) if fits else (low, mid, plan)
        size = low
        plan = attempt(size)[1]
    return size, plan


def membership(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """Distinct ``(doc_id, source, n_tokens)`` rows from documents with ``n_tokens``."""
    return docs.select("doc_id", F.col(source).alias("source"), F.col("n_tokens").cast("long").alias("n_tokens")).filter("source is not null and n_tokens > 0").distinct()


def mix(docs: DataFrame, targets: DataFrame, seed: int = 17, totals: dict[str, float] | None = None, max_patterns: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """``(chosen, report)`` for every mix of ``targets``.

    ``docs`` has ``doc_id, source, n_tokens``, several rows where a document counts for several
    sources. ``chosen`` is ``(mix_id, source, doc_id, n_tokens, repeats)``; ``report`` is
    ``(mix_id, source, target_share, actual_share, tokens, available_tokens, n_docs, max_used)``.
    """
    spark = docs.sparkSession
    rows = docs.filter("source is not null and n_tokens > 0").select("doc_id", "source", "n_tokens").distinct()
    wanted = [r.asDict() for r in targets.select("mix_id", "source", "target_weight", "max_repeats").distinct().limit(max_patterns + 1).collect()]
    # A source without weight or repeats takes nothing, so documents need not be told apart by it.
    live = sorted({(r["mix_id"], r["source"]) for r in wanted if r["source"] is not None and (r["target_weight"] or 0) > 0 and (r["max_repeats"] or 0) > 0})
    names = _small(spark.createDataFrame(live, "mix_id string, source string"), len(live))
    own = rows.join(names, "source").groupBy("mix_id", "doc_id").agg(F.array_join(F.array_sort(F.collect_set("source")), _AND).alias("pattern"), F.max("n_tokens").alias("n_tokens"))
    own = written(own, "patterns")
    found = own.groupBy("mix_id", "pattern").agg(F.sum("n_tokens").alias("tokens")).limit(max_patterns + 1).collect()
    if max(len(found), len(wanted)) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns or targets")
    orders = []
    for mix_id in sorted({m for m, _ in live}):
        weights = {r["source"]: float(r["target_weight"]) for r in wanted if (r["mix_id"], r["source"]) in live and r["mix_id"] == mix_id}
        repeats = {r["source"]: int(r["max_repeats"]) for r in wanted if r["source"] in weights and r["mix_id"] == mix_id}
        patterns = {tuple(r.pattern.split(_AND)): float(r.tokens) for r in found if r.mix_id == mix_id}
        _, plan = route(patterns, weights, repeats, (totals or {}).get(mix_id))
        orders += [(mix_id, _AND.join(p), s, a, b) for p, s, a, b in intervals(plan)]
    plan = _small(spark.createDataFrame(orders, "mix_id string, pattern string, source string, low double, high double"), len(orders))
    chosen = _choose(own, plan, seed)
    return chosen, _report(rows, targets, chosen)


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A table of the driver's own, broadcast up to ``MAX_BROADCAST`` rows."""
    return F.broadcast(df) if rows <= MAX_BROADCAST else df


def intervals(plan: dict[tuple[tuple[str, ...], str], float]) -> list[tuple[tuple[str, ...], str, float, float]]:
    """``(pattern, source, low, high)``: disjoint stretches of a tape on which a pattern's tokens come again and again.

    Each place of the tape belongs to one source, so a pass over the pattern's documents gives
    each of them to one source only, and a document is repeated no sooner than all are used.
    """
    at: dict[tuple[str, ...], float] = {}
    out = []
    for (pattern, source), tokens in sorted(plan.items()):
        low = at.get(pattern, 0.0)
        at[pattern] = low + tokens
        out.append((pattern, source, low, at[pattern]))
    return out


def _choose(own: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``(mix_id, source, doc_id, n_tokens, repeats)`` from ``(mix_id, doc_id, pattern, n_tokens)`` and the intervals.

    A document's middle lies on the tape once a pass; it is used by the source whose interval
    holds the place. Prefix sums run over slices of the seeded order, then within a slice.
    """
    order = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 40))
    slices = own.withColumn("place", order).withColumn("slice", F.floor(F.col("place") / F.lit((1 << 40) // SLICES)).cast("int"))
    sums = slices.groupBy("mix_id", "pattern", "slice").agg(F.sum("n_tokens").alias("tokens"))
    over = Window.partitionBy("mix_id", "pattern")
    sums = sums.withColumn("before", F.sum("tokens").over(over.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))).withColumn("whole", F.sum("tokens").over(over))
    sums = sums.select("mix_id", "pattern", "slice", F.coalesce("before", F.lit(0)).alias("before"), "whole")
    each = slices.join(sums, ["mix_id", "pattern", "slice"])
    within = Window.partitionBy("mix_id", "pattern", "slice").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)) + F.col("n_tokens") / 2
    each = each.withColumn("middle", middle).join(plan, ["mix_id", "pattern"])

    def passes(end):
        return F.greatest(F.ceil((F.col(end) - F.col("middle")) / F.col("whole")), F.lit(0))

    return each.withColumn("repeats", (passes("high") - passes("low")).cast("int")).filter("repeats > 0").select("mix_id", "source", "doc_id", "n_tokens", "repeats")


def _report(rows: DataFrame, targets: DataFrame, chosen: DataFrame) -> DataFrame:
    have = rows.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    got = chosen.groupBy("mix_id", "source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("n_docs"), F.max("repeats").alias("max_used"))
    t = targets.filter("source is not null").select("mix_id", "source", "target_weight", "max_repeats").distinct().join(have, "source", "left").join(got, ["mix_id", "source"], "left")
    mixes = Window.partitionBy("mix_id")
    whole = F.sum(F.coalesce("tokens", F.lit(0))).over(mixes)
    weight = F.sum(F.greatest(F.coalesce("target_weight", F.lit(0.0)), F.lit(0.0))).over(mixes)
    return t.select(
        "mix_id", "source", (F.greatest(F.coalesce("target_weight", F.lit(0.0)), F.lit(0.0)) / F.nullif(weight, F.lit(0.0))).alias("target_share"),
        F.when(whole > 0, F.coalesce("tokens", F.lit(0)) / whole).otherwise(F.lit(0.0)).alias("actual_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("available_tokens", F.lit(0)).alias("available_tokens"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("max_used", F.lit(0)).alias("max_used"),
    )
