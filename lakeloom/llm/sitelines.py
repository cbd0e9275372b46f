"""Problem 7: lines repeated across one site's documents.

Method: distributed PrefixSpan over each source's line-identifier sequences. Lines become
hashes of their normal form; frequent single lines are the first level, longer sequences grow
from projected positions: level by level where a source's are many, else in one task for all
levels. Occurrences of the members of frequent sequences are deleted.

Lines are the same after trimming, taking each run of white space as one space, ignoring
case, and taking each run of the digits 0-9 as one number. Supports count distinct
documents; rows of one ``doc_id`` count once. Null and blank texts have no lines.
A hot source is never gathered: supports combine map-side, and joins on a source are salted.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from lakeloom.functions.arrow import map_slices
from lakeloom.session import ship, written

#: Parts that a large source's documents are spread over when they meet its frequent lines, and the share of a large one.
SALTS, HOT_SHARE = 32, 1000


def line_keys(df: DataFrame, source: str = "domain") -> DataFrame:
    """One row a document with text: ``(doc_id, source, keys)``; a blank line's key is null.

    Only the hashes leave the text's stage.
    """
    normal = F.regexp_replace(F.regexp_replace(F.lower("text"), "[0-9]+", "0"), r"(?U)[\s&&[^\n]]+", " ")
    keys = F.transform(F.split(normal, "\n"), lambda x: F.when(F.trim(x) != "", F.xxhash64(F.trim(x))))
    rows = df.filter(F.col("doc_id").isNotNull() & F.col(source).isNotNull() & F.col("text").rlike(r"(?U)\S"))
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(source).alias("source"), keys.alias("keys"))
    return written(rows, "line-keys").dropDuplicates(["doc_id"])


def frequent_lines(lines: DataFrame, min_docs: int = 5, min_share: float = 0.2) -> DataFrame:
    """First level: ``(source, key, support, n_docs)`` of lines frequent within their source."""
    docs = lines.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    each = lines.select("source", F.explode(F.array_distinct("keys")).alias("key")).filter(F.col("key").isNotNull())
    support = each.groupBy("source", "key").agg(F.count(F.lit(1)).alias("support")).filter(F.col("support") >= min_docs)
    return support.join(docs, "source").filter(F.col("support") >= min_share * F.col("n_docs"))


def _beside_frequent(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """Documents with their source's frequent keys. A source has at most lines-a-document / share of them.

    Sources of more than one document in ``HOT_SHARE``, of which there are at most so many, are spread over ``SALTS`` parts.
    """
    sizes = lines.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    least = sizes.agg(F.sum("n_docs")).first()[0] or 0
    hot = F.broadcast(sizes.filter(F.col("n_docs") * HOT_SHARE > least).select("source", F.lit(SALTS).alias("salts")))
    parts = F.coalesce("salts", F.lit(1))
    per = frequent.groupBy("source").agg(F.collect_set("key").alias("frequent")).join(hot, "source", "left")
    per = per.select("source", "frequent", F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"))
    salted = lines.join(hot, "source", "left").withColumn("salt", F.pmod(F.xxhash64("doc_id"), parts).cast("int")).drop("salts")
    return salted.join(per.hint("merge"), ["source", "salt"])  # their size is not known: never broadcast


def occurrences(lines: DataFrame, sequences: DataFrame) -> DataFrame:
    """``(doc_id, line_no)`` of the lines to delete: the occurrences of the members of ``sequences``."""
    members = sequences.select("source", F.explode("pattern").alias("key")).distinct()
    return _beside_frequent(lines, members).select("doc_id", "frequent", F.posexplode("keys").alias("at", "key")).filter(F.array_contains("frequent", F.col("key"))).select("doc_id", (F.col("at") + 1).alias("line_no"))


def frequent_sequences(lines: DataFrame, min_docs: int = 5, min_share: float = 0.2, max_len: int | None = None, max_gap: int | None = None) -> DataFrame:
    """``(source, pattern, length, support)``: every frequent line, and the frequent sequences of more lines.

    Without ``max_gap`` members may be any number of lines apart, and of the sequences of
    more than one line the closed ones are given: those without a longer sequence of the same support, from which the
    support of every frequent sequence follows. With it all are given whose consecutive members are
    at most ``max_gap`` frequent lines apart. Levels grow until none is frequent, or to ``max_len`` lines.
    """
    first = written(frequent_lines(lines, min_docs, min_share), "frequent")
    kept = _beside_frequent(lines, first.select("source", "key"))
    items = F.expr("filter(keys, x -> x is not null and array_contains(frequent, x))")
    docs = lines.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    if max_gap is None:
        return _closed_sequences(kept.select("source", items.alias("items")), docs, first, min_docs, min_share, max_len)
    sequences = written(kept.select("source", "doc_id", items.alias("items")), "sequences")
    level = sequences.select("source", "doc_id", "items", F.posexplode("items").alias("end", "key")).select("source", "doc_id", "items", "end", F.array("key").alias("pattern"))
    found = first.select("source", F.array("key").alias("pattern"), F.lit(1).alias("length"), "support")
    length = 1
    while max_len is None or length < max_len:
        length += 1
        grown = level.withColumn("next", F.explode(F.expr(f"sequence(end + 1, end + {max_gap})"))).filter(F.col("next") < F.size("items"))
        grown = grown.select("source", "doc_id", "items", F.col("next").alias("end"), F.concat("pattern", F.array(F.expr("items[next]"))).alias("pattern"))
        grown = written(grown, f"level-{length}")
        support = grown.select("source", "pattern", "doc_id").distinct().groupBy("source", "pattern").agg(F.count(F.lit(1)).alias("support"))
        good = support.filter(F.col("support") >= min_docs).join(docs, "source").filter(F.col("support") >= min_share * F.col("n_docs")).select("source", "pattern", "support")
        good = written(good, f"patterns-{length}")
        if good.isEmpty():
            break
        found = found.unionByName(good.select("source", "pattern", F.lit(length).alias("length"), "support"))
        level = grown.join(good.select("source", "pattern"), ["source", "pattern"], "left_semi")
    return found


#: What :func:`_events` counts: lines that may follow, that may stand between, and that stand before a pattern's first place.
FOLLOWS, BETWEEN, BEFORE = 0, 1, 2
EVENTS = StructType([StructField("source", StringType()), StructField("pattern", ArrayType(LongType())), StructField("events", ArrayType(StructType([StructField("at", LongType()), StructField("key", LongType())]))), StructField("weight", LongType())])


def _events(items: list[int], pattern: list[int]) -> list[tuple[int, int]]:
    """``(3 * member + kind, line)``: the lines by which one sequence can extend ``pattern``, after BIDE.

    A line that every sequence with the pattern has between the first place of the members
    before ``member`` and the last place of that member makes a longer pattern of the same
    support; where the last place is taken within the pattern's first occurrence, so does every longer one.
    """
    n = len(pattern)
    first, at = [], -1
    for x in pattern:
        at = items.index(x, at + 1)
        first.append(at)

    def last(end: int) -> list[int]:
        out = [0] * n
        for i in range(n - 1, -1, -1):
            end -= 1
            while items[end] != pattern[i]:
                end -= 1
            out[i] = end
        return out

    out = {(FOLLOWS, x) for x in items[first[-1] + 1 :]}
    for kind, ends in ((BETWEEN, last(len(items))), (BEFORE, last(first[-1] + 1))):
        for i, end in enumerate(ends):
            out.update((3 * i + kind, x) for x in items[first[i - 1] + 1 if i else 0 : end])
    return sorted(out)


#: Sequences of a source with a common beginning that hold at most so many lines are mined in one task, some 5 MB of a worker's memory.
LOCAL_LINES = 50_000
SEQUENCES = StructType([StructField("source", StringType()), StructField("pattern", ArrayType(LongType())), StructField("length", IntegerType()), StructField("support", LongType())])


def _mined(rows: list[tuple[list[int], int]], pattern: list[int], least: float, max_len: int | None) -> list[tuple[list[int], int]]:
    """``(pattern, support)`` of the closed sequences of more than one line that begin with ``pattern``.

    ``rows`` are all ``(items, weight)`` that hold ``pattern``; ``least`` is the least support.
    """
    out, open_ = [], [(pattern, rows)]
    while open_:
        p, held = open_.pop()
        support = sum(w for _, w in held)
        follows: Counter = Counter()
        if p:
            events: Counter = Counter()
            for items, w in held:
                for e in _events(items, p):
                    events[e] += w
            every = [at % 3 for (at, _), n in events.items() if n == support]
            if len(p) > 1 and all(kind == BEFORE for kind in every):
                out.append((p, support))
            # A pattern with a line before it in its first place of all sequences leads to no closed one.
            if BEFORE in every or len(p) == max_len:
                continue
            follows.update({x: n for (at, x), n in events.items() if at == FOLLOWS})
        else:
            for items, w in held:
                for x in set(items):
                    follows[x] += w
        for x in sorted(x for x, n in follows.items() if n >= least):
            longer = [*p, x]
            open_.append((longer, [r for r in held if _holds(r[0], longer)]))
    return out


def _holds(items: list[int], pattern: list[int]) -> bool:
    rest = iter(items)
    return all(x in rest for x in pattern)


def _mined_locally(level: DataFrame, min_docs: int, min_share: float, max_len: int | None) -> DataFrame:
    """Closed sequences of ``(source, n_docs, pattern, items, weight)``, a task for a source's sequences with ``pattern``."""
    ship(level.sparkSession)
    target = to_arrow_schema(SEQUENCES)

    def run(group: pa.Table) -> pa.Table:
        source, n_docs, pattern = (group.column(c)[0].as_py() for c in ("source", "n_docs", "pattern"))
        found = _mined(list(zip(group.column("items").to_pylist(), group.column("weight").to_pylist())), pattern, max(min_docs, min_share * n_docs), max_len)
        values = [source] * len(found), [p for p, _ in found], [len(p) for p, _ in found], [n for _, n in found]
        return pa.Table.from_arrays([pa.array(v, type=f.type) for v, f in zip(values, target, strict=True)], schema=target)

    # By number, so that small groups, which take time, aren't put together in one task.
    parts = int(level.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return level.repartition(parts, "source", "pattern").groupBy("source", "pattern").applyInArrow(run, SEQUENCES)


def _closed_sequences(sequences: DataFrame, docs: DataFrame, first: DataFrame, min_docs: int, min_share: float, max_len: int | None) -> DataFrame:
    """Closed sequences. Equal sequences of a source are one row with their number as weight.

    Sequences with a common beginning are grown level by level while they hold more than ``LOCAL_LINES`` lines;
    what is left of a source then is mined in one task, so that levels do not cost jobs.
    """
    sequences = sequences.filter(F.size("items") > 0).groupBy("source", "items").agg(F.count(F.lit(1)).alias("weight"))
    level = written(sequences.join(docs, "source").select("source", "n_docs", F.array().cast("array<bigint>").alias("pattern"), "items", "weight"), "sequences")
    frequent = (F.col("n") >= min_docs) & (F.col("n") >= min_share * F.col("n_docs"))

    def factory():
        def kernel(sources, items, patterns, weights):
            return [sources, patterns, [_events(x, p) for x, p in zip(items, patterns)], weights]

        return kernel

    found = first.select("source", F.array("key").alias("pattern"), F.lit(1).alias("length"), "support")
    patterns = found.select("source", "pattern", "support")
    length = 0
    while True:
        large = level.groupBy("source", "pattern").agg(F.sum(F.size("items")).alias("n")).filter(F.col("n") > LOCAL_LINES).select("source", "pattern")
        large = F.broadcast(written(large, f"large-{length}"))  # at most so many as the lines hold LOCAL_LINES
        found = found.unionByName(written(_mined_locally(level.join(large, ["source", "pattern"], "left_anti"), min_docs, min_share, max_len), f"mined-{length}"))
        if large.isEmpty():
            return found
        level = level.join(large, ["source", "pattern"], "left_semi")
        if not length:
            level = level.select("source", "n_docs", "items", "weight", F.explode(F.array_distinct("items")).alias("key"))
            level = written(level.select("source", "n_docs", F.array("key").alias("pattern"), "items", "weight"), "level-1")
            length = 1
            continue
        patterns = patterns.join(large, ["source", "pattern"], "left_semi")
        events = map_slices(level, ["source", "items", "pattern", "weight"], EVENTS, factory)
        per = events.select("source", "pattern", "weight", F.explode("events").alias("x")).groupBy("source", "pattern", "x.at", "x.key").agg(F.sum("weight").alias("n"))
        per = written(per.join(patterns, ["source", "pattern"]).withColumn("all", F.col("n") == F.col("support")).join(docs, "source"), f"events-{length}")
        if length > 1:
            closed = patterns.join(per.filter(F.col("all") & (F.col("at") % 3 != BEFORE)).select("source", "pattern"), ["source", "pattern"], "left_anti")
            found = found.unionByName(written(closed.select("source", "pattern", F.lit(length).alias("length"), "support"), f"closed-{length}"))
        if length == max_len:
            return found
        # A pattern with a line before it in its first place of all sequences leads to no closed one.
        grown = per.filter((F.col("at") == FOLLOWS) & frequent).join(per.filter(F.col("all") & (F.col("at") % 3 == BEFORE)).select("source", "pattern"), ["source", "pattern"], "left_anti")
        length += 1
        grown = written(grown.select("source", F.concat("pattern", F.array("key")).alias("pattern"), F.col("n").alias("support")), f"patterns-{length}")
        if grown.isEmpty():
            return found
        longer = grown.select("source", F.slice("pattern", 1, length - 1).alias("pattern"), F.element_at("pattern", -1).alias("key"))
        level = level.join(longer, ["source", "pattern"]).select("source", "n_docs", F.concat("pattern", F.array("key")).alias("pattern"), "items", "weight")
        level = level.filter(f"aggregate(items, 0, (i, x) -> if(i < {length} and x = pattern[least(i, {length - 1})], i + 1, i)) = {length}")
        level = written(level, f"level-{length}")
        patterns = grown


def repeated_lines(df: DataFrame, source: str = "domain", min_docs: int = 5, min_share: float = 0.2) -> DataFrame:
    """``(doc_id, line_no)`` of lines that ``source`` repeats excessively: members of its frequent sequences, single lines included."""
    lines = line_keys(df, source)
    return occurrences(lines, frequent_sequences(lines, min_docs, min_share))


def without_repeated_lines(df: DataFrame, source: str = "domain", min_docs: int = 5, min_share: float = 0.2) -> DataFrame:
    """``(doc_id, text_kept)``: each document's text without its source's repeated lines."""
    gone = repeated_lines(df, source, min_docs, min_share).groupBy("doc_id").agg(F.collect_set("line_no").alias("gone"))
    # Texts with lines come first, so that a blank row of the same id does not stand for them.
    rows = df.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).groupBy("doc_id").agg(F.max_by("text", F.col("text").rlike(r"(?U)\S")).alias("text"))
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), (i + 1).cast("int")))
    return rows.join(gone, "doc_id", "left").select("doc_id", F.array_join(kept, "\n").alias("text_kept"))
