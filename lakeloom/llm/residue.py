"""Problem 6: template residue, filler text and error pages.

Method: the lines of records are aligned by their sentences and clauses, with slots for
figures, codes and the site's name. Slots that retain a variable's name, a default or filler
words flag their line (:func:`lakeloom.llm.pagelines.unfilled`). Whole-page templates are found by
repetition: a piece belongs to one if it comes in several records and nearly all of these
records, furniture aside, hold nothing but such pieces (the largest set of pieces for which
that is so, reached by removing those that do not fit). Records that hold the same frequent
pieces at the same places and differ at others are aligned before: what varies there is a further
slot. No phrase is listed anywhere.

A record is excluded if it has flagged lines or pieces of templates and, furniture aside,
nothing else. A null or blank text, a page of furniture only, and an article with a stray
placeholder are kept. An article's pieces come with pieces of their own elsewhere, and its copies,
known by their headline or, without title, their text, have one vote.

No record is compared with another: pieces meet their counts by key. Keys that very many
records share are few, so they are looked up in a table of bounded size; all others are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeloom.llm import pages as pg
from lakeloom.operators.copies import one_per_key
from lakeloom.session import written

#: A key of more than one in so many records is hot; there are at most so many times the pieces of a record of them.
HOT_SHARE = 100
#: Parts that the records of one signature are spread over.
SALTS = 16


def _signed(pages: DataFrame) -> DataFrame:
    """Records with ``sig``, equal for records that are alike in all that is looked at here."""
    return pages.select("doc_id", "voter", "pieces", "loose", "n_unfilled", F.xxhash64("voter", "pieces", "loose", "n_unfilled").alias("sig"))


def _supported(each: DataFrame, min_support: int) -> DataFrame:
    """``(key, n)``: pieces of ``min_support`` voters."""
    return each.groupBy("key").agg(F.count_distinct("voter").alias("n")).filter(F.col("n") >= min_support)


def _all_frequent(sure: DataFrame, frequent: DataFrame, n_records: int) -> DataFrame:
    """``(sig, hits)``: how many of a record's sure pieces are frequent."""
    hot = F.broadcast(frequent.filter(F.col("n") * HOT_SHARE >= n_records).select("key", F.lit(True).alias("hot")))
    each = sure.join(hot, "key", "left")
    here = each.filter("hot").select("sig")
    there = each.filter("hot is null").select("sig", "key").join(frequent.filter(F.col("n") * HOT_SHARE < n_records).select("key"), "key").select("sig")
    return here.unionByName(there).groupBy("sig").agg(F.count(F.lit(1)).alias("hits"))


def _templates(rows: DataFrame, frequent: DataFrame, min_support: int, min_share: float) -> tuple[DataFrame, DataFrame]:
    """``(key)`` of template pieces and ``(sig)`` of the records among ``rows`` that hold others.

    ``rows`` are ``(sig, voter, key, sure)`` of records all of whose sure pieces are frequent.
    """
    bad, size = None, None
    while True:
        left = rows if bad is None else rows.join(bad, "sig", "left_anti")
        seen = left.groupBy("key").agg(F.count_distinct("voter").alias("seen")).join(frequent, "key")
        keys = written(seen.filter((F.col("seen") >= min_support) & (F.col("seen") >= min_share * F.col("n"))).select("key"), "template-keys")
        bad = written(rows.filter("sure").join(keys, "key", "left_anti").select("sig").distinct(), "template-not")
        # Fewer pieces make more records unfit, and the other way round, until neither changes.
        now = tuple(keys.select(F.lit(1).alias("k")).unionByName(bad.select(F.lit(0).alias("k"))).agg(F.sum("k"), F.count(F.lit(1))).first())
        if now == size:
            return keys, bad
        size = now


def _aligned(one: DataFrame, near: DataFrame, frequent: DataFrame, min_support: int) -> DataFrame:
    """``(sig, voter, key, n)``: slots that stand for the pieces in which aligned records differ.

    Records are aligned if their frequent pieces are the same at the same places; a place at which
    ``min_support`` of them differ is a slot. Records with a piece that is neither have no row.
    """
    sure = F.expr("filter(pieces, x -> not array_contains(loose, x.line_no))")
    ordered = one.join(near, "sig", "left_semi").select("sig", "voter", F.posexplode(sure).alias("at", "x")).select("sig", "voter", "at", "x.key")
    marked = ordered.join(frequent.select("key", F.lit(True).alias("known")), "key", "left")
    frames = marked.groupBy("sig", "voter").agg(
        F.array_sort(F.collect_list(F.struct("at", F.when(F.col("known"), F.col("key")).alias("key")))).alias("frame"), F.array_sort(F.collect_list(F.when(F.col("known").isNull(), F.struct("at", "key")))).alias("holes")
    )
    holes = written(frames.select("sig", "voter", F.xxhash64("frame").alias("frame"), F.explode("holes").alias("hole")).select("sig", "voter", "frame", "hole.at", "hole.key"), "holes")
    slots = holes.groupBy("frame", "at").agg(F.count_distinct("voter").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).filter((F.col("n") >= min_support) & (F.col("lo") != F.col("hi"))).select("frame", "at", "n")
    filled = holes.join(slots, ["frame", "at"], "left")
    whole = filled.groupBy("sig").agg(F.min(F.col("n").isNotNull()).alias("whole")).filter("whole").select("sig")
    return filled.join(whole, "sig", "left_semi").select("sig", "voter", F.xxhash64("frame", "at").alias("key"), "n")


def excluded(pages: DataFrame, min_support: int = 3, min_share: float = 0.6) -> DataFrame:
    """``doc_id`` of the records to exclude, from the table of :func:`lakeloom.llm.pages.scan`."""
    return residue_lines(pages, min_support, min_share)[0]


def residue_lines(pages: DataFrame, min_support: int = 3, min_share: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """``(doc_id)`` of the records to exclude, and ``(doc_id, line_no)`` of their lines that make them so."""
    signed = _signed(pages)
    one = written(one_per_key(signed.drop("doc_id"), "sig"), "signatures")
    n_records = one.count()
    each = one.select("voter", F.explode(F.array_distinct("pieces.key")).alias("key"))
    frequent = written(_supported(each, min_support), "frequent-pieces")
    own = F.expr("array_distinct(transform(filter(pieces, x -> not array_contains(loose, x.line_no)), x -> x.key))")
    sized = one.select("sig", "n_unfilled", F.size(own).alias("n_sure"))
    hits = _all_frequent(one.select("sig", F.explode(own).alias("key")), frequent, n_records)
    fit = written(sized.join(hits, "sig", "left").withColumn("hits", F.coalesce("hits", F.lit(0))).filter("2 * hits >= n_sure"), "fit")
    slots = written(_aligned(one, fit.filter("hits < n_sure").select("sig"), frequent, min_support), "aligned")
    closed = fit.filter("hits = n_sure").select("sig", "n_unfilled").unionByName(fit.join(slots.select("sig"), "sig", "left_semi").select("sig", "n_unfilled"))
    rows = one.join(closed, "sig", "left_semi").select("sig", "voter", "loose", F.explode("pieces").alias("x")).select("sig", "voter", "x.key", (~F.array_contains("loose", F.col("x.line_no"))).alias("sure"))
    rows = rows.groupBy("sig", "voter", "key").agg(F.max("sure").alias("sure"))
    # The pieces that a slot stands for are not asked for, the slot is.
    rows = rows.join(frequent.select("key"), "key", "left_semi").unionByName(slots.select("sig", "voter", "key", F.lit(True).alias("sure")).distinct())
    rows = written(rows, "closed-pieces")
    keys, bad = _templates(rows, frequent.unionByName(slots.select("key", "n").distinct()), min_support, min_share)
    rest = closed.join(bad, "sig", "left_anti")
    found = rest.filter("n_unfilled > 0").select("sig").unionByName(rest.join(rows.join(keys, "key", "left_semi").select("sig"), "sig", "left_semi").select("sig"))
    found = written(found.distinct(), "excluded")
    salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    gone = one_per_key(signed.select("doc_id", "sig", "pieces"), "doc_id").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, ["sig", "salt"], "left_semi")
    lines = gone.select("doc_id", F.explode("pieces").alias("x")).select("doc_id", "x.line_no", "x.key").join(keys, "key", "left_semi").select("doc_id", "line_no").distinct()
    return gone.select("doc_id"), lines


def exclude_residue(df: DataFrame) -> DataFrame:
    """The rows of ``df`` that are kept; its columns and their order are unchanged."""
    return df.join(excluded(pg.scan(df)), "doc_id", "left_anti").select(*df.columns)
