"""Queries of the operators in this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.llm import chunking, encode, forms, langid, mainbody, mixing, pages, residue, sentences, sitelines
from lakeloom.operators.copies import one_per_key
from lakeloom.session import table, written


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return forms.same_look_pairs(table(spark, sf, "corpus"))


def p1_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Every record's title and text in one form."""
    rows = table(spark, sf, "corpus").select("doc_id", "title", "text", F.xxhash64("text").alias("stored"))
    return forms.unify(one_per_key(rows, "doc_id", "stored").drop("stored")).select("doc_id", "title_form", "text_form")


def p1_classes(spark: SparkSession, sf: str) -> DataFrame:
    return forms.look_classes(table(spark, sf, "corpus"))


def _languages(spark: SparkSession, sf: str, every: bool = False) -> tuple[DataFrame, DataFrame]:
    scanned = pages.scan(table(spark, sf, "corpus"), langid.fit(table(spark, sf, "lang_samples")), every=every)
    rows = pages.records(scanned, "langs").filter(F.size("langs") > 0).select("doc_id", F.explode("langs").alias("x")).select("doc_id", "x.*")
    return scanned, rows


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    scanned, rows = _languages(spark, sf)
    found = rows.filter("line_no > 0 or mislabelled").join(residue.excluded(scanned), "doc_id", "left_anti")
    return found.select("doc_id", "line_no", "lang")


def p2_languages(spark: SparkSession, sf: str) -> DataFrame:
    """Main language (line 0) of every record and language of every line in another, with confidence."""
    return _languages(spark, sf, every=True)[1].select("doc_id", "line_no", "lang", F.round("confidence", 6).alias("confidence"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    cut = chunking.with_spans(table(spark, sf, "corpus").select("doc_id", "text"))
    return cut.filter(F.size("spans") > 1).select("doc_id").distinct()


def p4_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.pieces(table(spark, sf, "corpus"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return mainbody.furniture(pages.scan(table(spark, sf, "corpus")))


def p5_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Every page's bare headline and article."""
    corpus = table(spark, sf, "corpus").select("doc_id", "domain", "title", "text")
    return mainbody.main_body(one_per_key(corpus.filter(F.col("text").rlike(r"\S")), "doc_id")).select("doc_id", "headline", "body")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return residue.excluded(pages.scan(table(spark, sf, "corpus")))


def p6_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers and statuses of the rows that are kept."""
    return residue.exclude_residue(table(spark, sf, "corpus")).select("doc_id", "crawl_status", F.length("text").alias("chars"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return sitelines.repeated_lines(table(spark, sf, "corpus"))


def p7_clean(spark: SparkSession, sf: str) -> DataFrame:
    return sitelines.without_repeated_lines(table(spark, sf, "corpus"))


def p7_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Frequent line sequences of each domain, as hashes of their lines."""
    return sitelines.frequent_sequences(sitelines.line_keys(table(spark, sf, "corpus")))


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode.with_ids(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "ids")


def _mix(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    sized = encode.with_token_counts(table(spark, sf, "documents").select("doc_id", "source", "text")).drop("text")
    return mixing.mix(written(sized, "sizes"), table(spark, sf, "mix_targets"))


def p9_chosen(spark: SparkSession, sf: str) -> DataFrame:
    return _mix(spark, sf)[0].select("mix_id", "source", "doc_id", "n_tokens", "repeats")


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    return _mix(spark, sf)[1]


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    ends = sentences.with_sentence_ends(table(spark, sf, "documents").select("doc_id", "text"))
    return ends.select("doc_id", F.explode("sent_ends").alias("sent_end"))


def p10_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return sentences.sentences(table(spark, sf, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = (p1_found, p1_forms, p1_classes, p2_found, p2_languages, p4_found, p4_pieces, p5_found, p5_bodies, p6_found, p6_kept, p7_found, p7_clean, p7_sequences, p8_ids, p9_chosen, p9_shares, p10_found, p10_sentences)
    return {f.__name__: f for f in each}


_LINES = r"""
    with docs as (select distinct doc_id, domain, text from corpus where text is not null and regexp_matches(text, '\S')),
    split as (select doc_id, domain, unnest(string_split(text, chr(10))) as line, unnest(range(1, len(string_split(text, chr(10))) + 1)) as line_no from docs),
    lines as (select doc_id, domain, cast(line_no as integer) as line_no,
        trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0085}\x0b]+', ' ', 'g')) as k from split),
    support as (select domain, k, count(distinct doc_id) as n from lines where k <> '' group by all),
    sizes as (select domain, count(distinct doc_id) as n_docs from docs group by all)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": "select distinct doc_id from corpus where length(text) > 4000",
        "p7_clean": _LINES
        + """, gone as (select doc_id, list(distinct line_no) as ns from lines join support using (domain, k) join sizes using (domain) where k <> '' and n >= 5 and n >= 0.2 * n_docs group by doc_id),
        texts as (select doc_id, max_by(text, regexp_matches(text, '\\S')) as text from corpus where text is not null group by doc_id)
        select doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: not coalesce(list_contains(ns, i), false)), chr(10)) as text_kept from texts left join gone using (doc_id)""",
        "p7_found": _LINES + "select distinct doc_id, line_no from lines join support using (domain, k) join sizes using (domain) where k <> '' and n >= 5 and n >= 0.2 * n_docs",
    }
