"""Text curation: Unicode stage, cleaning rules held as data, Markdown stage, quality gate.

A rule is a row of :data:`RULES`; one function evaluates all of them. Rules match a host
exactly, then by suffix in their order, else the generic rule applies.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lakeloom.functions import columns as C
from lakeloom.operators.copies import one_per_key
from lakeloom.session import ship


@dataclass(frozen=True)
class Rule:
    """What a host's pages are freed of."""

    hosts: tuple[str, ...] = ()
    #: headings (``#`` and text) that start the tail; the text from there on is cut
    tail_headings: tuple[str, ...] = ()
    #: other patterns of whole lines that start the tail
    tail_lines: tuple[str, ...] = ()
    #: patterns of lines that are dropped anywhere
    drop: tuple[str, ...] = ()
    #: whole lines, in lower case, that are dropped anywhere
    drop_equal: tuple[str, ...] = ()
    #: ``(pattern, most characters)`` of lines dropped at the end, again and again
    trailing: tuple[tuple[str, int], ...] = ()
    #: drop bullets before the first main heading
    head_bullets: bool = False
    #: a heading goes with a dropped last line of this pattern
    heading_of: str = ""
    trim_head: bool = False
    _made: dict = field(default_factory=dict, compare=False, repr=False)


_VIEWS = r"\d+\s*lượt\s*xem"
# Hosts and the phrases that mark their page furniture.
RULES = (
    Rule(
        tail_headings=("chia sẻ", "share", "bình luận", "comment", "bài viết liên quan", "tin liên quan", "tin cùng chuyên mục", "theo dõi chúng tôi", "kết nối với chúng tôi", "thông tin liên hệ"),
        tail_lines=(r"©\s*(?:copyright|bản quyền)",), drop_equal=("chia sẻ", "share", "like", "tweet", "in bài"), trailing=((r"(?:---|___|\*\*\*)$", 3),),
    ),
    Rule(
        ("tamanhhospital.vn",), ("đối tác bảo hiểm", "đặt lịch khám", "hệ thống bệnh viện đa khoa tâm anh", "bài viết cùng chủ đề", "bài viết liên quan", "chuyên mục liên quan"),
        (r"bước 1:\s*bấm vào nút.*thêm bệnh viện đa khoa tâm anh",), (r"bước \d+:\s*.*bệnh viện đa khoa tâm anh", r"khi ô vuông chuyển thành dấu tích xanh là hoàn thành", r"\*?\s*hotline:\s*\d+"),
    ),
    Rule(
        ("tiemchunglongchau.com.vn",), ("bài viết liên quan", "chủ đề liên quan", "tiêm chủng liên quan", "nội dung liên quan", "thông tin tiêm chủng", "hệ thống trung tâm tiêm chủng"),
        drop=(_VIEWS,), trailing=((_VIEWS, 9999),), heading_of=_VIEWS,
    ),
    Rule(("hanoimoi.vn",), ("tin liên quan", "tin cùng chuyên mục", "đọc thêm", "từ khóa"), (r"\(\*\)\s*không sao chép dưới mọi hình thức.*cơ quan báo.*hà nội",), trailing=((r"- ", 59),)),
    Rule(
        ("vietnamnet.vn",), ("tin cùng chuyên mục", "tin mới", "tin nổi bật", "bình luận"), trailing=((r"(?:- )?xem thêm(?: về)?:$", 20), (r"- ", 59), (r"### ", 39)), head_bullets=True,
    ),
    Rule(("vov2.vov.vn",), ("tin cùng chuyên mục", "tin liên quan", "tin mới nhất", "tin mới", "xem nhiều", "đọc nhiều", "chương trình liên quan", "podcast", "nghe lại"), trailing=((r"#### ", 9999),)),
    Rule(("baoquangninh.vn",), ("từ khóa", "tin liên quan", "ý kiến bạn đọc"), trailing=((r"\*\*[^\W\d_][\w\s-]*\*\*$", 59), (r"- ", 39))),
    Rule(("nhandan.vn",), ("tin liên quan", "tin cùng chuyên mục", "đọc thêm", "từ khóa", "bình luận"), trailing=((r"(?:theo\s|bài và ảnh:|nguồn:|phóng viên|nhân dân|báo nhân dân)", 79), (r"- ", 39))),
    Rule(
        ("ask.39.net",),
        drop_equal=("- 就医助手", "- 药品通", "- 疾病百科", "- 咨讯诊疗", "- 资讯诊疗", "- 药品", "- 检查", "- 症状", "- 医院", "- 找医生", "- 39问医生", "- 39找医生", "- 39健康网", "- 找医院", "- 问答"),
    ),
    Rule(("woman.39.net", "pf.39.net"), ("推荐医院", "相关医院", "就医推荐", "相关阅读", "相关推荐"), trailing=((r"-\s+.+?(?:医院|妇幼保健院|诊所|中心)\s+[一二三]级", 9999), (r"- .*医院", 44))),
    Rule(
        ("www.baidu.com", "baidu.com"), drop=(r"(?=.*百度健康医典原创内容).*三审三校",),
        drop_equal=("- 概述", "- 病因", "- 症状", "- 就医", "- 检查", "- 诊断", "- 治疗", "- 预后", "- 预防", "- 日常"), trim_head=True,
    ),
)
_REGISTERED: list[Rule] = list(RULES)


def register(rule: Rule) -> None:
    """Add a rule, asked before the suffix rules that are there."""
    _REGISTERED.append(rule)


def rule_for(domain: str | None) -> Rule:
    d = (domain or "").strip().lower()
    for r in reversed(_REGISTERED):
        if d in r.hosts:
            return r
    return next((r for r in _REGISTERED for h in r.hosts if d.endswith(f".{h}")), _REGISTERED[0])


def _compiled(rule: Rule) -> dict:
    if not rule._made:
        heads = "|".join(map(re.escape, rule.tail_headings))
        tails = [rf"#+\s*(?:{heads})"] if heads else []
        rule._made.update(
            tail=re.compile("|".join((*tails, *rule.tail_lines)) or r"(?!)", re.I), drop=re.compile("|".join(rule.drop) or r"(?!)", re.I),
            trailing=[(re.compile(p, re.I), n) for p, n in rule.trailing], heading=re.compile(rule.heading_of or r"(?!)", re.I),
        )
    return rule._made


def apply_rule(rule: Rule, text: str) -> str:
    """``text`` without what the rule names."""
    made = _compiled(rule)
    lines = text.split("\n")
    if rule.head_bullets:
        first = next((i for i, x in enumerate(lines) if x.strip().startswith("# ")), 0)
        if all(not x.strip() or x.strip().startswith("- ") for x in lines[:first]):
            lines = lines[first:]
    lines = lines[: next((i for i, x in enumerate(lines) if made["tail"].match(x.strip())), len(lines))]
    while lines:
        last = lines[-1].strip()
        gone = not last or last.lower() in rule.drop_equal or any(len(last) <= n and p.match(last) for p, n in made["trailing"])
        if not gone:
            break
        lines.pop()
        if last and made["heading"].match(last) and lines and lines[-1].strip().startswith("#"):
            lines.pop()
    lines = [x for x in lines if not made["drop"].match(x.strip()) and x.strip().lower() not in rule.drop_equal]
    while lines and not lines[-1].strip():
        lines.pop()
    while rule.trim_head and lines and not lines[0].strip():
        lines.pop(0)
    return "\n".join(lines)


def unicode_stage(c):
    """NFC, no invisible characters, plain blanks and line ends, no blanks at line ends."""
    x = F.translate(C.unicode_form(c), "​‌‍﻿⁠­ ", "\x00" * 6 + " ")
    x = F.regexp_replace(F.regexp_replace(x, "\x00", ""), r"\r\n?", "\n")
    return F.regexp_replace(x, r"(?m)[ \t]+$", "")


def by_domain(df: DataFrame, text: str = "text", domain: str = "domain") -> DataFrame:
    """``df`` with ``text`` after its domain's rule."""
    ship(df.sparkSession)

    @F.pandas_udf("string")
    def clean(domains: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else apply_rule(rule_for(d), t) for d, t in zip(domains, texts)])

    return df.withColumn(text, clean(F.col(domain), F.col(text)))


def curate(corpus: DataFrame, min_chars: int = 50) -> DataFrame:
    """SUCCESS records after all stages: ``(doc_id, url, domain, title, text, raw_text_chars, text_chars, removed_chars, content_hash, curation_status)``
    and, where ``corpus`` has them, ``final_url, content_type, language, http_status, crawl_status``.

    ``CLEAN`` are texts of at least ``min_chars`` characters, the others ``LOW_QUALITY``; a
    null text counts as empty. Of an id's rows one with text counts; only repeated ids are compared.
    """
    good = corpus.filter("crawl_status = 'SUCCESS'").withColumn("_full", F.coalesce(F.col("text").rlike(r"\S"), F.lit(False)))
    full = one_per_key(good.filter("_full"), "doc_id")
    rows = full.unionByName(one_per_key(good.filter("not _full"), "doc_id").join(full.select("doc_id"), "doc_id", "left_anti"))
    rest = [c for c in ("final_url", "content_type", "language", "http_status", "crawl_status") if c in corpus.columns]
    raw = F.coalesce("text", F.lit(""))
    rows = rows.select(*rest, "doc_id", "url", "domain", C.strip(unicode_stage(F.coalesce("title", F.lit("")))).alias("title"), F.length(raw).alias("raw_text_chars"), unicode_stage(raw).alias("text"))
    rows = by_domain(rows).withColumn("text", C.strip(F.regexp_replace("text", r"\n{3,}", "\n\n")))
    n = F.length("text")
    return rows.withColumns(
        {"text_chars": n, "removed_chars": F.greatest(F.lit(0), F.col("raw_text_chars") - n), "content_hash": F.sha2("text", 256), "curation_status": F.when(n >= min_chars, "CLEAN").otherwise("LOW_QUALITY")}
    )


def curation_stats(curated: DataFrame) -> DataFrame:
    """Per domain: documents, clean ones and removed characters."""
    return curated.groupBy("domain").agg(F.count(F.lit(1)).alias("n_docs"), F.sum((F.col("curation_status") == "CLEAN").cast("long")).alias("n_clean"), F.sum("removed_chars").alias("removed_chars"))


def pair_raw_and_clean(curated: DataFrame, corpus: DataFrame) -> DataFrame:
    """Clean documents beside their raw text; without one the clean text stands in."""
    raw = corpus.filter("text is not null").groupBy("doc_id").agg(F.max("text").alias("raw_text"))
    return curated.join(raw, "doc_id", "left").withColumn("raw_text", F.coalesce("raw_text", "text"))
