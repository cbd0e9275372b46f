"""Edge cases: nulls, ties, repeats, empty tables, clashing names."""

import gzip
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom import schemas
from lakeloom.functions import columns as C
from lakeloom.operators import archive, chunks, cleaning, corpus, dense, extraction, fusion, lexical, planning, profile, results, sampling, selection, skew, state


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_urls(spark):
    df = spark.createDataFrame([(u,) for u in (" HTTP://Ex.com:80", "https://ex.com:443/a?b=1#c", "https://u:p@ex.com/", "ftp://ex.com/", "http://[::1]:8080/x", "", None, "https://ex.com/A.PDF")], "url string")
    got = [r[0] for r in df.select(C.normalize_fetch_url(F.col("url"))).collect()]
    assert got == ["http://ex.com/", "https://ex.com/a?b=1", None, None, "http://[::1]:8080/x", None, None, "https://ex.com/A.PDF"]
    assert [r[0] for r in df.select(C.is_pdf_like(F.col("url"))).collect()][-1]


def test_stable_int_is_the_definition(spark):
    import hashlib

    df = spark.createDataFrame([(i,) for i in range(200)], "v long").select("v", C.stable_int(F.col("v"), 7).alias("h"))
    for v, h in df.collect():
        assert h == int.from_bytes(hashlib.sha256(f"7:{v}".encode()).digest()[:8], "big") & (2**63 - 1)


def test_text_columns(spark):
    t = "é a\r\n\r\n\r\n\r\n x , y  "
    df = spark.createDataFrame([(t,), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(C.clean_text(F.col("t"))).collect()] == ["é a\n\nx, y", None, ""]
    assert spark.range(1).select(C.token_count(F.lit("中文 and more words"))).first()[0] == 2 + 3
    assert spark.range(1).select(C.tokens(F.lit("Beta-HCG 中文字 v1.2"))).first()[0] == ["beta-hcg", "v1.2", "中文", "文字"]


def test_hot_keys_and_empty_tables(spark):
    df = spark.createDataFrame([("a",)] * 90 + [("b",)] * 5 + [(f"k{i}",) for i in range(4)] + [(None,)], "k string")
    assert rows(skew.hot_keys(df, "k")) == [("a",), ("b",)]
    assert skew.hot_keys(df.limit(0), "k").count() == 0
    assert rows(skew.keyed_distinct(spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", None)], "k string, v int"), "k", "v", "n")) == [("a", 1), ("b", 0)]


def test_winners_do_not_depend_on_order(spark):
    made = [(1, "u", None, "d", None, None, None, None, None, None, "FAILED", 0, 0), (1, "u", None, "d", None, "t", "text", None, "h", 200, "SUCCESS", 4, 9), (1, "u", None, "d", None, "t", "text", None, "h", 200, "SUCCESS", 4, 9), (2, "v", None, "d", None, None, None, None, None, None, "NOT_FOUND", 0, 0)]
    for _ in range(3):
        random.shuffle(made)
        df = spark.createDataFrame(made, schemas.CORPUS_SCHEMA)
        assert rows(corpus.winners(df).select("doc_id", "crawl_status")) == [(1, "SUCCESS"), (2, "NOT_FOUND")]
    assert rows(corpus.merge_conflicts(df).select("doc_id", "n_versions")) == [(1, 2)]


def test_recovery_never_demotes(spark):
    base = spark.createDataFrame([(1, "SUCCESS"), (2, "FAILED"), (3, "FAILED")], "doc_id long, crawl_status string")
    new = spark.createDataFrame([(1, "FAILED", 1), (2, "SUCCESS", 1), (2, "FAILED", 2), (3, "NEEDS_JS", 1)], "doc_id long, crawl_status string, seq long")
    assert rows(corpus.recovery_merge(base, new, "seq")) == [(1, "SUCCESS"), (2, "SUCCESS"), (3, "NEEDS_JS")]


def test_pilot_is_exact_and_capped(spark):
    links = spark.createDataFrame([(i, f"https://h{i % 10}.example/{i}{'.pdf' if i % 10 == 0 or i % 7 == 0 else ''}") for i in range(300)], "doc_id long, url string")
    a, b = rows(sampling.pilot(links, 40)), rows(sampling.pilot(links.repartition(5), 40))
    assert a == b and len({r[0] for r in a}) == 40
    assert max(sum(r[2] == d for r in a) for d in {r[2] for r in a}) <= 6


def test_sqrt_quotas():
    q = sampling.sqrt_quotas({"a": 100, "b": 25, "c": 1}, {"a": 100, "b": 25, "c": 1}, 30)
    assert sum(q.values()) == 30 and q["a"] > q["b"] > q["c"]
    with pytest.raises(ValueError):
        sampling.sqrt_quotas({"a": 2}, {"a": 2}, 3)


def test_balance_splits_the_hot_domain(spark):
    work = {"hot": 100.0, **{f"d{i}": 10.0 for i in range(5)}}
    plan = planning.balance(work, {k: int(v) for k, v in work.items()}, 6)
    assert len({w for d, _, _, w in plan if d == "hot"}) == 2 and len(plan) == 7
    links = spark.createDataFrame([(i, f"https://{'hot' if i < 100 else f'd{i % 5}'}.example/{i}") for i in range(150)], "doc_id long, url string")
    done = planning.assign(links, spark.createDataFrame([("hot.example", 100.0)], "domain string, estimated_work double"))
    assert done.count() == 150 and planning.check_assignment(links, done).count() == 0


TASKS = "doc_id long, fetch_key string, domain string, status string, attempts int, next_retry_at double, text_chars int"


def test_claims_and_outcomes(spark):
    t = spark.createDataFrame([(1, "a", "x", "PENDING", 0, None, None), (2, "a", "x", "PENDING", 0, None, None), (3, "b", "x", "RETRY_WAIT", 1, 5.0, None), (4, "c", "y", "RETRY_WAIT", 1, 99.0, None), (5, "d", "y", "PENDING", 0, None, None), (6, "e", "z", "DEFERRED", 0, None, None)], TASKS)
    got = state.fair_claim(t, 10.0, 3)
    assert rows(got.select("claim_no", "fetch_key")) == [(1, "b"), (2, "d"), (3, "a")]
    after = state.claim(t, got)
    assert rows(after.filter("status = 'FETCHING'").select("doc_id", "attempts")) == [(1, 1), (2, 1), (3, 2), (5, 1)]
    out = spark.createDataFrame([("a", "SUCCESS", False), ("b", "FAILED", True), ("d", "FAILED", None)], "fetch_key string, outcome string, retryable boolean")
    end = {r.doc_id: (r.status, r.next_retry_at) for r in state.settle(after, out, 100.0).collect()}
    assert end[1] == end[2] == ("SUCCESS", None) and end[5] == ("FAILED", None) and end[3][0] == "RETRY_WAIT" and 160 <= end[3][1] < 161.1
    assert state.recover(after).filter("status = 'FETCHING'").count() == 0
    assert state.fair_claim(t.limit(0), 1.0, 3).count() == 0


def test_timings(spark):
    log = spark.createDataFrame([("k", "d", 1, "FAILED", True, 2.0, 1, 1), ("k", "d", 1, "FAILED", True, 2.0, 1, 1), ("k", "d", 2, "SUCCESS", None, 3.0, 2, 9), ("k", "d", 2, "FAILED", None, 4.0, 2, 8)], "fetch_key string, domain string, attempt int, status string, retryable boolean, elapsed_seconds double, finished_at int, logged_at int")
    assert rows(profile.target_timings(log)) == [("k", "d", 2, 5.0, "SUCCESS")]
    assert rows(profile.timing_conflicts(log)) == [("k", 2)]


def test_bm25_is_brute_force(spark, sf):
    import math
    from collections import Counter

    docs = spark.createDataFrame([(1, "heart pain", "the heart hurts at night"), (2, None, "pain in the knee, pain"), (3, "", None), (4, "heart pain", "the heart hurts at night"), (5, "x", "heart")], "doc_id long, title string, text string")
    asked = spark.createDataFrame([(10, "heart pain pain"), (11, "unknown"), (12, None)], "query_id long, query string")
    got = {(r.query_id, r.doc_id): r.score for r in lexical.search(docs, asked, 10).collect()}
    data = [(r.doc_id, r.title or "", r.text or "") for r in docs.collect()]
    want = {}
    for field, boost in ((1, 2.0), (2, 1.0)):
        toks = {d[0]: [w.strip(",") for w in d[field].split()] for d in data}
        avg, n = sum(map(len, toks.values())) / len(data), len(data)
        for w, uses in Counter("heart pain pain".split()).items():
            df = sum(w in t for t in toks.values())
            for d, t in toks.items():
                if w in t:
                    want[d] = want.get(d, 0) + uses * boost * math.log(1 + (n - df + 0.5) / (df + 0.5)) * t.count(w) * 2.2 / (t.count(w) + 1.2 * (0.25 + 0.75 * len(t) / avg))
    assert got == {(10, d): round(s, 6) for d, s in want.items()}
    ranks = {r.doc_id: r["rank"] for r in lexical.search(docs, asked, 2).collect()}
    assert ranks == {1: 1, 4: 2}  # a tie goes to the smaller id


def test_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (4, None), (5, [1.0])], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(7, [1.0, 0.5])], "query_id long, embedding array<float>")
    assert [(r.vec_id, r["rank"]) for r in dense.top_k(v, q, 2).orderBy("rank").collect()] == [(1, 1), (3, 2)]
    assert dense.top_k(v, q.limit(0), 2).count() == 0
    e = dense.hashing_encoder(64)(["alpha beta gamma", "", None])
    assert np.allclose(np.linalg.norm(e, axis=1), [1, 0, 0])


def test_fusion(spark):
    a = spark.createDataFrame([(1, 10, 1, 3.0), (1, 20, 2, 2.0), (1, 20, 5, 1.0)], "query_id long, doc_id long, rank int, score double")
    b = spark.createDataFrame([(1, 10, 2, 0.5), (1, 40, 1, 0.9)], "query_id long, doc_id long, rank int, score double")
    got = fusion.fuse(a, b).orderBy("final_rank").collect()
    assert [(r.doc_id, round(r.fused_score, 6)) for r in got] == [(10, round(1 / 61 + 1 / 62, 6)), (40, round(1 / 61, 6)), (20, round(1 / 65, 6))]
    assert tuple(fusion.fusion_stats(fusion.fuse(a, b)).first()) == (3, 1, 1, 1)


@pytest.mark.parametrize(
    "domain, text, want",
    [
        ("any.example", "body\n## Chia sẻ\ntail", "body"), ("any.example", "Share\nbody\n---\n", "body"), ("www.hanoimoi.vn", "body text\n- Tag\n- Other tag", "body text"),
        ("vietnamnet.vn", "- Home\n- News\n# Title\nbody\n## Tin mới\nx", "# Title\nbody"), ("vov2.vov.vn", "body\n#### One\n#### Two", "body"), ("tiemchunglongchau.com.vn", "body\n### Next\n12 lượt xem", "body"),
        ("ask.39.net", "answer\n- 药品\n- 医院", "answer"), ("pf.39.net", "body\n- 某某医院 三级甲等", "body"), ("baidu.com", "\n- 概述\nbody\n- 治疗", "body"), ("nhandan.vn", "body\nTheo Báo", "body"), ("baoquangninh.vn", "body\n**Lan Anh**", "body"),
    ],
)
def test_cleaning_rules(domain, text, want):
    assert cleaning.apply_rule(cleaning.rule_for(domain), text) == want


def test_curation_counts(spark):
    t = "a​b  \r\n" + "word " * 20
    made = [(1, "u", None, "d", None, " T ", t, None, None, 200, "SUCCESS", 4, 9), (2, "u", None, "d", None, None, None, None, None, 200, "SUCCESS", 0, 9), (3, "u", None, "d", None, None, "x", None, None, 200, "FAILED", 0, 9)]
    got = {r.doc_id: r for r in cleaning.curate(spark.createDataFrame(made, schemas.CORPUS_SCHEMA)).collect()}
    assert got[1].text.startswith("ab\nword") and got[1].title == "T" and got[1].curation_status == "CLEAN" and got[2].curation_status == "LOW_QUALITY" and 3 not in got


def test_extraction(spark):
    html = b"<html><title>T</title><body><nav>menu</nav><div class='related-box'>no</div><h1>Head</h1><p>One &amp; two</p><ul><li>a</li></ul><table><tr><th>x</th></tr><tr><td>1|2</td><td>3</td></tr></table><script>x()</script></body></html>"
    title, text, density = extraction.extract_html(html)
    assert title == "Head" and "# Head" in text and "One & two" in text and "- a" in text and "| 1\\|2 | 3 |" in text and "menu" not in text and "no" not in text.split() and density == 0
    df = spark.createDataFrame([(bytearray(html), "text/html"), (bytearray(b"<div id=\"root\"></div>"), "text/html"), (bytearray(b"%PDF-1.4"), "text/html"), (None, None), (bytearray(b"hi"), "text/plain"), (bytearray(b"x"), "image/png")], "content binary, content_type string")
    assert [r.status for r in extraction.route(df, min_chars=10).collect()] == ["SUCCESS", "NEEDS_JS", "NEEDS_OCR", "FAILED", "EMPTY_CONTENT", "UNSUPPORTED"]
    record = gzip.compress(b"WARC/1.0\r\n\r\nHTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n2\r\nde\r\n0\r\n\r\n")
    assert extraction.decode_record(record) == b"abcde" and extraction.decode_record(b"junk") is None


def test_extraction_by_site(spark):
    long_ = "This paragraph of the article has quite enough characters to stay. " * 4
    html = f"<h1>Head</h1><div class='detail-cmain'><div class='detail-social'><p>{long_} no</p></div><p>{long_}</p><p>short</p></div><p>outside of the body, long enough</p>"
    df = spark.createDataFrame([(html, "thanhnien.vn"), ("<h1>H</h1><p>general text</p>", "thanhnien.vn"), (None, "qdnd.vn"), ("<p>x</p>", None)], "content string, domain string")
    got = [r.page for r in extraction.extracted_by_site(df).collect()]
    assert got[0].title == "Head" and got[0].text == long_.strip() and got[1].text.endswith("general text") and got[2].text is None and got[3].text == "x"
    answer = "The answer in the linked data is long enough to be used. " * 3
    page = f'<div class="txt_label"><a>gout</a><a>diet</a></div><p class="ans_cont">An answer of some twenty characters.</p><script type="application/ld+json">{{"acceptedAnswer": {{"text": "{answer}"}}}}</script>'
    text = extraction.extract_site(page, "ask.39.net")[1]
    assert text.startswith("gout, diet") and "An answer" in text and answer.strip() in text


def test_ranges(spark):
    r = spark.createDataFrame([("f", 0, 10), ("f", 20, 10), ("f", 1000, 5), ("g", 25, 1)], "filename string, offset long, length long")
    assert rows(archive.coalesce_ranges(r, 50).select("filename", "offset", "length", "n_records")) == [("f", 0, 30, 2), ("f", 1000, 5, 1), ("g", 25, 1, 1)]
    many = spark.createDataFrame([("f", i * 10, 10) for i in range(10)], "filename string, offset long, length long")
    assert rows(archive.bounded_ranges(many, 50, 35).select("offset", "length", "n_records")) == [(0, 30, 3), (30, 30, 3), (60, 30, 3), (90, 10, 1)]
    g = spark.createDataFrame([("f", 0, 30, bytearray(b"0123456789..........abcdefghij"))], "filename string, offset long, length long, payload binary")
    assert {bytes(x.record) for x in archive.slice_records(g, r).collect()} == {b"0123456789", b"abcdefghij"}
    assert archive.probe_quotas({"a": 100, "b": 1}, 10) == {"a": 9, "b": 1}


def test_chunks_lose_no_sentence():
    text = " ".join(f"Sentence number {i} has some words in it." for i in range(120))
    made = chunks.chunk_document("A title", text, most=100, target=80, overlap=20)
    assert all(t <= 100 for _, _, t in made) and all(any(f"number {i} " in c for _, c, _ in made) for i in range(120))
    assert chunks.chunk_document("Only", None) == [("", "Only", 1)] and chunks.chunk_document(None, " ") == []
    assert chunks.split_sentences("Dr. Lee came at 3.5 km. Then left! 你好。再见") == ["Dr. Lee came at 3.5 km.", "Then left!", "你好。", "再见"]


def test_selection(spark):
    text = {1: "alpha beta gamma delta epsilon zeta eta theta iota", 2: "one two three four five six seven eight nine"}
    c = [(1, 10, 1, "10_0", 0, 0.9, text[1]), (1, 10, 1, "10_1", 1, 0.8, text[1] + "!"), (1, 10, 1, "10_2", 2, 0.7, "© 2020 all rights reserved"), (1, 20, 2, "20_0", 0, 0.1, text[2]), (1, 30, 3, "30_0", 0, 0.1, text[2])]
    df = spark.createDataFrame(c, "query_id long, doc_id long, doc_rank int, chunk_id string, chunk_index int, score double, text string")
    got = selection.select_chunks(df, top_k=5).orderBy("chunk_order").collect()
    assert [(r.chunk_id, r.source) for r in got] == [("10_0", "ranked"), ("20_0", "ranked"), ("30_0", "fallback")]
    p = spark.createDataFrame([("pubmed:12 Query: [Tiêu đề: x] real text",)], "t string").select(selection.strip_prefixes(F.col("t"))).first()[0]
    assert p == "real text"


def test_expansion():
    full = " ".join(f"This is sentence {i} of the text." for i in range(40))
    chunk = "This is sentence 20 of the text."
    grown, how = selection.expand_passage(chunk, full, budget=60)
    assert how == "grown" and chunk in grown and grown in full and chunks.count_tokens(grown) <= 60
    assert selection.expand_passage(chunk, chunk + " " + "word " * 100 + chunk, budget=60)[1] == "ambiguous"
    assert selection.expand_passage("a b c d", None, None, "b c d e f", budget=60) == ("a b c d e f", "neighbours")
    assert selection.expand_passage("", "x") == ("", "empty")


def item(**change):
    return {"id": 1, "relevant_docs": [5], "relevant_chunks": [{"doc_id": 5, "chunk_text": "t", "chunk_order": 1}]} | change


@pytest.mark.parametrize(
    "items, check",
    [
        ([item()], None), ([item(id="1")], "id is no integer"), ([item(), item()], "query twice"), ([item(id=2)], "query is missing"), ([item(relevant_docs=["5"])], "document id is no integer"), ([item(relevant_docs=[5, 5])], "document twice"),
        ([item(relevant_chunks=[{"doc_id": 5, "chunk_text": " "}])], "chunk without text"), ([item(relevant_chunks=[{"doc_id": 5, "chunk_text": "Query: x"}])], "prefix leaks"), ([item(relevant_chunks=[{"doc_id": 5, "chunk_text": "x", "score": 1}])], "forbidden field"),
        ([item(relevant_docs=None)], "relevant_docs is no array"), ([item(relevant_chunks=[{"doc_id": True, "chunk_text": "x"}])], "chunk's document id is no integer"),
    ],
)
def test_validation(spark, items, check):
    raw = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "item_no int, raw string")
    found = {r["check"] for r in results.validate(raw, spark.createDataFrame([(1,)], "query_id long")).collect() if r.severity == "error"}
    assert (check in found) if check else not found


def test_results_round_trip(spark, tmp_path):
    q = spark.createDataFrame([(1,), (2,)], "query_id long")
    ranked = spark.createDataFrame([(1, 7, 2), (1, 8, 1), (1, 8, 3)], "query_id long, doc_id long, rank int")
    chosen = spark.createDataFrame([(1, 8, 1, "text")], "query_id long, doc_id long, chunk_order int, text string")
    made = results.nested(q, ranked, chosen)
    assert [(r.id, r.relevant_docs) for r in made.orderBy("id").collect()] == [(1, [8, 7]), (2, [])]
    results.write_results(made, str(tmp_path / "r.zip"))
    assert results.read_results(spark, str(tmp_path / "r.zip")).count() == 2
    assert rows(results.compare(made, made).select("verdict").distinct()) == [("same",)]
    assert "n_queries" in results.report_text(results.diagnose(made))
