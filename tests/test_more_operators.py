"""Indexes, copies, quantiles, archive states, abstracts and result reports on small fixtures."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import archive, copies, corpus, dense, index, lexical, planning, profile, results, selection, state


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_one_per_key(spark):
    made = [(i, f"t{i}") for i in range(50)] + [(7, "t7"), (None, "a"), (None, "a")]
    df = spark.createDataFrame(made, "k long, t string").withColumn("_word", F.lit(1)).withColumnRenamed("_word", "word")
    for bits in (24, 7):  # with few bits keys share one: rows are compared, none is lost
        assert rows(copies.one_per_key(df, "k", bits=bits).filter("k is not null")) == sorted({(k, t, 1) for k, t in made if k is not None})
        assert copies.one_per_key(df, "k", bits=bits).filter("k is null").count() == 1
    assert copies.one_per_key(df.limit(0), "k").count() == 0


def test_quantiles_are_exact(spark):
    rng = random.Random(3)
    made = [(rng.choice(["hot"] * 9 + ["a", None]), rng.choice([0.0, 0.5, rng.random() * 100, rng.random()])) for _ in range(400)] + [("one", 3.0), ("a", None)]
    got = {r.g: (r.n, r.median, r.p95) for r in profile.quantiles(spark.createDataFrame(made, "g string, v double"), ["g"], "v").collect()}
    for g in {g for g, _ in made}:
        v = sorted(x for k, x in made if k == g and x is not None)
        n, median, p95 = got[g]
        assert n == len(v) and abs(median - statistics.median(v)) < 1e-12 and p95 == v[-(-95 * len(v) // 100) - 1]
    assert profile.quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v").count() == 0


def test_token_index_gives_what_a_search_gives(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Gout", "a diet rich in walnuts"), (2, None, "walnuts and gout gout"), (3, "Sleep", None), (3, "Sleep", "long sleep helps gout")], "doc_id long, title string, text string")
    asked = spark.createDataFrame([(1, "gout walnuts"), (2, "nothing"), (3, None)], "query_id long, query string")
    index.build_tokens(docs, str(tmp_path / "i"))
    opened = index.open_tokens(spark, str(tmp_path / "i"))
    one = docs.filter("not (doc_id = 3 and text is null)")
    assert rows(opened.search(asked)) == rows(lexical.search(one, asked)) and opened.facts["n_docs"] == 3
    with pytest.raises(ValueError, match="no field"):
        opened.search(asked, boosts={"abstract": 1.0})


def test_search_in_blocks_of_queries(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i % 7} w{i % 5} x") for i in range(60)], "doc_id long, text string")
    asked = spark.createDataFrame([(q, f"w{q % 7} w{q % 3}") for q in range(11)], "query_id long, query string")
    want = rows(lexical.search(docs, asked, 5, {"text": 1.0}))
    monkeypatch.setattr(lexical, "QUERY_BLOCK", 3)
    assert rows(lexical.search(docs, asked, 5, {"text": 1.0})) == want and len(want) == 55


def test_vector_index(spark, tmp_path):
    v = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(9)], "vec_id long, embedding array<float>")
    config = {"model": "hashing", "normalise": True}
    index.build_vectors(v, str(tmp_path / "v"), config)
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<float>")
    assert [r.vec_id for r in index.open_vectors(spark, str(tmp_path / "v"), config).search(asked, 3).orderBy("rank").collect()] == [2, 5, 8]
    with pytest.raises(ValueError, match="normalise"):
        index.open_vectors(spark, str(tmp_path / "v"), config | {"normalise": False})
    assert index.fingerprint({"a": 1, "b": 2}) == index.fingerprint({"b": 2, "a": 1})


def test_encoding_in_parts_is_taken_up_again(spark, tmp_path):
    docs = spark.createDataFrame([(i, None if i == 3 else f"text {i}") for i in range(20)], "doc_id long, text string")
    assert dense.encode_in_parts(docs, str(tmp_path / "e"), "text", 4, prefix="query: ") == 4
    assert dense.encode_in_parts(docs, str(tmp_path / "e"), "text", 4, prefix="query: ") == 0
    back = spark.read.parquet(str(tmp_path / "e"))
    assert back.count() == 20 and back.filter("vector is null").count() == 1


def test_chunks_from_every_source(spark):
    chunks = spark.createDataFrame([(d, f"{d}_{n}", n, f"text {d} {n}") for d in (1, 2) for n in (0, 1, 2)], "doc_id long, chunk_id string, chunk_index int, text string")
    ranked = spark.createDataFrame([(9, 1, 1), (9, 2, 2)], "query_id long, doc_id long, rank int")
    hits = spark.createDataFrame([(9, "1_2", 0.8), (9, "7_0", 0.9)], "query_id long, chunk_id string, score double")
    got = {r.chunk_id: r.score for r in selection.chunk_sources(ranked, hits, chunks).collect()}
    assert got == {"1_0": 0.0, "1_1": 0.0, "1_2": 0.8, "2_0": 0.5, "2_1": 0.0, "2_2": 0.0}


def test_near_duplicates_are_those_of_brute_force(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 9))) for _ in range(40)]
    marks = {r.i: r.marks for r in selection.with_marks(spark.createDataFrame(list(enumerate(texts)), "i long, text string")).collect()}
    for i, t in enumerate(texts):
        for j in range(i):
            a, b = texts[j].split(), t.split()
            seen = selection.Accepted()
            seen.add(marks[j])
            if min(len(a), len(b)) < 3:
                x, y = set(a), set(b)
            else:
                x, y = ({tuple(w[k : k + 3]) for k in range(len(w) - 2)} for w in (a, b))
            same = not b or a == b or bool(x and y and len(x & y) >= 0.85 * len(x | y))
            assert seen.says(marks[i]) == same, (texts[j], t)


def test_archive_states(spark):
    tasks = spark.createDataFrame([(1, "http://a.x/p/1", "PENDING"), (2, "https://a.x/p/2", "PENDING"), (3, "https://b.x/q", "SUCCESS"), (4, None, "PENDING"), (5, "https://c.x/r/z", "PENDING")], "doc_id long, url string, status string")
    states = archive.seed_states(tasks)
    assert [r.state for r in states.orderBy("doc_id").collect()] == ["UNRESOLVED", "UNRESOLVED", "SKIPPED", "SKIPPED", "UNRESOLVED"]
    captures = archive.newest_captures(spark.createDataFrame([("https://a.x/p/1", 5)], "url string, captured_at int"))
    searched = spark.createDataFrame([("a.x/p/",)], "prefix string")
    states = archive.resolve(states, captures, searched)
    assert [r.state for r in states.orderBy("doc_id").collect()] == ["FOUND", "MISS", "SKIPPED", "SKIPPED", "UNRESOLVED"]
    for events, want in (([(1, "start"), (2, "done")], "FETCHING"), ([(1, "crash")], "FOUND"), ([(1, "failed")], "FALLBACK"), ([(1, "done")], "FALLBACK")):
        states = archive.advance(states, spark.createDataFrame(events, "doc_id long, event string"))
        assert states.filter("doc_id = 1").first().state == want and states.filter("doc_id = 2").first().state == "MISS"
    assert sum(r.n for r in archive.state_counts({"a": states, "b": states}).collect()) == 10
    probes = spark.createDataFrame([(True, True, True, 2.0), (True, True, False, 2.0), (True, False, None, None), (False, None, None, None)], "found boolean, downloaded boolean, extracted boolean, seconds double")
    r = archive.probe_rates(probes).first()
    assert (r.n, r.coverage, round(r.downloaded, 4), r.extracted, r.rate) == (4, 0.75, 0.6667, 0.5, 0.5)


def test_abstracts_and_classes(spark):
    links = spark.createDataFrame([(900_001, "https://pubmed.ncbi.nlm.nih.gov/11/"), (900_002, "https://pubmed.ncbi.nlm.nih.gov/12"), (900_003, "https://pubmed.ncbi.nlm.nih.gov/13"), (5, "https://x.cn/a"), (900_004, "https://youmed.vn/a"), (900_005, "bad")], "doc_id long, url string")
    answers = spark.createDataFrame([("11", "T", "An abstract."), ("11", "T", None), ("12", "Only a title", None), (None, "x", "y")], "pmid string, title string, abstract string")
    got = {r.doc_id: r for r in corpus.abstract_records(links.filter("url like '%pubmed%'"), answers).collect()}
    assert [(got[d].text, got[d].crawl_status, got[d].http_status, got[d].bytes_downloaded) for d in sorted(got)] == [("An abstract.", "SUCCESS", 200, 12), ("Only a title", "SUCCESS", 200, 12), ("", "NOT_FOUND", 404, 0)]
    kinds = {r.doc_id: r.c for r in links.select("doc_id", corpus.corpus_class(F.col("doc_id"), F.col("url")).alias("c")).collect()}
    assert kinds == {900_001: "abstract", 900_002: "abstract", 900_003: "abstract", 5: "vi", 900_004: "vi", 900_005: "zh"}
    delta = corpus.classed_delta(links, links.filter("doc_id = 5").select("doc_id"))
    assert {r.part for r in delta.filter("corpus_class <> 'abstract'").collect()} == {0} and delta.count() == 5


def test_merge_rejects_foreign_urls(spark):
    have = spark.createDataFrame([(1, "u1", "SUCCESS", "h", 9, 200, "x", 1), (1, "other", "SUCCESS", "h", 99, 200, "y", 1), (2, "u2", "FAILED", None, 0, 500, None, 0), (8, "u8", "SUCCESS", "h", 1, 200, "z", 1)], "doc_id long, url string, crawl_status string, content_hash string, text_chars int, http_status int, text string, bytes_downloaded long")
    tasks = spark.createDataFrame([(1, "u1", "SUCCESS"), (2, "u2", "FAILED"), (3, "u3", "SUCCESS"), (4, "u4", "PENDING")], "doc_id long, url string, status string")
    kept, wrong = corpus.merged(have, tasks)
    assert sorted((r.doc_id, r.url) for r in kept.collect()) == [(1, "u1"), (2, "u2")]
    assert sorted((r.check, r.key) for r in wrong.collect()) == [("another URL than the task's", "1"), ("no row", "3"), ("no task", "8")]


def test_queues_and_fan_out(spark):
    tasks = spark.createDataFrame([(i, f"k{i // 2}", "d" if i < 8 else "e", "RETRY_WAIT" if i in (6, 7) else "PENDING", 1, 5.0 if i in (6, 7) else None) for i in range(12)], "doc_id long, fetch_key string, domain string, status string, attempts int, next_retry_at double")
    queue = {r.fetch_key: (r.domain, r.place, r.not_before) for r in state.domain_queue(tasks, 10.0, 2.0).collect()}
    assert queue == {"k3": ("d", 1, 10.0), "k0": ("d", 2, 12.0), "k1": ("d", 3, 14.0), "k2": ("d", 4, 16.0), "k4": ("e", 1, 10.0), "k5": ("e", 2, 12.0)}
    assert state.even_quota(tasks, 10.0, 5) == 3 and rows(state.fan_out(tasks))[:2] == [("k0", 0, 2), ("k0", 1, 2)]
    busy = spark.createDataFrame([("d", 1)], "domain string, n long")
    assert [r.domain for r in state.fair_claim(tasks, 10.0, 9, per_domain=2, in_flight=busy).collect()].count("d") == 1


def test_assignment_violations(spark):
    links = spark.createDataFrame([(i, f"http://{'big' if i % 3 else 'small'}.x/{i}") for i in range(90)], "doc_id long, url string")
    work = spark.createDataFrame([("big.x", 100.0), ("small.x", 1.0)], "domain string, estimated_work double")
    made = planning.assign(links, work, workers=3)
    assert planning.check_assignment(links, made, planning.worker_summary(made)).count() == 0 and made.count() == 90
    wrong = made.limit(80).unionByName(made.limit(1))
    assert {r.check for r in planning.check_assignment(links, wrong, planning.worker_summary(made)).collect()} >= {"not assigned", "assigned twice", "worker's total differs"}


def test_export_and_reports(spark):
    asked = spark.createDataFrame([(1,), (2,)], "query_id long")
    ranked = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id long, doc_id long, rank int")
    chosen = spark.createDataFrame([(1, 10, 1, "old text"), (1, 10, 2, "more"), (1, 11, 3, "third")], "query_id long, doc_id long, chunk_order int, text string")
    made, short = results.export(asked, ranked, chosen, target=3)
    assert rows(short) == [(2, 0, 3)]
    fresh = spark.createDataFrame([(1, 10, 1, "old text grown by a few words"), (1, 99, 7, "not there")], "query_id long, doc_id long, chunk_order int, text string")
    again, _ = results.export(asked, ranked, fresh, baseline=made)
    texts = [c.chunk_text for c in again.filter("id = 1").first().relevant_chunks]
    assert texts == ["old text grown by a few words", "more", "third"] and again.filter("id = 1").first().relevant_docs == [10, 11]
    r = results.passage_diagnosis(again, made, most=100).first()
    assert (r.n_passages, r.n_grown, r.n_without_source, r.n_at_budget, r.n_moved) == (3, 1, 2, 0, 0)
    d = results.chunk_distribution(made).first()
    assert (d.n_one, d.n_two, d.n_three, d.n_over_two, d.mean_coverage, d.max_docs) == (1, 1, 0, 0, 0.5, 2)
    c = results.comparison_summary(results.compare(again, made)).first()
    assert (c.n_queries, c.n_same, c.n_more, c.net_change, c.n_other_ranking) == (2, 2, 0, 0, 0)
    unknown = results.validate(spark.createDataFrame([(0, '{"id": 1, "relevant_docs": [10, 77], "relevant_chunks": []}')], "item_no int, raw string"), asked, corpus=spark.createDataFrame([(10,)], "doc_id long"))
    assert ("document is not in the corpus", "77") in {(r.check, r.detail) for r in unknown.collect()}


def _pdf(pages):
    """A small PDF: one deflated content stream a page."""
    import zlib

    out = [b"%PDF-1.4\n"]
    for p in pages:
        data = zlib.compress(b"BT " + b" ".join(f"1 0 0 1 {x} {y} Tm ({t}) Tj".encode("latin-1") for x, y, t in p) + b" ET")
        out.append(b"1 0 obj\n<< /Type /Page >>\nendobj\n2 0 obj\n<< /Length %d /Filter /FlateDecode >>\nstream\n" % len(data) + data + b"\nendstream\nendobj\n")
    return b"".join(out) + b"%%EOF"


def test_pdf_text_and_challenges(spark):
    from lakeloom.operators import extraction

    made = _pdf([[(50, 700, "Second \\(line\\)"), (50, 720, "First line"), (200, 720, "goes on")], [(50, 700, "Page two")]])
    assert extraction.extract_pdf(made) == ("First line goes on\nSecond (line)\n\nPage two", 2)
    long = _pdf([[(50, 700, "x" * 400)]])
    page = b"<html><body><p>" + b"Rest and drink enough water. " * 9 + b"</p></body></html>"
    rows_ = [(1, long, "application/pdf", "http://a/x.pdf"), (2, made, "text/html", "http://a/y"), (3, page, "text/html", "https://image.39.net/verify.html/"), (4, page, "text/html", "https://x.39.net/verify.html"), (5, b"%PDF-broken", "application/pdf", None)]
    got = {r.doc_id: r.status for r in extraction.route(spark.createDataFrame(rows_, "doc_id long, content binary, content_type string, final_url string")).collect()}
    assert got == {1: "SUCCESS", 2: "NEEDS_OCR", 3: "NEEDS_JS", 4: "SUCCESS", 5: "NEEDS_OCR"}
    import zlib

    raw = zlib.compressobj(wbits=-15)
    assert extraction._inflated(raw.compress(b"abc") + raw.flush()) == b"abc"


def test_retry_after_and_forms(spark):
    from lakeloom.functions import columns as C

    df = spark.createDataFrame([(1, " 120 "), (2, "9000"), (3, "Thu, 01 Jan 1970 00:01:40 GMT"), (4, "soon"), (5, None), (6, "Thu, 01 Jan 1970 00:00:01 GMT")], "i int, h string")
    assert [r[0] for r in df.orderBy("i").select(C.retry_after(F.col("h"), F.lit(40.0))).collect()] == [120.0, 300.0, 60.0, None, None, 0.0]
    assert spark.createDataFrame([("Ｓtraße—ΟΔΌΣ ok",)], "t string").select(C.qa_form(F.col("t"))).first()[0] == "strasse οδόσ ok"


def test_disjoint_audit_samples(spark):
    from lakeloom.operators import sampling

    scores = spark.createDataFrame([(i, f"d{i % 4}", i % 50) for i in range(200)] + [(None, "d1", 99)], "doc_id long, domain string, risk int")
    got = sampling.disjoint_audit(scores, "domain", "doc_id", [F.desc("risk"), F.asc("doc_id")], (20, 30, 40)).collect()
    assert len({r.doc_id for r in got}) == len(got) == 90 and [sum(r.sample == s for r in got) for s in ("high-risk", "random", "stratified")] == [20, 30, 40]
    assert min(r.risk for r in got if r.sample == "high-risk") >= 40


def test_lookups_and_invalid_urls(spark):
    from lakeloom.operators import chunks

    made = spark.createDataFrame([(1, "1_1", 1), (1, "1_0", 0), (2, "2_3", 3)], "doc_id long, chunk_id string, chunk_index int")
    assert [r.chunk_id for r in chunks.lookup(made, spark.createDataFrame([(1,), (7,)], "doc_id long")).collect()] == ["1_0", "1_1"]
    assert rows(chunks.first_chunks(made)) == [(1, "1_0", 0), (2, "2_3", 3)]
    links = spark.createDataFrame([(1, "http://a"), (2, "ftp://b"), (3, None), (4, "HTTPS://c")], "doc_id long, url string")
    assert rows(profile.scheme_counts(links)) == [("", 1), ("ftp", 1), ("http", 1), ("https", 1)] and [r.doc_id for r in profile.invalid_urls(links).collect()] == [2, 3]
