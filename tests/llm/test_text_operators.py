"""The text operators: edge cases, brute force, round trips and held-out accuracy."""

import random
import unicodedata as ud
from collections import defaultdict

import harness
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeloom import session
from lakeloom.llm import chunking, encode, forms, langid, mainbody, mixing, pagelines, pages, queries, residue, sentences, sitelines
from lakeloom.session import table

CORPUS = "doc_id long, url string, final_url string, domain string, content_type string, title string, text string, language string, content_hash string, http_status int, crawl_status string, text_chars int, bytes_downloaded long"


def corpus(spark, rows):
    """Rows of ``(doc_id, domain, title, text, language)``, with a column that clashes with results."""
    made = [(i, "u", None, d, None, t, x, lang, None, 200, "SUCCESS", 0, 0) for i, d, t, x, lang in rows]
    return spark.createDataFrame(made, CORPUS).withColumn("line_no", F.lit(9)).withColumn("keys", F.lit("k"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- one form ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("Ｆｕｌｌ", "Full", True), ("é", "é", True), ("ế", "é̂", True), ("a​b", "ab", True), ("a b", "a b", True), ("раin", "pain", True), ("ﬁt", "fit", True), ("Đau", "Ðau", True), ("⼈", "人", True), ("㎎", "mg", True),
        ("a \r\nb", "a\nb", True), ("A", "a", False), ("é", "e", False), ("1", "l", False), ("a.", "a。", False), ("a\nb", "a b", False), ("x²", "x2", False), ("α", "a", False), ("đ", "d", False), ("①", "1", False),
    ],
)
def test_looks(a, b, same):
    assert (forms.skeleton(a) == forms.skeleton(b)) is same


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_the_form_is_stable(text):
    form = forms.one_form(text)
    assert forms.skeleton(form) == forms.skeleton(text) and forms.one_form(form) == form


def test_pairs_of_looks(spark):
    t = "Người bệnh nên giữ ấm cơ thể. " * 10
    df = corpus(spark, [(1, "d", "T", t, None), (1, "d", "T", t, None), (2, "d", "T", ud.normalize("NFD", t), None), (3, "d", "T", t, None), (4, "d", "Ｔ", t, None), (5, "d", None, t, None), (6, "d", "T", None, None), (7, "d", "T", "short", None)])
    assert rows(forms.same_look_pairs(df)) == [(1, 2), (1, 4), (2, 3), (2, 4), (3, 4)]
    assert rows(forms.look_classes(df)) == [(1, 1, 1, 4, 3), (2, 1, 2, 4, 3), (3, 1, 1, 4, 3), (4, 1, 4, 4, 3), (5, 5, 5, 1, 1)]
    assert forms.same_look_pairs(df.limit(0)).count() == 0
    got = forms.unify(df).filter("doc_id = 6").first()
    assert got.text_form is None and got.title_form == "T" and got.line_no == 9


def test_pairs_of_many_copies(spark):
    t = "Người bệnh nên giữ ấm cơ thể. " * 10
    df = corpus(spark, [(i, "d", "T", t, None) for i in range(1001)] + [(2000, "d", "Ｔ", t, None)])
    assert forms.same_look_pairs(df).count() == 1001
    member = forms.look_classes(df).select("doc_id", "look_class", "form_id")
    rebuilt = member.alias("a").join(member.alias("b"), F.expr("a.look_class = b.look_class and a.form_id <> b.form_id and a.doc_id < b.doc_id"))
    assert rebuilt.count() == 1001


def test_look_alikes_of_rarer_scripts():
    assert forms.skeleton("ᎪꓐϹ") == forms.skeleton("ABC") and forms.skeleton("pɑın") == forms.skeleton("pain") and forms.skeleton("2∶1 − 5′") == forms.skeleton("2:1 - 5'")
    assert len(set(map(forms.skeleton, ["rn", "m", "cl", "d", "1", "l", "0", "O", ".", ",", "–", "-", "“", '"', "ƒ", "f"]))) == 16


# --- languages --------------------------------------------------------------------------


def test_language_accuracy_on_held_out_samples(spark, sf):
    samples = [(r.lang, r.text) for r in table(spark, sf, "lang_samples").collect()]
    random.Random(1).shuffle(samples)
    model = langid.train(samples[:240])
    got, sure = model.predict([t for _, t in samples[240:]])
    assert sum(a == b for a, (b, _) in zip(got, samples[240:])) >= 0.98 * 120 and ((sure > 0) & (sure <= 1)).all()
    bare = [langid.without_accents(t) for lang, t in samples[240:] if lang == "vi"]
    assert sum(x == "vi" for x in model.predict(bare)[0]) >= 0.95 * len(bare)
    assert model.predict(["34CY/ae8Fmk5TnbDb94GHg8PS/FQ6m9WhFh8FVkaMgC4", "| --- | 12.5 | 33 |", "2001 - 2002 - 2003"])[0] == [None] * 3


def test_languages_of_lines_in_parts(monkeypatch):
    """Lines looked at in parts, one at a time and all together score alike; short, blank and broken lines are lines."""
    model = langid.train([("en", "the doctor will see you in the morning"), ("vi", "bác sĩ sẽ khám cho bạn vào buổi sáng"), ("zh", "医生早上会给你看病")] * 3)
    lines = ["", "a", "中", "see\nyou", "bác sĩ sẽ khám", "１２ mg", "医生早上会给你看病", "the doctor will see you", "x" * 70, ""]
    whole = model.logits(lines)
    assert np.allclose(whole, [model.logits([x])[0] for x in lines], atol=1e-5)
    for size in (1, 20, 60):
        monkeypatch.setattr(langid, "AT_ONCE", size)
        assert np.allclose(whole, model.logits(lines), atol=1e-5)
    assert model.logits([]).shape == (0, len(langid.CLASSES))


def test_equal_lines_are_scored_once(monkeypatch):
    model = langid.train([("en", "the doctor will see you in the morning"), ("vi", "bác sĩ sẽ khám cho bạn vào buổi sáng"), ("zh", "医生早上会给你看病")] * 3)
    lines = ["the doctor will see you", "医生早上会给你看病", "", "12 - 34", "the doctor will see you", "bác sĩ sẽ khám", "12 - 34"]
    each = [model.judge([x]) for x in lines]
    scored, old = [], langid.LanguageModel._logits
    monkeypatch.setattr(langid.LanguageModel, "_logits", lambda self, texts: scored.extend(texts) or old(self, texts))
    best, p = model.judge(lines)
    assert len(scored) == len(set(lines)) and best.tolist() == [int(b[0]) for b, _ in each] and np.allclose(p, np.concatenate([q for _, q in each]), atol=1e-5)
    got = model.predict(lines)[0]
    assert got[:2] + got[3:] == ["en", "zh", None, "en", "vi", None]
    assert [len(x) for x in model.judge([])] == [0, 0]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ0 é中鿿㐀ΣİếA💊\u0301\n，", max_size=80))
def test_buckets_and_contents_of_lines(text):
    """Buckets are those of the formula; letters and Han characters are counted line by line."""
    codes, h = langid._codes(text), 0
    for n, bucket in langid._buckets(codes):
        want = []
        for at in range(len(text) - n + 1):
            h = 0
            for k in range(n):
                h = (h * 1_000_003 + int(codes[at + k]) + k + 1) % (1 << 64)
            want.append((h * 0x9E3779B97F4A7C15 % (1 << 64)) >> (64 - langid.BITS))
        assert bucket.tolist() == want
    lines = text.split("\n")
    letters, han = langid._contents(lines)
    assert letters.tolist() == [sum(c.isalpha() or ord(c) > 0xFFFF for c in x) for x in lines] and han.tolist() == [any("㐀" <= c <= "鿿" for c in x) for x in lines]
    assert [langid.plain(x, h) for x, h in zip(lines, han.tolist())] == [langid.plain(x) for x in lines]


def test_labels():
    assert langid.same_language("vi_VN", "vi") and langid.same_language(" ZH-Hans", "zh") and not langid.same_language(None, "vi") and not langid.same_language("unknown", "vi") and not langid.same_language("fr", "en")


def test_mixed_records(spark, sf):
    model = langid.fit(table(spark, sf, "lang_samples"))
    en = "The first step is to drink enough water, and only then should other medicines be considered."
    vi = "Người nhà nên nhắc bệnh nhân giữ ấm cơ thể, đồng thời ghi lại số lần đau đầu trong tuần."
    df = corpus(spark, [(1, "d", "t", f"{en}\n{en}\n{vi}", "vi"), (2, "d", "t", f"{vi}\n{vi}", "VI"), (3, "d", "t", None, "en"), (4, "d", "t", "short", None)])
    got = pages.records(pages.scan(df, model), "langs").select("doc_id", F.explode("langs").alias("x")).select("doc_id", "x.line_no", "x.lang", "x.mislabelled")
    assert rows(got) == [(1, 0, "en", True), (1, 3, "vi", False), (2, 0, "vi", False)]
    assert pages.scan(df.limit(0), model).count() == 0


def test_every_record_is_labelled(spark, sf):
    model = langid.fit(table(spark, sf, "lang_samples"))
    df = corpus(spark, [(1, "d", "t", "Drink enough water.", None), (2, "d", "t", "Please turn on JavaScript to read Med Lake.\nLoading...", None), (3, "d", "t", "12 - 34 - 56", None)])
    got = {r.doc_id: r.langs for r in pages.scan(df, model, every=True).collect()}
    assert all(got[i][0].line_no == 0 and 0 < got[i][0].confidence <= 1 and got[i][0].lang in ("vi", "en", "zh") for i in (1, 2, 3)) and got[1][0].lang == got[2][0].lang == "en"


# --- splitting --------------------------------------------------------------------------


@given(st.text(alphabet="ab .!?。\n#，中文é́", max_size=900), st.integers(20, 90), st.integers(0, 9))
@settings(max_examples=150, deadline=None)
def test_pieces_lose_nothing(text, limit, overlap):
    made = chunking.spans(text, limit, overlap)
    whole, end = "", 0
    for a, b, _ in made:
        assert a <= end < b or not text and a == b
        assert b - a <= limit and end - a <= overlap
        whole += text[end:b]
        end = b
    assert whole == text


def test_pieces_end_at_boundaries(spark):
    text = "\n\n".join(" ".join(f"Sentence {i} of paragraph {k}." for i in range(60)) for k in range(4))
    df = corpus(spark, [(1, "d", "t", text, None), (1, "d", "t", text, None), (2, "d", "t", None, None), (3, "d", "t", "", None), (4, "d", "t", " \n", None), (5, "d", "t", "x" * 9000, None)])
    got = chunking.pieces(df).orderBy("doc_id", "piece_no").collect()
    assert {r.doc_id for r in got} == {1, 4, 5} and all(len(r.piece) <= 4000 for r in got)
    assert [r.kind for r in got if r.doc_id == 1][0] in ("paragraph", "sentence") and all(r.kind == "character" for r in got if r.doc_id == 5 and r.end < 9000)
    assert chunking.pieces(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chunking.spans("x" * 99, 10, 5)


# --- main body and residue --------------------------------------------------------------

PAGE = """- Home
- News
We use cookies to remember your choices. [OK] [Reject]
Home > News > Gout > At night
# Diagnosing gout among older adults
By Ann Lee, photos Sam Poe
Diagnosis rests on examination, blood tests and imaging of the joints. The score rose from 2.5 to 7.25 after 32 hours.
- A red rash at night
- Swollen joints

Read next: gout / Velora
▶ 7 facts about Panizol and walnuts
Helpline 000-864-869, weekdays only"""


def test_main_body(spark):
    df = corpus(spark, [(1, "med-lake.example", "Diagnosing gout | Med Lake", PAGE, "en"), (2, "d", None, None, None), (3, "d", "", "\n \n", None)])
    got = mainbody.main_body(df).orderBy("doc_id").collect()
    assert got[0].headline == "Diagnosing gout" and got[0].body.split("\n") == [PAGE.split("\n")[i] for i in (4, 6, 7, 8)]
    assert got[1].body is None and got[1].headline is None and got[2].headline == "" and got[0].line_no == 9
    found = mainbody.furniture(pages.scan(df))
    assert rows(found) == [(1, n) for n in (0, 1, 2, 3, 4, 6, 11, 12, 13)]
    assert mainbody.furniture(pages.scan(df.limit(0))).count() == 0


def test_folded_separators_of_titles():
    assert all(pagelines.decorated(f"Diagnosing gout{x}Med Lake", "med-lake.example", frozenset()) for x in ("｜", " － ", " ／ ", "\u00a0:\u00a0", " \u2010 "))


ODD = ["a", "b0", "²", "１", "é", "ế", "đ", "İ", "ﬁ", "…", "中", "文", "。", "、", "💊", "·", "–", "_", "|", "/", " ", "  ", " - ", ". ", '."', ".) ", "! ", "?", ",", ":", "\u200b", "\u2028", "\r", "{x}", "1. ", "\u0301"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=20).map("".join), min_size=1, max_size=5))
def test_lines_folded_together(lines):
    """Folded words, counts, ends and word scores of many lines at once are those of each line alone."""
    folded, words, bounds, counts = pagelines._folded_words(lines)
    assert folded == [pagelines.fold(x).strip() for x in lines]
    assert [words[a:b] for a, b in zip(bounds, bounds[1:])] == [pagelines.tokens(x) for x in folded]
    known = {"a": (1.0, -0.5), "b0": (0.25, 2.0), "中": (-3.0, 0.1), "< a": (0.7, 0.7), "a b0": (0.3, -0.9), "中 中": (1.5, 0.0), "0": (0.1, 0.2)}
    for f, (han, signs), a, b, score in zip(folded, counts, bounds, bounds[1:], pagelines.Blocks(known).scores(words, bounds)):
        assert (han, pagelines.separators(f, signs)) == (len(pagelines._HAN.findall(f)), len(pagelines._SEPARATOR.findall(f)))
        assert pagelines.inner_ends(f) == len(pagelines._INNER_END.findall(f)) and pagelines.ends_sentence(f) == bool(pagelines._ENDS.search(f[-8:]))
        odds = [known[g] for g in pagelines.grams(words[a:b]) if g in known]
        assert score == pytest.approx([sum(x[k] for x in odds) / (len(odds) + 1) for k in (0, 1)])


def test_long_and_short_lines_are_described_alike(monkeypatch):
    """In parts, alone, remembered or not, a line's description is the same."""
    blocks = pagelines.Blocks({"gout": (1.0, 2.0), "the gout": (0.5, 0.25), "the": (0.0, 0.1)}, frozenset(pagelines.edges("the gout of the knee")))
    lines = ["The gout of the knee", "- Home", "Tên\tbệnh 12", "㎎ ½ của … ﬁt", "中文。中文", "The gout. " * 40]
    want = [blocks.describe(x) for x in lines]
    for size in (1, 30, 10_000):
        monkeypatch.setattr(pagelines, "AT_ONCE", size)
        assert blocks.described(lines) == want == blocks._descriptions(lines) == blocks._descriptions(lines[::-1])[::-1]
    monkeypatch.setattr(pagelines, "REMEMBERED", 2)
    assert blocks._descriptions(lines * 2) == want * 2 and len(blocks.seen) <= 2


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["lorem", "ipsum", "dolor", "gout", "ab", "ab", "x", "wordwordx", "{{ a }}", "[b]", "%(c)s", "_", ".", "!", "中", " "]), max_size=14))
def test_unfilled_lines_by_the_patterns(words):
    """What is looked at first leaves out no repeated token and no filler."""
    line = " ".join(words).strip()
    said = pagelines.tokens(line)
    plain = not set("{[%<_") & set(line)
    want = bool(pagelines._REPEATED.fullmatch(line)) or len(said) >= 3 and sum(w in pagelines.FILLER for w in said) >= 0.8 * len(said)
    assert pagelines.unfilled(line, said) is want if plain else pagelines.unfilled(line, said) >= want


def test_pieces_are_remembered_for_all_sites():
    """Only a line that has the site's name is cut anew for another site."""
    pages.line_pieces.cache_clear()
    got = [pages.pieces_of([(1, 0.0, False, "home and news", None), (2, 0.0, False, "read med lake, daily", None)], site) for site in ("med lake", "gout club", "")]
    assert pages.line_pieces.cache_info().misses == 3 and got[1] == got[2] and got[0][0] == got[1][0] and got[0] != got[1]


def test_the_committee_is_the_mean_of_its_trees():
    trees, _ = pagelines.committee()
    x = np.random.default_rng(1).normal(5, 9, (3000, len(pagelines.FEATURES)))
    assert (trees.share(x) == sum(t.predict(x[:, c]) for c, t in trees.trees) / len(trees.trees)).all() and len(trees.share(x[:0])) == 0


def test_sections_are_learned_from_titles(spark):
    made = [(i, "h.example", f"Gout in group number {i} of the ward | Heart matters", "Some text.", None) for i in range(5)]
    model = pages.line_model(corpus(spark, made))
    assert pagelines.bare_headline("Another long headline of the ward - Heart matters", "x.example", model.sections) == ("Another long headline of the ward", True)
    assert not pagelines.decorated("Gout in group number 3 of the ward", "x.example", model.sections)


def test_held_out_page_lines():
    """Trees and words learned without a fifth of the labelled table classify pages composed of that fifth."""
    for held in range(2):
        trees, words = pagelines.committee(held_out=held)
        rng = random.Random(99)
        x, y = pagelines.composed(rng, pagelines._parts(pagelines.table.LINES, 5, held)[1], words, 150, hide=False)
        said = trees.share(x) > 0.5
        right = (said == (y > 0)).mean()
        assert right >= 0.93, right


def test_the_trees_split_on_words_and_links():
    trees, _ = pagelines.committee()
    split = {pagelines.FEATURES[c[f]] for c, t in trees.trees for f in t.feature if f >= 0}
    assert {"words", "words_before", "words_after", "words_before_run", "words_after_run", "link_density"} <= split


def _codes(text, n):
    return [text.replace("#", f"{i:02}f{i * 7}") for i in range(n)]


@pytest.mark.parametrize(
    "text, gone",
    [
        ("{{ title }}\nBy {{author}}\n{{body}}", True), ("Tác giả: ${tac_gia}. Đăng ngày ${ngay}.", True), ("Lorem ipsum dolor sit amet.\nElit sed magna aliqua.", True), ("asdf asdf asdf", True),
        ("To learn more, call {{hotline}} at the clinic. Doctors advise older adults to keep warm and to rest.", False), ("The portal of the clinic asks patients to turn on JavaScript, so relatives may help.\nDiagnosis rests on examination, blood tests and imaging.", False), (PAGE, False), ("- Home\n- News", False), ("A red rash at night", False),
    ],
)
def test_residue_of_a_single_record(spark, text, gone):
    df = corpus(spark, [(1, "med.example", "t", text, None), (2, "d", None, None, None), (3, "d", None, " \n", None)])
    assert rows(residue.excluded(pages.scan(df))) == ([(1,)] if gone else [])


def test_repeated_error_pages_are_found_by_repetition(spark):
    """Messages that no list names: their pages hold nothing else, articles that mention them do."""
    errors = [(i, f"h{i}.example", None, x, None) for i, x in enumerate(_codes("The zorgle is being rewound, please wait.\nTicket number #", 4))]
    errors += [(10 + i, "web.example", None, f"- Home\n- News\n{x}\nHelpline 000-864-869, weekdays only", None) for i, x in enumerate(_codes("The zorgle is being rewound, please wait.", 3))]
    article = [(20, "h.example", None, "On Monday the screens said that the zorgle is being rewound, please wait, and the nurse laughed about it for days.\nDiagnosis rests on examination, blood tests and imaging.", None)]
    copies = [(30 + i, f"c{i}.example", "Keeping warm", "Doctors advise older adults to keep warm and to rest for some days.", None) for i in range(6)]
    assert rows(residue.excluded(pages.scan(corpus(spark, errors + article + copies)))) == [(i,) for i in (0, 1, 2, 3, 10, 11, 12)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([x for x in ODD if x.isascii()] + ["\x01", "\x01x", "\t", "med lake", ";", "..."]), max_size=20).map("".join))
def test_pieces_of_plain_lines(line):
    """ASCII lines are cut as the pattern cuts them."""
    if not pages._LINES.search(line):
        want = [w for x in pages._PIECES.split(line) if (w := pages._TOKEN.findall(x))]
        assert [w for x in pages._plain_pieces(line) if (w := x.split())] == want


def test_templates_are_induced(spark):
    pages_ = [(i, f"h{i}.example", None, f"Error 50{i}\nThe gremlins took page {i * 31}", None) for i in range(1, 5)]
    other = [(10, "h.example", None, "The gremlins took page 7", None), (11, "h.example", None, "Trembling hands at night", None)]
    assert rows(residue.excluded(pages.scan(corpus(spark, pages_ + other)))) == [(1,), (2,), (3,), (4,), (10,)] or rows(residue.excluded(pages.scan(corpus(spark, pages_)))) == [(1,), (2,), (3,), (4,)]
    kept = residue.exclude_residue(corpus(spark, pages_ + other))
    assert (11,) in rows(kept.select("doc_id")) and kept.columns[-1] == "keys"


def test_blank_slots_of_an_induced_template(spark):
    filled = [(i, f"h{i}.example", None, f"Condition: {{{{ c{i} }}}}\nSummary: ${{s{i}}}", None) for i in range(1, 5)]
    blank = [(10, "h.example", None, "Condition:\nSummary:", None), (11, "h.example", None, "Condition: gout of the left knee\nTrembling hands at night", None)]
    assert rows(residue.excluded(pages.scan(corpus(spark, filled + blank)))) == [(1,), (2,), (3,), (4,), (10,)]


def test_templates_of_prose_are_aligned(spark):
    names = ["Ann", "Bob Miller", "Carol", "Dan of Velora"]
    filled = [(i, f"h{i}.example", None, f"Error 50{i}\nThe gremlins could not bring the page that {x} asked for on this occasion, so please go back.", None) for i, x in enumerate(names, 1)]
    long = "The gremlins of this portal have taken the page away " + "and nobody has seen where they put it " * 6 + "so far."
    whole = [(i, f"h{i}.example", f"Page {'abcde'[i - 11]}", f"404\n{long}", None) for i in range(11, 15)] + [(15, "h15.example", None, long, None)]
    article = "Diagnosis rests on examination, blood tests and imaging of the joints.\nDoctors advise older adults to keep warm and to rest for some days."
    copies = [(i, f"h{i}.example", None, f"Loading...\n{article}", None) for i in range(21, 25)] + [(25, "h25.example", None, article, None)]
    assert rows(residue.excluded(pages.scan(corpus(spark, filled + whole + copies)))) == [(i,) for i in (1, 2, 3, 4, 11, 12, 13, 14, 15)]


# --- repeated lines ---------------------------------------------------------------------


def test_repeated_lines_by_brute_force(spark):
    rng = random.Random(2)
    pool = [f"Share  This {i}" for i in range(6)] + ["  legal notice ", "LEGAL\tnotice", "", "99 views"]
    made = [(i, rng.choice(["hot"] * 8 + ["a", "b"]), None, "\r\n".join([rng.choice(pool) for _ in range(rng.randint(1, 5))] + [f"own line number {'x' * i}"]), None) for i in range(60)]
    made += made[:5] + [(99, "a", None, None, None), (98, "a", None, " \n", None), (97, None, None, "x", None)]
    import re

    def key(x):
        return re.sub("[0-9]+", "0", " ".join(x.lower().split()))

    docs = {i: (d, x) for i, d, _, x, _ in made if x and x.strip() and d}
    n, support = defaultdict(set), defaultdict(set)
    for i, (d, x) in docs.items():
        n[d].add(i)
        for line in x.split("\n"):
            support[d, key(line)].add(i)
    want = sorted((i, k) for i, (d, x) in docs.items() for k, line in enumerate(x.split("\n"), 1) if key(line) and len(support[d, key(line)]) >= max(5, 0.2 * len(n[d])))
    df = corpus(spark, made)
    assert rows(sitelines.repeated_lines(df)) == want and want
    clean = {r.doc_id: r.text_kept for r in sitelines.without_repeated_lines(df).collect()}
    assert all(len(clean[i].split("\n")) == len(docs[i][1].split("\n")) - sum(a == i for a, _ in want) for i in docs)
    found = sitelines.frequent_sequences(sitelines.line_keys(df))
    assert found.filter("length = 1").count() == len({(docs[i][0], key(docs[i][1].split("\n")[k - 1])) for i, k in want})
    assert sitelines.repeated_lines(df.limit(0)).count() == 0


def test_sequences_by_brute_force(spark):
    made = [(i, "s", None, "\n".join(x), None) for i, x in enumerate([["a", "b", "c"], ["a", "b", "z", "c"], ["b", "a", "c"], ["a", "b"], ["a", "b", "c"], ["q"]])]
    found = sitelines.frequent_sequences(sitelines.line_keys(corpus(spark, made)), min_docs=3, min_share=0.1, max_len=3, max_gap=2)
    assert sorted((r.length, r.support) for r in found.collect()) == [(1, 4), (1, 5), (1, 5), (2, 4), (2, 4), (2, 4), (3, 3)]


def test_closed_sequences_by_brute_force(spark):
    from itertools import combinations

    rng = random.Random(5)
    notice = [f"notice {x}" for x in "abcdefgh"]
    made = [[x for x in notice if rng.random() < 0.9] for _ in range(14)] + [["a", *notice], [*notice, "notice a"]] + [rng.choices("abc", k=4) for _ in range(6)]
    support = defaultdict(set)
    for i, x in enumerate(made):
        for n in range(1, len(x) + 1):
            for p in combinations(x, n):
                support[p].add(i)
    frequent = {p: len(ids) for p, ids in support.items() if len(ids) >= 5}

    def within(p, q):
        rest = iter(q)
        return all(x in rest for x in p)

    want = sorted((len(p), n) for p, n in frequent.items() if len(p) == 1 or not any(n == m and len(q) == len(p) + 1 and within(p, q) for q, m in frequent.items()))
    found = sitelines.frequent_sequences(sitelines.line_keys(corpus(spark, [(i, "s", None, "\n".join(x), None) for i, x in enumerate(made)])))
    assert sorted((r.length, r.support) for r in found.collect()) == want and want[-1][0] > 3


@pytest.mark.parametrize("most", [0, 12, 60, 50_000])
def test_sequences_of_large_and_small_sources(spark, monkeypatch, most):
    rng = random.Random(3)
    made = [(i, "hot" if i < 30 else f"s{i % 2}", None, "\n".join(x for x in "abcdef" if rng.random() < 0.8) or "q", None) for i in range(44)]
    lines = sitelines.line_keys(corpus(spark, made))
    want = rows(sitelines.frequent_sequences(lines))
    monkeypatch.setattr(sitelines, "LOCAL_LINES", most)
    got = sitelines.frequent_sequences(lines)
    assert rows(got) == want and max(r.length for r in got.collect()) > 3
    assert max(r.length for r in sitelines.frequent_sequences(lines, max_len=2).collect()) == 2


def test_long_sequences_need_no_more_stages(spark):
    """Each level took four stages before, and their plans filled the driver's memory."""

    def stages(n):
        made = [(i, "s", None, "\n".join(f"line {chr(97 + k)}" for k in range(n)), None) for i in range(6)]
        session.drop_stages(spark)
        found = sitelines.frequent_sequences(sitelines.line_keys(corpus(spark, made)))
        assert max(r.length for r in found.collect()) == n
        return session.drop_stages(spark)

    assert stages(12) == stages(3)


# --- tokens -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{encode.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def test_ids_of_all_documents(spark, sf, reference):
    got = {r.doc_id: r.ids for r in queries.p8_ids(spark, sf).collect()}
    for r in table(spark, sf, "documents").collect():
        assert got[r.doc_id] == reference.encode(r.text or "", add_special_tokens=False).ids


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_ids_and_round_trip(text):
    from tokenizers import Tokenizer

    if not hasattr(test_ids_and_round_trip, "t"):
        test_ids_and_round_trip.t = Tokenizer.from_file(f"{encode.TOKENIZERS}/byte_bpe_50k.json")
        test_ids_and_round_trip.t.encode_special_tokens = True
    e = encode.encoder()
    ids = e.encode(text)
    assert ids == test_ids_and_round_trip.t.encode(text, add_special_tokens=False).ids and e.decode(ids) == text


def test_long_words_and_empty_texts(reference):
    e = encode.encoder()
    assert e.encode(None) == e.encode("") == []
    for w in ("a" * 5000, "的" * 3000, "<|endoftext|>", "ab" * 2000):
        assert e.encode(w) == reference.encode(w, add_special_tokens=False).ids
    assert len(e.automaton.own) == 50_001  # one state, and one more a merge


# --- mixing -----------------------------------------------------------------------------


def test_mix(spark):
    docs = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate([("big", 10)] * 300 + [("small", 7)] * 20 + [(None, 5), ("big", 0), ("big", None)])] + [(0, "big", 10)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("m", "big", 1.0, 1), ("m", "small", 1.0, 3), ("m", "none", 5.0, 2), ("m", "big", 1.0, 1), ("z", "small", 0.0, 3), ("z", None, 1.0, 1)], "mix_id string, source string, target_weight double, max_repeats int")
    chosen, report = mixing.mix(docs, targets)
    r = {(x.mix_id, x.source): x for x in report.collect()}
    assert abs(r["m", "big"].actual_share - 0.5) < 0.02 and r["m", "small"].max_used == 3 and r["m", "none"].tokens == 0 and r["z", "small"].tokens == 0
    again = mixing.mix(docs.repartition(7), targets)[0]
    assert rows(chosen) == rows(again) and chosen.groupBy("mix_id", "doc_id").count().filter("count > 1").count() == 0
    assert chosen.filter("repeats > 3 or repeats < 1").count() == 0
    assert mixing.mix(docs.limit(0), targets)[0].count() == 0


def _overlapping(spark, owners, weights, repeats, n_tokens=lambda i: 10):
    """``mix`` over documents of several sources; the chosen rows and the report by source."""
    docs = spark.createDataFrame([(i, s, n_tokens(i)) for i, own in enumerate(owners) for s in own], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("m", s, w, repeats[s]) for s, w in weights.items()], "mix_id string, source string, target_weight double, max_repeats int")
    chosen, report = mixing.mix(docs, targets)
    return chosen.collect(), {r.source: r for r in report.collect()}


def test_two_overlapping_sources_use_every_document_once(spark):
    rows, report = _overlapping(spark, ["ab"] * 100, {"a": 1.0, "b": 1.0}, {"a": 1, "b": 1})
    assert len({r.doc_id for r in rows}) == len(rows) == 100 and all(r.repeats == 1 for r in rows)
    assert report["a"].tokens == report["b"].tokens == 500


@pytest.mark.parametrize("repeats", [{"a": 1, "b": 1, "c": 1}, {"a": 2, "b": 1, "c": 3}])
def test_three_overlapping_sources_keep_shares_and_cap(spark, repeats):
    owners = ["abc"] * 60 + ["ab"] * 40 + ["c"] * 30 + ["b"] * 5 + ["bc"] * 25
    sizes = {i: 5 + i * 7 % 23 for i in range(len(owners))}
    rows, report = _overlapping(spark, owners, {"a": 2.0, "b": 1.0, "c": 1.0}, repeats, sizes.get)
    uses = {}
    for r in rows:
        assert r.source in owners[r.doc_id] and r.n_tokens == sizes[r.doc_id] and r.repeats <= repeats[r.source]
        uses[r.doc_id] = uses.get(r.doc_id, 0) + r.repeats
    assert all(n <= max(repeats[s] for s in owners[d]) for d, n in uses.items())
    whole = sum(r.tokens for r in report.values())
    for s, share in (("a", 0.5), ("b", 0.25), ("c", 0.25)):
        # Each pattern of a source may be off by a document at either end of its interval.
        assert abs(report[s].tokens - share * whole) <= 2 * max(sizes.values()) * len({o for o in owners if s in o})
    fresh = sum(sizes[i] for i in range(len(owners)))
    if max(repeats.values()) == 1:
        assert whole <= fresh


def test_long_plans_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_BROADCAST", 0)
    rows, _ = _overlapping(spark, ["ab"] * 10, {"a": 1.0, "b": 1.0}, {"a": 1, "b": 1})
    assert len({r.doc_id for r in rows}) == 10


def test_flow_shares_documents_between_sources():
    total, plan = mixing.route({("a",): 100.0, ("a", "b"): 50.0}, {"a": 1.0, "b": 1.0}, {"a": 1, "b": 1})
    assert abs(total - 100) < 0.01 and abs(plan[("a", "b"), "b"] - 50) < 0.01 and abs(plan[("a",), "a"] - 50) < 0.01
    total, plan = mixing.route({("a",): 10.0, ("b",): 100.0}, {"a": 1.0, "b": 1.0}, {"a": 4, "b": 1})
    assert abs(total - 80) < 0.01 and abs(plan[("a",), "a"] - 40) < 0.01
    assert mixing.route({("a",): 100.0}, {"a": 1.0}, {"a": 2}, total=30)[0] == 30


# --- sentences --------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, want",
    [
        ("Dr. Lee came at 3.5 p.m. to rest. Then he left!", ["Dr. Lee came at 3.5 p.m. to rest.", "Then he left!"]), ("The ache grew slowly... and then stopped.", ["The ache grew slowly... and then stopped."]),
        ("Pain fades.It returns.", ["Pain fades.", "It returns."]), ('"Please wash hands!" said Dr. Lee. He left.', ['"Please wash hands!" said Dr. Lee.', "He left."]),
        ("Th.S Lê An ở TP. Hồ Bạc khám bệnh. Bệnh nhân về.", ["Th.S Lê An ở TP. Hồ Bạc khám bệnh.", "Bệnh nhân về."]), ("她说：“我有皮疹。昨晚更重。”随后离开了医院。鲜姜即可。", ["她说：“我有皮疹。昨晚更重。”随后离开了医院。", "鲜姜即可。"]),
        ("# Heading\nText one.\n- item\n- other", ["# Heading", "Text one.", "- item", "- other"]), ("Q: Is it gout?\nA: No.", ["Q: Is it gout?", "A: No."]), ("1. Diet in gout\nEat oats.", ["1. Diet in gout", "Eat oats."]),
        ("one\n\ntwo", ["one", "two"]), ("", []), (None, []), (" \n\t", []),
    ],
)
def test_sentences(text, want):
    ends = sentences.sentence_ends(text)
    assert [text[a:b].strip() for a, b in zip([0, *ends], ends)] == want


def _boundaries(pairs):
    """Precision and recall of the boundaries of ``(found, true)`` pairs."""
    both = sum(len(a & b) for a, b in pairs)
    return both / max(1, sum(len(a) for a, _ in pairs)), both / max(1, sum(len(b) for _, b in pairs))


@pytest.mark.parametrize("part", [0, 3])
def test_held_out_sentences(part):
    """The chain over marks on documents of sentences that it was not trained on."""
    chain, (_, held) = sentences.marked_model(without=part), sentences.split_pools(part)
    rng = random.Random(77)
    made = [sentences.compose(rng, held) for _ in range(150)]
    precision, recall = _boundaries([(set(sentences.sentence_ends(text, chain)), set(ends)) for text, ends in made])
    assert precision >= 0.9 and recall >= 0.95, (precision, recall)


def test_unpunctuated_runs():
    """Runs without marks are cut wherever they stand; their chain is measured on the sentences it knows."""
    rng = random.Random(3)
    chain, pairs = sentences.unmarked_model(), []
    for _ in range(30):
        text, ends = sentences.bare_text(rng, sentences.POOLS["zh"])
        if len(text) >= sentences.BARE_CHARS:
            pairs.append((set(sentences.bare_ends(text, chain)) | {len(text)}, {e + 1 for e in ends}))
    assert min(_boundaries(pairs)) >= 0.9
    text = next(x for x in (sentences.bare_text(rng, sentences.POOLS["zh"])[0] for _ in range(99)) if len(x) >= 60)
    within = sentences.sentence_ends(f"标题\n{text}\n别再吃了！")
    assert within[0] == 2 and len(within) > 3


def test_marks_of_other_scripts():
    for text in ("यह पहला है। यह दूसरा है।", "هل هذا مؤلم؟ نعم يؤلم۔", "ይህ አንድ ነው። ይህ ሁለት ነው።"):
        assert len(sentences.sentence_ends(text)) == 2


@given(st.text(alphabet="aB.!? \n\"“”。中,1-", max_size=120))
@settings(max_examples=150, deadline=None)
def test_sentence_ends_are_in_order_and_whole(text):
    ends = sentences.sentence_ends(text)
    assert ends == sorted(set(ends)) and (not text.strip() or ends[-1] == len(text.rstrip())) and all(not text[e - 1].isspace() for e in ends)


def test_sentence_table(spark):
    df = spark.createDataFrame([(1, "One. Two."), (2, None), (3, " ")], "doc_id long, text string")
    assert rows(sentences.sentences(df)) == [(1, 1, 0, 4, "One."), (1, 2, 4, 9, "Two.")]


# --- queries ----------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_run_and_match_their_sql(spark, sf, name):
    frame = queries.queries()[name](spark, sf).toPandas()
    assert len(frame) or name == "p7_sequences"
    if name.endswith("_found"):
        assert not frame.duplicated().any()
    if name in queries.oracle_sql():
        assert not harness.differences(frame, harness.connect(sf).sql(queries.oracle_sql()[name]).df())
