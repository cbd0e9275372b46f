"""Problem 10: sentence boundaries across languages and scripts.

Method: a linear-chain sequence model tags places as boundary or inside, decoded by Viterbi
and trained as an averaged structured perceptron. The places are sentence marks (with the quotes
and brackets that close with them) and line breaks; other characters are inside by
construction, but for runs of a script without spaces that have no mark, comma or blank over
:data:`BARE_CHARS` characters: these are tagged character by character by a second chain,
trained on punctuation-stripped text, whatever marks stand elsewhere in the text.

Training documents are composed from the small labelled table of
:mod:`lakeloom.llm.labelled_sentences`, so their boundaries are known.

Defined results: null and blank texts have no sentences; every non-blank character belongs to
one sentence; a blank line always ends one.
"""

from __future__ import annotations

import random
import re
import textwrap
from collections import defaultdict
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType

from lakeloom.llm import labelled_sentences as table
from lakeloom.session import ship

INSIDE, BOUNDARY = 0, 1
# Abbreviations by what follows them.
TITLES = set("dr mr mrs ms prof st lt col gen rev hon sr jr th.s ths ts bs gs pgs gs.ts ts.bs pgs.ts bs.cki bscki ks cn đ.c tp tx bv q p tt h tr ô đ/c vs cf e.g i.e approx no nos ext ver fig figs sect tab vol al ed eds".split())
NUMBERED = set("no nos ext ver fig figs sect tab vol p pp h q sept jan feb mar apr jun jul aug oct nov dec ch art par".split())
CLOSING = set("etc v.v vv p.m a.m ph.d m.d u.s u.k al inc ltd co b.a v.v".split())
# Marks that end a sentence outright in scripts that have no full stop of their own, and their question marks.
_FULL, _ASKING = "。｡।॥۔።።៕។။༎", "؟፧՞"
_MARK = rf"[.!?…！？．‼⁇{_FULL}{_ASKING}]"
_SCAN = re.compile(rf"(?P<break>[^\S\n]*\n\s*)|(?P<mark>{_MARK}+)|(?P<quote>[\"“”„«»「」『』])")
_CLOSERS = set("”’»」』)]）】")
_TOKEN = re.compile(r"[^\s(（\[“\"「,，;:：。！？｡]*$")
_LIST = re.compile(r"[^\S\n]*(?:[-*•▶»›+·▪]|\d{1,3}[.)]|[a-zA-Z][.)]|\(\d{1,2}\)|[ivx]{1,4}\))[^\S\n]+")
_AFTER_HAN = re.compile(r"[^㐀-鿿]+$")
_JOINED = re.compile(r"[^\W\d_]{0,20}[^\W\d_A-Z]{3}[.!?](?=[A-ZĐ])")
_ASKED = re.compile(r"[^\S\n]*(?:Q|A|Hỏi|Đáp|问|答|H|Đ|T)[:：]")
_HAN = re.compile(r"[㐀-鿿豈-﫿぀-ヿ]")


def _kind(ch: str) -> str:
    if not ch:
        return "end"
    if _HAN.match(ch):
        return "han"
    if ch.isupper():
        return "upper"
    if ch.islower():
        return "lower"
    if ch.isdigit():
        return "digit"
    if ch in "\"“「『«":
        return "open"
    if ch in "(（[【":
        return "bracket"
    if ch in ",，;；:：、)）]】%/-–":
        return "joint"
    return "letter" if ch.isalpha() else "sign"


def _token(text: str, at: int) -> str:
    """Class of the token that ends at ``at``; of a longer one its last 24 characters tell."""
    return _token_class(_TOKEN.search(text, max(0, at - 24), at).group())


@lru_cache(maxsize=100_000)
def _token_class(t: str) -> str:
    if not t:
        return "none"
    if _HAN.match(t[-1]):
        return "han"
    t = _AFTER_HAN.search(t).group().lstrip(".") or "."
    joined = _JOINED.match(t)
    t = t[joined.end() :] if joined and joined.end() < len(t) else t  # a stop without its space
    low = t.lower().rstrip(".")
    if low in CLOSING:
        return "closing"
    if low in NUMBERED:
        return "numbered"
    if low in TITLES:
        return "title"
    tail = re.split(r"[^\w.]", t)[-1]
    if len(tail) == 1 and tail.isupper():
        return "initial"
    if re.fullmatch(r"(?:\w\.)+\w", tail) and not tail[-1].isdigit():
        return "dotted"
    if len(tail) in (2, 3) and tail[0].isupper() and tail.isalpha():
        return "short"
    if t[-1].isdigit():
        return "digit"
    if t[-1] in ")）%":
        return "shut"
    return "word"


def _line_kind(line: str) -> str:
    s = line.strip()
    if s.startswith("#") or s.startswith("**"):
        return "heading"
    if s.startswith("|"):
        return "row"
    if _LIST.match(line):
        return "item"
    if _ASKED.match(line):
        return "asked"
    return "text"


def _next_seen(text: str, at: int) -> int:
    """Place of the next character that tells something: blanks and stray signs are passed over."""
    n = len(text)
    while at < n and (text[at].isspace() or _kind(text[at]) == "sign" and text[at] not in "|#*•▶+") and text[at] != "\n":
        at += 1
    return at


def _before(text: str, at: int) -> int:
    """End of what is not blank before ``at``."""
    while at and text[at - 1].isspace():
        at -= 1
    return at


@lru_cache(maxsize=50_000)
def _mark_features(sort: str, tok: str, nk: str, spaced: bool, within: bool, shut: str, frame: str, following: str) -> tuple[str, ...]:
    """Features of a cluster of marks: its sort, the token before, what follows, and the quotation it stands in or closes."""
    if shut == '"':
        return (f"quote:{frame}:{sort}:{nk}", f"quote2:{frame}:{nk}", f"quote-next:{following}:{frame}")
    f = [f"mark:{sort}:{tok}:{nk}:{spaced}", f"mark2:{sort}:{nk}", f"tok:{tok}:{nk if sort in ('stop', 'ellipsis') else sort}", f"tok-alone:{tok}:{sort}"]
    if within:
        f.append(f"quote-within:{sort}")
    if shut:
        f.append(f"mark-shut:{sort}:{nk}")
    return tuple(f)


def places(text: str) -> tuple[list[int], list[tuple[str, ...]]]:
    """``(ends, features)`` of the places where a sentence may end, in order."""
    lines = text.split("\n")
    # The width that lines are wrapped at, where some line goes on in lower case on the next.
    width = max((len(a.rstrip()) for a, b in zip(lines, lines[1:]) if a.strip() and b[:1].islower() and _line_kind(b) == "text"), default=0)
    flowing = 0 < width <= 120
    width = max((len(a.rstrip()) for a in lines if len(a.rstrip()) <= width + 8), default=width)
    ends: list[int] = []
    feats: list[tuple[str, ...]] = []
    opened, frame, start_of_unit = -1, "", True
    line_start, skip = 0, -1
    m0 = _LIST.match(text)
    if m0:
        skip = m0.end()
    for m in _SCAN.finditer(text):
        at, to = m.span()
        if at < skip and m.lastgroup == "mark":
            continue
        if m.lastgroup == "quote":
            ch = text[at]
            if ch in "“„«「『" or ch == '"' and opened < 0:
                opened = at
                last = _before(text, at)
                before = text[last - 1] if last else ""
                frame = "first" if ends and last <= ends[-1] or not before or at == line_start else "colon" if before in ":：" else "comma" if before in ",，" else "word"
            else:
                opened = -1
            continue
        if m.lastgroup == "break":
            prev = text[line_start:at]
            following = text[to : text.find("\n", to) if text.find("\n", to) >= 0 else len(text)]
            gap = m.group().count("\n")
            end = _before(text, at)
            if not end:
                line_start = to
                continue
            nxt = _next_seen(text, to)
            first = following.split(" ", 1)[0]
            nofit = flowing and len(prev.rstrip()) + 1 + len(first) > width
            kind, then = _line_kind(prev), _line_kind(following) if following.strip() else "end"
            if then == "item" and prev.count("(") > prev.count(")"):
                then = "text"  # "(n =" goes on with "19)", which is no item's number
            nk = _kind(text[nxt : nxt + 1])
            if nofit and then == "text" and nk in ("letter", "sign"):
                nk = "lower"  # a stray word of another script says nothing of the sentence
            marked = bool(ends) and ends[-1] == end
            f = [
                f"length:{min(len(prev) // 12, 9)}:{marked}:{then}:{nk}" if nofit else "fits", "blank" if gap > 1 else f"break:{flowing}:{nofit}:{then}:{nk}:{marked}", f"kinds:{kind}:{then}:{flowing and nofit}", f"flow:{flowing}:{nofit}:{nk}",
            ]
            if gap > 1:
                f.append("blank-line")
            elif not nofit or then not in ("text", "asked"):
                f.append("break-plain")
            if marked:
                feats[-1] = (*(x for x in feats[-1] if x.startswith(("mark", "tok", "quote"))), *f)
            else:
                ends.append(end)
                feats.append(tuple(f))
            if gap > 1:
                opened = -1
            line_start = to
            mm = _LIST.match(text, to)
            skip = mm.end() if mm else -1
            continue
        # a cluster of sentence marks, and what closes with it
        end = to
        shut = ""
        while end < len(text) and (text[end] in _CLOSERS or text[end] == '"' and opened >= 0 and shut != '"'):
            shut = '"' if text[end] in '"”’»」』' else shut or ")"
            end += 1
        mark = m.group()
        sort = "ellipsis" if mark[:2] in ("..", "……") or mark == "…" else "stop" if mark[-1] in ".．" else "full" if mark[-1] in _FULL else "ask"
        within = opened >= 0 and shut != '"'
        nxt = _next_seen(text, end)
        nk = _kind(text[nxt : nxt + 1]) if text[nxt : nxt + 1] != "\n" else "newline"
        spaced = nxt > end
        tok = _token(text, at)
        f = _mark_features(sort, tok, nk, spaced, within, shut, frame, text[nxt : nxt + 2] if shut == '"' and nk == "han" else nk)
        ends.append(end)
        feats.append(f)
    last = len(text.rstrip())
    if last and (not ends or ends[-1] != last):
        ends.append(last)
        feats.append(("end",))
    elif last and ends:
        feats[-1] = (*feats[-1], "end")
    return ends, feats


class Chain:
    """Weights of a linear chain over two tags."""

    def __init__(self, weights: dict[str, float], turn: list[list[float]]):
        self.weights, self.turn = weights, turn
        self.sums: dict[tuple[str, ...], float] | None = None

    def __reduce__(self):
        return _frozen, (self.weights, self.turn)

    def score(self, f: tuple[str, ...]) -> float:
        """Sum of the weights of a place's features; places are much alike, so a frozen chain remembers sums."""
        if self.sums is None:
            w = self.weights
            return sum(w.get(x, 0.0) for x in f)
        s = self.sums.get(f)
        if s is None:
            w = self.weights
            s = sum(w.get(x, 0.0) for x in f)
            if len(self.sums) < 100_000:
                self.sums[f] = s
        return s

    def decode(self, feats: list[tuple[str, ...]]) -> list[int]:
        """The best tags by Viterbi; a feature's weight counts for the boundary tag."""
        if not feats:
            return []
        (stay, rise), (fall, again) = self.turn
        back: list[tuple[int, int]] = []
        a, b = 0.0, self.score(feats[0])
        for f in feats[1:]:
            ka = a + stay >= b + fall
            kb = a + rise >= b + again
            a, b, pair = (a + stay if ka else b + fall), (a + rise if kb else b + again) + self.score(f), (0 if ka else 1, 0 if kb else 1)
            back.append(pair)
        tag = INSIDE if a >= b else BOUNDARY
        out = [tag]
        for pair in reversed(back):
            tag = pair[tag]
            out.append(tag)
        return out[::-1]


def _frozen(weights: dict[str, float], turn: list[list[float]]) -> Chain:
    """A chain whose weights do not change any more."""
    chain = Chain(weights, turn)
    chain.sums = {}
    return chain


def perceptron(rows: list[tuple[list[tuple[str, ...]], list[int]]], epochs: int = 6, seed: int = 5) -> Chain:
    """Averaged structured perceptron."""
    rng = random.Random(seed)
    w: dict[str, float] = defaultdict(float)
    total: dict[str, float] = defaultdict(float)
    turn, turn_total = [[0.0, 0.0], [0.0, 0.0]], [[0.0, 0.0], [0.0, 0.0]]
    step = 1
    rows = list(rows)
    for _ in range(epochs):
        rng.shuffle(rows)
        for feats, gold in rows:
            got = Chain(w, turn).decode(feats)
            if got != gold:
                for i, f in enumerate(feats):
                    if got[i] != gold[i]:
                        d = 1.0 if gold[i] == BOUNDARY else -1.0
                        for x in f:
                            w[x] += d
                            total[x] += d * step
                    if i:
                        for tags, d in ((gold, 1.0), (got, -1.0)):
                            turn[tags[i - 1]][tags[i]] += d
                            turn_total[tags[i - 1]][tags[i]] += d * step
            step += 1
    return _frozen({x: w[x] - total[x] / step for x in w}, [[turn[i][j] - turn_total[i][j] / step for j in (0, 1)] for i in (0, 1)])


POOLS = {"en": table.EN, "vi": table.VI, "zh": table.ZH}


def split_pools(part: int, parts: int = 4) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """The labelled sentences without one part, and that part."""
    kept = {lang: [s for i, s in enumerate(pool) if i % parts != part] for lang, pool in POOLS.items()}
    return kept, {lang: [s for i, s in enumerate(pool) if i % parts == part] for lang, pool in POOLS.items()}


def compose(rng: random.Random, pools: dict[str, list[str]] | None = None) -> tuple[str, list[int]]:
    """A training document and the ends of its sentences."""
    lang = rng.choice(("en", "vi", "zh"))
    pool = (pools or POOLS)[lang]
    stop = rng.choice((".", ". ", "｡")) if lang == "zh" and rng.random() < 0.4 else None
    wrap = lang != "zh" and rng.random() < 0.35
    text, ends = "", []

    def add(unit: str, joint: str) -> None:
        nonlocal text
        text += (joint if text else "") + unit
        ends.append(len(text.rstrip()))

    for _ in range(rng.randint(1, 5)):
        if rng.random() < 0.35:
            add(rng.choice(table.HEADS[lang]), rng.choice(("\n", "\n\n")))
        joint = "\n\n" if wrap else rng.choice(("\n", "\n\n"))
        if rng.random() < 0.2:
            mark = rng.choice(("- ", "• ", "* ", "+ ", "{}. ", "{}) ", "{a}) ", "")) if not wrap else rng.choice(("- ", "• ", "{}. ", "{a}) "))
            for k in range(rng.randint(2, 4)):
                add(mark.format(k + 1, a="abcd"[k]) + rng.choice(table.ITEMS[lang]), "\n")
            continue
        if rng.random() < 0.1:
            for r in table.ROWS:
                add(r, "\n")
            continue
        asked = rng.random() < 0.15
        sentences = [rng.choice(pool) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.08:
            sentences[-1] = sentences[-1].rstrip(".。")
        if asked and any(s[-1] in "?？" for s in pool):
            sentences[0] = table.LABELS[lang][0] + next(s for s in rng.sample(pool, len(pool)) if s[-1] in "?？")
            add(sentences[0], joint)
            sentences = [table.LABELS[lang][1] + rng.choice(pool)] + sentences[1:]
            joint = "\n"
        block, marks = "", []
        for s in sentences:
            if stop:
                s = s.replace("。", stop.strip() if s.endswith("。") else "。") if "”" not in s and "）" not in s else s
                between = " " if stop.endswith(" ") else ""
            else:
                between = "" if lang == "zh" else "" if rng.random() < 0.1 and block[-1:] == "." and block[-4:-1].islower() and block[-4:-1].isalpha() and s[0].isupper() and s[0].isalpha() else rng.choice((" ", " ", " ", "  "))
            block += (between if block else "") + s
            marks.append(len(block))
        if wrap and "  " not in block:
            w = rng.choice((72, 76, 80))
            lines = textwrap.wrap(block, w, break_long_words=False, break_on_hyphens=False)
            if "\n".join(lines).replace("\n", " ") == block:
                block = "\n".join(lines)
        text += joint if text else ""
        ends += [len(text) + k for k in marks]
        text += block
    return text, ends


@lru_cache(maxsize=8)
def marked_model(documents: int = 4000, seed: int = 3, without: int | None = None) -> Chain:
    """The chain over marks and breaks, trained on ``documents`` composed texts; part ``without`` of the labelled sentences takes no part."""
    rng = random.Random(seed)
    pools = POOLS if without is None else split_pools(without)[0]
    rows = []
    for _ in range(documents):
        text, ends = compose(rng, pools)
        at, feats = places(text)
        known = set(ends)
        rows.append((feats, [int(e in known) for e in at]))
    return perceptron(rows)


#: A run of a script without spaces that has no mark, blank or comma over so many characters is unpunctuated.
BARE_CHARS = 40
_BARE_RUN = re.compile(rf"[^\W_]{{{BARE_CHARS},}}")


def _around(text: str, i: int) -> tuple[str, ...]:
    pad = f"\x02\x02\x02{text}\x03\x03\x03"
    j = i + 3
    return (f"l3:{pad[j - 2 : j + 1]}", f"r3:{pad[j + 1 : j + 4]}", f"l2r2:{pad[j - 1 : j + 3]}", f"l1:{pad[j]}", f"l2:{pad[j - 1 : j + 1]}", f"r1:{pad[j + 1]}", f"r2:{pad[j + 1 : j + 3]}", f"lr:{pad[j]}{pad[j + 1]}", f"l2r1:{pad[j - 1 : j + 2]}")


def bare_text(rng: random.Random, pool: list[str]) -> tuple[str, set[int]]:
    """Sentences stripped of their punctuation and joined, and the places of their last characters."""
    text, ends = "", set()
    for _ in range(rng.randint(2, 6)):
        text += re.sub(r"[^\w]", "", rng.choice(pool))
        ends.add(len(text) - 1)
    return text, ends


@lru_cache(maxsize=8)
def unmarked_model(documents: int = 900, seed: int = 4, without: int | None = None) -> Chain:
    """The chain over characters, trained on sentences stripped of their punctuation."""
    rng = random.Random(seed)
    pool = POOLS["zh"] if without is None else split_pools(without)[0]["zh"]
    rows = []
    for _ in range(documents):
        text, ends = bare_text(rng, pool)
        rows.append(([_around(text, i) for i in range(len(text))], [int(i in ends) for i in range(len(text))]))
    return perceptron(rows, epochs=6)


def bare_ends(text: str, chain: Chain) -> list[int]:
    """Boundaries within the unpunctuated runs of a text, whatever stands elsewhere in it."""
    out = []
    for m in _BARE_RUN.finditer(text):
        run = m.group()
        if len(_HAN.findall(run)) > 0.3 * len(run):
            tags = chain.decode([_around(run, i) for i in range(len(run))])
            out += [m.start() + i + 1 for i, t in enumerate(tags[:-1]) if t == BOUNDARY]
    return out


def sentence_ends(text: str | None, marked: Chain | None = None, unmarked: Chain | None = None) -> list[int]:
    """End of each sentence: the number of characters up to and including its last one."""
    if not text or not text.strip():
        return []
    ends, feats = places(text)
    tags = (marked or marked_model()).decode(feats)
    out = [e for e, t in zip(ends, tags) if t == BOUNDARY]
    last = len(text.rstrip())
    if not out or out[-1] != last:
        out.append(last)
    if last >= BARE_CHARS and not text.isascii() and _BARE_RUN.search(text):
        out = sorted({*out, *bare_ends(text, unmarked or unmarked_model())})
    return out


def with_sentence_ends(df: DataFrame, column: str = "text", to: str = "sent_ends") -> DataFrame:
    """``df`` with ``to``: the array of sentence ends of ``column``.

    Both chains are trained on the driver and sent to the executors.
    """
    ship(df.sparkSession)
    marked, unmarked = marked_model(), unmarked_model()

    @F.pandas_udf(ArrayType(IntegerType()))
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([sentence_ends(t, marked, unmarked) for t in texts], dtype=object)

    return df.withColumn(to, cut(F.col(column)))


def sentences(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(doc_id, sent_no, sent_start, sent_end, sentence)`` in order; sentences count from 1."""
    rows = with_sentence_ends(df.select(key, "text")).select(key, "text", "sent_ends", F.posexplode("sent_ends").alias("at", "sent_end"))
    start = F.when(F.col("at") == 0, F.lit(0)).otherwise(F.expr("sent_ends[at - 1]"))
    rows = rows.withColumn("sent_start", start)
    return rows.select(key, (F.col("at") + 1).alias("sent_no"), "sent_start", "sent_end", F.regexp_replace(F.expr("substring(text, sent_start + 1, sent_end - sent_start)"), r"^(?U)\s+", "").alias("sentence"))
