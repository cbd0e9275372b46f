"""What each line of a crawled page is: the article's or furniture.

A page is cut into flat text blocks, its lines. Each block has its word count, link density,
list and sentence marks, the words and links of the blocks around it and of the run of blocks
of the same shape it stands in, and two scores of its words: how far they are furniture's
rather than an article's, and how far they are a headline's rather than a sentence's or list
item's. Words are learned from the labelled table of :mod:`lakeloom.llm.labelled_pages`; nothing here
lists phrases. A committee of decision trees grown on pages composed of that table classifies
the blocks. So that the trees do not take known words for granted, each fifth of the table is
described with the words of the other four.

Lines are compared in a folded form: skeleton of :mod:`lakeloom.llm.forms`, without marks and
in lower case, so that look-alike characters and dropped accents make no difference.
"""

from __future__ import annotations

import math
import random
import re
import unicodedata as ud
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import repeat

import numpy as np
import xxhash

from lakeloom.llm import forms
from lakeloom.llm import labelled_pages as table


class _Folds(dict):
    def __missing__(self, cp: int) -> str:
        out = "".join(x for x in forms._TABLE[cp] if ud.category(x) != "Mn").lower().replace("đ", "d")
        self[cp] = out
        return out


_FOLDS = _Folds()


def fold(text: str) -> str:
    return text.translate(_FOLDS)


def flat(line: str) -> str:
    """A line folded, trimmed, with single blanks."""
    return _BLANKS.sub(" ", fold(line)).strip()


def hash64(text: str) -> int:
    h = xxhash.xxh3_64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


_WORD = re.compile(r"[㐀-鿿豈-﫿]|[^\W_㐀-鿿豈-﫿]+")
_HAN = re.compile(r"[㐀-鿿豈-﫿]")
_LINK = re.compile(r"\[([^\]\n]*)\]\([^)\n]*\)|https?://\S+|www\.\S+")
_LIST = re.compile(r"\s*([-*•▶»›+·▪►]|\d{1,2}[.)]|[a-z]\)|\(\d{1,2}\))\s+")
_ENDS = re.compile(r"[.!?。!?…][\"'”’」』)\]]*$")
_INNER_END = re.compile(r"[.!?][\"'”’」』)\]]* +(?=\S)|[。!?](?=.)")
_CLOSED = re.compile(r"\.[\"'”’」』)\]]")
_LAST_MARK = ".!?。…"
_LAST = _LAST_MARK + "\"'”’」』)]"
_SEPARATOR = re.compile(r"[|/•·»›>–—_\t]| - |  +")
_SIGNS = "|/•·»›>–—_\t"
_BLANKS = re.compile(r" {2,}")
_FIGURE = re.compile(r"\d")

# --- words ------------------------------------------------------------------------------


def grams(words: list[str]) -> list[str]:
    """Words and pairs of words."""
    return words + [f"{a} {b}" for a, b in zip(["<", *words], words)]


def tokens(folded: str) -> list[str]:
    """Words of a folded text; a Han character is a word, all figures are one word."""
    words = _WORD.findall(folded)
    return ["0" if x[0].isdigit() else x for x in words] if _FIGURE.search(folded) else words


def edges_of(words: list[str], han: bool) -> list[int]:
    n = 3 if han else 2
    return [hash64("<" + " ".join(words[:n])), hash64(" ".join(words[-n:]) + ">")] if len(words) > n else []


def edges(folded: str) -> list[int]:
    """Hashes of a line's first and last words, without its list mark."""
    listed = _LIST.match(folded)
    return edges_of(tokens(folded[listed.end() :] if listed else folded), bool(_HAN.search(folded)))


#: Groups of kinds that words are told apart by: furniture, menu, headline, list item or heading, prose.
_GROUPS = {"menu": 1, "headline": 2, "item": 3, "heading": 3, "prose": 4, "row": 4}
_PLACES = re.compile(r"\{\w\}")


def learn_words(lines: dict[str, dict[str, list[str]]], prior: float = 0.3) -> dict[str, tuple[float, float]]:
    """Log odds of each gram: furniture against article, headline or menu against item and prose."""
    count: dict[str, list[int]] = defaultdict(lambda: [0] * 5)
    n = [0] * 5
    for kinds in lines.values():
        for kind, texts in kinds.items():
            if kind == "subject":
                continue
            group = _GROUPS.get(kind, 0)
            for text in texts:
                n[group] += 1
                for g in set(grams(tokens(flat(_PLACES.sub(lambda m: "0" if m.group() in ("{n}", "{m}") else "\x01 ", text))))):
                    count[g][group] += 1

    def odds(v: list[int], one: tuple[int, ...], other: tuple[int, ...]) -> float:
        return math.log((sum(v[i] for i in one) + prior) / (sum(n[i] for i in one) + 1)) - math.log((sum(v[i] for i in other) + prior) / (sum(n[i] for i in other) + 1))

    return {g: (odds(v, (0, 1), (2, 3, 4)), odds(v, (1, 2), (3, 4))) for g, v in count.items()}


# --- slots and defaults -----------------------------------------------------------------

# How templating languages write a slot.
_SLOT = re.compile(
    r"\{\{[^{}\n]{1,40}\}\}|[$#]\{[^{}\n]{1,40}\}|\[\[[^\[\]\n]{1,40}\]\]|%%[^%\n]{1,40}%%|<%[^%\n]{1,60}%>|<insert [^<>\n]{1,40}>|__(?=[^\W_])[^\n]{1,38}?__|(?<!\{)\{[^{}\n]{1,40}\}(?!\})|%\([a-z_]{2,30}\)s|(?<!\])\[(?!\d+\])[^\[\]\n()]{1,30}\](?![(\[])|<[^<>\n]{2,40}>"
)
#: A label before a slot has at most so many words.
LABEL_WORDS = 5
# Words of the usual filler text, folded.
FILLER = set("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo".split())
_REPEATED = re.compile(r"(\S{2,8})(?: \1)+(?: [0-9a-z]{1,6})?[.!]?")


def unfilled(folded: str, words: list[str]) -> bool:
    """A line, with its words, of slots that retain a variable's name or a default: placeholders, filler words, one token over and over."""
    if ("[" in folded or "{" in folded or "<" in folded or "_" in folded or "%" in folded) and "](" not in folded:
        parts = _SLOT.split(folded)
        n = len(parts) - 1
        # A slot in a sentence is a stray one, and brackets after a sentence are buttons; a line of labels and slots is a template.
        if n and not any(_ENDS.search(p.rstrip()) and _size(p) > LABEL_WORDS for p in parts):
            left = len(_WORD.findall(" ".join(parts)))
            if left <= 4 * n + 3 and (n > 1 or not _ENDS.search(parts[-1].rstrip()) or left <= 4):
                return True
    # What is repeated stands before the first blank and after it.
    first = folded.find(" ", 0, 9)
    if first > 1 and folded.startswith(folded[:first], first + 1) and _REPEATED.fullmatch(folded):
        return True
    # Of so many filler words one is in the first fifth, or next.
    return len(words) >= 3 and not FILLER.isdisjoint(words[: len(words) // 5 + 1]) and sum(w in FILLER for w in words) >= 0.8 * len(words)


def slots_blank(folded: str) -> str:
    """An unfilled line with its slots blank; nothing is left of filler words."""
    rest, n = _SLOT.subn("\x01", folded)
    return rest if n else ""


# --- blocks -----------------------------------------------------------------------------

OWN = ("words", "link_density", "listed", "ends", "separators", "label_words", "table", "heading", "sentences", "furniture_words", "headline_words", "headline_edges")
FEATURES = (
    *OWN, "names_site", "words_before", "words_after", "links_before", "links_after", "furniture_words_before", "furniture_words_after", "prose_before", "prose_after",
    "run_length", "run_furniture_words", "run_headline_words", "run_headline_edges", "words_before_run", "words_after_run", "furniture_before_run", "furniture_after_run", "prose_before_run", "prose_after_run",
)
#: Words from which a block that ends as a sentence does is prose; runs and distances are told apart up to these lengths.
PROSE_WORDS, RUN, FAR = 14, 12, 20


def _size(text: str) -> float:
    """Length in words; a Han character is about half a word."""
    words = len(_WORD.findall(text))
    return words if text.isascii() else words - 0.5 * len(_HAN.findall(text))


#: Short lines whose description is kept, some 15 MB of a worker's memory.
REMEMBERED = 20_000
SHORT_LINE = 120
#: Longer lines are aligned whole: paragraphs of which a template would repeat every clause.
LONG_LINE = 240


def site_name(domain: str | None) -> str:
    """The name a site shows, from the registered part of its host."""
    labels = (domain or "").lower().split(".")
    longest = max(labels[: max(1, len(labels) - 1)], key=len, default="")
    return longest.replace("-", " ")


def _counts(folded: str) -> tuple[int, int]:
    """Numbers of Han characters and of ``_SIGNS`` in a text."""
    return len(_HAN.findall(folded)), sum(map(folded.count, _SIGNS))


def separators(text: str, signs: int) -> int:
    """Number of ``_SEPARATOR`` in a text with so many ``_SIGNS``; only runs of blanks need the pattern."""
    return len(_SEPARATOR.findall(text)) if "  " in text else signs + text.count(" - ")


def ends_sentence(folded: str) -> bool:
    """``_ENDS`` is found at the end of a trimmed text."""
    last = folded[-1:]
    return last in _LAST and (last in _LAST_MARK or bool(_ENDS.search(folded[-8:]))) if last else False


def inner_ends(folded: str) -> int:
    """Number of ``_INNER_END`` in a folded, trimmed text; the pattern is only needed where marks are closed, doubled or other ones."""
    if "!" in folded or "?" in folded or "  " in folded or "\n" in folded or "\r" in folded or _CLOSED.search(folded):
        return len(_INNER_END.findall(folded))
    return folded.count(". ") + folded.count("。") - folded.endswith("。")


class _Codes:
    """Code points folded, and what the folded ones are; filled as they come."""

    DELETED, LONGER = 0x110000, 0x110001
    KNOWN, WORD, HAN, DIGIT, DECIMAL, SIGN = 1, 2, 4, 8, 16, 32

    def __init__(self):
        self.folds = np.zeros(0x110000, dtype=np.uint32)  # 0: not yet known
        self.kinds = np.zeros(0x110000, dtype=np.uint8)
        self.folds[0] = self.DELETED

    def folded(self, codes: np.ndarray) -> np.ndarray:
        out = self.folds[codes]
        if not out.all():
            for cp in np.unique(codes[out == 0]).tolist():
                f = _FOLDS[cp]
                self.folds[cp] = ord(f) if len(f) == 1 else self.LONGER if f else self.DELETED
            out = self.folds[codes]
        return out

    def kinds_of(self, codes: np.ndarray) -> np.ndarray:
        out = self.kinds[codes]
        if not out.all():
            for cp in np.unique(codes[out == 0]).tolist():
                c = chr(cp)
                han = bool(_HAN.match(c))
                self.kinds[cp] = self.KNOWN | self.WORD * bool(_WORD.match(c)) | self.HAN * han | self.DIGIT * c.isdigit() | self.DECIMAL * c.isdecimal() | self.SIGN * (c in _SIGNS)
            out = self.kinds[codes]
        return out


_CODES = _Codes()
#: Characters of lines that are folded and cut into words at once; longer lines are on their own.
AT_ONCE = 1 << 15


def _folded_words(lines: list[str]) -> tuple[list[str], list[str], list[int], list[tuple[int, int]]]:
    """Each line folded and trimmed, the :func:`tokens` of all lines, where each line's begin, and the last one's end, and each line's :func:`_counts`.

    The arrays take some 60 bytes a character of ``lines``.
    """
    text = "\n".join(lines)
    codes = _CODES.folded(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32))
    begins = np.zeros(len(lines) + 1, dtype=np.int64)
    np.cumsum([len(x) + 1 for x in lines], out=begins[1:])
    begins[-1] -= 1
    longer = np.flatnonzero(codes == _Codes.LONGER).tolist()
    if longer:
        size = np.ones(len(codes), dtype=np.int64)
        several = [_FOLDS[ord(text[at])] for at in longer]
        size[longer] = [len(x) for x in several]
        ends = np.cumsum(size)
        codes = np.repeat(codes, size)
        for at, x in zip(ends[longer].tolist(), several):
            codes[at - len(x) : at] = [ord(c) for c in x]
        begins += np.concatenate(([0], np.cumsum(size - 1)))[begins]
    gone = codes == _Codes.DELETED
    if gone.any():
        begins -= np.concatenate(([0], np.cumsum(gone)))[begins]
        codes = codes[~gone]
    whole = codes.tobytes().decode("utf-32-le")
    at = begins.tolist()
    folded = [whole[a:b].strip() for a, b in zip(at, at[1:])]

    kinds = _CODES.kinds_of(codes)
    word, han = (kinds & _Codes.WORD) > 0, (kinds & _Codes.HAN) > 0
    plain = word & ~han
    first = plain.copy()
    first[1:] &= ~plain[:-1]
    first |= han
    starts = np.flatnonzero(first)
    shown = np.where(word, codes, 32).astype(np.uint32)
    digits = (kinds[starts] & _Codes.DIGIT) > 0
    if digits.any():
        # A word that begins with a figure is the word 0, in lines with a decimal figure.
        decimals = np.concatenate(([0], np.cumsum((kinds & _Codes.DECIMAL) > 0)))
        line = np.searchsorted(begins, starts, side="right") - 1
        line = np.minimum(line, len(lines) - 1)
        digits &= decimals[begins[line + 1]] > decimals[begins[line]]
        number = np.cumsum(first) - 1
        shown[plain & ~first & digits[np.maximum(number, 0)]] = 32
        shown[starts[digits]] = 48
    if han.any():
        apart = han.copy()
        apart[:-1] |= han[1:] & word[:-1]
        size = 1 + apart.astype(np.int64)
        ends = np.cumsum(size)
        shown = np.repeat(shown, size)
        shown[ends[apart] - 1] = 32
    words = shown.tobytes().decode("utf-32-le").split()
    counts = [np.diff(np.concatenate(([0], np.cumsum(x)))[begins]).tolist() for x in (han, (kinds & _Codes.SIGN) > 0)]
    return folded, words, np.searchsorted(starts, begins).tolist(), list(zip(*counts))


class Blocks:
    """Describes lines; short ones, which come again, are remembered."""

    #: Whether lines are remembered.
    remembers = True

    def __init__(self, words: dict[str, tuple[float, float]], headlines: frozenset[int] = frozenset()):
        self.words, self.headlines = words, headlines
        self.seen: dict[str, tuple] = {}
        ones = [w for w in words if " " not in w]
        self.number = {w: i for i, w in enumerate(ones, 2)}  # 0: unknown, 1: before the first word
        self.odds = np.zeros((len(ones) + 2, 2))
        if ones:
            self.odds[2:] = [words[w] for w in ones]
        pairs = [(self.number.get(a, 1 if a == "<" else 0), self.number[b], *words[g]) for g in words if " " in g for a, b in [g.split(" ")]]
        pairs.sort()
        self.pairs = np.array([a * len(self.odds) + b for a, b, *_ in pairs] + [len(self.odds) ** 2], dtype=np.int64)
        self.pair_odds = np.array([x[2:] for x in pairs] + [(0.0, 0.0)])

    def __reduce__(self):
        return Blocks, (self.words, self.headlines)

    def scores(self, words: list[str], bounds: list[int]) -> list[tuple[float, float]]:
        """Mean log odds of each line's grams: furniture, headline; a line's words are between two of the ``bounds``. No pair with an unknown word is known."""
        n = len(bounds) - 1
        at = np.fromiter(map(self.number.get, words, repeat(0)), dtype=np.int64, count=len(words))
        line = np.repeat(np.arange(n), np.diff(bounds))
        before = np.zeros(len(at), dtype=np.int64)
        before[1:] = at[:-1]
        firsts = np.array(bounds[:-1], dtype=np.int64)
        before[firsts[np.diff(bounds) > 0]] = 1
        key = before * len(self.odds) + at
        place = np.searchsorted(self.pairs, key)
        paired = self.pairs[place] == key
        # In the words' order, each before the pair that it ends: the sums are those of a loop.
        odds = np.zeros((len(at), 2, 2))
        odds[:, 0] = self.odds[at]
        odds[paired, 1] = self.pair_odds[place[paired]]
        twice = np.repeat(line, 2)
        size = 1 + np.bincount(line, at > 0, n) + np.bincount(line, paired, n)
        furniture, headline = (np.bincount(twice, odds[:, :, k].ravel(), n) / size for k in (0, 1))
        return list(zip(furniture.tolist(), headline.tolist()))

    def described(self, lines: list[str]) -> list[tuple]:
        """:meth:`describe` of many lines, some ten thousand characters at a time."""
        out: list[tuple] = []
        chunk, size = [], 0
        for line in lines:
            if chunk and size + len(line) > AT_ONCE:
                out += self._chunk(chunk)
                chunk, size = [], 0
            chunk.append(line)
            size += len(line) + 1
        return out + self._chunk(chunk) if chunk else out

    def describe(self, line: str) -> tuple[tuple[float, ...], int, bool, str, int | None]:
        """Own features, shape (0: stands alone), whether it is an unfilled template, the folded line, and a long line's hash."""
        return self.described([line])[0]

    def _chunk(self, lines: list[str]) -> list[tuple]:
        lines = [x.replace("\t", "|") if "\t" in x else x for x in lines]
        if len(lines[0]) > AT_ONCE:
            folded = [fold(lines[0]).strip()]
            words = tokens(folded[0])
            bounds, counts = [0, len(words)], [_counts(folded[0])]
        else:
            folded, words, bounds, counts = _folded_words(lines)
        scores = self.scores(words, bounds)
        return [self._described(f, words[a:b], *c, *s) for f, a, b, c, s in zip(folded, bounds, bounds[1:], counts, scores)]

    def _described(self, f: str, said: list[str], n_han: int, signs: int, furniture: float, headline: float) -> tuple:
        words = len(said) - 0.5 * n_han
        linked = sum(_size(m.group(1) or m.group()) for m in _LINK.finditer(f)) if "](" in f or "http" in f or "www." in f else 0
        listed = _LIST.match(f)
        bare = f[listed.end() :] if listed else f
        if listed and signs:
            signs -= _counts(listed.group())[1]
        colon = bare.find(":")
        ends = ends_sentence(f)
        density = linked / words if words else 0.0
        tabled = f.startswith("|")
        near = sum(e in self.headlines for e in edges_of(said[len(_WORD.findall(listed.group(1))) :] if listed else said, n_han > 0)) / 2 if words <= 30 and self.headlines else 0.0
        own = (
            float(words), density, float(bool(listed)), float(ends), float(separators(bare, signs)), float(min(len(_WORD.findall(bare[:colon])), FAR) if 0 < colon < 200 else FAR),
            float(tabled), float(f.startswith("#") or f.startswith("**") and f.endswith("**")), float(inner_ends(f)), furniture, headline, near,
        )
        if listed:
            sign = listed.group(1)[0]
            shape = 1 if sign.isalnum() or sign == "(" else 16 + ord(sign)
        else:
            shape = 2 if tabled else 3 if density > 0.5 else 4 if words < PROSE_WORDS and not ends else 0
        whole = hash64(" ".join(said)) if len(f) > LONG_LINE and said else None
        return own, shape, unfilled(_BLANKS.sub(" ", f) if "  " in f else f, said), f, whole

    def _descriptions(self, lines: list[str]) -> list[tuple]:
        """:meth:`described`; short lines are remembered, at most ``REMEMBERED`` at a time."""
        if not self.remembers:
            return self.described(lines)
        found = {x: self.seen.get(x) for x in lines}
        new = [x for x, o in found.items() if o is None]
        for at in range(0, len(new), REMEMBERED):
            part = new[at : at + REMEMBERED]
            short = {}
            for x, o in zip(part, self.described(part)):
                found[x] = o
                if len(x) <= SHORT_LINE:
                    short[x] = o
            if len(self.seen) + len(short) > REMEMBERED:
                self.seen.clear()
            self.seen.update(short)
        return [found[x] for x in lines]

    def features(self, pages: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray, list[int], list[bool], list[tuple[str, int | None]]]:
        """Rows of :data:`FEATURES` of all non-blank lines of ``(text, site)`` pages, and each line's page, number, template flag, and folded form with its hash if it is long."""
        lines, gaps, numbers, owner, bounds = [], [], [], [], [0]
        for at, (text, _) in enumerate(pages):
            gap = False
            for n, line in enumerate(text.split("\n"), 1):
                line = line.strip()
                if not line:
                    gap = True
                    continue
                lines.append(line)
                numbers.append(n)
                owner.append(at)
                gaps.append(gap)
                gap = False
            bounds.append(len(lines))
        described = self._descriptions(lines)
        named = np.zeros(len(lines))
        for (_, site), a, b in zip(pages, bounds, bounds[1:]):
            names = [w for w in re.findall(r"[a-z0-9]+", site) if len(w) >= 4]
            if len(names) > 2:
                named[a:b] = [sum(w in x[3] for w in names) >= len(names) - 1 for x in described[a:b]]
            elif names:
                named[a:b] = [any(w in x[3] for w in names) if len(names) > 1 else names[0] in x[3] for x in described[a:b]]
        own, shapes = [x[0] for x in described], [x[1] for x in described]
        flags, folded = [x[2] for x in described], [x[3:] for x in described]
        page = np.array(owner, dtype=int)
        return _with_context(np.array(own, dtype=float).reshape(-1, len(OWN)), np.array(shapes, dtype=int), np.array(gaps, dtype=bool), named, page), page, numbers, flags, folded


def _with_context(own: np.ndarray, shape: np.ndarray, gap: np.ndarray, named: np.ndarray, page: np.ndarray) -> np.ndarray:
    m = len(own)
    if not m:
        return np.zeros((0, len(FEATURES)))
    at = np.arange(m)
    words, links, furniture, headline, near = (own[:, OWN.index(c)] for c in ("words", "link_density", "furniture_words", "headline_words", "headline_edges"))

    def beside(values: np.ndarray, place: np.ndarray) -> np.ndarray:
        ok = (place >= 0) & (place < m)
        there = np.where(ok, place, 0)
        return np.where(ok & (page[there] == page), values[there], 0.0)

    prose = (words >= PROSE_WORDS) & (own[:, OWN.index("ends")] > 0) & (own[:, OWN.index("separators")] < 3)
    last = np.maximum.accumulate(np.where(prose, at, -1))
    before = np.where((last >= 0) & (page[np.maximum(last, 0)] == page), at - last, FAR)
    following = np.minimum.accumulate(np.where(prose, at, m)[::-1])[::-1]
    after = np.where((following < m) & (page[np.minimum(following, m - 1)] == page), following - at, FAR)

    starts = np.ones(m, dtype=bool)
    starts[1:] = (page[1:] != page[:-1]) | (shape[1:] == 0) | (shape[1:] != shape[:-1]) | gap[1:]
    run = np.cumsum(starts) - 1
    size = np.bincount(run)
    first = np.flatnonzero(starts)
    lead, tail = (first - 1)[run], (first + size)[run]

    def mean(values: np.ndarray) -> np.ndarray:
        return (np.bincount(run, values) / size)[run]

    long = ((words >= PROSE_WORDS) & (own[:, OWN.index("ends")] > 0)).astype(float)
    return np.column_stack(
        [
            own, named, beside(words, at - 1), beside(words, at + 1), beside(links, at - 1), beside(links, at + 1), beside(furniture, at - 1), beside(furniture, at + 1), np.minimum(before, FAR), np.minimum(after, FAR),
            np.minimum(size, RUN)[run], mean(furniture), mean(headline), mean(near), beside(words, lead), beside(words, tail), beside(furniture, lead), beside(furniture, tail), beside(long, lead), beside(long, tail),
        ]
    )


# --- trees ------------------------------------------------------------------------------


class Tree:
    """A binary decision tree grown by Gini impurity, kept as flat arrays."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2):
        self.feature: list[int] = []
        self.limit: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.share: list[float] = []
        self._grow(x, y, depth, least)
        self.arrays = [np.array(a) for a in (self.feature, self.limit, self.left, self.right, self.share)]

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        at = len(self.feature)
        for a, v in ((self.feature, -1), (self.limit, 0.0), (self.left, at), (self.right, at), (self.share, float(y.mean()))):
            a.append(v)
        best = None
        if depth and 0 < y.mean() < 1 and len(y) >= 2 * least:
            for j in range(x.shape[1]):
                order = np.argsort(x[:, j], kind="stable")
                v, t = x[order, j], np.cumsum(y[order])
                n = np.arange(1, len(y) + 1)
                cut = np.nonzero((v[:-1] < v[1:]) & (n[:-1] >= least) & (n[:-1] <= len(y) - least))[0]
                if len(cut):
                    a, b = t[cut] / n[cut], (t[-1] - t[cut]) / (len(y) - n[cut])
                    cost = n[cut] * a * (1 - a) + (len(y) - n[cut]) * b * (1 - b)
                    i = int(np.argmin(cost))
                    if best is None or cost[i] < best[0] - 1e-12:
                        best = (cost[i], j, (v[cut[i]] + v[cut[i] + 1]) / 2)
        if best:
            _, j, limit = best
            go = x[:, j] <= limit
            self.feature[at], self.limit[at] = j, limit
            self.left[at] = self._grow(x[go], y[go], depth - 1, least)
            self.right[at] = self._grow(x[~go], y[~go], depth - 1, least)
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, limit, left, right, share = self.arrays
        at = np.zeros(len(x), dtype=int)
        rows = np.arange(len(x))
        while True:
            f = feature[at]
            if (f < 0).all():
                return share[at]
            go = x[rows, f] <= limit[at]
            at = np.where(go, left[at], right[at])


@dataclass
class Committee:
    """Decision trees, each grown on other rows and features; their mean share decides."""

    trees: list[tuple[np.ndarray, Tree]] = field(default_factory=list)
    _walks: list | None = field(default=None, repr=False, compare=False)
    ROWS = 1024

    @classmethod
    def grow(cls, x: np.ndarray, y: np.ndarray, trees: int = 32, features: int = 12, depth: int = 8, least: int = 20, seed: int = 5) -> Committee:
        rng = np.random.default_rng(seed)
        out = cls()
        for _ in range(trees):
            columns = np.sort(rng.choice(x.shape[1], features, replace=False))
            rows = rng.integers(0, len(x), len(x) // 2)
            out.trees.append((columns, Tree(x[rows][:, columns], y[rows], depth, least)))
        return out

    def _paths(self) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Each tree: its depth, and of each node the column, the limit, where its left child is, and the share; the right child comes next."""
        out = []
        for chosen, t in self.trees:
            order, depth, level = [0], 0, [0]
            while level := [c for at in level if t.feature[at] >= 0 for c in (t.left[at], t.right[at])]:
                order += level
                depth += 1
            place = {at: i for i, at in enumerate(order)}
            # A leaf is its own left child, and all rows go left.
            leaf = [t.feature[at] < 0 for at in order]
            out.append((
                depth, np.array([0 if x else int(chosen[t.feature[at]]) for at, x in zip(order, leaf)]), np.array([np.inf if x else t.limit[at] for at, x in zip(order, leaf)]),
                np.array([i if x else place[t.left[at]] for i, (at, x) in enumerate(zip(order, leaf))]), np.array([t.share[at] for at in order]),
            ))
        return out

    def share(self, x: np.ndarray) -> np.ndarray:
        """Mean share of the trees, some rows at a time, so that these stay in a CPU's cache."""
        if self._walks is None:
            self._walks = self._paths()
        out = np.zeros(len(x))
        for start in range(0, len(x), self.ROWS):
            values = np.ascontiguousarray(x[start : start + self.ROWS])
            total, rows, values = out[start : start + len(values)], np.arange(len(values)) * x.shape[1], values.ravel()
            for depth, column, limit, left, share in self._walks:
                at = np.zeros(len(rows), dtype=np.int64)
                for _ in range(depth):
                    right = values.take(rows + column.take(at)) > limit.take(at)
                    at = left.take(at)
                    at += right
                total += share.take(at)
        return out / len(self.trees)


#: Shares of grams that are hidden from a training line: of most lines, and of lines as unknown as can be.
HIDDEN, UNKNOWN = 0.15, 0.1


def _parts(lines: dict[str, dict[str, list[str]]], folds: int, held: int) -> tuple[dict, dict]:
    """The labelled table without its part ``held``, and that part alone."""
    kept: dict[str, dict[str, list[str]]] = {}
    out: dict[str, dict[str, list[str]]] = {}
    for lang, kinds in lines.items():
        kept[lang] = {k: v if k == "subject" else [x for i, x in enumerate(v) if i % folds != held] for k, v in kinds.items()}
        out[lang] = {k: v if k in ("subject", "menu") else [x for i, x in enumerate(v) if i % folds == held] or v for k, v in kinds.items()}
    return kept, out


def composed(rng: random.Random, lines: dict, words: dict, pages: int, hide: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and labels (1: furniture) of pages composed of ``lines``, described with ``words``."""
    made = [table.compose(rng, lines) for _ in range(pages)]
    seen = Counter(e for page in made for kind, line in page if kind == "headline" for e in edges(flat(line)))
    headlines = frozenset(e for e, n in seen.items() if n > 1 and rng.random() > HIDDEN * hide)
    blocks = Blocks(words, headlines)
    if hide:

        def odds(said: list[str]) -> tuple[float, float]:
            share = 1.0 if rng.random() < UNKNOWN else HIDDEN
            known = [words[g] for g in grams(said) if g in words and rng.random() > share]
            n = len(known) + 1.0
            return sum(x[0] for x in known) / n, sum(x[1] for x in known) / n

        blocks.scores = lambda said, bounds: [odds(said[a:b]) for a, b in zip(bounds, bounds[1:])]
        blocks.remembers = False
    sites = [next((s for s in table.SITES if any(s in line for _, line in page)), "") for page in made]
    x, *_ = blocks.features([("\n".join(line for _, line in page), site.lower()) for page, site in zip(made, sites)])
    return x, np.array([float(kind in table.FURNITURE_KINDS) for page in made for kind, line in page if line.strip()])


@lru_cache(maxsize=4)
def committee(folds: int = 5, pages: int = 240, seed: int = 7, held_out: int | None = None) -> tuple[Committee, dict]:
    """The trees and the words they go with; the part ``held_out`` of the table takes no part."""
    rng = random.Random(seed)
    lines = table.LINES if held_out is None else _parts(table.LINES, folds, held_out)[0]
    rows = []
    for k in range(folds):
        known, unknown = _parts(lines, folds, k)
        rows.append(composed(rng, unknown, learn_words(known), pages))
    return Committee.grow(np.concatenate([x for x, _ in rows]), np.concatenate([y for _, y in rows]), seed=seed), learn_words(lines)


class LineModel:
    """Tells furniture from article on whole slices of pages.

    ``headlines`` are the edges of the corpus's titles (:func:`title_facts`), ``sections`` hashes
    of its section names.
    """

    def __init__(self, headlines: frozenset[int] = frozenset(), sections: frozenset[int] = frozenset(), held_out: int | None = None):
        self.trees, words = committee(held_out=held_out)
        self.blocks = Blocks(words, headlines)
        self.sections = sections | {hash64(flat(x)) for kinds in table.LINES.values() for x in kinds["menu"]}

    def classify(self, pages: list[tuple[str, str]]) -> list[list[tuple[int, float, bool, str, int | None]]]:
        """For each ``(text, site)``: ``(line number, furniture's share, unfilled, folded line, a long line's hash)`` of its non-blank lines."""
        x, page, numbers, flags, folded = self.blocks.features(pages)
        out: list[list[tuple[int, float, bool, str, int | None]]] = [[] for _ in pages]
        if len(x):
            for at, n, share, flag, f in zip(page.tolist(), numbers, self.trees.share(x).tolist(), flags, folded):
                out[at].append((n, 0.0 if flag else share, flag, *f))
        return out


# --- titles -----------------------------------------------------------------------------

_TITLE_CUTS = re.compile(r"\s*[|»›•·_«]+\s*|\s+[-–—/:]+\s+|\s*::\s*")
_TITLE_BRACKETS = re.compile(r"[\[(（【<]([^\])）】>]{2,60})[\])）】>]")
_LABELS = re.compile(r"[a-z0-9]+")
_DECOR = re.compile(r"[|»›•·_«\[\]（(【<–—/-]|::|\s:+\s")
#: A section's name has at most so many words.
SECTION_WORDS = 6


def title_parts(title: str) -> list[int]:
    """Hashes of the short parts of a title of several parts: its sections' names are among them."""
    f = flat(title)
    parts = [m.group(1).strip() for m in _TITLE_BRACKETS.finditer(f) if m.start() == 0]
    cut = [p.strip() for p in _TITLE_CUTS.split(f) if p.strip()]
    parts += cut if len(cut) > 1 else []
    return [hash64(p) for p in dict.fromkeys(parts) if len(_WORD.findall(p)) <= SECTION_WORDS]


def _is_site(part: str, tokens: set[str], joined: str) -> bool:
    """The part of a title is the site's name or address."""
    words = _LABELS.findall(part)
    if not words:
        return False
    if sum(w in tokens for w in words[:2]) == min(2, len(words)) and len("".join(words)) >= 4:
        return True
    compact = "".join(words[:-1] if len(words) > 1 and "." in part else words)
    return len(compact) >= 5 and compact in joined


def headline_of(title: str, domain: str | None, sections: frozenset[int]) -> tuple[str, bool]:
    """The bare headline, and whether the title is :func:`decorated`."""
    headline, more = bare_headline(title, domain, sections)
    return headline, bool(more and _DECOR.search(fold(title)))


def decorated(title: str | None, domain: str | None, sections: frozenset[int]) -> bool:
    """The title holds more than the headline."""
    return bool(title and _DECOR.search(fold(title)) and bare_headline(title, domain, sections)[1])


def bare_headline(title: str, domain: str | None, sections: frozenset[int]) -> tuple[str, bool]:
    """``(headline, decorated)``: the title without the site's name, address or a section's name."""
    folded = flat(title)
    labels = (domain or "").lower().split(".")
    tokens = {w for x in labels[: max(1, len(labels) - 1)] for w in _LABELS.findall(x)}
    joined = re.sub(r"[^a-z0-9]", "", "".join(labels[: max(1, len(labels) - 1)]))

    def extra(part: str) -> bool:
        return hash64(part) in sections or _is_site(part, tokens, joined)

    shown = forms.one_form(title).strip()
    brackets = [m for m in _TITLE_BRACKETS.finditer(folded) if (m.start() == 0 or m.end() == len(folded)) and extra(m.group(1).strip())]
    if brackets and sum(m.end() - m.start() for m in brackets) < len(folded):
        plain = _TITLE_BRACKETS.sub(lambda m: " " if extra(flat(m.group(1))) else m.group(), shown)
        return bare_headline(plain.strip(), domain, sections)[0], True
    parts = [p.strip() for p in _TITLE_CUTS.split(folded) if p.strip()]
    if len(parts) > 1:
        keep = [not extra(p) for p in parts]
        if not all(keep) and any(keep):
            cut = [p.strip() for p in _TITLE_CUTS.split(shown) if p.strip()]
            if len(cut) == len(parts):
                shown = " - ".join(p for p, k in zip(cut, keep) if k)
            return shown, True
    return shown, False
