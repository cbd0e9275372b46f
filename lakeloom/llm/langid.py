"""Problem 2: the language of a record and of its lines, with a confidence.

Method: sparse multinomial logistic regression on TF-IDF character n-grams (one to three
characters, hashed), trained with follow-the-regularised-leader and elastic-net penalties,
then calibrated by one temperature on held-out samples.

A fourth class, ``none``, holds lines of names, figures and letter runs; it is trained on
lines made by rule from the samples' own capitalised words, figures and letters. Vietnamese
samples are used a second time without accents. The training table is bounded: at most
``max_samples`` labelled rows are read.
"""

from __future__ import annotations

import random
import re
import unicodedata as ud
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

CLASSES = ("en", "vi", "zh", "none")
NONE = CLASSES.index("none")
#: Buckets of hashed n-grams, as bits; the weight table stays within a CPU's cache.
BITS = 16
ORDERS = (1, 2, 3)
#: Characters of lines that are looked at together.
AT_ONCE = 1 << 15
_BREAK = 10
_HAN_RUN = re.compile("[㐀-鿿][㐀-鿿，。：；、]{3}")
_LATIN_RUN = re.compile("[A-Za-z][A-Za-z0-9 ]{2,}")
# Other names of the three languages.
ALIASES = {"vie": "vi", "eng": "en", "zho": "zh", "chi": "zh", "cmn": "zh", "vietnamese": "vi", "english": "en", "chinese": "zh"}


def same_language(label: str | None, lang: str) -> bool:
    """A stored label names ``lang``; case and region or script suffixes do not count."""
    head = re.split(r"[-_]", (label or "").strip().lower())[0]
    return ALIASES.get(head, head) == lang


def without_accents(text: str) -> str:
    out = "".join(c for c in ud.normalize("NFD", text) if ud.category(c) != "Mn")
    return out.replace("đ", "d").replace("Đ", "D")


def plain(line: str, han: bool = True) -> str:
    """Lower case; stored decomposed or not, a letter with its accents is one character. ``han``: it may hold Han characters."""
    if line.isascii():
        return f" {line.lower()} "
    if han and _HAN_RUN.search(line):
        line = _LATIN_RUN.sub(" a ", line)  # a Latin name in Chinese counts as one letter
    return f" {ud.normalize('NFC', line).lower()} "


def _codes(text: str) -> np.ndarray:
    """Code points, with full-width forms as plain ones and all figures as one."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    c = np.where((c >= 0xFF01) & (c <= 0xFF5E), c - 0xFEE0, c)
    return np.where((c >= 48) & (c <= 57), 48, c).astype(np.uint64)


#: Which code points of the basic plane are letters; those above it count as letters.
_IS_LETTER = np.array([chr(i).isalpha() for i in range(0x10000)] + [True])


def _contents(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of letters of each line, and whether it holds Han characters."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), dtype=np.uint32)
    bounds = np.cumsum([0] + [len(x) for x in lines])
    letters = np.concatenate(([0], np.cumsum(_IS_LETTER.take(codes, mode="clip"))))
    han = np.flatnonzero((codes >= 0x3400) & (codes <= 0x9FFF))
    return np.diff(letters[bounds]), np.diff(np.searchsorted(han, bounds)) > 0


def _parts(lines: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of lines that have some ``AT_ONCE`` characters."""
    at = size = 0
    for n, line in enumerate(lines, 1):
        size += len(line)
        if size >= AT_ONCE:
            yield at, n
            at, size = n, 0
    if at < len(lines):
        yield at, len(lines)


_FACTOR, _SPREAD = 1_000_003, 0x9E3779B97F4A7C15


def _buckets(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each order and the bucket of each of its n-grams.

    An n-gram's hash is that of its first characters times ``_FACTOR``, plus the last one and n; the bucket is its upper
    bits times ``_SPREAD``. Characters are multiplied by that beforehand.
    """
    spread = codes * np.uint64(_SPREAD)
    h = np.zeros(len(codes) + 1, np.uint64)
    for n in ORDERS:
        if len(codes) < n:
            break
        h = h[:-1] * np.uint64(_FACTOR)
        h += spread[n - 1 :]
        h += np.uint64(n * _SPREAD % (1 << 64))
        yield n, (h >> np.uint64(64 - BITS)).view(np.int64)


def grams(lines: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per order: bucket of each n-gram, number of its line, and a mask of those within a line."""
    codes = _codes("\n".join(lines))
    line = np.cumsum(codes == _BREAK)
    out = []
    for n, bucket in _buckets(codes):
        first = line[: len(bucket)]
        out.append((bucket, first, (first == line[n - 1 :]) & (codes[: len(bucket)] != _BREAK)))
    return out


class LanguageModel:
    """Weights by bucket and class, a bias, and a temperature."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, temperature: float, density: dict[str, float]):
        self.weights, self.bias, self.temperature, self.density = weights, bias, temperature, density

    def logits(self, lines: list[str]) -> np.ndarray:
        """Scores of all classes of each line."""
        return self._scores(lines)[0]

    def _scores(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`logits` and the number of letters of each line, some lines at a time, so that their n-grams stay in a CPU's cache."""
        z, letters = np.empty((len(lines), len(CLASSES))), np.empty(len(lines), dtype=np.int64)
        for a, b in _parts(lines):
            letters[a:b], han = _contents(lines[a:b])
            z[a:b] = self._logits([plain(x.replace("\n", " "), h) for x, h in zip(lines[a:b], han.tolist())])
        return z, letters

    def _logits(self, texts: list[str]) -> np.ndarray:
        z = np.zeros((len(texts), len(CLASSES)))
        size = np.array([len(t) for t in texts])
        ends = np.cumsum(size + 1) - 1
        starts = ends - size
        total = np.zeros(len(texts))
        for n, bucket in _buckets(_codes("\n".join(texts))):
            part = self.weights.take(bucket, axis=0)
            for k in range(n):  # n-grams that reach beyond their line; each line is at least as long as its two blanks
                beyond = ends - k
                part[beyond[beyond < len(part)]] = 0
            # reduceat needs starts within the array; a line too short for the order has none
            ok = starts < len(part)
            z[ok] += np.add.reduceat(part, starts[ok], axis=0)
            total += np.maximum(size - n + 1, 0)
        return z / np.maximum(total, 1)[:, None] + self.bias

    def probabilities(self, lines: list[str]) -> np.ndarray:
        return self._calibrated(self.logits(lines))

    def _calibrated(self, z: np.ndarray) -> np.ndarray:
        z = z / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, lines: list[str]) -> tuple[list[str | None], np.ndarray]:
        """Language (None: a line without one) and confidence of each line."""
        best, p = self.judge(lines)
        return [None if k == NONE else CLASSES[k] for k in best.tolist()], p.max(axis=1)

    def judge(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Class (``NONE``: a line without language) and the calibrated probabilities of all classes of each line; equal lines are scored once."""
        place: dict[str, int] = {}
        at = np.array([place.setdefault(x, len(place)) for x in lines], dtype=np.int64)
        z, letters = self._scores(list(place))
        p = self._calibrated(z)
        best = p.argmax(axis=1)
        best[letters < 0.3 * np.array([len(x) for x in place])] = NONE
        return best[at], p[at]

    def content(self, best: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Amount of content: characters over the usual number of the class's language for the same text."""
        return chars / np.array([self.density.get(c, 1.0) for c in CLASSES])[best]


def _no_language(texts: list[str], rng: random.Random, n: int) -> list[str]:
    """Lines of names, figures or letter runs only, made from what the samples hold."""
    names = sorted({w for t in texts for w in re.findall(r"(?<=[a-z一-鿿] )?[A-Z][a-z]{4,}", t)}) or ["Velora"]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    out = []
    for k in range(n):
        kind = k % 4
        if kind == 0:
            out.append(" ".join(rng.choice(names) for _ in range(rng.randint(3, 9))))
        elif kind == 1:
            out.append("".join(rng.choice(letters) for _ in range(rng.randint(40, 120))))
        elif kind == 2:
            out.append("".join(rng.choice("0123456789 .,:/-|%") for _ in range(rng.randint(30, 90))))
        else:
            out.append(" | ".join(f"{rng.choice(names)} {rng.choice(names)} {rng.randint(1, 99)} mg" for _ in range(rng.randint(2, 4))))
    return out


def _with_names(rows: list[tuple[str, str]], rng: random.Random) -> list[tuple[str, str]]:
    """Pieces of the samples beside invented names and between separators, so that these tell nothing of a language."""
    words = sorted({w for lang, t in rows for w in re.findall(r"[a-z]{4,9}", without_accents(t).lower())}) or ["velora"]
    out = []
    for lang, t in rows:
        at = rng.randrange(max(1, len(t) - 12))
        piece = t[at : at + rng.randint(12, 60)]
        name = " ".join((rng.choice(words) + rng.choice(("", rng.choice(words)[:4]))).capitalize() for _ in range(rng.randint(2, 4)))
        space = "" if lang == "zh" else " "
        out.append((lang, rng.choice((f"{name}{space}{piece}", f"{piece}{space}{name}", f"{name}{space}{piece[:14]}"))))
        # A menu: short pieces between separators.
        bits = [t[i : i + rng.randint(2, 5)] for i in range(0, len(t) - 5, 9)] if lang == "zh" else [" ".join(t.split()[i : i + rng.randint(1, 2)]) for i in range(0, len(t.split()), 2)]
        out.append((lang, rng.choice((" / ", " > ", " | ", " » ", "  ", " - ")).join(bits[:8])))
    return out


def _augmented(base: list[tuple[str, str]], rng: random.Random) -> list[tuple[str, str]]:
    """The samples, Vietnamese ones without accents, capitals, pieces beside names, and lines without language."""
    rows = list(base)
    rows += [("vi", without_accents(t)) for lang, t in base if lang == "vi"]
    rows += [(lang, t.upper()) for lang, t in base if lang in ("en", "vi")]
    rows += _with_names(rows, rng)
    return rows + [("none", t) for t in _no_language([t for _, t in base], rng, max(8, len(rows) // 4))]


def train(samples: list[tuple[str, str]], epochs: int = 6, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 1e-3, seed: int = 7) -> LanguageModel:
    """Fit on ``(lang, text)`` rows; rows of other languages or without text are left out."""
    rng = random.Random(seed)
    base = [(lang, t) for lang, t in samples if lang in CLASSES and t and t.strip()]
    rng.shuffle(base)
    # Held out before anything is made of the samples: the temperature is fitted on texts of which training knows nothing.
    n_held = max(1, len(base) // 5)
    kept, base = base[:n_held], base[n_held:] or base
    rows = _augmented(base, rng)
    rng.shuffle(rows)
    k, size = len(CLASSES), 1 << BITS
    features = []
    for _, t in rows:
        parts = [b[inside] for b, _, inside in grams([plain(t.replace("\n", " "))])]
        index, count = np.unique(np.concatenate(parts), return_counts=True)
        features.append((index, count / count.sum()))
    df = np.zeros(size)
    for index, _ in features:
        df[index] += 1
    idf = np.log((1 + len(rows)) / (1 + df)) + 1
    scale = 20.0  # relative frequencies are small; one constant brings them to unit range
    z, n, w = np.zeros((size, k)), np.zeros((size, k)), np.zeros((size, k))
    zb, nb, bias = np.zeros(k), np.zeros(k), np.zeros(k)
    y = np.array([CLASSES.index(lang) for lang, _ in rows])
    order = list(range(len(rows)))
    for _ in range(epochs):
        rng.shuffle(order)
        for r in order:
            index, tf = features[r]
            x = tf * idf[index] * scale
            zi, ni = z[index], n[index]
            wi = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
            bias = -zb / ((beta + np.sqrt(nb)) / alpha + l2)
            s = x @ wi + bias
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[r]] -= 1.0
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[index] = zi + g - sigma * wi
            n[index] = ni + g * g
            sb = (np.sqrt(nb + p * p) - np.sqrt(nb)) / alpha
            zb += p - sb * bias
            nb += p * p
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    bias = -zb / ((beta + np.sqrt(nb)) / alpha + l2)
    density = {c: float(np.median([len(t) for lang, t in samples if lang == c and t] or [1.0])) for c in CLASSES}
    model = LanguageModel((w * idf[:, None] * scale).astype(np.float32), bias, 1.0, density)
    # Calibrated on short pieces of the held-out texts, where the model does err.
    pieces, y = [], []
    for lang, t in _augmented(kept, rng):
        for _ in range(4):
            at = rng.randrange(max(1, len(t) - 8))
            pieces.append(t[at : at + rng.randint(5, 24)])
            y.append(CLASSES.index(lang))
    held = len(pieces)
    s, y = model.logits(pieces), np.array(y)
    best = None
    for t in np.geomspace(0.1, 10, 41):
        q = s / t
        loss = float((np.log(np.exp(q - q.max(axis=1, keepdims=True)).sum(axis=1)) + q.max(axis=1) - q[np.arange(held), y]).mean())
        if best is None or loss < best[0]:
            best = (loss, float(t))
    model.temperature = best[1]
    return model


def fit(samples: DataFrame, max_samples: int = 5000) -> LanguageModel:
    """Train on a labelled table ``(lang, text)``, at most ``max_samples`` of its rows in id order."""
    rows = samples.filter(F.col("text").isNotNull()).orderBy("sample_id").select("lang", "text").limit(max_samples).collect()
    return train([(r.lang, r.text) for r in rows])
