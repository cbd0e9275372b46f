"""One pass over crawled pages; the narrow table that problems 2, 5 and 6 work on.

For each record with non-blank text: its furniture lines, whether its title is decorated, the
hashed pieces of its lines that :mod:`lakeloom.llm.residue` aligns, and, if asked for, languages.
The pages' texts never shuffle; rows of one ``doc_id`` that are exact copies fall together
afterwards, in the narrow table.
"""

from __future__ import annotations

import gc
import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lakeloom.functions.arrow import map_slices
from lakeloom.llm import pagelines as pl
from lakeloom.llm.langid import CLASSES, NONE, LanguageModel, same_language
from lakeloom.operators.copies import one_per_key
from lakeloom.session import written

#: Furniture's share in the trees above which a line is furniture, and up to which a short one surely is the article's.
FURNITURE, SURE = 0.5, 0.4
#: From this length on a line that ends as a sentence is prose: surely the article's unless it is furniture.
PROSE_CHARS = 60

SCAN = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("voter", LongType()),
        StructField("pieces", ArrayType(StructType([StructField("line_no", IntegerType()), StructField("key", LongType())]))),
        StructField("loose", ArrayType(IntegerType())),
        StructField("n_unfilled", IntegerType()),
        StructField("furniture", ArrayType(IntegerType())),
        StructField("decorated", BooleanType()),
        StructField("langs", ArrayType(StructType([StructField("line_no", IntegerType()), StructField("lang", StringType()), StructField("confidence", DoubleType()), StructField("mislabelled", BooleanType())]))),
    ]
)

_PIECES = re.compile(r"[.!?。…]+[\"'”’」』)\]]*(?:\s+|$)|(?<=[。!?])|[,;、:]\s*| {2,}|\s*\|\s*")
_VALUE = re.compile(r"(?<![^\s㐀-鿿豈-﫿])(?=[^\s㐀-鿿豈-﫿]*\d)[^\s㐀-鿿豈-﫿]+")
_TOKEN = re.compile(r"\x01|[㐀-鿿豈-﫿]|[^\W_㐀-鿿豈-﫿]+")


#: For plain ASCII: marks that always end a piece as line breaks, all else that is in no word as blanks.
_PLAIN = {i: "\n" if chr(i) in ",;:|!?\n" else chr(i) if i == 1 or chr(i).isalnum() else " " for i in range(128)}
_LINES = re.compile(r"[\t\n\r]")
_CLOSED = re.compile(r"\.[\"')\]]+(?=\s|$)")


def _plain_pieces(folded: str) -> list[str]:
    """The parts ``_PIECES`` cuts an ASCII line into, with blanks between words; line breaks are not in it."""
    if "  " in folded:
        folded = folded.replace("  ", "\n")
    if "." in folded:
        folded = _CLOSED.sub("\n", folded).replace(". ", "\n").replace(".\n", "\n")
    folded = folded.translate(_PLAIN)
    return (folded.replace("\x01", " \x01 ") if "\x01" in folded else folded).split("\n")


@lru_cache(maxsize=20_000)
def line_pieces(folded: str, site: str) -> list[int]:
    """Hashes of a line's sentences and clauses, with slots for figures, codes and the site's name; slots alone are none."""
    if site and site in folded:
        folded = folded.replace(site, "\x01")
    if pl._FIGURE.search(folded):
        folded = _VALUE.sub("\x01", folded)
    out = []
    plain = folded.isascii() and not _LINES.search(folded)
    for piece in _plain_pieces(folded) if plain else _PIECES.split(folded):
        words = piece.split() if plain else _TOKEN.findall(piece)
        if words and (words[0] != "\x01" or any(w != "\x01" for w in words)):
            out.append(pl.hash64(" ".join(words)))
    return out


def pieces_of(found: list[tuple[int, float, bool, str, int | None]], site: str) -> list[tuple[int, int]]:
    """``(line number, hash)`` of the pieces of a page's lines.

    A long line is one piece. Of an unfilled line the labels of its slots count, so that blank slots are known by them.
    """
    out = []
    for n, _, flag, f, whole in found:
        if whole is not None and not flag:
            out.append((n, whole))
        else:
            line = pl.slots_blank(f) if flag else f
            out += [(n, key) for key in line_pieces(line, site if site in line else "")]
    return out


def _doubtful(share: float, folded: str) -> bool:
    """The line may be furniture; a longer one that ends as a sentence only if it is more likely than not."""
    return share > SURE and (share > FURNITURE or not (len(folded) >= PROSE_CHARS and pl.ends_sentence(folded)))


def line_model(df: DataFrame, section_share: float = 5e-4, headline_share: float = 5e-5) -> pl.LineModel:
    """The line classifier, with what the corpus's titles tell: how headlines begin and end, and sections' names.

    What is kept of the titles is bounded by the shares: a title has two edges, and at most a
    handful of short parts.
    """
    schema = StructType([StructField("edges", ArrayType(LongType())), StructField("parts", ArrayType(LongType()))])

    def factory():
        def kernel(titles):
            return [[pl.edges(pl.flat(t)) for t in titles], [pl.title_parts(t) for t in titles]]

        return kernel

    held = df.filter(F.col("title").rlike(r"\S")).select("title")
    whole = held.count()
    titles = map_slices(held, ["title"], schema, factory)

    def each(kind: int, column: str) -> Column:
        return F.transform(column, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("key")))

    counts = titles.select(F.explode(F.concat(each(1, "edges"), each(2, "parts"))).alias("x")).groupBy("x.kind", "x.key").agg(F.count(F.lit(1)).alias("n"))
    least = F.when(F.col("kind") == 1, F.lit(max(2, headline_share * whole))).otherwise(F.lit(max(3, section_share * whole)))
    kept = counts.filter(F.col("n") >= least).collect()
    return pl.LineModel(frozenset(r.key for r in kept if r.kind == 1), frozenset(r.key for r in kept if r.kind == 2))


def scan(df: DataFrame, model: LanguageModel | None = None, min_chars: int = 100, min_line: int = 40, least: float = 0.55, every: bool = False, lines: pl.LineModel | None = None) -> DataFrame:
    """The narrow table of :data:`SCAN`, one row for each row with text, written to the shared folder.

    Exact copies of a record give equal rows: see :func:`records`.

    With ``model``, ``langs`` has line 0 (the main language of the article, ``mislabelled``
    where the stored label is missing or names another) and lines of at least ``min_line`` characters in
    another language than the main one, for texts of at least ``min_chars`` characters. With ``every``
    each record has line 0, whatever its length: without an article's language that of all its lines,
    and without any the likeliest class of the whole text with its probability.
    """
    known = lines or line_model(df)

    def factory():
        import numpy as np

        def kernel(*columns):
            # The rows of a slice are many small objects without cycles: collecting among them finds nothing.
            gc.disable()
            try:
                return scanned(*columns)
            finally:
                gc.enable()

        def scanned(ids, domains, titles, languages, texts):
            out = [[] for _ in SCAN.fields]
            jobs, rows, numbers, articles = [], [], [], []
            names = [pl.site_name(d) for d in domains]
            for at, (i, dom, title, text, site, found) in enumerate(zip(ids, domains, titles, texts, names, known.classify(list(zip(texts, names))))):
                furniture = [n for n, share, *_ in found if share > FURNITURE]
                # Copies of an article, whatever stands around it, speak with one voice.
                headline, decorated = pl.headline_of(title, dom, known.sections) if title and title.strip() else (None, False)
                voter = pl.hash64("\n".join(f for _, _, _, f, _ in found) if headline is None else pl.flat(headline))
                loose = [n for n, share, flag, f, _ in found if flag or _doubtful(share, f)]
                values = (i, voter, pieces_of(found, site), loose, sum(x[2] for x in found), furniture, decorated, [])
                for col, v in zip(out, values):
                    col.append(v)
                if model is not None and (every or len(text) >= min_chars):
                    lines = text.split("\n")
                    for n, share, flag, _, _ in found:
                        line = lines[n - 1].strip()
                        article = share <= FURNITURE and not flag
                        if every or article or len(line) >= min_line:
                            jobs.append(line)
                            rows.append(at)
                            numbers.append(n)
                            articles.append(article)
            if jobs:
                for at, found in languages_of(jobs, np.array(rows), numbers, np.array(articles), languages).items():
                    out[-1][at] = found
            return out

        def languages_of(jobs, rows, numbers, articles, languages):
            """``langs`` of each row that has a main language; ``jobs`` are lines, in the order of their rows."""
            best, p = model.judge(jobs)
            sure, size = p.max(axis=1), np.array([len(x) for x in jobs], dtype=float)
            spoken = best != NONE
            amount = model.content(best, size)

            def weights(of):
                return np.bincount(rows[of] * len(CLASSES) + best[of], amount[of], len(languages) * len(CLASSES)).reshape(-1, len(CLASSES))

            weight = weights(spoken & articles)
            article = weight.any(axis=1)
            if every:
                weight[~article] = weights(spoken)[~article]
            # Of equal weights the first name counts; those of CLASSES are in order.
            main, has = weight.argmax(axis=1), weight.any(axis=1)
            # The calibrated probability of the main language, over the lines that speak of it, by their length.
            said = spoken & (articles | ~article[rows])
            told = np.bincount(rows[said], p[said, main[rows[said]]] * size[said], len(languages))
            confidence = (told / np.maximum(np.bincount(rows[said], size[said], len(languages)), 1)).tolist()
            langs = {at: [(0, CLASSES[main[at]], confidence[at], not same_language(languages[at], CLASSES[main[at]]))] for at in np.flatnonzero(has).tolist()}
            if every:
                for at in np.unique(rows[~has[rows]]).tolist():
                    a, b = np.searchsorted(rows, (at, at + 1))
                    shares = model.probabilities([" ".join(jobs[a:b])])[0, :NONE]
                    k = int(shares.argmax())
                    langs[at] = [(0, CLASSES[k], float(shares[k]), not same_language(languages[at], CLASSES[k]))]
            for k in np.flatnonzero(spoken & has[rows] & (best != main[rows]) & (size >= min_line) & (sure >= least)).tolist():
                langs[int(rows[k])].append((numbers[k], CLASSES[best[k]], float(sure[k]), False))
            return langs

        return kernel

    rows = df.filter(F.col("doc_id").isNotNull() & F.col("text").rlike(r"\S")).select(F.col("doc_id").cast("long").alias("doc_id"), "domain", "title", "language", "text")
    found = map_slices(rows, ["doc_id", "domain", "title", "language", "text"], SCAN, factory)
    return written(found, "pages")


def records(pages: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` and ``columns`` of a scan, one row a record."""
    return one_per_key(pages.select("doc_id", *columns), "doc_id")
