"""Problem 1: text that looks the same but is stored with different characters.

Method: the confusables skeleton. Every character is decomposed, replaced by its
prototype from a look-alike table, and decomposed again; marks are put in one order.
Originals with equal skeletons print the same.

Defined results: a null title or text has a null form; an empty one an empty form.
Characters with no visible shape (zero-width, soft hyphen, direction marks, variation
selectors) vanish, all kinds of space become U+0020, blanks at a line's end and ``\\r``
before a line break vanish. Case, accents, digits, words, punctuation marks and line breaks
are kept. Rows of one ``doc_id`` that are exact copies count once.
"""

from __future__ import annotations

import re
import unicodedata as ud

import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakeloom.functions.arrow import map_slices
from lakeloom.session import written

# Look-alike letters and their prototypes, by script.
LOOK_ALIKES = {
    # Cyrillic, small
    "а": "a", "с": "c", "е": "e", "о": "o", "р": "p", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    # Cyrillic, capital
    "А": "A", "В": "B", "Е": "E", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I", "Ү": "Y",
    # Greek
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    # Armenian
    "օ": "o", "ս": "u", "հ": "h", "ո": "n", "զ": "q", "Օ": "O", "Ս": "U", "Ⴝ": "S",
    # Cherokee
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    # Lisu
    "ꓮ": "A", "ꓐ": "B", "ꓚ": "C", "ꓓ": "D", "ꓰ": "E", "ꓝ": "F", "ꓖ": "G", "ꓧ": "H", "ꓲ": "I", "ꓙ": "J", "ꓗ": "K", "ꓡ": "L", "ꓟ": "M", "ꓠ": "N", "ꓳ": "O", "ꓑ": "P", "ꓣ": "R", "ꓢ": "S", "ꓔ": "T", "ꓴ": "U", "ꓦ": "V", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓜ": "Z",
    # Coptic, Gothic and Greek letters drawn alike
    "Ⲁ": "A", "Ⲃ": "B", "Ⲉ": "E", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "Ⲣ": "P", "Ⲥ": "C", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X", "ⲟ": "o", "ⲣ": "p", "ⲥ": "c",
    # Latin letters and signs drawn alike
    "ɡ": "g", "ɑ": "a", "ı": "i", "ȷ": "j", "Ð": "Đ", "Ɖ": "Đ", "ǃ": "!", "ꞌ": "'", "′": "'", "ʹ": "'", "‐": "-", "‑": "-", "﹣": "-", "−": "-", "⁃": "‐", "∶": ":", "։": ":", "∣": "|", "ǀ": "|", "⁄": "/", "∕": "/", "‚": ",", "∗": "*",
}
#: Compatibility forms that are drawn differently from their letters.
_DRAWN_APART = ("<super>", "<sub>", "<circle>", "<fraction>")
_MARKS = re.compile("[̀-ͯ᪰-᫿᷀-᷿⃐-⃿]{2,}")
_ANY_MARK = re.compile("[̀-ͯ᪰-᫿᷀-᷿⃐-⃿]")
_LINE_END = re.compile(r"[ \r]+(?=\n|$)")
#: Circumflex, breve and horn make letters; tones come after them.
_SHAPING = "\u0302\u0306\u031b"
#: Shapeless characters besides category Cf: joiner, fillers, variation selectors.
_SHAPELESS = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}


def _decomposed(ch: str) -> str:
    """Full decomposition of one character, without the forms drawn apart."""
    how = ud.decomposition(ch)
    if not how:
        return ud.normalize("NFD", ch)  # Hangul has no table entry
    parts = how.split()
    if parts[0] in _DRAWN_APART or parts[0] == "<compat>" and parts[1] == "0020":
        return ch
    return "".join(_decomposed(chr(int(x, 16))) for x in parts if x[0] != "<")


def sort_marks(text: str) -> str:
    """Each run of combining marks in code point order: the order of marks is not seen."""
    return _MARKS.sub(lambda m: "".join(sorted(m.group())), text)


class Prototypes(dict):
    """Translation table from a code point to its skeleton, filled as characters come."""

    def __missing__(self, cp: int) -> str:
        ch = chr(cp)
        if cp in (9, 10, 13):
            out = " " if cp == 9 else ch
        elif cp in _SHAPELESS or ud.category(ch) == "Cf" or (ud.category(ch) == "Cc"):
            out = ""
        elif ud.category(ch) == "Zs":
            out = " "
        elif cp in (0x2028, 0x2029, 0x85):
            out = "\n"
        else:
            out = LOOK_ALIKES.get(ch) or "".join(LOOK_ALIKES.get(x, x) for x in _decomposed(ch))
            out = sort_marks("".join(y for x in out for y in _decomposed(x)))
        self[cp] = out
        return out


_TABLE = Prototypes()


def skeleton(text: str) -> str:
    """The form that all texts which print like ``text`` share."""
    out = text.translate(_TABLE)
    if _ANY_MARK.search(text):
        out = sort_marks(out)
    return _LINE_END.sub("", out)


def one_form(text: str) -> str:
    """The skeleton, composed again for storage: marks that shape a letter before those above it."""
    return ud.normalize("NFC", _MARKS.sub(lambda m: "".join(sorted(m.group(), key=lambda x: (x not in _SHAPING, x))), skeleton(text)))


def unify(df: DataFrame, columns: tuple[str, ...] = ("title", "text")) -> DataFrame:
    """Every row with ``<column>_form`` added for each of ``columns``; other columns unchanged.

    A column of ``df`` that already has such a name is replaced.
    """
    columns = tuple(columns)
    rest = [f for f in df.schema.fields if f.name not in {f"{c}_form" for c in columns}]
    schema = StructType(rest + [StructField(f"{c}_form", StringType()) for c in columns])
    names = [f.name for f in rest]
    at = [names.index(c) for c in columns]

    def factory():
        def kernel(*cols):
            return [*cols, *([None if x is None else one_form(x) for x in cols[i]] for i in at)]

        return kernel

    return map_slices(df, names, schema, factory)


def looks(df: DataFrame, min_chars: int = 200, key: str = "doc_id") -> DataFrame:
    """One row a distinct stored form of a record: ``(doc_id, look_a, look_b, stored)``.

    ``look_a, look_b`` are a 128-bit hash of the skeletons of title and text (a null title
    prints like an empty one), ``stored`` a hash of both as stored. Records whose text is
    null or under ``min_chars`` characters have no row.
    """
    schema = StructType([StructField(key, LongType()), StructField("look_a", LongType()), StructField("look_b", LongType()), StructField("stored", LongType())])

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    def factory():
        def kernel(ids, titles, texts):
            a, b, s = [], [], []
            for t, x in zip(titles, texts):
                t = t or ""
                h = xxhash.xxh3_128_intdigest(f"{skeleton(t)}\x00{skeleton(x)}")
                a.append(signed(h >> 64))
                b.append(signed(h & (1 << 64) - 1))
                s.append(signed(xxhash.xxh3_64_intdigest(f"{t}\x00{x}")))
            return [ids, a, b, s]

        return kernel

    rows = df.filter(F.col(key).isNotNull() & (F.length("text") >= min_chars)).select(F.col(key).cast("long").alias(key), "title", "text")
    return map_slices(rows, [key, "title", "text"], schema, factory).distinct()


def look_classes(df: DataFrame, min_chars: int = 200, key: str = "doc_id") -> DataFrame:
    """``(doc_id, look_class, form_id, n_records, n_stored_forms)``: the class of records that print alike.

    ``look_class`` is the class's smallest id, ``form_id`` the smallest id of the records stored
    alike. One row a record, of any class size; every pair of :func:`same_look_pairs` is two rows
    of one ``look_class`` and different ``form_id``.
    """
    each = looks(df, min_chars, key)
    forms = each.groupBy("look_a", "look_b", "stored").agg(F.min(key).alias("form_id"), F.count(F.lit(1)).alias("n"))
    per = forms.groupBy("look_a", "look_b").agg(F.min("form_id").alias("look_class"), F.sum("n").alias("n_records"), F.count(F.lit(1)).alias("n_stored_forms"))
    return each.join(forms.drop("n"), ["look_a", "look_b", "stored"]).join(per, ["look_a", "look_b"]).select(key, "look_class", "form_id", "n_records", "n_stored_forms")


#: Records of a class that meet another one's in one task; larger classes are spread.
PART = 1000


def same_look_pairs(df: DataFrame, min_chars: int = 200, key: str = "doc_id") -> DataFrame:
    """Pairs ``(doc_id_a, doc_id_b)`` of records that print the same and are stored differently.

    Records are joined on the look's hash, so no pair of different looks is ever formed;
    classes with a single stored form are left out before the join, and a large class is spread over
    tasks by one side's id. All pairs are given; :func:`look_classes` has them as a membership.
    """
    each = written(looks(df, min_chars, key), "looks")  # narrow, and read three times
    mixed = each.groupBy("look_a", "look_b").agg(F.min("stored").alias("lo"), F.max("stored").alias("hi"), F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")).filter("lo <> hi").select("look_a", "look_b", "parts")
    each = each.join(mixed, ["look_a", "look_b"])
    a = each.select("look_a", "look_b", F.col(key).alias("doc_id_a"), F.col("stored").alias("stored_a"), F.pmod(F.xxhash64(key), F.col("parts")).cast("int").alias("part"))
    b = each.select("look_a", "look_b", F.col(key).alias("doc_id_b"), F.col("stored").alias("stored_b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    pairs = a.join(b, ["look_a", "look_b", "part"]).filter((F.col("doc_id_a") < F.col("doc_id_b")) & (F.col("stored_a") != F.col("stored_b")))
    return pairs.select("doc_id_a", "doc_id_b").distinct()
