"""Column functions: URLs, hashes, text, tokens and decisions, all on the JVM.

Null in gives null out unless stated; an unusable URL gives null.
"""

from __future__ import annotations

import unicodedata as ud

import pandas as pd
from pyspark.sql import Column, functions as F

from lakeloom.schemas import TERMINAL

_URL = r"^(?i)(https?)://([^/?#]*)([^?#]*)(\?[^#]*)?"
_AUTHORITY = r"^(\[[0-9A-Fa-f:.]+\]|[^:@\[\]\s]+)(?::(\d*))?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(strip(url), _URL, group)


def strip(c: Column) -> Column:
    """Without white space at both ends; ``trim`` takes spaces only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def domain_from_url(url: Column) -> Column:
    """Lower-case host without port, or null."""
    host = F.lower(F.regexp_extract(_part(url, 2), _AUTHORITY, 1))
    return F.when(host != "", host)


def normalize_fetch_url(url: Column) -> Column:
    """http(s) URL with lower-case scheme and host, no default port, no fragment, ``/`` for no path.

    Credentials and other schemes give null.
    """
    scheme, host, port = F.lower(_part(url, 1)), domain_from_url(url), F.regexp_extract(_part(url, 2), _AUTHORITY, 2)
    default = F.when(scheme == "http", "80").otherwise("443")
    shown = F.when((port == "") | (port == default), "").otherwise(F.concat(F.lit(":"), port))
    path = F.when(_part(url, 3) == "", "/").otherwise(_part(url, 3))
    return F.when((scheme != "") & host.isNotNull(), F.concat(scheme, F.lit("://"), host, shown, path, _part(url, 4)))


def origin_from_url(url: Column) -> Column:
    return F.regexp_extract(normalize_fetch_url(url), r"^(https?://[^/?]*)", 1)


def fetch_key(url: Column) -> Column:
    return F.sha2(normalize_fetch_url(url), 256)


def task_url(url: Column) -> Column:
    """The URL a task is kept under: an unusable one stays as it is, so no row is lost."""
    return F.coalesce(normalize_fetch_url(url), url)


def is_pdf_like(url: Column) -> Column:
    return F.lower(_part(url, 3)).endswith(".pdf")


def stable_int(value: Column, seed: int | str) -> Column:
    """63-bit integer: the first eight bytes of sha256 of ``seed:value`` without the top bit."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), value.cast("string")), 256)
    high = F.conv(F.substring(h, 1, 8), 16, 10).cast("long").bitwiseAND(2147483647)
    return high * F.lit(4294967296) + F.conv(F.substring(h, 9, 8), 16, 10).cast("long")


def stable_key(*parts: Column | str | int) -> Column:
    return F.sha2(F.concat_ws(":", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts)), 256)


def _normalizer(form: str):
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else ud.normalize(form, x))

    return run


def unicode_form(c: Column, form: str = "NFC") -> Column:
    """Unicode normal form; texts in ASCII never leave the JVM's value."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), _normalizer(form)(c)).otherwise(c)


def clean_text(c: Column) -> Column:
    """Unix line ends, single blanks, stripped lines, no blank before ``,.;:!?%``, at most one empty line."""
    x = F.regexp_replace(unicode_form(c), r"\r\n?", "\n")
    x = F.regexp_replace(x, r"[ \t\f\x0B]+", " ")
    x = F.regexp_replace(x, r"(?m)^ +| +$", "")
    x = F.regexp_replace(x, r" +([,.;:!?%])", "$1")
    return strip(F.regexp_replace(x, r"\n{3,}", "\n\n"))


def content_hash(c: Column) -> Column:
    return F.sha2(clean_text(c), 256)


def dedup_form(c: Column) -> Column:
    """Lower case, words only, single blanks."""
    return strip(F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}\p{N}_]+", " "))


_HAN = r"[\x{3400}-\x{9fff}]"


def token_count(c: Column) -> Column:
    """Estimated tokens: Han characters and a quarter more than the other words; at least 1."""
    han = F.length(F.regexp_replace(c, r"[^\x{3400}-\x{9fff}]", ""))
    rest = strip(F.regexp_replace(c, _HAN, " "))
    words = F.when(rest == "", 0).otherwise(F.size(F.split(rest, r"(?U)\s+")))
    return F.greatest(F.lit(1), han + F.floor(words * 1.25)).cast("int")


def first_words(c: Column, n: int) -> Column:
    return F.array_join(F.slice(F.split(strip(c), r"(?U)\s+"), 1, n), " ")


def tokens(c: Column) -> Column:
    """Search tokens: lower-case words with inner hyphens and points, and bigrams of Han runs."""
    low = F.lower(c)
    words = F.regexp_extract_all(F.regexp_replace(low, _HAN + "+", " "), F.lit(r"[\p{L}\p{M}\p{N}_]+(?:[-.][\p{L}\p{M}\p{N}_]+)*"), 0)
    runs = F.regexp_extract_all(low, F.lit(_HAN + "+"), 0)
    grams = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(r) - 1)), lambda i: F.substr(r, i, F.lit(2)))))
    return F.concat(words, grams)


def cost_category(status: Column) -> Column:
    return F.when(status.isin("SUCCESS", "FAILED", "EMPTY_CONTENT", "NEEDS_JS", "ROBOTS_DENIED"), status).otherwise("OTHER")


def is_terminal(status: Column) -> Column:
    return status.isin(*TERMINAL)


def retry_delay(attempt: Column, base: float = 30.0, jitter: Column | None = None, most: float = 3600.0) -> Column:
    """Seconds to wait after ``attempt`` tries: base · 2^(n−1) plus a stable jitter, capped."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), attempt - 1) + (jitter if jitter is not None else F.lit(0.0)))


def retry_after(header: Column, now: Column, most: float = 300.0) -> Column:
    """Seconds that a ``Retry-After`` header asks for, as a number or an HTTP date, from 0 to ``most``; null without a usable one."""
    value = strip(header)
    date = F.unix_timestamp(F.try_to_timestamp(F.regexp_replace(value, r"^[A-Za-z]{3}, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss")))
    seconds = F.when(value.rlike(r"^\d{1,9}$"), F.expr("0.0") + value.try_cast("double")).otherwise(date - now)
    return F.when(seconds.isNotNull(), F.least(F.lit(most), F.greatest(F.lit(0.0), seconds)))


def qa_form(c: Column) -> Column:
    """NFKC, case folded, words joined by single blanks."""
    low = F.regexp_replace(F.regexp_replace(F.lower(unicode_form(c, "NFKC")), "ß", "ss"), "ς", "σ")
    return strip(F.regexp_replace(low, r"[^\p{L}\p{M}\p{N}_]+", " "))


def archive_prefix(url: Column) -> Column:
    """``host/first-segment/`` of a URL."""
    return F.regexp_extract(normalize_fetch_url(url), r"^https?://([^/?]+/(?:[^/?]+/)?)", 1)


def sniff_type(payload: Column, header: Column) -> Column:
    """Content type: magic bytes beat the header."""
    magic = F.hex(F.substring(payload, 1, 5))
    return F.when(magic == "255044462D", "application/pdf").when(F.lower(F.substring(payload, 1, 256).cast("string")).rlike(r"<!doctype html|<html"), "text/html").otherwise(F.lower(F.split(header, ";")[0]))
