"""Text from payloads: HTML to Markdown-like blocks, the status of a fetch, archive records."""

from __future__ import annotations

import gzip
import json
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from lakeloom.functions import columns as C
from lakeloom.session import ship

# Elements and class or id words that hold page furniture.
NOISE_TAGS = frozenset("script style noscript nav footer aside form button svg canvas iframe template".split())
NOISE_WORDS = frozenset(
    "advert advertisement breadcrumb comment comments copyright footer menu nav newsletter outbrain pager pagination recommend recommended related share sharing sidebar social taboola".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset("p blockquote pre li h1 h2 h3 h4 h5 h6 div section article main td th tr table ul ol dt dd figcaption".split())
EXTRACT = StructType([StructField("title", StringType()), StructField("text", StringType()), StructField("link_density", DoubleType()), StructField("pages", IntegerType())])
JS_MARKS = ("__next_data__", 'id="__next"', 'id="root"', 'id="app"', "enable javascript", "requires javascript")


class _Blocks(HTMLParser):
    """Collects blocks of text outside noise, table rows, the title, and characters within links."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool]] = []
        self.noise = 0
        self.blocks: list[str] = []
        self.now: list[str] = []
        self.title: list[str] = []
        self.headline = ""
        self.rows: list[list[str]] | None = None
        self.linked = self.all = 0

    def _flush(self, form: str = "{}") -> None:
        text = " ".join("".join(self.now).split())
        self.now = []
        if text and (not self.blocks or self.blocks[-1] != form.format(text)):
            self.blocks.append(form.format(text))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _VOID:
            self.now.append(" " if tag != "br" else "\n")
            return
        a = dict(attrs)
        words = set(re.split(r"[^a-z0-9]+", f"{a.get('class') or ''} {a.get('id') or ''}".lower()))
        noisy = tag in NOISE_TAGS or bool(words & NOISE_WORDS)
        self.stack.append((tag, noisy))
        self.noise += noisy
        if tag in _BLOCKS and self.rows is None:
            self._flush()
        if tag == "table" and not self.noise:
            self.rows = []
        elif tag == "tr" and self.rows is not None:
            self.rows.append([])

    def handle_endtag(self, tag: str) -> None:
        if tag not in {t for t, _ in self.stack}:
            return
        while self.stack:
            t, noisy = self.stack.pop()
            self.noise -= noisy
            if t == tag:
                break
        if self.rows is not None:
            if tag in ("td", "th") and self.rows:
                self.rows[-1].append(" ".join("".join(self.now).split()).replace("|", "\\|"))
                self.now = []
            elif tag == "table":
                width = max(map(len, self.rows), default=0)
                for i, r in enumerate(r for r in self.rows if r):
                    self.blocks.append("| " + " | ".join(r + [""] * (width - len(r))) + " |")
                    if not i:
                        self.blocks.append("|" + " --- |" * width)
                self.rows, self.now = None, []
        elif re.fullmatch(r"h[1-6]", tag):
            if tag == "h1" and not self.headline:
                self.headline = " ".join("".join(self.now).split())
            self._flush("#" * int(tag[1]) + " {}")
        elif tag == "li":
            self._flush("- {}")
        elif tag in _BLOCKS:
            self._flush()

    def handle_data(self, data: str) -> None:
        if any(t == "title" for t, _ in self.stack):
            self.title.append(data)
        elif not self.noise:
            self.now.append(data)
            n = len("".join(data.split()))
            self.all += n
            if any(t == "a" for t, _ in self.stack):
                self.linked += n


def extract_html(payload: bytes | str | None) -> tuple[str | None, str | None, float]:
    """``(title, text, link density)``; the title is the main heading's, else the page's."""
    if payload is None:
        return None, None, 0.0
    p = _Blocks()
    p.feed(payload.decode("utf-8", "replace") if isinstance(payload, (bytes, bytearray)) else payload)
    p.close()
    p._flush()
    return p.headline or " ".join("".join(p.title).split()) or None, "\n\n".join(p.blocks) or None, p.linked / p.all if p.all else 0.0


@dataclass(frozen=True)
class Site:
    """Where a host keeps its article: class or id names of the body, the lead and what to drop."""

    hosts: tuple[str, ...]
    body: tuple[str, ...]
    lead: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    #: class or id names of a question's labels, put before the body
    labels: tuple[str, ...] = ()
    least_block: int = 20
    #: below so many characters the general extraction stands in
    least_text: int = 200


# Hosts and the names in their pages.
SITES: list[Site] = [
    Site(("baoquangtri.vn",), ("td-post-content", "content"), least_block=21),
    Site(("baothanhhoa.vn",), ("dcontent", "article__body"), ("article__sapo", "sapo"), ("box-content", "content-list"), least_block=11),
    Site(("qdnd.vn", "www.qdnd.vn"), ("articleContent", "post-content", "detail-post"), (), ("relate-news", "detail-related", "author-info", "float-image", "post-tool", "comment-box"), least_block=16, least_text=100),
    Site(("thanhnien.vn",), ("detail-cmain", "detail-content"), ("detail-sapo",), ("box-detail-related", "detail__related", "detail__comment", "detail-social"), least_block=21),
    Site(("ask.39.net", "wapask.39.net"), ("sele_txt", "zwAll", "ans_cont"), labels=("txt_label",), least_block=20, least_text=100),
]


class _SiteBlocks(HTMLParser):
    """Text blocks of the named parts of a page, each once, and its linked data."""

    def __init__(self, site: Site) -> None:
        super().__init__(convert_charrefs=True)
        self.site, self.stack = site, []
        self.parts: dict[str, list[str]] = {"body": [], "lead": [], "labels": []}
        self.data: list[str] = []
        self.now: list[str] = []
        self.headline: list[str] = []
        self.shown = ""
        self.seen: set[str] = set()

    def _where(self) -> str | None:
        names = [w for _, w, _ in self.stack if w]
        return None if "drop" in names or any(t in NOISE_TAGS for t, _, _ in self.stack) else names[-1] if names else None

    def _flush(self) -> None:
        text, where = " ".join("".join(self.now).split()), self._where()
        self.now = []
        if where and text not in self.seen and len(text) >= (1 if where == "labels" else self.site.least_block):
            self.seen.add(text)
            self.parts[where].append(text)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _VOID:
            a = dict(attrs)
            if tag == "meta" and a.get("property") == "og:title":
                self.shown = " ".join((a.get("content") or "").split())
            self.now.append(" ")
            return
        if tag in _BLOCKS or tag == "a" and self._where() == "labels":
            self._flush()
        a = dict(attrs)
        names = {*(a.get("class") or "").split(), a.get("id") or ""}
        s = self.site
        where = next((n for n, of in (("drop", s.drop), ("labels", s.labels), ("lead", s.lead), ("body", s.body)) if names & set(of)), None)
        self.stack.append((tag, where, a.get("type") == "application/ld+json"))

    def handle_endtag(self, tag: str) -> None:
        if tag not in {t for t, _, _ in self.stack}:
            return
        if tag in _BLOCKS or self._where() == "labels":
            self._flush()
        while self.stack and self.stack.pop()[0] != tag:
            pass

    def handle_data(self, data: str) -> None:
        if any(linked for _, _, linked in self.stack):
            self.data.append(data)
        elif any(t == "h1" for t, _, _ in self.stack):
            self.headline.append(data)
        else:
            self.now.append(data)


def _linked_texts(scripts: list[str]) -> list[str]:
    """Descriptions and texts in a page's linked data, in order."""
    out: list[str] = []

    def walk(x) -> None:
        if isinstance(x, dict):
            out.extend(v.strip() for k, v in x.items() if k in ("description", "text") and isinstance(v, str))
            for v in x.values():
                walk(v)
        elif isinstance(x, list):
            for v in x:
                walk(v)

    for s in scripts:
        try:
            walk(json.loads(s))
        except ValueError:
            continue
    return out


def extract_site(payload: bytes | str | None, host: str | None) -> tuple[str | None, str | None, float]:
    """As :func:`extract_html`, by the host's own table where it has one and yields enough text."""
    title, text, density = extract_html(payload)
    site = next((s for s in SITES if (host or "").lower() in s.hosts), None)
    if site is None or payload is None:
        return title, text, density
    p = _SiteBlocks(site)
    p.feed(payload.decode("utf-8", "replace") if isinstance(payload, (bytes, bytearray)) else payload)
    p.close()
    p._flush()
    blocks = p.parts["lead"] + p.parts["body"]
    if sum(map(len, blocks)) < site.least_text:
        blocks += [x for x in _linked_texts(p.data) if len(x) >= site.least_block and x not in p.seen]
    if p.parts["labels"]:
        blocks.insert(0, ", ".join(p.parts["labels"]))
    made = "\n\n".join(blocks)
    return (p.shown or " ".join("".join(p.headline).split()) or title, made, 0.0) if len(made) >= site.least_text else (title, text, density)


def extracted_by_site(df: DataFrame, payload: str = "content", host: str = "domain") -> DataFrame:
    """``df`` with ``page`` by the table of each row's host."""
    ship(df.sparkSession)

    @F.pandas_udf(EXTRACT)
    def run(payloads: pd.Series, hosts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([extract_site(p, h) for p, h in zip(payloads, hosts)], columns=["title", "text", "link_density"]).assign(pages=pd.Series(dtype="Int32"))

    return df.withColumn("page", run(F.col(payload), F.col(host)))


_PDF_STREAM = re.compile(rb"<<(?:[^<>]|<<[^<>]*>>|<[^<>]*>)*>>\s*stream\r?\n(.*?)endstream", re.S)
_PDF_PAGE = re.compile(rb"/Type\s*/Page(?![a-zA-Z])")
_PDF_TOKEN = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|-?\d*\.?\d+|\[|\]|[A-Za-z'\"*]+", re.S)
_PDF_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"", b"f": b"", b"\n": b""}


def _pdf_string(token: bytes) -> str:
    if token[:1] == b"<":
        raw = bytes.fromhex(re.sub(rb"\s", b"", token[1:-1]).decode() + ("0" if len(re.sub(rb"\s", b"", token[1:-1])) % 2 else ""))
    else:
        raw = re.sub(rb"\\([0-7]{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else _PDF_ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S)
    return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("latin-1")


def extract_pdf(payload: bytes) -> tuple[str, int]:
    """``(text, pages)`` of a PDF: strings of its content streams in reading order, from the top and the left.

    Fonts with an encoding of their own give no useful characters, so that such a file needs OCR or a
    fuller reader.
    """
    out = []
    for m in _PDF_STREAM.finditer(payload):
        try:
            data = zlib.decompress(m[1])
        except zlib.error:
            data = m[1]
        if b"BT" not in data:
            continue
        blocks: list[tuple[float, float, str]] = []
        x = y = 0.0
        numbers: list[float] = []
        strings: list[str] = []
        for t in _PDF_TOKEN.findall(data):
            if t[:1] in b"(<" and len(t) > 1:
                strings.append(_pdf_string(t))
            elif t[:1] in b"-.0123456789":
                numbers.append(float(t))
            elif t == b"BT":
                x = y = 0.0
            elif t in (b"Td", b"TD") and len(numbers) >= 2:
                x, y = x + numbers[-2], y + numbers[-1]
            elif t == b"Tm" and len(numbers) >= 6:
                x, y = numbers[-2], numbers[-1]
            elif t in (b"Tj", b"TJ", b"'", b'"'):
                text = "".join(strings).strip()
                if text:
                    blocks.append((-y, x, text))
            if t[:1].isalpha() or t in (b"'", b'"'):
                numbers, strings = [], []
        lines: dict[float, list[str]] = {}
        for top, _, text in sorted(blocks):
            lines.setdefault(top, []).append(text)
        out.append("\n".join(" ".join(v) for v in lines.values()))
    return "\n\n".join(p for p in out if p), max(1, len(_PDF_PAGE.findall(payload)))


def extracted(df: DataFrame, payload: str = "content", content_type: str = "content_type", pdf: Callable[[bytes], tuple[str, int]] | None = None) -> DataFrame:
    """``df`` with ``page``: title, text, link density and, of PDFs, the number of pages."""
    ship(df.sparkSession)
    read_pdf = pdf or extract_pdf

    @F.pandas_udf(EXTRACT)
    def run(payloads: pd.Series, types: pd.Series) -> pd.DataFrame:
        rows = []
        for p, t in zip(payloads, types):
            kind = t or ""
            if p is not None and kind == "application/pdf" and not isinstance(p, str):
                try:
                    rows.append((None, *read_pdf(bytes(p))))
                except Exception:
                    rows.append((None, "", 1))
                rows[-1] = (rows[-1][0], rows[-1][1], 0.0, rows[-1][2])
            elif p is not None and kind.startswith("text/plain"):
                rows.append((None, bytes(p).decode("utf-8", "replace") if not isinstance(p, str) else p, 0.0, None))
            else:
                rows.append((*extract_html(p), None))
        return pd.DataFrame(rows, columns=["title", "text", "link_density", "pages"]).astype({"pages": "Int32"})

    return df.withColumn("page", run(F.col(payload), F.col(content_type)))


def looks_like_script_shell(html: Column, text: Column) -> Column:
    low = F.lower(F.substring(html.cast("string"), 1, 200_000))
    marks = F.lit(False)
    for m in JS_MARKS:
        marks = marks | F.contains(low, F.lit(m))
    return (F.length(C.strip(F.coalesce(text, F.lit("")))) < 100) & marks


# Host and path of a page that asks visitors to prove themselves.
CHALLENGE = ("image.39.net", "/verify.html")


def is_challenge(url: Column) -> Column:
    """The URL is that of a check of the visitor."""
    path = F.lower(F.regexp_replace(F.regexp_extract(url, r"^(?i)https?://[^/?#]*([^?#]*)", 1), "/+$", ""))
    return F.coalesce((C.domain_from_url(url) == CHALLENGE[0]) & (path == CHALLENGE[1]), F.lit(False))


def route(df: DataFrame, min_chars: int = 100, max_bytes: int = 5_000_000, max_pdf_bytes: int = 25_000_000, url: str = "final_url", pdf: Callable[[bytes], tuple[str, int]] | None = None) -> DataFrame:
    """``df`` with ``page`` and ``status`` of a fetched payload ``(content, content_type)``.

    Where ``df`` has the column ``url``, pages of a visitor check are NEEDS_JS whatever they hold. ``pdf`` reads
    a PDF's text and number of pages; the built-in reader knows PDFs whose text is stored as plain strings.
    """
    kind = C.sniff_type(F.col("content"), F.col("content_type"))
    pages = extracted(df.withColumn("content_type", kind), pdf=pdf)
    size, text = F.length("content"), F.col("page.text")
    useful = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s", ""))
    status = (
        F.when(F.col("content").isNull(), "FAILED")
        .when(F.col("content_type") == "application/pdf", F.when(size > max_pdf_bytes, "TOO_LARGE").when(needs_ocr(useful, F.coalesce("page.pages", F.lit(1))), "NEEDS_OCR").otherwise("SUCCESS"))
        .when(is_challenge(F.col(url)) if url in df.columns else F.lit(False), "NEEDS_JS")
        .when(size > max_bytes, "TOO_LARGE")
        .when(F.col("content_type").isNotNull() & ~F.col("content_type").rlike("^text/|html|xml"), "UNSUPPORTED")
        .when(F.length(F.coalesce(C.strip(text), F.lit(""))) >= min_chars, "SUCCESS")
        .when(looks_like_script_shell(F.col("content"), text), "NEEDS_JS")
        .otherwise("EMPTY_CONTENT")
    )
    return pages.withColumn("status", status)


def needs_ocr(useful_chars: Column, pages: Column) -> Column:
    """A PDF whose text is under 100 characters or 50 a page."""
    return useful_chars < F.greatest(F.lit(100), 50 * pages)


def _inflated(body: bytes) -> bytes:
    """A deflated body, with or without the zlib header."""
    try:
        return zlib.decompress(body)
    except zlib.error:
        return zlib.decompress(body, -zlib.MAX_WBITS)


def decode_record(record: bytes | None) -> bytes | None:
    """The body of a gzip-compressed archive record, unchunked and decompressed; None where it is broken."""
    if record is None:
        return None
    try:
        raw = gzip.decompress(record)
        _, _, http = raw.partition(b"\r\n\r\n")
        head, _, body = http.partition(b"\r\n\r\n")
        fields = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
        if fields.get(b"transfer-encoding") == b"chunked":
            out, at = b"", 0
            while True:
                end = body.index(b"\r\n", at)
                n = int(body[at:end].split(b";")[0], 16)
                if not n:
                    break
                out += body[end + 2 : end + 2 + n]
                at = end + 4 + n
            body = out
        encoding = fields.get(b"content-encoding", b"")
        return gzip.decompress(body) if encoding == b"gzip" else _inflated(body) if encoding == b"deflate" else body
    except (OSError, ValueError, EOFError, zlib.error):
        return None


def decoded(df: DataFrame, column: str = "record", to: str = "content") -> DataFrame:
    ship(df.sparkSession)

    @F.pandas_udf("binary")
    def run(records: pd.Series) -> pd.Series:
        return records.map(lambda x: decode_record(None if x is None else bytes(x)))

    return df.withColumn(to, run(F.col(column)))
