"""Problem 8: encoding a corpus with a public byte-level BPE tokenizer.

Method: the merges are compiled into one deterministic automaton by successive merge gadgets.
It starts as one state that loops on every byte. The gadget of a merge ``u v`` turns each
path ``p -u-> q -v-> r`` into ``p -uv-> r`` and sends ``u`` from ``p`` to a copy of ``q``
without ``v``; so in the end the automaton accepts exactly the correct token sequences. Every
prefix of a word has one correct sequence, so a word is encoded by one pass over its bytes
with table look-ups only, however long it is; ids are decoded by emitting the tokens' bytes.

States are stored as differences: a copy inherits all transitions of its original but those
listed in its own row (a missing one is listed as ``DEAD``).

Defined results: a null and an empty text both give the empty list; strings that look like
special tokens are ordinary text; the text is taken as stored.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from pathlib import Path

import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType

from lakeloom.session import ship

#: Where the public vocabularies are on every machine; a parameter of every function here.
TOKENIZERS = "/opt/tokenizers"
# Fixed value: the pattern that cuts a text into words before the merges.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEAD = -1
#: Words whose ids a task remembers, a bound on its memory.
REMEMBERED = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """``(u, v, uv)`` in the order of ranks: each token's last merge, found with the merges before it."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) == 1:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            at = min(range(len(parts) - 1), key=lambda i: r if (r := ranks.get(parts[i] + parts[i + 1], rank)) < rank else 1 << 30)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        out.append((ranks[parts[0]], ranks[parts[1]], rank))
    return out


class Automaton:
    """The automaton and the trie of the tokens' bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.parent: list[int] = [DEAD]
        self.own: list[dict[int, int]] = [{r: 0 for t, r in ranks.items() if len(t) == 1}]
        #: symbol -> states whose own row lists it
        rows: dict[int, list[int]] = {r: [0] for r in self.own[0]}
        for u, v, uv in merges_of(ranks):
            self._gadget(u, v, uv, rows)
        self.bytes = {r: t for t, r in ranks.items()}
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[int] = [DEAD]
        for t, r in ranks.items():
            at = 0
            for b in t:
                if b not in self.trie[at]:
                    self.trie[at][b] = len(self.trie)
                    self.trie.append({})
                    self.token.append(DEAD)
                at = self.trie[at][b]
            self.token[at] = r
        self.memo: dict[tuple[int, int], int] = {}

    def _gadget(self, u: int, v: int, uv: int, rows: dict[int, list[int]]) -> None:
        copies: dict[int, int] = {}
        for p in list(rows[u]):
            q = self.own[p][u]
            r = self.step(q, v) if q != DEAD else DEAD
            if r != DEAD:
                if q not in copies:
                    copies[q] = len(self.own)
                    self.parent.append(q)
                    self.own.append({v: DEAD})
                    rows[v].append(copies[q])
                    if u == v:
                        self.own[-1][uv] = DEAD
                        rows.setdefault(uv, []).append(copies[q])
                self.own[p][u] = copies[q]
            if r != DEAD or p:
                self.own[p][uv] = r
                rows.setdefault(uv, []).append(p)
        rows.setdefault(uv, [])

    def step(self, state: int, symbol: int) -> int:
        """The next state, or ``DEAD``."""
        while state != DEAD:
            to = self.own[state].get(symbol)
            if to is not None:
                return to
            state = self.parent[state]
        return DEAD

    def encode_word(self, word: bytes) -> list[int]:
        n = len(word)
        state, came, last = [DEAD] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        state[0] = 0
        trie, token, memo, step = self.trie, self.token, self.memo, self.step
        for i in range(n):
            s = state[i]
            if s == DEAD:
                continue
            at = 0
            for j in range(i, n):
                at = trie[at].get(word[j], DEAD)
                if at == DEAD:
                    break
                t = token[at]
                if t != DEAD:
                    to = memo.get((s, t))
                    if to is None:
                        to = memo[s, t] = step(s, t)
                        if len(memo) > 2_000_000:
                            memo.clear()
                    if to != DEAD:
                        state[j + 1], came[j + 1], last[j + 1] = to, i, t
        out, at = [], n
        while at:
            out.append(last[at])
            at = came[at]
        return out[::-1]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(self.bytes[i] for i in ids)


class Encoder:
    """Text to ids and back."""

    def __init__(self, ranks: dict[bytes, int], words: str = WORDS):
        self.automaton = Automaton(ranks)
        self.words = regex.compile(words)
        self.known: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        known = self.known
        for word in self.words.findall(text or ""):
            ids = known.get(word)
            if ids is None:
                ids = self.automaton.encode_word(word.encode())
                if len(word) <= 32:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return self.automaton.decode(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Encoder:
    """Compiled once a Python worker."""
    return Encoder(read_ranks(f"{folder}/{name}.tiktoken"))


def with_ids(df: DataFrame, column: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS, to: str = "ids") -> DataFrame:
    """``df`` with ``to``: the token ids of ``column``; a column of that name is replaced."""
    ship(df.sparkSession)

    @F.pandas_udf(ArrayType(IntegerType()))
    def ids(texts: pd.Series) -> pd.Series:
        e = encoder(name, folder)
        return pd.Series([e.encode(t) for t in texts], dtype=object)

    return df.withColumn(to, ids(F.col(column)))


def with_token_counts(df: DataFrame, column: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS, to: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of ``column``."""
    ship(df.sparkSession)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        e = encoder(name, folder)
        return pd.Series([len(e.encode(t)) for t in texts])

    return df.withColumn(to, count(F.col(column)))
