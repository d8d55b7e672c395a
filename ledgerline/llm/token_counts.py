"""Token counts by heap-and-linked-list byte-pair merging.

A text is pre-tokenised, each pre-token becomes a linked list of byte symbols, and a heap of the
adjacent pairs' merge ranks is popped lowest first. Every merge shortens the list by one, so the
count is *initial symbols - merges*; no identifier is ever looked up.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import FORGET

# Fixed value: the pre-token pattern of byte-level BPE vocabularies.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_WORDS = 250_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, spare = {b: chr(b) for b in printable}, 0x100
    for b in range(256):
        if b not in table:
            table[b], spare = chr(spare), spare + 1
    return [table[b] for b in range(256)]


def merges_needed(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges byte-pair encoding applies to the symbols: always the lowest-rank pair, leftmost first."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    heapq.heapify(heap)
    symbols, done = list(symbols), 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        # An entry is stale when its left symbol is gone or either symbol has grown since.
        if symbols[i] is None or j >= n or ranks.get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        done += 1
        for left in (before[i], i):
            if left >= 0 and after[left] < n:
                r = ranks.get((symbols[left], symbols[after[left]]))
                if r is not None:
                    heapq.heappush(heap, (r, left))
    return done


class WordCounts(dict):
    """Pre-token -> number of tokens, filled on demand in two generations of ``CACHE_WORDS`` entries."""

    def __init__(self, ranks: dict[tuple[str, str], int]):
        self.ranks, self.symbol, self.older = ranks, byte_symbols(), {}

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        n = self.older.get(word)
        if n is None:
            symbols = [self.symbol[b] for b in word.encode("utf-8", "surrogatepass")]
            n = len(symbols) - merges_needed(symbols, self.ranks)
        self[word] = n
        return n


class TokenCounter:
    """Counts the tokens of texts by a tokenizers JSON file with byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"])
        self.words = WordCounts({p: i for i, p in enumerate(pairs)})
        added = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pre_token = regex.compile(PRE_TOKEN)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.added.split(text) if self.added else [text]
        words, find = self.words, self.pre_token.findall
        return len(parts) - 1 + sum(sum(map(words.__getitem__, find(p))) for p in parts)


@lru_cache(maxsize=4)
def counter(path: str) -> TokenCounter:
    """One counter per Python worker and vocabulary."""
    return TokenCounter(path)


FORGET.append(counter.cache_clear)


def with_token_counts(df: DataFrame, path: str, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """Add ``out_col``: the number of tokens of each whole text, as the tokenizers library counts them.

    ``path`` names the vocabulary (.json) on every executor. Special strings inside a text are one
    token each, as the library's default has it; no begin or end tokens are added. Null and empty
    texts count 0. Row-wise, so ties, repeated rows and other columns do not matter; an existing
    column ``out_col`` is replaced. Long texts cost O(n log n) per pre-token.
    """

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(path)
        for texts in batches:
            yield pd.Series([c.count(t) for t in texts], dtype="int64")

    return df.withColumn(out_col, count(F.col(text_col)))
