"""Benchmark decontamination as a prefix-filtered set join.

Benchmark items are cut into windows of ``window`` words (shorter items are one window). A window is a
set of word shingles that a document must contain whole, at consistent places, so one *necessary*
shingle per window suffices to find candidates: the rarest in the corpus, by document counts over all
texts. Candidates pass length and positional bounds and are then verified shingle by shingle.

The benchmark is taken in blocks of bounded size; each block's index is broadcast and every document
meets it where it is, so no document moves, however often its passages repeat.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, tidy

WINDOW = 13
SHINGLE = 3
BLOCK_BYTES = 2_000_000
BLOCKS_AT_ONCE = 8
SLICE_CHARS = 500_000
#: Words are runs of digits, lower-cased letters A-Z and non-ASCII bytes.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


@dataclass
class Index:
    """One block of items. Shingles are numbered; those of width k have the sorted keys ``keys[k]``."""

    vocabulary: dict[bytes, int]
    keys: dict[int, np.ndarray]
    first_gram: dict[int, int]
    item: np.ndarray          # by window: place in item_ids
    length: np.ndarray        # by window: words
    grams: np.ndarray         # by window: its shingles in order, padded with -2
    item_ids: list[str]
    rarest: np.ndarray | None = None   # by window: which of its shingles is the necessary one
    windows_of: np.ndarray | None = None  # windows ordered by necessary shingle
    window_starts: np.ndarray | None = None  # by shingle: its part of windows_of

    @property
    def n_grams(self) -> int:
        return sum(map(len, self.keys.values()))

    def text_grams(self, flat: list[bytes], ends: np.ndarray) -> tuple[dict[int, np.ndarray], np.ndarray]:
        """By width k: the shingle starting at each word of the concatenated texts (-1: none of the index's)."""
        ids = np.fromiter(map(self.vocabulary.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
        out = {}
        for k, keys in self.keys.items():
            found = np.full(len(ids), -1, dtype=np.int32)
            n = len(ids) - k + 1
            if n > 0 and len(keys):
                ok = np.arange(n) + k <= ends[:n]
                key = np.zeros(n, dtype=np.int64)
                for j in range(k):
                    ok &= ids[j:n + j] >= 0
                    key = key * len(self.vocabulary) + ids[j:n + j]
                where = np.flatnonzero(ok)
                at = np.minimum(np.searchsorted(keys, key[where]), len(keys) - 1)
                same = keys[at] == key[where]
                found[where[same]] = at[same] + self.first_gram[k]
            out[k] = found
        return out


def build_index(items: list[tuple[str, str]], window: int) -> Index:
    vocabulary: dict[bytes, int] = {}
    item_ids = sorted({i for i, _ in items}, key=lambda i: (i is not None, i or ""))
    place = {i: n for n, i in enumerate(item_ids)}
    windows = []  # (item, width k, word ids)
    for item_id, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)]
        if ids:
            size = min(window, len(ids))
            windows += [(place[item_id], min(SHINGLE, len(ids)), ids[s:s + size]) for s in range(len(ids) - size + 1)]
    base = max(len(vocabulary), 1)

    def key(part: list[int]) -> int:
        value = 0
        for i in part:
            value = value * base + i
        return value

    by_width = defaultdict(list)
    for _, k, ids in windows:
        by_width[k] += [key(ids[j:j + k]) for j in range(len(ids) - k + 1)]
    keys, first, total = {}, {}, 0
    for k in sorted(by_width):
        keys[k] = np.unique(np.array(by_width[k], dtype=np.int64))
        first[k], total = total, total + len(keys[k])
    most = max((len(ids) - k + 1 for _, k, ids in windows), default=1)
    grams = np.full((len(windows), most), -2, dtype=np.int32)
    for n, (_, k, ids) in enumerate(windows):
        part = np.array([key(ids[j:j + k]) for j in range(len(ids) - k + 1)], dtype=np.int64)
        grams[n, :len(part)] = np.searchsorted(keys[k], part) + first[k]
    return Index(vocabulary, keys, first, np.array([w[0] for w in windows], np.int64),
                 np.array([len(w[2]) for w in windows], np.int64), grams, item_ids)


def order_by_rarity(index: Index, frequency: np.ndarray) -> Index:
    """Choose each window's necessary shingle, the one in the fewest documents; windows with an absent one go."""
    padded = np.append(frequency.astype(np.int64), np.iinfo(np.int64).max)
    counts = padded[np.where(index.grams < 0, len(frequency), index.grams)]
    rarest = counts.argmin(axis=1) if len(counts) else np.zeros(0, np.int64)
    keep = np.flatnonzero(counts[np.arange(len(counts)), rarest] > 0) if len(counts) else rarest
    index.item, index.length, index.grams, index.rarest = (index.item[keep], index.length[keep], index.grams[keep], rarest[keep])
    necessary = index.grams[np.arange(len(keep)), index.rarest]
    index.windows_of = np.argsort(necessary, kind="stable")
    index.window_starts = np.searchsorted(necessary[index.windows_of], np.arange(index.n_grams + 1))
    return index


def _text_slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if size and size + n > SLICE_CHARS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def _flat_words(texts: list[str | None]):
    words = [words_of(t) for t in texts]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    return list(chain.from_iterable(words)), counts, np.repeat(np.cumsum(counts), counts)


def _document_counts(shared):
    """mapInArrow function: (_text) -> (gram, count), one row per shingle and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        total = np.zeros(index.n_grams, dtype=np.int64)
        for b in batches:
            texts = b.column("_text").to_pylist()
            for lo, hi in _text_slices(texts):
                flat, counts, ends = _flat_words(texts[lo:hi])
                doc = np.repeat(np.arange(hi - lo), counts)
                for found in index.text_grams(flat, ends).values():
                    at = np.flatnonzero(found >= 0)
                    pairs = np.unique(doc[at] * index.n_grams + found[at])
                    total += np.bincount(pairs % max(index.n_grams, 1), minlength=index.n_grams)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["gram", "count"])

    return run


def find_windows(index: Index, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of windows in the texts: word counts by text; text, first word and window of each occurrence."""
    flat, counts, ends = _flat_words(texts)
    doc = np.repeat(np.arange(len(texts)), counts)
    begin = np.cumsum(counts) - counts
    out = [(np.zeros(0, np.int64),) * 2]
    for found in index.text_grams(flat, ends).values():
        at = np.flatnonzero(found >= 0)
        lo, hi = index.window_starts[found[at]], index.window_starts[found[at] + 1]
        n = hi - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        if not len(at):
            continue
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        window = index.windows_of[np.repeat(lo, n) + step]
        word = np.repeat(at, n)
        start = word - index.rarest[window]
        fits = (start >= begin[doc[word]]) & (start + index.length[window] <= ends[word])  # positional and length bounds
        start, window = start[fits], window[fits]
        padded = np.concatenate([found, np.full(index.grams.shape[1], -3, np.int32)])
        same = np.ones(len(start), dtype=bool)
        for j in range(index.grams.shape[1]):
            gram = index.grams[window, j]
            same &= (gram == -2) | (padded[start + j] == gram)
        out.append((start[same], window[same]))
    start, window = map(np.concatenate, zip(*out))
    d = doc[start] if len(start) else start
    return counts, d, start - begin[d], window


def _join_block(shared, first: bool):
    """mapInArrow function: adds one block's occurrences to _n_words, _spans and _items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for whole in batches:
            texts = whole.column("_text").to_pylist()
            for lo, hi in _text_slices(texts):
                b = whole.slice(lo, hi - lo)
                counts, doc, start, window = find_windows(index, texts[lo:hi])
                spans = [[] for _ in counts] if first else b.column("_spans").to_pylist()
                items = [[] for _ in counts] if first else b.column("_items").to_pylist()
                new = defaultdict(lambda: ([], set()))
                for d, s, w in zip(doc.tolist(), start.tolist(), window.tolist()):
                    new[d][0].append((s, s + int(index.length[w])))
                    new[d][1].update(i for i in (index.item_ids[index.item[w]],) if i is not None)
                for d, (places, names) in new.items():
                    old = spans[d]
                    spans[d] = list(chain.from_iterable(_union([*zip(old[::2], old[1::2]), *places])))
                    items[d] = sorted({*items[d], *names})
                yield pa.RecordBatch.from_arrays(
                    [b.column("_row"), b.column("_text"), pa.array(counts), pa.array(spans, pa.list_(pa.int32())),
                     pa.array(items, pa.list_(pa.string()))], names=["_row", "_text", "_n_words", "_spans", "_items"])

    return run


def _union(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` plus ``n_words``, ``hit_spans``, ``n_hit`` and ``items``.

    ``hit_spans`` are flat pairs of first and last-plus-one word of the document's words that lie in an
    occurrence of an item window; ``n_hit`` counts these words; ``items`` are the ids (as strings, sorted
    as strings by code point) of the items with such windows. Null and empty texts have no words. Items without words
    are left out; the words of an item with a null id are hit, but it has no id to list; repeated item rows count once. Repeated documents are rows of their own,
    and other columns are carried along whatever their names (these four are replaced if they exist).
    Documents are read whole and never leave their partition.
    """
    spark = docs.sparkSession
    added = ("n_words", "hit_spans", "n_hit", "items")
    kept = [c for c in docs.columns if c not in added]
    flat = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"), F.col(f"`{text_col}`").alias("_text"))
    texts, row_type = flat.select("_text"), flat.schema["_row"].dataType.simpleString()
    benchmark = (items.select(F.col(f"`{item_id_col}`").cast("string").alias("id"), F.col(f"`{item_text_col}`").alias("text"))
                 .filter("text IS NOT NULL").distinct())
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    for block in range(n_blocks):
        own = benchmark.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == block).collect()  # about BLOCK_BYTES
        index = build_index(sorted(((r["id"], r["text"]) for r in own), key=lambda r: (r[0] is not None, r)), window)
        unordered = spark.sparkContext.broadcast(index)
        frequency = np.zeros(index.n_grams, dtype=np.int64)
        for r in (texts.mapInArrow(tidy(_document_counts(unordered)), "gram int, count long")
                  .groupBy("gram").agg(F.sum("count").alias("count")).collect() if index.n_grams else ()):
            frequency[r["gram"]] = r["count"]
        index = spark.sparkContext.broadcast(order_by_rarity(index, frequency))
        flat = flat.mapInArrow(tidy(_join_block(index, block == 0)),
                               f"_row {row_type}, _text string, _n_words long, _spans array<int>, _items array<string>")
        if block % BLOCKS_AT_ONCE == BLOCKS_AT_ONCE - 1 and block < n_blocks - 1:
            flat = cut(flat)
    n_hit = F.aggregate(F.sequence(F.lit(0), F.size("_spans") - 2, F.lit(2)), F.lit(0).cast("long"),
                        lambda n, i: n + F.element_at("_spans", i + 2) - F.element_at("_spans", i + 1))
    return flat.select("_row.*", F.col("_n_words").alias("n_words"), F.col("_spans").alias("hit_spans"),
                       F.when(F.size("_spans") == 0, F.lit(0).cast("long")).otherwise(n_hit).alias("n_hit"),
                       F.col("_items").alias("items"))


def is_contaminated(share: int = 20):
    """At least one word, and at least one word in ``share``, lies in an occurrence of a window."""
    return (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))
