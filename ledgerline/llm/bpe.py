"""Byte-level BPE encoding and decoding with overlapping chunks.

Texts longer than ``chunk_chars`` are cut into chunks that overlap their successor by ``overlap``
characters, and all chunks are pre-tokenised in parallel. The pre-token pattern only looks forward,
so once a chunk's boundaries agree with a trusted boundary inside the overlap the two tokenisations
stay equal: that common boundary is the stitch. Chunk i then owns the text between its stitch and the
next one, and these pieces are encoded in parallel (looking ahead past their end, as the pattern does). Decoding concatenates the tokens' raw bytes.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import FORGET, tidy

CHUNK_CHARS = 32_768
OVERLAP = 1_024
#: A boundary this many characters before the end of a chunk does not depend on what follows the chunk:
#: the longest look-ahead of the pattern is the three characters of 're, 've and 'll.
SAFE_TAIL = 3
LONG_PIECE = 64
MERGE_AT_ONCE = 4_096
NO_RANK = 1 << 24  # more than any rank; times LONG_PIECE it still is an int32
#: A pair in the merge is rank * LONG_PIECE + place, so that the least is the lowest rank, leftmost; NO_PAIR stands behind all.
NO_PAIR = NO_RANK * LONG_PIECE


class PairRanks:
    """(token id, token id) -> rank of the two as one token, an open-addressed table read for whole arrays of pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        self.base = max(ranks.values()) + 2  # id -1, no token, comes as 0
        pairs = {(left + 1) * self.base + right + 1: rank for token, rank in ranks.items() for i in range(1, len(token))
                 if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None}
        keys, values = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        bits = max(len(pairs), 1).bit_length() + 1
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NO_RANK, np.int32)
        at = self._slots(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several keys for one slot the last stays
            placed = self.keys[at] == keys
            self.ranks[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], (at[~placed] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) + 1) * self.base + right + 1
        at = self._slots(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.ranks[at], np.int32(NO_RANK))
        open_ = np.flatnonzero((there != keys) & (there >= 0))  # slots of other pairs: the next one is looked at
        at = at[open_]
        while len(open_):
            at = (at + 1) & self.mask
            there, wanted = self.keys[at], keys[open_]
            out[open_] = np.where(there == wanted, self.ranks[at], NO_RANK)
            on = (there != wanted) & (there >= 0)
            open_, at = open_[on], at[on]
        return out


def _merged_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """By a heap over linked symbols: n log n, for runs without a break."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # symbol i spans piece[i:end[i]]
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue
        alive[j], end[i] = False, stop
        if stop < n:
            before[stop] = i
        for left in (before[i], i):
            if left >= 0 and end[left] < n:
                span = piece[left:end[end[left]]]
                r = ranks.get(span)
                if r is not None:
                    heapq.heappush(heap, (r, left, left + len(span)))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class Codec:
    """A rank file (base64 token, rank per line) with its pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.tokens = pa.array(self.bytes_of, pa.large_binary())
        if len(self.bytes_of) > NO_RANK:
            raise ValueError(f"ranks must be below {NO_RANK}")
        self.of_byte = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        self.pair_ranks = PairRanks(self.ranks)
        every = np.append(self.of_byte, -1)  # 256 stands behind a word's last byte
        self.of_bytes = self.pair_ranks(np.repeat(every, 257), np.tile(every, 257))
        self.pattern = regex.compile(pattern)

    def encode(self, texts: list[str], spans: Iterable[tuple[int, int | None]]) -> pa.ListArray:
        """Ids of text[first:last] for every text and its span, both boundaries of its pre-tokens; what follows ``last`` is only looked at.

        A pre-token that comes again among these texts is merged once.
        """
        words, ends = [], [0]
        for text, (first, last) in zip(texts, spans):
            found = self.pattern.findall(text, first)
            beyond = 0 if last is None else len(text) - last
            while beyond > 0:
                beyond -= len(found.pop())
            words += found
            ends.append(len(words))
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        ids, n = self.merged(coded.dictionary.cast(pa.large_binary()).to_pylist())
        which = coded.indices.to_numpy()
        starts, sizes = (np.cumsum(n) - n)[which], n[which]
        after = np.concatenate([[0], np.cumsum(sizes)])
        values = ids[np.repeat(starts - after[:-1], sizes) + np.arange(after[-1])]
        return pa.ListArray.from_arrays(pa.array(after[ends], pa.int32()), pa.array(values, pa.int32()))

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens, one after the other, and how many each has: merge the lowest-rank adjacent pair,
        leftmost first, until none is a token. Words of about one length are merged side by side, long ones by a heap."""
        whole = np.fromiter((self.ranks.get(w, -1) for w in words), np.int64, len(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        n = np.ones(len(words), np.int64)
        which, ids = [np.flatnonzero(whole >= 0)], [whole[whole >= 0]]  # the word of each id, and the id; of a word in order
        for i in np.flatnonzero((whole < 0) & (lengths > LONG_PIECE)):
            long = _merged_long(words[i], self.ranks)
            which.append(np.full(len(long), i))
            ids.append(np.array(long, np.int64))
            n[i] = len(long)
        short = np.flatnonzero((whole < 0) & (lengths <= LONG_PIECE))
        short = short[np.argsort(lengths[short], kind="stable")]
        for lo in range(0, len(short), MERGE_AT_ONCE):
            some = short[lo:lo + MERGE_AT_ONCE]
            for cols, symbols in self._merged_short([words[i] for i in some], lengths[some]):
                left = symbols >= 0
                n[some[cols]] = left.sum(axis=1)
                which.append(np.repeat(some[cols], n[some[cols]]))
                ids.append(symbols[left])
        which, ids = np.concatenate(which), np.concatenate(ids)
        return ids[np.argsort(which, kind="stable")], n

    def _merged_short(self, words: list[bytes], lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merges of words side by side, a column each: (columns, their ids by row, -1 behind the last) as columns end."""
        width, cols = int(lengths[-1]), np.arange(len(words))
        place = np.arange(width, dtype=np.int32)[:, None]
        letters = np.full((len(words), width + 1), 256, np.int32)
        letters[:, :-1][place.T < lengths[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        letters = np.ascontiguousarray(letters.T)
        symbols = np.append(self.of_byte, np.int32(-1))[letters]  # the last row stays -1
        if (symbols[letters < 256] < 0).any():
            raise KeyError("a byte that is no token")
        pairs = self.of_bytes[letters[:-1] * 257 + letters[1:]] * LONG_PIECE + place
        while len(cols):
            least = pairs.min(axis=0)
            done = least >= NO_PAIR
            if done.any():
                yield cols[done], symbols[:, done].T
                symbols, pairs, cols, least = symbols[:, ~done], pairs[:, ~done], cols[~done], least[~done]
            rank, at = least // LONG_PIECE, least % LONG_PIECE
            behind, every = place > at, np.arange(len(cols))
            symbols[:-1] = np.where(behind, symbols[1:], symbols[:-1])  # what is behind the pair moves up by one
            pairs[:-1] = np.where(behind[:-1], pairs[1:] - 1, pairs[:-1])
            pairs[-1] = np.where(behind[-1], np.int32(NO_PAIR + width - 1), pairs[-1])
            symbols[at, every] = rank  # a token's rank is its id
            pairs[at, every] = self.pair_ranks(rank, symbols[at + 1, every]) * LONG_PIECE + at
            led = np.flatnonzero(at)
            pairs[at[led] - 1, led] = self.pair_ranks(symbols[at[led] - 1, led], rank[led]) * LONG_PIECE + at[led] - 1

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The bytes that each list of ids stands for (null stays null)."""
        raw = self.tokens.take(ids.values)
        ends = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)[ids.offsets.to_numpy()]
        back = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), raw.buffers()[2]])
        return back.cast(pa.binary()).take(pa.array(np.arange(len(ids)), mask=ids.is_null().to_numpy(zero_copy_only=False)))

    def boundaries(self, text: str) -> np.ndarray:
        """Where pre-tokens end, in characters."""
        return np.fromiter((m.end() for m in self.pattern.finditer(text)), dtype=np.int64)


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


FORGET.append(codec.cache_clear)


def slices_of(rows: list[int], budget: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Cut a batch so that one result batch holds about ``budget`` characters of input at most."""
    start = size = 0
    for i, n in enumerate(rows):
        if size and size + n > budget:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(rows):
        yield start, len(rows)


def _encoder(path: str, pattern: str, decode: bool, text: str, first: str | None = None, last: str | None = None):
    """mapInArrow function: replaces ``text`` by ``_ids``, those of [first, last) when these columns are named, and
    ``_bytes``, what the ids decode to (null unless asked for)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for whole in batches:
            lengths = pc.fill_null(pc.utf8_length(whole.column(text)), 0).to_pylist()
            for lo, hi in slices_of(lengths):
                b = whole.slice(lo, hi - lo)
                texts = [t or "" for t in b.column(text).to_pylist()]
                spans = zip(b.column(first).to_pylist(), b.column(last).to_pylist()) if first else repeat((0, None))
                ids = c.encode(texts, spans)
                back = c.decode(ids) if decode else pa.nulls(len(ids), pa.binary())
                keep = [n for n in b.schema.names if n not in (text, first, last)]
                yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), ids, back], names=[*keep, "_ids", "_bytes"])

    return run


def _cut_chunks(chunk_chars: int, overlap: int):
    """mapInArrow function: (_key, _text) -> (_key, _n, _no, _chunk), the last character count being the text's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, t in zip(b.column("_key").to_pylist(), b.column("_text").to_pylist()):
                parts = [t[i:i + chunk_chars + overlap] for i in range(0, len(t), chunk_chars)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(parts)), pa.array([len(t)] * len(parts), pa.int64()),
                     pa.array(np.arange(len(parts), dtype=np.int32)), pa.array(parts, pa.string())],
                    names=["_key", "_n", "_no", "_chunk"])

    return run


def _ends_of_chunks(path: str, pattern: str, chunk_chars: int, overlap: int):
    """mapInArrow function: each chunk's boundaries inside the overlap before and after it (absolute positions)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            out = []
            for key, n, no, chunk in zip(*(b.column(k).to_pylist() for k in ("_key", "_n", "_no", "_chunk"))):
                start = no * chunk_chars
                ends = c.boundaries(chunk)
                if start + len(chunk) < n:
                    ends = ends[ends <= len(chunk) - SAFE_TAIL]
                ends = ends + start
                head = np.concatenate([[start], ends[ends < start + overlap]])
                out.append((key, n, no, head, ends[ends >= start + chunk_chars]))
            keys, ns, nos, heads, tails = zip(*out) if out else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(ns, pa.int64()), pa.array(nos, pa.int32()),
                 pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                names=["_key", "_n", "_no", "_head", "_tail"])

    return run


def _stitch(chunk_chars: int):
    """applyInPandas function over one text's chunk ends: (_key, _no, _first, _last) relative to each chunk.

    Chunk 0 starts at a true boundary. The first boundary of the next chunk that the trusted
    tokenisation also has is true as well; from there the next chunk is trusted. If two chunks share no
    boundary in their overlap (one pre-token spans it), the single row (_key, -1, 0, 0) asks for the text as a whole.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_no")
        key, n = pdf["_key"].iloc[0], int(pdf["_n"].iloc[0])
        cuts, trusted = [0], 0
        for tail, head in zip(pdf["_tail"].iloc[:-1], pdf["_head"].iloc[1:]):
            common = np.intersect1d(tail, head)
            common = common[common >= trusted]
            if not len(common):
                return pd.DataFrame({"_key": [key], "_no": [-1], "_first": [0], "_last": [0]})
            trusted = int(common[0])
            cuts.append(trusted)
        no = pdf["_no"].to_numpy()
        base = no.astype(np.int64) * chunk_chars
        return pd.DataFrame({"_key": key, "_no": no, "_first": np.array(cuts) - base,
                             "_last": np.array([*cuts[1:], n]) - base})

    return run


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", out_col: str = "ids",
           chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP, decoded_col: str | None = None,
           keep_text: bool = True) -> DataFrame:
    """Add ``out_col`` (array<int>): the ids of each whole text by the rank file at ``path``; with ``decoded_col``
    also the bytes that decoding these ids gives; without ``keep_text`` the text is left out, which halves what moves.

    Pre-tokens are the matches of ``pattern``; there are no special tokens. Texts up to
    ``chunk_chars`` characters are one chunk and are encoded where they are. Longer ones are chunked,
    each distinct text once, so a hot group of copies is encoded once and joined back. Null and empty
    texts give an empty array; repeated rows stay as often as they come; every other column is carried
    along whatever its name (an existing ``out_col`` is replaced); an empty frame gives an empty frame.
    """
    if not 0 < overlap <= chunk_chars:
        raise ValueError("overlap must be between 1 and chunk_chars")
    others = [c for c in df.columns if c not in (out_col, decoded_col) and (keep_text or c != text_col)]
    decode = decoded_col is not None
    flat = df.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    row_type = flat.schema["_row"].dataType.simpleString()
    short = flat.filter(F.char_length("_text") <= chunk_chars).mapInArrow(
        tidy(_encoder(path, pattern, decode, "_text"), forget=False), f"_row {row_type}, _ids array<int>, _bytes binary")

    long = flat.filter(F.char_length("_text") > chunk_chars).withColumn("_key", F.sha2("_text", 256))
    chunks = (long.select("_key", "_text")
              .mapInArrow(tidy(_cut_chunks(chunk_chars, overlap), forget=False), "_key string, _n long, _no int, _chunk string")
              .dropDuplicates(["_key", "_no"]))
    ends = chunks.mapInArrow(tidy(_ends_of_chunks(path, pattern, chunk_chars, overlap), forget=False),
                             "_key string, _n long, _no int, _head array<long>, _tail array<long>")
    cuts = ends.groupBy("_key").applyInPandas(_stitch(chunk_chars), "_key string, _no int, _first long, _last long")
    pieces = chunks.drop("_n").join(cuts, ["_key", "_no"])
    unstitched = cuts.filter("_no = -1").select("_key")
    whole = (long.select("_key", "_text").join(unstitched, "_key", "left_semi").dropDuplicates(["_key"])
             .select("_key", F.lit(0).alias("_no"), F.col("_text").alias("_chunk"), F.lit(0).cast("long").alias("_first"),
                     F.char_length("_text").cast("long").alias("_last")))
    encoded = pieces.unionByName(whole).mapInArrow(
        tidy(_encoder(path, pattern, decode, "_chunk", "_first", "_last"), forget=False), "_key string, _no int, _ids array<int>, _bytes binary")
    parts = F.array_sort(F.collect_list(F.struct("_no", "_ids", "_bytes")))
    by_text = encoded.groupBy("_key").agg(parts.alias("_parts")).select(
        "_key", F.flatten("_parts._ids").alias("_ids"),
        F.unhex(F.array_join(F.transform("_parts._bytes", lambda b: F.hex(b)), "")).alias("_bytes"))
    stitched = long.select("_row", "_key").join(by_text, "_key").select("_row", "_ids", "_bytes")
    return short.unionByName(stitched).select("_row.*", F.col("_ids").alias(out_col), *([F.col("_bytes").alias(decoded_col)] if decode else []))


def decoded(path: str, pattern: str, ids):
    """Column of bytes: the concatenated raw bytes of the tokens in ``ids`` (null stays null)."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path, pattern)
        for lists in batches:
            yield c.decode(pa.array(lists, pa.list_(pa.int32()))).to_pandas()

    return run(ids)
