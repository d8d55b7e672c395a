"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A byte goes if it lies in a string of ``length`` bytes that also starts in a document with a smaller id.
Suffixes need to be ordered only through ``length`` bytes; groups that are equal to that depth are the
repeated windows. The sort goes most significant digit first, and groups within one document drop out
after every pass:

* The first digit is the window's *anchor*: the least hash among its ``ANCHOR``-byte substrings. Equal
  windows have equal anchors, and a run of neighbouring windows with one anchor travels as one string.
  Anchors that occur in one document only are told apart before any text moves: documents lie in
  blocks, every block sends its distinct anchors once, and gets back one code for each.
* The following digits are 8 bytes each, sorted by numpy inside the tasks that hold an anchor.

Frequent anchors are pre-aggregated twice: each block keeps only the smallest document for each distinct
string, and anchors found in many blocks are first sorted in salted groups of blocks, whose smallest
documents meet in a second sort.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import release_memory

LENGTH = 50
ANCHOR = 16
BLOCK_BYTES = 4_000_000
#: Distinct anchors of this many bytes of text meet in one task when they are counted.
BYTES_PER_BUCKET = 12_000_000
BLOCKS_PER_SALT = 64
SORT_WINDOWS = 200_000
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX1
    h = (h ^ (h >> np.uint64(33))) * _MIX2
    return h ^ (h >> np.uint64(33))


def window_anchors(text: bytes, length: int) -> np.ndarray:
    """The anchor of every window: the least hash of its substrings of ANCHOR bytes (all 8 bytes hashed at once)."""
    n, k = len(text) - length + 1, min(ANCHOR, length)
    if n <= 0:
        return np.zeros(0, np.uint64)
    raw = text + bytes(16)
    words = np.ndarray(shape=(len(text) + 8,), dtype="<u8", buffer=raw, strides=(1,))
    m = len(text) - k + 1
    if k == 16:
        h = _mix(words[:m] ^ (_mix(words[8:m + 8] + np.uint64(0x9E3779B97F4A7C15))))
    else:
        bytes_of = np.frombuffer(text, np.uint8).astype(np.uint64)
        h = np.zeros(m, np.uint64)
        for j in range(k):
            h = _mix(h ^ (bytes_of[j:m + j] + np.uint64(0x9E3779B97F4A7C15)))
    wide, step = length - k + 1, 1
    while step * 2 <= wide:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return np.minimum(h[:n], h[wide - step:wide - step + n]) if wide > step else h[:n]


def anchor_runs(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of neighbouring windows with one anchor: anchor, first window, number of windows."""
    a = window_anchors(text, length)
    if not len(a):
        return a, np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.concatenate([[0], np.flatnonzero(a[1:] != a[:-1]) + 1])
    # The minima of hashes crowd near zero: mix again to spread them, and keep 48 bits.
    return _mix(a[first]) >> np.uint64(16), first, np.diff(np.concatenate([first, [len(a)]]))


def pack48(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def bucket_of(anchors: np.ndarray, n: int) -> np.ndarray:
    return ((anchors >> np.uint64(16)) * np.uint64(n)) >> np.uint64(32)


def squeezed(values: np.ndarray) -> bytes:
    """Compressed; numbers byte plane by byte plane, so that their constant high bytes cost nothing."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T) if len(values) else values
    raw = planes.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def restored(raw: bytes, kind) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.decompress(raw[8:], decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel() if size else np.zeros(0, kind)


class Strings:
    """Byte strings of anchor runs: for each its anchor, document id, row (by rank in its block), start, length, block and log2 of its salts."""

    FIELDS = (("anchor", np.uint64), ("doc", np.int64), ("row", np.int32), ("start", np.int32), ("size", np.int32),
              ("block", np.int32), ("hot", np.int8))

    def __init__(self, fields: dict[str, np.ndarray], raw: bytes):
        self.__dict__.update(fields)
        self.raw = raw
        self.offset = np.cumsum(self.size, dtype=np.int64) - self.size

    def __len__(self) -> int:
        return len(self.anchor)

    def take(self, index: np.ndarray) -> Strings:
        raw = b"".join([self.raw[o:o + s] for o, s in zip(self.offset[index].tolist(), self.size[index].tolist())])
        return Strings({k: getattr(self, k)[index] for k, _ in self.FIELDS}, raw)

    def pack(self) -> dict[str, bytes]:
        return {k: squeezed(getattr(self, k)) for k, _ in self.FIELDS} | {"raw": squeezed(np.frombuffer(self.raw, np.uint8))}

    @classmethod
    def unpack(cls, rows: list[dict]) -> Strings:
        fields = {k: np.concatenate([np.zeros(0, t), *(restored(r[k], t) for r in rows)]) for k, t in cls.FIELDS}
        return cls(fields, b"".join(restored(r["raw"], np.uint8).tobytes() for r in rows))


PACKED = ", ".join(f"{k} binary" for k, _ in Strings.FIELDS) + ", raw binary"
_PACKED_NAMES = [*(k for k, _ in Strings.FIELDS), "raw"]


def smallest_copies(s: Strings) -> tuple[np.ndarray, np.ndarray]:
    """Of equal strings, which start in the smallest document (first), and which do not (second)."""
    least: dict[bytes, int] = {}
    parts = [s.raw[o:o + n] for o, n in zip(s.offset.tolist(), s.size.tolist())]
    docs = s.doc.tolist()
    for p, d in zip(parts, docs):
        if least.setdefault(p, d) > d:
            least[p] = d
    keep = np.fromiter((least[p] == d for p, d in zip(parts, docs)), dtype=bool, count=len(parts))
    return np.flatnonzero(keep), np.flatnonzero(~keep)


def radix_pass(s: Strings, index: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Repeated windows of the strings ``index``: (string, window) of those that also start in a smaller document.

    Most-significant-digit passes: the group starts as the anchor, every pass orders the remaining
    windows by group and their next 8 bytes, renumbers the groups, and drops groups of one document.
    """
    n = s.size[index].astype(np.int64) - length + 1
    string = np.repeat(index, n)
    window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = s.offset[string] + window
    words = np.ndarray(shape=(len(s.raw) + 1,), dtype=">u8", buffer=s.raw + bytes(8), strides=(1,))
    doc, group = s.doc[string], np.unique(s.anchor[string], return_inverse=True)[1].astype(np.int64)
    depth = 0
    while True:
        last = depth + 8 >= length
        digit = words[at + (min(depth, length - 8) if length >= 8 else 0)].astype(np.uint64)
        if length < 8:
            digit >>= np.uint64(8 * (8 - length))
        order = np.lexsort((digit, group))
        group, digit, doc, at, string, window = (x[order] for x in (group, digit, doc, at, string, window))
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])]) if len(group) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        least = np.minimum.reduceat(doc, first) if len(first) else doc
        most = np.maximum.reduceat(doc, first) if len(first) else doc
        shared = (least < most)[group] if len(first) else np.zeros(0, bool)
        if last or not shared.any():
            hit = shared & (doc > least[group]) if len(first) else shared
            return string[hit], window[hit]
        group, doc, at, string, window = (x[shared] for x in (group, doc, at, string, window))
        depth += 8


def repeated_windows(s: Strings, length: int, keep: np.ndarray, copies: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Spans of repeated windows: block, row, first and last-plus-one byte.

    Strings equal to one of a smaller document (``copies``) are whole spans; the others (``keep``) are
    sorted by their windows, in slices of whole anchors.
    """
    yield s.block[copies], s.row[copies], s.start[copies], s.start[copies] + s.size[copies]
    order = keep[np.argsort(s.anchor[keep], kind="stable")]
    anchor, doc = s.anchor[order], s.doc[order]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(order) else np.zeros(0, np.int64)
    if not len(first):
        return
    mixed = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
    bounds = np.append(first, len(order))
    windows = np.add.reduceat(s.size[order].astype(np.int64) - length + 1, first)
    batch, load = [], 0
    for g in np.flatnonzero(mixed).tolist():
        batch.append(order[bounds[g]:bounds[g + 1]])
        load += int(windows[g])
        if load >= SORT_WINDOWS:
            yield _spans_of(s, *radix_pass(s, np.concatenate(batch), length), length)
            batch, load = [], 0
    if batch:
        yield _spans_of(s, *radix_pass(s, np.concatenate(batch), length), length)


def _spans_of(s: Strings, string: np.ndarray, window: np.ndarray, length: int):
    order = np.lexsort((window, string))
    string, window = string[order], window[order]
    new = np.concatenate([[True], (string[1:] != string[:-1]) | (window[1:] > window[:-1] + 1)]) if len(string) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(string)) - 1 if len(first) else first
    own = string[first]
    return s.block[own], s.row[own], s.start[own] + window[first], s.start[own] + window[last] + length


def _doc_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _block_runs(table: pa.Table, length: int):
    """All anchor runs of a block's documents with an id: anchor, document id, start, windows; and the texts by row."""
    texts = [_doc_bytes(t) for t in table.column("_text").to_pylist()]
    anchors, rows, firsts, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, (known, t) in enumerate(zip(table.column("_id").is_valid().to_pylist(), texts)):
        if known and len(t) >= length:
            a, f, c = anchor_runs(t, length)
            anchors.append(a)
            rows.append(np.full(len(a), i, np.int64))
            firsts.append(f)
            counts.append(c)
    ids = np.array([-1 if x is None else x for x in table.column("_id").to_pylist()], dtype=np.int64)
    return texts, ids, *map(np.concatenate, (anchors, rows, firsts, counts))


def _distinct_anchors(anchors: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors in order, and whether each has several documents."""
    order = np.lexsort((docs, anchors))
    anchors, docs = anchors[order], docs[order]
    first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]])) if len(anchors) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(anchors)) - 1 if len(first) else first
    return anchors[first], docs[first] != docs[last]


def _bucket_runs(distinct: np.ndarray, n_buckets: int) -> tuple[list[int], list[int], list[int]]:
    """The buckets that sorted anchors fall in, and where each one's run begins and ends; other buckets cost nothing."""
    some, first = np.unique(bucket_of(distinct, n_buckets), return_index=True)
    first = first.tolist()
    return some.tolist(), first, [*first[1:], len(distinct)] if first else []


def _send_anchors(length: int, n_buckets: int):
    """applyInArrow on a block: its distinct anchors, packed by bucket."""

    def run(table: pa.Table) -> pa.Table:
        _, ids, anchors, rows, _, _ = _block_runs(table, length)
        distinct, several = _distinct_anchors(anchors, ids[rows])
        some, first, last = _bucket_runs(distinct, n_buckets)
        block = table.column("_block")[0].as_py() if len(table) else 0
        return pa.table({
            "bucket": pa.array(some, pa.int32()), "_block": pa.array([block] * len(some), pa.int32()),
            "anchors": pa.array([pack48(distinct[i:j]) for i, j in zip(first, last)], pa.binary()),
            "several": pa.array([np.packbits(several[i:j]).tobytes() for i, j in zip(first, last)], pa.binary())})

    return run


def _judge_anchors(table: pa.Table) -> pa.Table:
    """applyInArrow on a bucket: for each block's anchors 0 if one document has them, else 1 + log2 of their salts."""
    blocks = [unpack48(x) for x in table.column("anchors").to_pylist()]
    several = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(a)).astype(bool)
               for x, a in zip(table.column("several").to_pylist(), blocks)]
    values, where, n_blocks = np.unique(np.concatenate(blocks), return_inverse=True, return_counts=True)
    shared = n_blocks > 1
    shared[where[np.concatenate(several)]] = True
    salts = np.ceil(np.log2(np.maximum(n_blocks / BLOCKS_PER_SALT, 1))).astype(np.uint8)
    code = np.where(shared, 1 + salts, 0).astype(np.uint8)[where]
    edges = np.cumsum([0, *map(len, blocks)])
    return pa.table({"bucket": table.column("bucket"), "_block": table.column("_block"),
                     "codes": pa.array([code[edges[i]:edges[i + 1]].tobytes() for i in range(len(blocks))], pa.binary())})


def _part_of(anchors: np.ndarray, salt: np.ndarray | np.uint64, n_parts: int) -> np.ndarray:
    return (_mix(anchors * np.uint64(0x9E3779B97F4A7C15) + salt) % np.uint64(n_parts)).astype(np.int64)


_MOVED_TYPES = [("part", pa.int32()), *((k, pa.binary()) for k in _PACKED_NAMES), ("_block", pa.int32()),
                ("rows", pa.binary()), ("firsts", pa.binary()), ("lasts", pa.binary())]
_MOVED = f"part int, {PACKED}, _block int, rows binary, firsts binary, lasts binary"


def _moved(s: Strings, part: np.ndarray, spans: list[tuple[np.ndarray, ...]], n_parts: int) -> pa.Table:
    """Rows of two kinds: strings packed by part, and settled spans packed by block (they go along to some part)."""
    rows = []
    order = np.argsort(part, kind="stable")
    parts, at = np.unique(part[order], return_index=True)
    for p, index in zip(parts.tolist(), np.split(order, at[1:])):
        rows.append({"part": p, **s.take(index).pack()})
    block, row, first, last = (np.concatenate(x) for x in zip(*spans))
    order = np.lexsort((first, row, block))
    blocks, at = np.unique(block[order], return_index=True)
    for b, index in zip(blocks.tolist(), np.split(order, at[1:])):
        rows.append({"part": b % n_parts, "_block": b, **{
            k: squeezed(x[index].astype(np.int32)) for k, x in (("rows", row), ("firsts", first), ("lasts", last))}})
    return pa.table({k: pa.array([r.get(k) for r in rows], t) for k, t in _MOVED_TYPES})


def _send_strings(length: int, n_buckets: int, n_parts: int):
    """applyInArrow on a block and its codes: strings of shared anchors to their parts, spans settled in the block along."""

    def run(docs: pa.Table, codes: pa.Table) -> pa.Table:
        texts, ids, anchors, rows, firsts, counts = _block_runs(docs, length)
        distinct, _ = _distinct_anchors(anchors, ids[rows])
        code = np.zeros(len(distinct), np.uint8)
        runs = {b: (i, j) for b, i, j in zip(*_bucket_runs(distinct, n_buckets))}
        for b, c in zip(codes.column("bucket").to_pylist(), codes.column("codes").to_pylist()):
            i, j = runs[b]
            code[i:j] = np.frombuffer(c, np.uint8)
        own = code[np.searchsorted(distinct, anchors)] if len(anchors) else np.zeros(0, np.uint8)
        go = np.flatnonzero(own)
        sizes = (counts[go] + length - 1).astype(np.int32)
        raw = b"".join([texts[r][f:f + n] for r, f, n in zip(rows[go].tolist(), firsts[go].tolist(), sizes.tolist())])
        block = docs.column("_block")[0].as_py() if len(docs) else 0
        s = Strings({"anchor": anchors[go], "doc": ids[rows[go]], "row": _row_ranks(docs)[rows[go]], "start": firsts[go].astype(np.int32),
                     "size": sizes, "block": np.full(len(go), block, np.int32), "hot": (own[go] - 1).astype(np.int8)}, raw)
        keep, copies = smallest_copies(s)
        settled = (s.block[copies], s.row[copies], s.start[copies], s.start[copies] + s.size[copies])
        s = s.take(keep)
        salt = np.uint64(block) & ((np.uint64(1) << s.hot.astype(np.uint64)) - np.uint64(1))
        moved = _moved(s, _part_of(s.anchor, salt, n_parts), [settled], n_parts)
        del s, raw, texts
        release_memory()
        return moved

    return run


def _sort_part(length: int, n_parts: int):
    """applyInArrow on a part: spans of its repeated windows; of salted anchors, the smallest documents' strings go on."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        s = Strings.unpack([r for r in rows if r["raw"] is not None])
        spans = [_unpack_spans(r) for r in rows if r["_block"] is not None]
        keep, copies = smallest_copies(s)
        spans += repeated_windows(s, length, keep, copies)
        on = s.take(keep[s.hot[keep] > 0])
        on.hot = np.zeros(len(on), np.int8)
        moved = _moved(on, _part_of(on.anchor, np.uint64(0), n_parts), spans, n_parts)
        del s, on, rows
        release_memory()
        return moved

    return run


def _unpack_spans(row: dict) -> tuple[np.ndarray, ...]:
    rows, firsts, lasts = (restored(row[k], np.int32) for k in ("rows", "firsts", "lasts"))
    return np.full(len(rows), row["_block"], np.int32), rows, firsts, lasts


def _row_ranks(docs: pa.Table) -> np.ndarray:
    """Each row's number within its block, in order of the rows' keys: the same whenever the block is read."""
    return np.unique(docs.column("_key").to_numpy(), return_inverse=True)[1].astype(np.int32)


def _without(raw: bytes, bounds: list[int]) -> str:
    """UTF-8 bytes without the spans in ``bounds``; a character that a span's edge cuts stays whole."""
    kept, at = [], 0
    for first, last in zip(bounds[::2], bounds[1::2]):
        while first < last and raw[first] & 0xC0 == 0x80:
            first += 1
        while last > first and last < len(raw) and raw[last] & 0xC0 == 0x80:
            last -= 1
        kept.append(raw[at:first])
        at = last
    return b"".join([*kept, raw[at:]]).decode("utf-8")


def _mark(whole: bool):
    """applyInArrow on a block and its spans: for every row the removed spans and the bytes left, or the text of whole characters left."""

    def run(docs: pa.Table, spans: pa.Table) -> pa.Table:
        values, ranks = docs.column("_text").to_pylist(), _row_ranks(docs)
        parts = [_unpack_spans(r) for r in spans.to_pylist()]
        none = np.zeros(0, np.int64)
        _, row, first, last = (np.concatenate(x) for x in zip(*parts)) if parts else (none,) * 4
        order = np.argsort(row, kind="stable")
        row, first, last = row[order], first[order], last[order]
        bounds, left = [], []
        for value, lo, hi in zip(values, np.searchsorted(row, ranks), np.searchsorted(row, ranks, side="right")):
            t = _doc_bytes(value)
            if lo == hi:
                bounds.append([])
                left.append(value if whole else t)
                continue
            n = len(t) + 1
            edge = np.bincount(first[lo:hi], minlength=n) - np.bincount(last[lo:hi], minlength=n)
            gone = np.cumsum(edge[:-1]) > 0
            bounds.append(np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).tolist())
            left.append(_without(t, bounds[-1]) if whole else np.frombuffer(t, np.uint8)[~gone].tobytes())
        out = pa.table({"_row": docs.column("_row"), "_text": docs.column("_text"), "_bounds": pa.array(bounds, pa.list_(pa.int64())),
                        "_left": pa.array(left, pa.string() if whole else pa.binary())})
        del values, parts, left, bounds
        release_memory()
        return out

    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   whole_characters: bool = False) -> DataFrame:
    """All columns of ``df`` plus ``removed_bounds`` (flat first and last-plus-one bytes) and ``kept_bytes``.

    With ``whole_characters`` the string ``kept_text`` takes the place of ``kept_bytes``: characters cut by a span's edge stay
    whole, and a null text stays null.

    Every byte covered by a ``length``-byte string that also starts in a document with a smaller id is
    removed; strings are compared on the texts as they come, overlaps count, and no string crosses
    documents. Null texts are empty. Rows with a null id neither remove nor lose anything. Rows that
    share an id take nothing from one another, but each loses what a smaller id has. Other columns are
    carried along whatever their names (those added are replaced if they exist). A text is read whole by
    one task; an empty frame gives an empty frame.
    """
    if length < 1:
        raise ValueError("length must be positive")
    left_col, left_type = ("kept_text", "string") if whole_characters else ("kept_bytes", "binary")
    kept = [c for c in df.columns if c not in ("removed_bounds", left_col)]
    text, doc = F.col(f"`{text_col}`"), F.col(f"`{id_col}`").cast("long")
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_BYTES))
    n_buckets = max(1, -(-total // BYTES_PER_BUCKET))
    flat = df.select(doc.alias("_id"), text.alias("_text"), F.struct(*(F.col(f"`{c}`") for c in kept if c != text_col)).alias("_row"),
                     F.xxhash64(doc, text).alias("_key")).withColumn("_block", F.pmod("_key", F.lit(n_blocks)).cast("int"))
    row_type = flat.schema["_row"].dataType.simpleString()
    blocks = flat.groupBy("_block")
    anchors = blocks.applyInArrow(_send_anchors(length, n_buckets), "bucket int, _block int, anchors binary, several binary")
    codes = anchors.groupBy("bucket").applyInArrow(_judge_anchors, "bucket int, _block int, codes binary")
    moved = blocks.cogroup(codes.groupBy("_block")).applyInArrow(_send_strings(length, n_buckets, n_blocks), _MOVED)
    for _ in ("salted groups of blocks", "all"):
        moved = moved.groupBy("part").applyInArrow(_sort_part(length, n_blocks), _MOVED)
    spans = moved.filter("_block IS NOT NULL").select("_block", "rows", "firsts", "lasts")
    marked = blocks.cogroup(spans.groupBy("_block")).applyInArrow(
        _mark(whole_characters), f"_row {row_type}, _text string, _bounds array<long>, _left {left_type}")
    return marked.select(*(F.col("_text").alias(c) if c == text_col else F.col(f"_row.`{c}`") for c in kept),
                         F.col("_bounds").alias("removed_bounds"), F.col("_left").alias(left_col))


def text_without(text, bounds):
    """Column of strings: ``text`` without the spans in ``bounds``; a character cut by a span's edge stays whole."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, all_bounds: pd.Series) -> pd.Series:
        out = [t if t is None or edges is None or not len(edges) else _without(_doc_bytes(t), edges) for t, edges in zip(texts, all_bounds)]
        return pd.Series(out, dtype=object)

    return run(text, bounds)
