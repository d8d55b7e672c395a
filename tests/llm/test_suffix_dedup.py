from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import suffix_dedup


def brute(rows, length):
    """By row: flat bounds of bytes covered by a length-byte string that also starts in a smaller id."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        if i is not None:
            for p in range(len(t) - length + 1):
                w = t[p:p + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1) if i is not None else ():
            if first[t[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        out.append((i, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def corpus(seed, n, alphabet, size):
    r = random.Random(seed)
    line = lambda k: "".join(r.choices(alphabet, k=k))
    shared = [line(r.randint(20, 90)) for _ in range(12)]
    return [(r.randint(0, n * 3), "".join(r.choice(shared) if r.random() < 0.4 else line(r.randint(1, size)) for _ in range(r.randint(0, 8))))
            for _ in range(n)]


@pytest.mark.parametrize("seed, length, alphabet, blocks", [
    (1, 50, "abcdefghij é漢 ", 6_000_000), (2, 50, "abcdefghij é漢 ", 500), (3, 20, "ab", 700), (4, 24, "aab", 400), (5, 9, "abcd ", 900), (6, 5, "abc", 900)])
def test_against_brute_force(spark, docs_of, monkeypatch, seed, length, alphabet, blocks):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", blocks)
    monkeypatch.setattr(suffix_dedup, "BYTES_PER_BUCKET", blocks * 3)
    monkeypatch.setattr(suffix_dedup, "SORT_WINDOWS", 300)
    rows = corpus(seed, 60, alphabet, 40) + [(5, "x" * 400), (6, "x" * 300), (7, None), (8, ""), (None, "x" * 100), (9, "x" * 60), (9, "x" * 60),
                                             (9, "y" * 60), (10, "z" + "y" * 59)]
    got = suffix_dedup.remove_repeats(docs_of(rows), length=length)
    assert got.columns == ["doc_id", "text", "_key", "_text", "n", "removed_bounds", "kept_bytes"]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    got = got.withColumn("again", suffix_dedup.text_without(F.col("text"), F.col("removed_bounds"))).collect()
    assert sorted(((r.doc_id, bytes(r.kept_bytes)) for r in got), key=key) == sorted(brute(rows, length), key=key)
    for r in got:
        assert r["_text"] == "t"
        if (r.text or "").isascii() and r.text is not None:
            assert r.again.encode() == bytes(r.kept_bytes)


def test_whole_characters_and_more_buckets_than_anchors(spark, docs_of, monkeypatch):
    """The text that comes with the spans is the one cut out afterwards; a bucket per byte changes nothing."""
    rows = corpus(11, 40, "abcdefghij é漢 ", 40) + [(500, None), (501, ""), (None, "é" * 60), (502, "aé" * 40), (503, "é" * 40)]
    want = suffix_dedup.remove_repeats(docs_of(rows), length=9)
    want = want.withColumn("kept_text", suffix_dedup.text_without(F.col("text"), F.col("removed_bounds"))).collect()
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 600)
    monkeypatch.setattr(suffix_dedup, "BYTES_PER_BUCKET", 1)
    got = suffix_dedup.remove_repeats(docs_of(rows), length=9, whole_characters=True)
    assert got.columns[-2:] == ["removed_bounds", "kept_text"]
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")
    fields = [(r.doc_id, r.text, r.removed_bounds, r.kept_text) for r in sorted(got.collect(), key=key)]
    assert fields == [(r.doc_id, r.text, r.removed_bounds, r.kept_text) for r in sorted(want, key=key)]
    assert any(r[2] for r in fields) and (500, None, [], None) in fields


def test_salted_anchors(spark, docs_of, monkeypatch):
    """More blocks than a salt group holds: a passage in every document is settled in two sorts."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 400)
    monkeypatch.setattr(suffix_dedup, "BLOCKS_PER_SALT", 4)
    r = random.Random(3)
    passage = "".join(r.choices("abcdefgh ", k=120))
    rows = [(i, "".join(r.choices("abcdefgh ", k=r.randint(0, 90))) + passage + "".join(r.choices("xyz", k=30))) for i in range(150)]
    got = suffix_dedup.remove_repeats(docs_of(rows)).collect()
    assert sorted((r.doc_id, bytes(r.kept_bytes)) for r in got) == sorted(brute(rows, 50))


def test_empty_table(spark, docs_of):
    assert suffix_dedup.remove_repeats(docs_of([])).collect() == []
