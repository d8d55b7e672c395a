from __future__ import annotations

import random
import re

import pytest

from ledgerline.llm import decontaminate

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()))


def brute(docs, items, window=13):
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for name, text in items:
            v = words(text)
            if not v:
                continue
            k = min(window, len(v))
            for s in range(len(v) - k + 1):
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == v[s:s + k]:
                        hit.update(range(p, p + k))
                        names |= {str(name)} - {"None"}
        out.append((i, len(w), len(hit), sorted(names)))
    return out


@pytest.mark.parametrize("block_bytes, slice_chars", [(2_000_000, 2_000_000), (300, 400)])
def test_against_brute_force(spark, docs_of, monkeypatch, block_bytes, slice_chars):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(decontaminate, "SLICE_CHARS", slice_chars)
    monkeypatch.setattr(decontaminate, "BLOCKS_AT_ONCE", 2)
    r = random.Random(5)
    vocab = ["the", "of", "Élan", "漢字", "a1", "b", "c", "delta", "e"]
    say = lambda n: " ".join(r.choice(vocab) + r.choice(["", ",", ".\n"]) for _ in range(n))
    items = [(i, say(r.choice([1, 2, 3, 5, 12, 13, 14, 30]))) for i in range(14)] + [(20, None), (21, "..."), (None, say(20)), (None, "only a nameless item says this"), (3, say(15)), (22, "unique"), (23, "the of"), (23, "the of")]
    docs = []
    for i in range(50):
        t = say(r.randint(0, 40))
        for _ in range(r.randint(0, 2)):
            t += " " + (r.choice(items)[1] or "").upper() + " | " + say(r.randint(0, 10))
        docs.append((i, t))
    docs += [(60, None), (61, ""), (62, "?!"), (63, docs[1][1]), (63, docs[1][1]), (None, items[7][1]), (64, "Only a nameless item says this!")]
    df = decontaminate.contamination(docs_of(docs), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in df.collect())
    assert got == sorted((str(i), *rest) for i, *rest in brute(docs, items))
    assert df.columns[:5] == ["doc_id", "text", "_key", "_text", "n"]


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs_of([]), none).collect() == []
    (row,) = decontaminate.contamination(docs_of([(1, "two words")]), none).collect()
    assert (row.n_words, row.n_hit, row["items"]) == (2, 0, [])
