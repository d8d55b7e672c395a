from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from ledgerline.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns.setdefault(c, []).append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends, children = {}, {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(turns.get(c - c % 5, [])[:h] + own[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
            if d:
                children.setdefault(seq[:d - 1], set()).add(seq[:d])
        ends.setdefault(seq, []).append(c)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, ms in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(ms) - 1) * (len(node[-1][1].encode()) if node else 0)
    digest = lambda n: hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()
    return sorted((min(ms), len(n), min(members[n[:-1]]) if n else None, len(ms), len(children.get(n, ())), leaves[n], saved[n], digest(n))
                  for n, ms in members.items())


def corpus(seed, n, turns=7, words=3):
    r = random.Random(seed)
    out = []
    for c in r.sample(range(n * 2), n):
        out += [(c, t, r.choice(["user", "assistant", None]), r.choice([f"text é {r.randint(1, words)}", None, ""])) for t in range(r.randint(1, turns))]
    r.shuffle(out)
    return out


EDGES = ([(1000 + i, t, "user", f"same {t}") for i in range(60) for t in range(4)]
         + [(2000, None, "system", "null turn first"), (2000, 1, "user", "a"), (2000, 1, "user", "a"), (2000, 1, "user", "b"), (2000, None, None, None)]
         + [(None, 1, "user", "belongs to none"), (3000, 2, "user", "x" * 100_000), (3003, 2, "user", "x" * 100_000), (3001, 1, "us", "er:x"), (3002, 1, "user", ":x")]
         + [(c, t, "user", f"long {t}") for c in (4000, 4001, 4002) for t in range(40)])


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "p") for r in rows], "conv_id long, turn long, role string, text string, depth int, piece string")


@pytest.mark.parametrize("seed, counters, block, members", [(1, 1 << 16, 4096, 1024), (2, 1, 3, 1), (3, 64, 5, 4)])
def test_against_brute_force(spark, monkeypatch, seed, counters, block, members):
    """Also with a sketch that is too small, so that nearly all prefixes are grouped exactly, and with many salts and blocks."""
    monkeypatch.setattr(prefix_trie, "FEWEST_COUNTERS", counters)
    monkeypatch.setattr(prefix_trie, "MOST_COUNTERS", max(counters, 16))
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "MEMBERS_PER_SALT", members)
    monkeypatch.setattr(prefix_trie, "EXACT", 2 if members < 1024 else 128)
    monkeypatch.setattr(prefix_trie, "CHUNK", 7 if seed > 1 else 10_000)
    rows = corpus(seed, 60) + EDGES
    got = prefix_trie.prefix_trie(frame(spark, rows))
    assert got.columns == COLUMNS and {t for _, t in got.dtypes} == {"bigint", "string"}
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == brute(rows)


def test_turnless_conversations_and_empty_table(spark):
    gone = [c for c in range(40) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:7]  # base absent, own turns all cut
    rows = [(c, 1, "user", "x") for c in gone]
    got = prefix_trie.prefix_trie(frame(spark, rows)).collect()
    assert [tuple(r) for r in got] == brute(rows) and got[0].n_leaves == 1 and got[0].n_convs == 7
    assert prefix_trie.prefix_trie(frame(spark, [])).collect() == []


def test_codes_never_fall_short():
    counts = np.array([0, 1, 2, 127, 128, 255, 256, 10**6, 10**9, 2**40])
    codes = prefix_trie.codes_of(counts, 128)
    assert (np.diff(codes) >= 0).all() and list(codes[:4]) == [0, 1, 2, 127]
    assert list(prefix_trie.salts_of(codes[:6], 128, 1024)) == [1] * 6 and (prefix_trie.salts_of(codes[7:], 128, 1024) > [900, 4000, 4000]).all()


def test_an_estimate_of_one_is_proof(spark):
    rows = [(i % 300, i % 7) for i in range(2000)]
    digests = spark.createDataFrame([(hash((a, "x")), hash((a, "y"))) for a, _ in rows], "g1 long, g2 long")
    codes = prefix_trie.sketch(digests, 1 << 16)
    at = prefix_trie._at(np.array([hash((a, "x")) for a in range(300)]), np.array([hash((a, "y")) for a in range(300)]), 1 << 16)
    assert (np.minimum(codes[at[0]], codes[at[1]]) >= 6).all() and int(codes[:1 << 16].astype(int).sum()) == 2000
