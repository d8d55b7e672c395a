from __future__ import annotations

import random
from pathlib import Path

import pytest

from ledgerline.llm import line_dedup

BLANKS = " \t\n\v\f\r"


def brute(rows, min_docs=3, min_chars=20):
    low = str.maketrans(line_dedup.UPPER, line_dedup.LOWER)
    key = lambda line: line.strip(BLANKS).translate(low)
    lines = [(i, (t or "").split("\n")) for i, t in rows]
    holders = {}
    for i, ls in lines:
        for k in {key(x) for x in ls}:
            holders.setdefault(k, []).append(i)
    out = []
    for i, ls in lines:
        kept = []
        for x in ls:
            held = holders[key(x)]
            last = max((h for h in held if h is not None), default=None)
            if len(key(x)) < min_chars or len(held) < min_docs or i == last:
                kept.append(x)
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def corpus(seed, n):
    r = random.Random(seed)
    shared = ["".join(r.choices("abcÄ漢 xyz", k=r.randint(15, 30))) for _ in range(20)]
    dress = lambda s: r.choice(["", " ", "\t\v"]) + r.choice([s, s.upper() if s.isascii() else s, s.title() if s.isascii() else s]) + r.choice(["", "\r", " \f"])
    return [(r.choice([i, i, i, -i]), "\n".join(dress(r.choice(shared)) if r.random() < 0.6 else r.choice(["", "short", "own line %06d of text" % r.randint(0, 10**6)])
                                                for _ in range(r.randint(0, 9)))) for i in range(n)]


EDGES = [(900, None), (901, ""), (902, "\n\n"), (None, "a line that only null ids hold\nx"), (None, "a line that only null ids hold\nx"),
         (None, "a line that only null ids hold"), (903, "twice the same long line!\ntwice the same long line!"),
         (903, "twice the same long line!\ntwice the same long line!"), (5, "Twice the same long line!"), (None, "twice the same long line!  "),
         (904, "exactly nineteen ch\nexactly twenty chars"), (905, "exactly nineteen ch\nexactly twenty chars"), (906, "exactly nineteen ch\nexactly twenty chars"),
         (907, " kept blank, not ASCII\n" + "long " * 50_000), (908, "kept blank, not ASCII"), (909, "kept blank, not ASCII")]


@pytest.mark.parametrize("seed, batches, fan_in", [(1, 8, 4), (2, 1, 2), (3, 5, 2)])
def test_against_brute_force(spark, docs_of, monkeypatch, seed, batches, fan_in):
    monkeypatch.setattr(line_dedup, "HOT_DOCUMENTS", 20)
    rows = corpus(seed, 150) + EDGES
    got = line_dedup.drop_common_lines(docs_of(rows), batches=batches, fan_in=fan_in)
    assert got.columns == ["doc_id", "text", "_key", "_text", "n", "n_lines", "n_dropped", "kept_text"]
    got = got.collect()
    assert order((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got) == order(brute(rows))
    assert all(r["_key"] == "k" and r["n"] == 7 for r in got)


def test_other_thresholds_and_clashing_columns(spark):
    rows = [(i, "ab\ncd%d" % (i % 2)) for i in range(4)]
    df = spark.createDataFrame([(t, i, "x", "y") for i, t in rows], "`a.b` string, gone long, n_lines string, t1 string")
    got = line_dedup.drop_common_lines(df, "gone", "a.b", min_docs=2, min_chars=1)
    assert got.columns == ["a.b", "gone", "t1", "n_lines", "n_dropped", "kept_text"]
    assert order((r.gone, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()) == order(brute(rows, 2, 1))


def test_empty_table(docs_of):
    assert line_dedup.drop_common_lines(docs_of([])).collect() == []


def test_runs_are_compacted_and_hold_what_is_settled_once(spark, tmp_path):
    runs = line_dedup.SortedRuns(spark, str(tmp_path), min_docs=2, fan_in=2)
    for ids in ([9, 8], [7, 6], [5, 4]):
        runs.add(spark.createDataFrame([(i, 1, 1, True) for i in ids] + [(ids[0], ids[0], 0, True)], "id long, k1 long, k2 long, first boolean"))
    assert [len(level) for level in runs.levels] == [1, 1]
    newest = runs._read(runs.levels[0]).collect()
    assert [(r.k1, r.n, r.last) for r in newest] == [(5, 1, 5)]  # key 1 was settled by the first batch
    common, total = runs.common()
    assert [tuple(r) for r in common.collect()] == [(1, 1, 2, 9)] and total == 5


def test_native():
    source = Path(line_dedup.__file__).read_text()
    assert not any(x in source for x in ("udf", "pandas", "Arrow", "pyarrow", ".rdd", "mapIn"))
