from __future__ import annotations

import random
import time

import pytest

from ledgerline.llm import ngram_join


def sets_of(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def brute(rows, width, percent):
    sets = [sets_of(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    first = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            first[root(i)] = min(first.get(root(i), doc), doc)
    return sorted((str(d), len(s), str(first.get(root(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def corpus(seed, n):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    base = [[r.choice(vocab) for _ in range(r.choice([1, 2, 3, 10, 40, 120]))] for _ in range(n // 8)]
    rows = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
            at = r.randrange(len(w) + 1)
            if r.random() < 0.5 or at == len(w):
                w.insert(at, r.choice(vocab))
            else:
                w[at] = r.choice(vocab)
        rows.append((i, " ".join(x.upper() if r.random() < 0.1 else x for x in w)))
    r.shuffle(rows)
    return rows + [(900, None), (901, ""), (902, " \t\n"), (903, "a b"), (904, "A  b"), (905, "one"), (906, "one"), (907, "a b"),
                   (903, "one two three four"), (None, "one two three four"), (None, "nobody else says this at all")]


@pytest.mark.parametrize("seed, width, percent, block", [(1, 3, 90, 1000), (2, 3, 90, 3), (3, 5, 80, 1000), (4, 2, 60, 4), (5, 1, 80, 2)])
def test_against_brute_force(spark, docs_of, monkeypatch, seed, width, percent, block):
    monkeypatch.setattr(ngram_join, "FIRST", 4 if seed != 2 else 2)
    monkeypatch.setattr(ngram_join, "POSTING_BLOCK", block)
    monkeypatch.setattr(ngram_join, "ROWS_PER_BUCKET", 500)
    monkeypatch.setattr(ngram_join, "LISTED", 64 if seed != 2 else 3)
    rows = corpus(seed, 160)
    got = ngram_join.similarity_components(docs_of(rows), width=width, percent=percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, width, percent)


def test_sets_that_share_a_name(spark, docs_of, monkeypatch):
    """Names of five bits: nearly every two sets collide, and none may be taken for another."""
    monkeypatch.setattr(ngram_join, "NAME_BITS", 5)
    rows = corpus(6, 120)
    got = ngram_join.similarity_components(docs_of(rows), width=3, percent=90).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, 3, 90)


def test_ids_that_are_text(spark):
    rows = [("b", "one two three four"), ("a", "one two three four"), ("c", None), (None, "x y"), ("d", "X  y")]
    got = ngram_join.similarity_components(spark.createDataFrame(rows, "name string, text string"), id_col="name").collect()
    assert sorted((str(r.name), r.component_id) for r in got) == [("None", "d"), ("a", "a"), ("b", "a"), ("c", "c"), ("d", "d")]


def test_extended_copies(spark, docs_of):
    """A shingle that no other prefix holds may lie behind the prefix of a similar set."""
    rows, i = [], 0
    for length in (11, 20, 40, 80):
        words = [f"x{length}y{k}" for k in range(length)]
        for more in range(3):
            rows.append((i, " ".join(words + [f"z{length}y{more}y{k}" for k in range(more * length // 20 + 1)][:more])))
            i += 1
    got = ngram_join.similarity_components(docs_of(rows), width=3, percent=90).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, 3, 90)


def test_partly_shared_groups(spark, docs_of):
    """Similar pairs whose prefixes are filled differently, where a third set leads all the lists they share."""
    r = random.Random(2)
    vocab, rows = [f"v{k}" for k in range(40)], []
    for g in range(12):
        core, some = [f"g{g}c{k}" for k in range(r.choice([30, 60, 80]))], [f"g{g}s{k}" for k in range(14)]
        for c in range(r.choice([3, 4, 6])):
            words = core + r.sample(some, r.randrange(11)) + [f"g{g}d{c}r{k}" for k in range(r.randrange(12))] + r.sample(vocab, r.randrange(3))
            rows.append((len(rows), " ".join(words)))
    r.shuffle(rows)
    got = ngram_join.similarity_components(docs_of(rows), width=1, percent=80).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, 1, 80)


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 200) for i in range(40)] + [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)] + [(7, 7)]
    got = {x.node: x.comp for x in ngram_join.connected_components(spark.createDataFrame(edges, "x long, y long")).collect()}
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert {n: root(n) for n in got} == got
    assert set(got) == {n for e in edges for n in e if e[0] != e[1]}


def test_empty_table(spark, docs_of):
    assert ngram_join.similarity_components(docs_of([])).collect() == []


def test_shuffles_of_ended_steps_are_dropped(spark, docs_of):
    """Their files stayed until the driver's heap happened to be collected; disk then held those of every step at once."""
    def held():
        return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()

    spark.sparkContext._jvm.java.lang.System.gc()
    time.sleep(2)  # what earlier tests left
    before = held()
    found = ngram_join.similarity_components(docs_of(corpus(6, 80)), width=3, percent=90)
    deadline = time.time() + 20
    while held() - before > 30 and time.time() < deadline:
        time.sleep(0.5)  # the cleaner works beside the driver
    assert held() - before <= 30, held() - before
    assert found.count() == 91
