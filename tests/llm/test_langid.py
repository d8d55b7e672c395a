from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import langid


def plain_kernel(x, y):
    total = 0.0
    for n in (1, 2, 3):
        a, b = ({"".join(s[i:i + n]) for i in range(len(s) - n + 1)} for s in (x, y))
        total += len(a & b) / math.sqrt(len(a) * len(b))
    return total / 3


def test_kernel_equals_its_definition():
    texts = ["Hello, World 12", "élan vital", "a", "漢字 漢", "hello hello"]
    norm = lambda t: " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
    spectra = [langid.spectrum(t) for t in texts]
    model = langid.fit(["x", "y", "x", "y", "x"], spectra, n_landmarks=5)
    order = [0, 1, 2, 3, 4]
    got = model.kernel(spectra)
    want = np.array([[plain_kernel(norm(a), norm(texts[b])) for b in order] for a in texts])
    assert np.allclose(got, want, atol=1e-5)


def test_languages_are_told_apart_and_odd_rows_defined(spark):
    r = random.Random(2)
    syllables = {"aa": ["ka", "mi", "to", "ra"], "bb": ["sch", "ung", "ein", "ö"], "cc": ["tion", "eau", "é", "ou"]}
    say = lambda lang: " ".join("".join(r.choices(syllables[lang], k=3)) for _ in range(30))
    rows = [(i, say(lang), lang) for i in range(300) for lang in [r.choice(list(syllables))]]
    rows += [(900, None, "aa"), (901, "123 !", "bb"), (902, "", None), (903, say("aa") * 200, None), (1, rows[1][1], rows[1][2])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df.filter("doc_id % 4 != 2"), rows_per_language=40, n_landmarks=30)
    got = df.withColumn("p", langid.predicted(df, model)).select("doc_id", "lang", F.col("p.*")).collect()
    by = {x.doc_id: x for x in got}
    assert all(x.lang_pred == x.lang for x in got if x.doc_id < 900)
    assert [by[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    assert all(0 <= x.score <= 1 for x in got) and by[900].score == 0
    assert langid.train(df.limit(0)) is None
    assert {x.p.lang_pred for x in df.withColumn("p", langid.predicted(df, None)).collect()} == {"und"}
