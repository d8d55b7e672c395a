from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from ledgerline.llm import bpe, token_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
ODD = ["", "a", " ", "   x", "\x1c\x1d a\x85b", "a<|endoftext|> b", "<|endoftext|><|endoftext|>", "it's 'll we'LL", "\x00\x01",
       "🙂🙃 ‍", "ſt ßüöä", "١٢٣ ½", "᠎　x", "x" * 3000, " \n\t  \n", "ab" * 900 + "'re", "日本語のテキスト"]


def texts():
    r = random.Random(7)
    alphabet = "aeé st'rlmvd 0129.,;!\n\t   ßñ漢😀"
    return ODD + ["".join(r.choices(alphabet, k=r.randint(1, 400))) for _ in range(120)]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_equal_the_library(spark, docs_of):
    t = Tokenizer.from_file(JSON)
    rows = [*enumerate(texts()), (900, None), (901, "dup"), (901, "dup")]
    got = token_counts.with_token_counts(docs_of(rows), JSON).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted(
        (i, len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in rows)
    assert token_counts.with_token_counts(docs_of([]), JSON).count() == 0


@pytest.mark.parametrize("chunk, overlap", [(64, 16), (200, 150), (4096, 64)])
def test_encoding_equals_the_library_at_any_chunk_size(spark, docs_of, reference, chunk, overlap):
    rows = [*enumerate(texts()), (900, None), (901, "dup " * 60), (901, "dup " * 60), (None, "no id " * 30)]
    got = bpe.encode(docs_of(rows), RANKS, P.PATTERN, chunk_chars=chunk, overlap=overlap)
    assert got.columns == ["doc_id", "text", "_key", "_text", "n", "ids"]
    both = bpe.encode(docs_of(rows), RANKS, P.PATTERN, chunk_chars=chunk, overlap=overlap, decoded_col="bytes").collect()
    assert all(bytes(r.bytes) == (r.text or "").encode() for r in both) and len(both) == len(rows)
    got = got.withColumn("back", bpe.decoded(RANKS, P.PATTERN, got["ids"])).collect()
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(i), reference.encode_ordinary(x or "")) for i, x in rows)
    assert all(bytes(r.back) == (r.text or "").encode() and r["_text"] == "t" for r in got)


def test_encoding_an_empty_table(spark, docs_of):
    assert bpe.encode(docs_of([]), RANKS, P.PATTERN).collect() == []


def test_distinct_words_are_merged_side_by_side(reference):
    r = random.Random(3)
    words = sorted({"".join(r.choices("aeiourstlnmq", k=r.randint(2, 24))) for _ in range(6000)} | {"x" * 64, "zq" * 32, "zq" * 40, "ß漢😀" * 5})
    c, calls = bpe.Codec(RANKS, P.PATTERN), []
    ranks_of, c.pair_ranks = c.pair_ranks, lambda left, right: calls.append(len(left)) or ranks_of(left, right)
    ids = c.encode([*words, "", *words], [(0, None)] * (2 * len(words) + 1))
    assert ids.to_pylist() == [reference.encode_ordinary(w) for w in [*words, "", *words]]
    assert len(calls) < len(words) / 10  # a few lookups a round for thousands of words; word by word it is several a word
    assert c.decode(ids).to_pylist() == [w.encode() for w in [*words, "", *words]]
    assert c.decode(ids.slice(5, 0)).to_pylist() == [] and c.decode(ids.slice(5, 2)).to_pylist() == [w.encode() for w in words[5:7]]


def test_pair_ranks_equal_the_rank_file():
    c = bpe.Codec(RANKS, P.PATTERN)
    r = random.Random(5)
    cut = [(t[:i], t[i:]) for t in r.sample(sorted(c.ranks), 2000) for i in range(1, len(t))]
    pairs = [(a, b) for a, b in cut + [(b, a) for a, b in cut] if a in c.ranks and b in c.ranks]
    left, right = (np.array([c.ranks[p[side]] for p in pairs]) for side in (0, 1))
    assert c.pair_ranks(left, right).tolist() == [c.ranks.get(a + b, bpe.NO_RANK) for a, b in pairs]
    assert c.pair_ranks(left, np.full(len(left), -1)).tolist() == [bpe.NO_RANK] * len(left)
