from __future__ import annotations

import hashlib

from hypothesis import given, strategies as st

from ledgerline.llm import chat

sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


@given(st.text(alphabet="\\<|>/s[INST]a \n😀", max_size=60))
def test_escape_is_reversible_and_hides_control_strings(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROL)


def test_visitor_orders_parts_and_counts_tokens(spark):
    parts = [[{"type": "text", "text": "see <|end|> "}, {"type": "image", "uri": "a.png", "width": 28, "height": 15}, {"type": "text", "text": "and"},
              {"type": None, "text": " both"}, {"type": "audio", "uri": "b.wav", "seconds": 2.02}, {"type": "document", "uri": "c.pdf", "pages": 3},
              {"type": "video", "uri": "d"}, None, {"type": "image"}]]
    df = spark.createDataFrame([(1, 0, "assistant", parts[0]), (1, 1, "user", None), (1, 2, None, [])], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    rows = {r.turn: r for r in chat.format_turns(df, parts_col="parts").collect()}
    r = rows[0]
    assert r.segment == ("<|turn|>assistant<|content|>see <\\|end|> <|image:0|>and both<|audio:1|><|document:2|><|other:3|><|image:4|><|end|>")
    assert [(a.place, a.kind, a.uri, a.tokens) for a in r.attachments] == [
        (0, "image", "a.png", 4), (1, "audio", "b.wav", 51), (2, "document", "c.pdf", 768), (3, "other", "d", 0), (4, "image", None, 576)]
    assert r.expanded_tokens == 4 + 51 + 768 + 576
    assert [chat.unescape(r.segment[i:j]) for i, j in zip(r.loss_spans[::2], r.loss_spans[1::2])] == ["see <|end|> ", "and both"]
    assert (rows[1].segment, rows[2].segment) == ("<|turn|>user<|content|><|end|>", "<|turn|><|content|><|end|>")
    assert chat.read_back(r.segment) == ("assistant", "see <|end|> and both")


def test_digests_against_brute_force(spark):
    rows = [(c, t, r, x) for c in range(9) for t, (r, x) in enumerate([("system", "a\\b"), ("user", "</s>[INST] ok"), ("assistant", "é😀 <|turn|>"), ("user", None), ("assistant", "")][:c % 6])]
    rows += [(50, 1, "assistant", "x" * 70_000), (51, 0, None, "no role"), (52, None, "user", "no turn"), (52, 0, "assistant", "y"), (None, 0, "user", "z"),
             (53, 0, "assistant", "same"), (53, 0, "assistant", "same")]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "conv_id long, turn long, role string, text string, n_turns int, segment string")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_turns(df)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, g in got.items():
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert g.n_turns == len(own) and g.loss_chars == len(loss) and g.loss_sha256 == sha(loss)
        assert g.turns_sha256 == sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own))
        assert g.formatted_chars == sum(len(f"<|turn|>{chat.escape(r[2] or '')}<|content|>{chat.escape(r[3] or '')}<|end|>") for r in own)
    assert chat.conversation_digests(chat.format_turns(df.limit(0))).collect() == []
