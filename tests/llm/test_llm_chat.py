from __future__ import annotations

from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import chat

PIECES = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "[", "s>", "/s>", "é", "\n", " ", "a", "\U0001f600"]), max_size=12).map("".join)


@given(st.lists(st.tuples(PIECES, PIECES), max_size=5))
@settings(max_examples=300, deadline=None)
def test_rendering_is_reversible(turns):
    text, spans, _ = chat.render(turns)
    assert chat.parse(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for _, t in turns]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), PIECES), max_size=5))
@settings(max_examples=100, deadline=None)
def test_masks_hold_the_assistant_texts(turns):
    text, spans, roles = chat.render(turns)
    e = TOKENIZER.encode(text, add_special_tokens=False)
    offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
    mask = chat.loss_mask(offsets[:, 0], offsets[:, 1], [s for s, r in zip(spans, roles, strict=True) if r == "assistant"])
    said = chat.masked_texts(text, offsets[:, 0].tolist(), offsets[:, 1].tolist(), mask.tolist())
    assert said == [t for r, t in turns if r == "assistant" and t]


with open(chat.TOKENIZER, encoding="utf-8") as f:
    TOKENIZER = chat.load(f.read())


def expected(rows):
    """Digests of rows (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    found = {}
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(t for _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        found[conv] = (len(turns), sha256(whole.encode()).hexdigest(), len(said), sha256(said.encode()).hexdigest())
    return found


def got(df):
    rows = df.collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}


def test_given_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    want = expected([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)])
    df = chat.chat(spark, sf_dir)
    assert got(df) == want
    row = df.filter("conv_id = -7").first()
    assert row["loss_chars"] == 21 and row["formatted_chars"] > 50


def test_odd_inputs(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "a"), (1, 1, None, "a"), (1, 1, "assistant", "b"), (None, 0, "assistant", "</s>"), (2, None, "assistant", "first"), (2, 0, "assistant", "second"), (3, 5, "a<t>b", "<s><t></s>"), (4, 0, "assistant", "long \n" * 30_000)]
    rows += [(9, i, "assistant" if i % 2 else "user", f"turn {i} <s> " * 3) for i in range(400)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    want = expected(rows)
    assert got(chat.digests(chat.formatted(docs))) == want
    pieces = chat.formatted(docs, chat.Settings(piece_chars=500))
    assert got(chat.digests(pieces)) == want
    for r in pieces.collect():
        assert len(r["token_ids"]) == len(r["starts"]) == len(r["ends"]) == len(r["loss"])
        assert "".join(r["formatted"][a:b] for a, b in dict.fromkeys(zip(r["starts"], r["ends"], strict=True))) == r["formatted"]
    assert chat.digests(chat.formatted(docs.limit(0))).collect() == []
