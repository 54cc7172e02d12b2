"""Conversations are parsed from their whole text, wherever its segments end."""

from __future__ import annotations

import hashlib
import random

import pytest

from cartoscope.llm import chat

SF = "/root/testdata/sf0.001"
PIECES = ["<s>", "</s>", "[INST] ", " [/INST]", "[ROLE]", "[/ROLE]", "<\\s>", "a", " ", "\n", "<", "é", "日"]


def conversations():
    rng = random.Random(6)
    rows = []
    for conv in [None, *range(25)]:
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "system", "", None, "</s>"])
            rows.append((conv, turn, role, rng.choice([None, "", "".join(rng.choices(PIECES, k=rng.randint(1, 30))), "x" * rng.randint(1, 400)])))
    return rows


@pytest.mark.parametrize("size", [1, 2, 7, 50, 1 << 16])
def test_segments_may_end_anywhere(spark, size):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.segments(df, size)
    assert all(len(r["segment"]) <= size for r in made.collect())
    got = {r["conv_id"]: r for r in chat.digests(made).collect()}
    for conv in {r[0] for r in rows}:
        own = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        said = "".join(t for r, t in own if r == "assistant")
        formatted = "".join(chat.format_turn(r, t) for r, t in own)
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"], r["formatted_chars"]) == (len(own), len(said), len(formatted))
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_torn_texts_are_refused():
    reader = chat._Reader(1)
    reader.read("<s>[INST] a [/INST]</s><s>b")
    with pytest.raises(ValueError):
        reader.row()
    with pytest.raises(ValueError):
        chat._Reader(1).read("x <s>a</s> and more of it")
