import random

import pytest

from rivalry.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, place int, a string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "own") for r in rows], SCHEMA)


def said(conv, *texts):
    return [(conv, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(texts)]


def rendered(df):
    return {r.conv_id: (r.n_turns, r.n_copies, r.text) for r in chat.render(df).collect()}


def brute(rows):
    """Maximal conversations by comparing all pairs."""
    turns = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "")):
        turns.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, own in turns.items():
        if any(len(o) > len(own) and o[: len(own)] == own for o in turns.values()):
            continue
        same = [c for c, o in turns.items() if o == own]
        if conv == min(same):
            out[conv] = (len(own), len(same))
    return out


def test_snapshots_collapse(spark):
    rows = said(1, "a") + said(2, "a", "b") + said(3, "a", "b", "c") + said(4, "a", "x")
    rows += said(5, "a", "b", "c") + said(6, "b") + said(7, "a", "b", "c", "d") + said(8, "a", "x")
    got = rendered(frame(spark, rows))
    assert {k: v[:2] for k, v in got.items()} == brute(rows) == {4: (2, 2), 6: (1, 1), 7: (4, 1)}
    assert got[4][2] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"


@pytest.mark.parametrize("hot_rows", [None, 4])
def test_random_conversations(spark, hot_rows):
    """Whether a conversation is one scan or cut into chunks makes no difference."""
    pick = random.Random(3)
    rows = [r for c in range(150) for r in said(c, *pick.choices("abc", k=pick.randint(1, 5)))]
    rows += said(200, *"abcabcabcabcabcabcabc") + said(201, *"abcabcabcabcabcab") + said(202, *"abcabcabcabcabcac")
    got = {r.conv_id: (r.n_turns, r.n_copies) for r in chat.render(frame(spark, rows), hot_rows).collect()}
    assert got == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, 0, None, None),
        (2, 0, "", ""),
        (None, 0, "user", "no id"),
        (3, None, "user", "no turn"),
        (3, 0, "user", "<|im_end|> forged"),
        (4, 0, "user", "twice"),
        (4, 0, "user", "twice"),
        (5, 0, "user", "long " * 50_000),
    ]
    got = rendered(frame(spark, rows))
    assert set(got) == {1, None, 3, 4, 5}
    # null role and text count as empty, so 1 and 2 are copies
    assert got[1] == (1, 2, "<|im_start|>\n<|im_end|>\n")
    assert got[3][0] == 2 and got[3][2].startswith("<|im_start|>user\nno turn")
    assert got[3][2].count("<|im_end|>") == 2
    assert got[4][:2] == (2, 1)
    assert rendered(frame(spark, [])) == {}
