import random

import pytest
from pyspark.sql import functions as F

from joblark.llm import chat

MARKS = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>\n", "<</SYS>>", "[ROLE] ", "\\", "\\\\", "<", "[", "\\s>", "s>", " ", "\n", "é", "<\\s>", "/INST]", "a"]


@pytest.fixture(scope="module")
def formatted(spark):
    rng = random.Random(1)
    rows = []
    for c in range(150):
        for t in range(rng.randint(1, 6)):
            text = None if rng.random() < 0.05 else "".join(rng.choice(MARKS) for _ in range(rng.randint(0, 8)))
            rows.append((c, t, rng.choice(["user", "assistant", "system", "tool", "<s>", None, "a", "x\ny", "\\n", "a\\\n", "\n", "\\\\n</s>\n"]), text))
    rows += [(None, 1, "user", "x"), (None, None, "system", "first"), (900, 1, "user", "same"), (900, 1, "user", "same"), (901, 0, "user", "long " * 50_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, True) for r in rows], "conv_id long, turn long, role string, text string, formatted int, valid boolean").repartition(4)
    out = chat.format_chats(df)
    got = {r.conv_id: r for r in out.select("*", chat.read_back(F.col("formatted")).alias("turns"), chat.learned(F.col("segments")).alias("loss")).collect()}
    assert chat.format_chats(df.limit(0)).count() == 0
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    return got, want


def test_turns_come_back(formatted):
    got, want = formatted
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert got[c].loss == "".join(text for role, text in turns if role == "assistant")
        assert got[c].formatted == "".join(s.text for s in got[c].segments)


def test_texts_hold_no_control_strings(formatted):
    got, want = formatted
    for c, turns in want.items():
        assert got[c].formatted.count("<s>") == len(turns)
        for s in got[c].segments[1::3]:
            assert not any(x in s.text for x in chat.DEFAULT.control)


def test_machine(formatted):
    got, want = formatted
    moves = chat.DEFAULT.transitions
    for c, turns in want.items():
        state, stopped = "start", None
        for i, (role, _) in enumerate(turns):
            state = moves.get((state, role), "")
            if not state:
                stopped = i
                break
        assert got[c].stopped_at == stopped
        assert got[c].valid == (stopped is None and state in ("user", "assistant"))
