import random

import pytest

from panelcast.llm import preference as p

ROWS = "conv_id long, turn long, role string, text string, prompt string, last int, differ int"
PAIR = "k int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string"
CHAT = p.ChatFormat()


def brute(chosen, rejected, chat=CHAT):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    show = lambda ts: "".join(chat.open.replace("{role}", r) + t + chat.close for r, t in ts)
    return n, show(chosen[:n]), show(chosen[n:]), show(rejected[n:])


@pytest.mark.parametrize("chat", [CHAT, p.ChatFormat(open="[", close="]", trained=("assistant", "tool"))])
def test_pairs_equal_brute_force(spark, chat):
    rng = random.Random(1)
    pairs = []
    for k in range(60):
        shared = [(rng.choice(["user", "assistant", "tool"]), rng.choice(["", "é", "two words", "x\ny"])) for _ in range(rng.randint(0, 4))]
        sides = [shared + [(rng.choice(["user", "assistant"]), rng.choice("abc")) for _ in range(rng.randint(0, 3))] for _ in range(2)]
        pairs.append((k, *sides, "clash"))
    got = {r.k: r for r in p.preferences(spark.createDataFrame(pairs, PAIR), chat).collect()}
    assert len(got) == 60
    for k, a, b, _ in pairs:
        r = got[k]
        assert (r.prompt_turns, r.prompt, r.chosen, r.rejected) == brute(a, b, chat)
        assert r.differ == (a != b)
        for side, turns in ((r.chosen, a), (r.rejected, b)):
            spans = r.chosen_spans if side is r.chosen else r.rejected_spans
            want = [t + chat.close for role, t in turns[r.prompt_turns :] if role in chat.trained]
            assert [side[s.start : s.end] for s in spans] == want


def test_null_and_empty_sides(spark):
    rows = [(1, None, [("user", "a")], "x"), (2, [], [], None), (3, None, None, "x")]
    got = {r.k: r for r in p.preferences(spark.createDataFrame(rows, PAIR)).collect()}
    assert (got[1].prompt_turns, got[1].chosen, got[1].differ) == (0, "", True)
    assert (got[2].prompt, got[2].differ, got[3].rejected_spans, got[3].differ) == ("", False, [], False)
    assert p.preferences(spark.createDataFrame([], PAIR)).collect() == []


def test_conversations_and_their_alternatives(spark):
    rows = [
        (1, 2, "user", "q2"), (1, 1, "assistant", "a1"), (1, 0, "user", "q1"), (1, 3, "assistant", "a2"), (1, 4, "user", "bye"),
        (2, 0, "user", "only"), (3, 0, "assistant", "hi"), (3, None, None, None), (4, 0, "user", "x"), (4, 0, "user", "x"), (4, 0, "assistant", "x"),
        (None, 0, "user", "lost"),
    ]
    held = p.turns_of(spark.createDataFrame([(*r, "p", 1, 2) for r in rows], ROWS))
    out = {r.conv_id: [tuple(t) for t in r.turns] for r in held.collect()}
    assert out == {
        1: [("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("assistant", "a2"), ("user", "bye")],
        2: [("user", "only")], 3: [("assistant", "hi"), ("", "")], 4: [("assistant", "x"), ("user", "x"), ("user", "x")],
    }
    other = {r[0]: [tuple(t) for t in r[1]] for r in held.select("conv_id", p.rejected_turns(held.turns)).collect()}
    assert other == {1: out[1][:3] + [("assistant", "a1")], 2: out[2], 3: [("assistant", "")], 4: [("assistant", "")]}
    assert p.turns_of(spark.createDataFrame([], ROWS)).collect() == []
