from __future__ import annotations

import random

import pytest
from odd import odd_rows  # noqa: F401

from pactlake.llm.chat import BEGIN, END, TOKEN_BYTES, format_windows, read_windows

SCHEMA = "conv_id long, turn long, role string, text string, place string, block string, tokens string, slot string"


@pytest.fixture
def conversations(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def made(seed, n=30):
    rng, rows = random.Random(seed), []
    pieces = ["hello", "<|im_end|>", "\\", "<|", "|>", "\n", "é", "<\\1", "\\0", "😀", " ", "x" * 90]
    for c in range(n):
        turns = rng.choice((1, 2, 3, 8, 40))
        for t in range(turns):
            role = "system" if t == 0 and c % 3 == 0 else ("assistant" if t % 2 else "user")
            rows.append((c, t, role, "".join(rng.choice(pieces) for _ in range(rng.choice((0, 3, 30))))))
    return rows


@pytest.mark.parametrize("budget,history", [(1024, 128), (120, 30), (10, 5)])
def test_round_trip(conversations, budget, history):
    rows = made(1)
    windows = format_windows(conversations(rows).repartition(4), budget, history)
    said, learned = {}, {}
    for r in sorted(read_windows(windows).collect(), key=lambda r: r["window"]):
        said.setdefault(r["conv_id"], []).extend((t["role"], t["text"]) for t in r["turns"])
        learned.setdefault(r["conv_id"], []).extend(r["learned"])
    for c in {r[0] for r in rows}:
        own = [(role, text) for conv, _, role, text in sorted(rows) if conv == c]
        assert said[c] == own
        assert learned[c] == [text for role, text in own if role == "assistant"]


def test_budget_history_and_system(conversations):
    rows = [(1, 0, "system", "be brief")] + [(1, t, "assistant" if t % 2 == 0 else "user", f"turn {t} " + "w" * 60) for t in range(1, 40)]
    windows = sorted(format_windows(conversations(rows), 200, 50).collect(), key=lambda r: r["window"])
    assert len(windows) > 3
    piece = lambda r: f"{BEGIN}{r[2]}\n{r[3]}{END}"
    place = 0
    for i, w in enumerate(windows):
        assert w["tokens"] <= 200 and w["formatted"].startswith(piece(rows[0]))
        fresh = w["turns"] - w["repeated"]
        own = rows[place : place + fresh]
        place += fresh
        before = rows[max(1, place - fresh - (w["repeated"] - 1)) : place - fresh] if i else []
        assert w["formatted"] == "".join(map(piece, ([rows[0]] if i else []) + before + own))
        history = sum(-(-len(piece(r).encode()) // TOKEN_BYTES) for r in before)
        assert history <= 50 and (not i or history + 25 > 50)
        assert [w["formatted"][s["begin"] : s["end"]] for s in w["loss"]] == [r[3] for r in own if r[2] == "assistant"]
    assert place == len(rows)


def test_blocks_of_a_long_conversation(conversations, monkeypatch):
    rows = [(7, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(300)]
    whole = {(r["window"], r["formatted"]) for r in format_windows(conversations(rows), 100, 20).collect()}
    monkeypatch.setattr("pactlake.llm.chat.BLOCK", 7)
    assert {(r["window"], r["formatted"]) for r in format_windows(conversations(rows), 100, 20).collect()} == whole


def test_odd_conversations(conversations):
    rows = [(1, None, None, None), (1, 2, "assistant", None), (None, 0, "a\nb\\2", "x"), (2, 0, "user", "same"), (2, 0, "user", "same"),
            (3, 0, "system", "alone"), (4, 5, "assistant", "y" * 50_000), (4, 6, "user", ""), (5, 0, "user", "q"), (5, 1, "system", "late")]
    found = {}
    for r in sorted(read_windows(format_windows(conversations(rows), 100, 20)).collect(), key=lambda r: r["window"]):
        found.setdefault(r["conv_id"], []).extend((t["role"], t["text"]) for t in r["turns"])
    assert found == {
        1: [("", ""), ("assistant", "")], None: [("a\nb\\2", "x")], 2: [("user", "same")] * 2, 3: [("system", "alone")],
        4: [("assistant", "y" * 50_000), ("user", "")], 5: [("user", "q"), ("system", "late")],
    }
    assert format_windows(conversations([])).count() == 0


def test_no_python_runs(conversations):
    plan = read_windows(format_windows(conversations(made(2, 3))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
