from __future__ import annotations

import random

import pytest
from odd import odd_rows

from pactlake.llm.mixing import mix, plan_mix


def waterfill(sizes, weights, budget, repeats):
    """Targets by resharing the excess until none is above."""
    capped, target = set(), {}
    while True:
        rest = [s for s in sizes if s not in capped]
        left = budget - sum(repeats * sizes[s] for s in capped)
        target = {s: repeats * sizes[s] if s in capped else left * weights[s] / sum(weights[r] for r in rest) for s in sizes}
        over = {s for s in rest if target[s] > repeats * sizes[s]}
        if not over:
            return target
        capped |= over


def test_targets_and_shares(documents):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(1, 40))), "en", rng.choice("aaaaaaaabbcde")) for i in range(600)]
    found = plan_mix(documents(rows)).collect()
    source = {r[0]: r[3] for r in rows}
    sizes = {s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in "abcde"}
    expected = waterfill(sizes, dict(zip("abcde", (5, 2, 1, 5, 2), strict=True)), sum(sizes.values()), 3)
    taken = dict.fromkeys("abcde", 0)
    for r in found:
        assert r["target"] == pytest.approx(expected[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["source"] == source[r["doc_id"]] and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert sum(taken.values()) <= sum(sizes.values()) < sum(taken.values()) + 41
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 41


def test_mix_repeats_whole_documents_in_order(documents):
    rows = [(i, f"a b c d {i}", "en", "big" if i % 10 else "small") for i in range(200)]
    plan = {r["doc_id"]: r["copies"] for r in plan_mix(documents(rows)).collect()}
    out = mix(documents(rows))
    assert out.columns == [*documents([]).columns, "epoch", "virtual_start"]
    got = out.collect()
    assert [r["virtual_start"] for r in got] == sorted(r["virtual_start"] for r in got)
    assert {d: sum(r["doc_id"] == d for r in got) for d in plan} == plan
    again = [(r["doc_id"], r["epoch"]) for r in mix(documents(rows[::-1])).collect()]
    assert again == [(r["doc_id"], r["epoch"]) for r in got]


def test_odd_rows(documents):
    found = plan_mix(documents(odd_rows())).collect()
    assert len(found) == 9
    assert all(r["taken"] == 0 for r in found if r["size"] == 0)
    assert {r["source"] for r in found} == {"a", "b", "c", None}
    assert plan_mix(documents([])).count() == 0
    assert mix(documents([])).count() == 0
    assert all(r["taken"] == 0 for r in plan_mix(documents([(1, None, "en", "a"), (2, " ", "en", "b")])).collect())
