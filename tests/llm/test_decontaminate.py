from __future__ import annotations

import random

from odd import PROSE, odd_rows

from pactlake.llm.decontaminate import contamination, without_contaminated


def shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def items(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, doc_id string")


def test_equals_brute_force(spark, documents):
    rng = random.Random(2)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randint(0, 300)}"
    tests = [(i, " ".join(word() for _ in range(rng.choice((2, 5, 6, 12, 30, 70))))) for i in range(25)]
    rows = []
    for d in range(120):
        words = [word() for _ in range(rng.choice((0, 30, 300)))]
        if d % 2:
            item = rng.choice(tests)[1].split()
            if rng.random() < 0.5:
                item[rng.randrange(len(item))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = item
        rows.append((d, " ".join(words).upper() if d % 3 else "\n".join(words), "en", "a"))
    expected = {
        (d, i, len(shingles(t)), len(shingles(t) & shingles(text)))
        for d, text, *_ in rows for i, t in tests if 100 * len(shingles(t) & shingles(text)) >= 80 * len(shingles(t))
    }
    found = contamination(documents(rows), items(spark, tests))
    assert {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in found.collect()} == expected and len(expected) > 20
    kept = {r["doc_id"] for r in without_contaminated(documents(rows), items(spark, tests)).collect()}
    assert kept == {r[0] for r in rows} - {e[0] for e in expected}


def test_odd_rows(spark, documents):
    tests = [(1, None), (2, ""), (3, PROSE), (4, "short."), (None, PROSE), (3, PROSE.upper())]
    found = [(r["doc_id"], r["item_id"]) for r in contamination(documents(odd_rows()), items(spark, tests)).collect()]
    assert sorted(found, key=str) == sorted([(None, 3), (None, None), (5, 3), (5, None), (6, 4)], key=str)
    assert contamination(documents([]), items(spark, tests)).count() == 0
    assert contamination(documents(odd_rows()), items(spark, [])).count() == 0
    kept = without_contaminated(documents(odd_rows()), items(spark, tests))
    assert kept.columns == documents([]).columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 7, 8]


def test_no_python_runs(spark, documents):
    plan = contamination(documents(odd_rows()), items(spark, [(1, PROSE)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
