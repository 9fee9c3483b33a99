from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from odd import odd_rows

from pactlake.llm.importance import corpus_counts, features, log_ratio, log_weights, resample
from pactlake.llm.selection import mark_largest


def test_weights_equal_brute_force(documents):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 30))) for _ in range(40)]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    lists = [features(pa.array([t]), 64)[0].tolist() for t in texts]
    raw, target = Counter(x for f in lists for x in f), Counter(x for f in lists[:10] for x in f)
    assert corpus_counts(documents(rows), 64).tolist() == [raw[i] for i in range(64)]
    p, q = np.array([target[i] for i in range(64)]), np.array([raw[i] for i in range(64)])
    found = {r["doc_id"]: r["log_weight"] for r in log_weights(documents(rows), log_ratio(p, q)).collect()}
    total = lambda c: sum(c.values()) + 64
    for i, f in enumerate(lists):
        expected = sum(math.log((target[x] + 1) / total(target)) - math.log((raw[x] + 1) / total(raw)) for x in f)
        assert found[i] is None if not f else abs(found[i] - expected) < 1e-9


def test_selects_the_largest(documents, labels):
    rng = random.Random(1)
    good = lambda: " ".join(rng.choice(["oak", "elm", "ash", "yew"]) for _ in range(30))
    bad = lambda: " ".join(rng.choice(["spam", "buy", "oak", "win"]) for _ in range(30))
    rows = [(i, good() if i % 4 else bad(), "en", "a") for i in range(400)]
    known = labels([(i, int(i % 4 > 0), 0, "x") for i in range(0, 400, 3)])
    found = resample(documents(rows), known).collect()
    k = round(400 * sum(i % 4 > 0 for i in range(0, 400, 3)) / 134)
    chosen = {r["doc_id"] for r in found if r["selected"]}
    assert chosen == {r["doc_id"] for r in sorted(found, key=lambda r: -r["noisy"])[:k]}
    assert sum(d % 4 > 0 for d in chosen) >= 0.97 * len(chosen)
    again = {r["doc_id"] for r in resample(documents(rows[::-1]).repartition(5), known).collect() if r["selected"]}
    assert again == chosen


def test_mark_largest(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, rng.gauss(0, 50), 1.5, -3.25])) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v double")
    some = sorted((r for r in rows if r[1] is not None), key=lambda r: (-r[1], r[0]))
    for k in (0, 1, 100, len(some), 1000):
        found = {r["id"] for r in mark_largest(df, "v", "id", k, "top").collect() if r["top"]}
        assert found == {r[0] for r in some[:k]}


def test_odd_rows(documents, labels):
    for known in ([], [(5, 1, 0, "x"), (7, 0, 0, "x"), (None, None, None, "x")]):
        found = resample(documents(odd_rows()), labels(known)).collect()
        assert len(found) == 9
        assert all(r["log_weight"] is None and not r["selected"] for r in found if r["doc_id"] in (1, 2, 3))
    assert resample(documents([]), labels([])).count() == 0
