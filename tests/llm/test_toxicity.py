from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from odd import odd_rows

from pactlake.llm import recurrent
from pactlake.llm.toxicity import STRIDE, WINDOW, Batch, fit, score, train


def test_gradients_equal_differences():
    """Backward pass against numeric differences."""
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in recurrent.initial(3, 3, 2, 3, rng).items()}
    x = rng.standard_normal((5, 4))
    index = rng.integers(0, 5, (6, 4))
    mask = (np.arange(6)[:, None] < np.array([6, 3, 1, 5])).astype(np.float64)
    label = np.array([1.0, 0, 1, 0])
    _, g, d_x = recurrent.gradients(p, x, index, mask, label)
    loss = lambda: recurrent.gradients(p, x, index, mask, label)[0]
    for values, found in [*((p[k], g[k]) for k in g), (x, d_x)]:
        for at in list(np.ndindex(values.shape))[:: max(1, values.size // 6)]:
            before = values[at]
            values[at] = before + 1e-3
            up = loss()
            values[at] = before - 1e-3
            down = loss()
            values[at] = before
            assert abs((up - down) / 2e-3 - found[at]) < 2e-3


def test_windows_cover_all_words():
    for n in (0, 1, WINDOW, WINDOW + 1, WINDOW + STRIDE, 5 * WINDOW + 3):
        batch = Batch(pa.array([" ".join("abcdefgh"[i % 8] * (1 + i % 5) for i in range(n)), "one"]))
        begins, owner = batch.windows()
        mine = begins[owner == 0]
        covered = {i for b in mine for i in range(b, min(b + WINDOW, n))}
        assert covered == set(range(n)) and all(np.diff(mine) == STRIDE) and (owner == 1).sum() == 1
        index, mask = batch.laid_out(begins, owner)
        assert index.shape == mask.shape == (WINDOW, len(begins))


def corpus(seed, n):
    rng, rows = random.Random(seed), []
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    for i in range(n):
        words = [word() for _ in range(rng.choice((6, 40, 200)))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(("vile", "zqrotten" + word(), "zqrotten" + word()))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_accuracy(spark, documents, labels):
    """Bad words, and unknown words with a bad beginning, are found wherever they stand."""
    rows = corpus(3, 700)
    table = documents([(i, t, "en", "a") for i, t, _ in rows])
    found = score(table, fit(table, labels([(i, 1, y, "x") for i, _, y in rows]))).collect()
    truth = {i: y for i, _, y in rows}
    tested = [r for r in found if r["held_out"]]
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in tested)
    assert len(tested) > 100 and right >= 0.93 * len(tested)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)


def test_same_sample_same_model():
    rows = corpus(4, 120)
    one, two = (train([t for _, t, _ in rows], [y for *_, y in rows], passes=2) for _ in range(2))
    assert all((one.params[k] == two.params[k]).all() for k in one.params)


def test_odd_rows(documents, labels):
    table = documents(odd_rows())
    for known in ([], [(6, 1, 0, "x")], [(6, 1, 1, "x"), (7, 1, 0, "x"), (7, 1, None, "x"), (None, 1, 1, "x")]):
        found = score(table, fit(table, labels(known))).collect()
        assert len(found) == 9
        assert all(r["score"] == 0 and r["predicted"] == 0 for r in found if r["doc_id"] in (1, 2, 3))
        assert len({r["score"] for r in found if r["doc_id"] in (None, 5)}) == 1
    assert score(documents([]), fit(documents([]), labels([]))).count() == 0
