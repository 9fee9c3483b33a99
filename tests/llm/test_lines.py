from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from odd import odd_rows

from pactlake.llm.lines import BUCKETS, SIMILAR, _met, key_count, keys_of, least_common, line_figures, repeated_lines, without_lines
from pactlake.llm.shipping import ship


def brute(rows):
    lines = [(d, i, frozenset(x.lower().split())) for d, t, *_ in sorted(rows) for i, x in enumerate((t or "").split("\n"))]
    return {
        (d, i) for at, (d, i, w) in enumerate(lines)
        if w and any(100 * len(w & v) >= 80 * len(w | v) for _, _, v in lines[:at])
    }


def made(seed, n=60):
    rng, rows = random.Random(seed), []
    word = lambda: f"{rng.choice('abcdefgh')}{int(rng.paretovariate(0.6)) % 500}"
    family = [[word() for _ in range(k)] for k in (1, 2, 4, 5, 9, 10, 18, 30, 60)]
    for d in range(n):
        lines = []
        for _ in range(rng.randint(0, 6)):
            words = list(rng.choice(family)) if rng.random() < 0.6 else [word() for _ in range(rng.choice((1, 3, 8, 30)))]
            for _ in range(rng.choice((0, 0, 1, 2, 5))):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.randint(0, 1)] = [word()] if rng.random() < 0.7 else []
            if rng.random() < 0.3:
                rng.shuffle(words)
            lines.append(" ".join(words).upper() if rng.random() < 0.2 else " ".join(words))
        rows.append((d, "\n".join(lines), "en", "a"))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(documents, seed):
    rows = made(seed)
    found = repeated_lines(documents(rows).repartition(5))
    assert {(r["doc_id"], r["line"]) for r in found.collect()} == brute(rows)


def test_texts_and_figures(documents):
    rows = [(1, "one two three\nfour five six seven eight", "en", "a"), (2, "One  two three\n\nnine", "en", "a"), (3, "eight seven six five\tfour", "en", "a")]
    table = documents(rows)
    removed = repeated_lines(table)
    assert {r["doc_id"]: r["text"] for r in without_lines(table, removed).collect()} == {1: rows[0][1], 2: "\nnine", 3: ""}
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in line_figures(table, removed).collect()} == {1: (2, 0), 2: (3, 1), 3: (1, 1)}


def test_odd_rows(documents):
    table = documents(odd_rows())
    removed = repeated_lines(table)
    assert {(r["doc_id"], r["line"]) for r in removed.collect()} == {(5, 0)}
    kept = without_lines(table, removed)
    assert kept.columns == table.columns and kept.count() == 9
    assert repeated_lines(documents([])).count() == 0
    assert line_figures(documents([]), repeated_lines(documents([]))).count() == 0


def test_families_of_variants(documents, monkeypatch):
    """Groups above the size that is listed pair by pair."""
    monkeypatch.setattr("pactlake.llm.lines.FEW", 3)
    rng, base = random.Random(9), [f"w{i}" for i in range(40)]
    rows = []
    for d in range(80):
        words = [w if rng.random() > 0.06 else f"v{rng.randint(0, 99)}" for w in base]
        rows.append((d, " ".join(words) + "\n" + " ".join(base[: rng.choice((5, 8, 9, 10, 11, 12, 13))]), "en", "a"))
    assert {(r["doc_id"], r["line"]) for r in repeated_lines(documents(rows)).collect()} == brute(rows)


def test_similar_lines_share_keys():
    rng = random.Random(1)
    for n in [*range(2, 40), 100]:
        for m in range(-(-4 * n // 5), n + 1):
            common = least_common(n, m)
            for _ in range(5):
                pool = rng.sample(range(1 << 30), n + m - common)
                x, y = sorted(pool[:n]), sorted(pool[:common] + pool[n:])
                values = np.array(x + y, np.uint64)
                line, key = keys_of(values, np.array([0, n, n + m]))
                assert set(key[line == 0].tolist()) & set(key[line == 1].tolist()), (n, m)


@pytest.mark.parametrize("n,m", [(10, 10), (10, 11), (13, 13), (13, 14), (18, 18)])
def test_similar_lines_share_keys_in_every_arrangement(n, m):
    common = least_common(n, m)
    size, at = n + m - common, range(n + m - common)
    lines = []
    for own in combinations(at, n - common):
        rest = [i for i in at if i not in own]
        for others in combinations(rest, m - common):
            lines += [[i for i in at if i not in others], [i for i in at if i not in own]]
    assert {len(line) for line in lines[::2]} == {n} and {len(line) for line in lines[1::2]} == {m} and size <= 20
    starts = np.concatenate([[0], np.cumsum([len(line) for line in lines])])
    line, key = keys_of(np.array([i for words in lines for i in words], np.uint64), starts)
    found = [set() for _ in lines]
    for i, k in zip(line.tolist(), key.tolist(), strict=True):
        found[i].add(k)
    lost = [i for i in range(0, len(lines), 2) if not found[i] & found[i + 1]]
    assert not lost, (len(lost), len(lines) // 2)


@pytest.mark.parametrize("run", [2, 3])
def test_key_count_is_least_over_every_partner(run):
    for n in range(10, 400):
        sizes = range(-(-SIMILAR * n // 100), 100 * n // SIMILAR + 1)
        shared = min(least_common(n, m) - (run - 1) * (1 + n + m - 2 * least_common(n, m)) for m in sizes)
        assert key_count(np.array([n]), run)[0] == min(n - run + 2 - shared, n - run + 1)


def test_copies_and_unlike_lines_do_not_meet(documents):
    """What shuffles after the keys have met is near copies alone: neither copies nor lines with a rare run of words in common."""
    rows = [(d, " ".join(f"w{i}" for i in range(30)), "en", "a") for d in range(40)]
    rows += [(100 + d, "rare pair " + " ".join(f"v{d}x{i}" for i in range(30)), "en", "a") for d in range(20)]
    table = documents(rows).select("doc_id", "text").coalesce(1)
    ship(table.sparkSession)
    places = np.roll(np.arange(BUCKETS), 5)
    assert _met(table, places, 3).where("to_doc IS NOT NULL").count() == 0
    near = [(1, rows[0][1], "en", "a"), (2, rows[0][1] + " more", "en", "a")]
    met = _met(documents(near).select("doc_id", "text").coalesce(1), places, 3).collect()
    assert [(r["doc_id"], r["to_doc"]) for r in met] == [(2, 1)]


def test_copies_stand_for_the_first(documents):
    """In each part the later copy comes first, so that the first line of its kind makes no keys of its own; ids are shared."""
    words = [f"w{i}" for i in range(20)]
    near = lambda i: " ".join([*words, f"x{i}"])
    rows = [(9, near(1), "en", "a"), (3, near(1), "en", "a"), (1, near(2), "en", "a"), (9, near(3), "en", "a"), (3, "other line", "en", "a")]
    assert {(r["doc_id"], r["line"]) for r in repeated_lines(documents(rows).coalesce(1)).collect()} == {(9, 0), (3, 0)}


def test_the_session_is_left_as_it_was(documents):
    table, key = documents([(1, "a b\na b", "en", "a")]), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = table.sparkSession.conf.get(key)
    assert repeated_lines(table).count() == 1 and table.sparkSession.conf.get(key) == before
