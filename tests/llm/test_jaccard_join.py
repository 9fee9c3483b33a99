from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from odd import odd_rows

from pactlake.llm import jaccard_join
from pactlake.llm.components import components
from pactlake.llm.hashing import shingle_sets
from pactlake.llm.jaccard_join import intersections, jaccard_components, one_of_each_component, signatures
from pactlake.llm.scratch import Scratch


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    least = {d: d for d in sets}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


def edited(rng, words, share):
    return [rng.choice("pqrstuvw") * rng.randint(1, 9) if rng.random() < share else w for w in words]


def corpus(seed, families=12):
    rng, rows = random.Random(seed), []
    common = [rng.choice("abcdef") * rng.randint(1, 6) for _ in range(60)]
    for _ in range(families):
        base = [f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(rng.choice((3, 6, 9, 15, 40, 120, 400)))]
        if rng.random() < 0.5:
            base = base + common
        for _ in range(rng.choice((1, 2, 5, 12))):
            rows.append((len(rows), " ".join(edited(rng, base, rng.choice((0, 0.005, 0.01, 0.02, 0.05)))), "en", "a"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(documents, seed):
    rows = corpus(seed)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(documents(rows).repartition(3)).collect()}
    assert found == brute(rows)


def test_blocks_of_large_clusters(documents, monkeypatch):
    """Clusters above a block's size are cut and lose no link."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rows = corpus(5, 8)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(documents(rows)).collect()}
    assert found == brute(rows)


def test_odd_rows(documents):
    found = jaccard_components(documents(odd_rows())).collect()
    by_id = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found}
    assert len(found) == 9
    assert by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[3] == (0, 3)
    assert by_id[None] == by_id[5] == (by_id[5][0], 5)
    assert by_id[6] == (1, 6) and by_id[8] == (1, 8) and by_id[7] == (5000, 7)
    assert jaccard_components(documents([])).count() == 0


def test_similar_sets_share_signatures():
    """Sets at the threshold share as many signatures as the screen asks for."""
    rng = random.Random(8)
    for n in (4, 5, 9, 20, 63, 64, 65, 300):
        for m in {n, -(-4 * n // 5)}:
            common = -(-4 * (n + m) // 9)
            pool = np.array(rng.sample(range(1 << 40), n + m), np.uint64)
            a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:common], pool[n : n + m - common]]))
            for fill in (2, 3):
                sides = []
                for x in (a, b):
                    index, level, filled, most, entry, signature = signatures(x, np.array([0, len(x)]), fill)
                    sides.append({int(v): (set(signature[entry == e].tolist()), int(filled[e] - most[e])) for e, v in enumerate(level)})
                assert any(
                    len(sides[0][v][0] & sides[1][v][0]) >= max(1, sides[0][v][1], sides[1][v][1]) for v in sides[0].keys() & sides[1].keys()
                ), (n, m, fill)


def test_shingle_sets():
    texts = ["One two  three four five SIX", "", None, "a b", "é É", "a\x0bb\x0cc d e f\x00", "one two three four five six"]
    values, starts = shingle_sets(pa.array(texts))
    assert np.diff(starts).tolist() == [len(shingles(t)) for t in texts]
    assert (values[: starts[1]] == values[starts[6] :]).all()


def test_intersections():
    rng = random.Random(4)
    sets = [sorted(rng.sample(range(60), rng.randint(0, 30))) for _ in range(40)]
    values = np.array([x for s in sets for x in s], np.uint64)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    assert (intersections(values, starts) == [[len(set(a) & set(b)) for b in sets] for a in sets]).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 199), (7, 7)]
    with Scratch(spark, "test") as scratch:
        found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 199: 199, 200: 199}


def test_rows_without_an_id_of_their_own(documents):
    """Null ids and different texts under one id are documents of their own."""
    text = lambda name, changed=(): " ".join(f"{name}{'x' if i in changed else ''}{i}" for i in range(80))
    rows = [
        (None, text("a")), (None, text("b")), (None, text("b", (79,))), (None, text("c")), (None, text("c")), (7, text("c", (0,))),
        (1, text("d")), (1, text("e")), (1, text("e")), (2, text("e", (79,))), (3, text("f")), (3, text("f", (0,))), (4, ""), (4, " "), (None, ""),
    ]
    table = documents([(*r, "en", "a") for r in rows])
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    found = sorted(((r["doc_id"], r["component_id"]) for r in jaccard_components(table).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or 0))
    assert found == [(1, 1)] * 3 + [(2, 1), (3, 3), (3, 3), (4, 4), (4, 4), (7, 7)] + [(None, None)] * 4 + [(None, 7)] * 2
    kept = one_of_each_component(table.repartition(3))
    assert kept.columns == table.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=key)
    b, f = ([k for k in kept if k[1] in (text(name), text(name, (at,)))] for name, at in (("b", 79), ("f", 0)))
    assert len(b) == 1 and b[0][0] is None and len(f) == 1 and f[0][0] == 3
    assert [k for k in kept if k not in b + f] == sorted([(None, text("a")), (7, text("c", (0,))), (1, text("d")), (1, text("e")), (4, ""), (4, " "), (None, "")], key=key)
