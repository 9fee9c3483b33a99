from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pactlake.llm.vector_codes import PartBounds, adapted, codebooks_digest, compress, decode, described


def brute_force(rows, parts, entries, rounds, scale):
    """Lloyd's rounds of every part position over plain integers, every distance measured."""
    kept = []
    for vec_id, vector, label in rows:
        if vector and all(x is not None and np.isfinite(x) for x in vector):
            kept.append((vec_id, [int(np.floor(scale * float(np.float32(x)))) for x in vector], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([v for _, v, _ in kept]).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    nearest = lambda p: ((x[:, p, None] - books[p]) ** 2).sum(axis=2).argmin(axis=1)
    for _ in range(rounds):
        for p in range(parts):
            code = nearest(p)
            for e in range(books.shape[1]):
                if (code == e).any():
                    books[p, e] = x[code == e, p].sum(axis=0) // (code == e).sum()
    codes = np.stack([nearest(p) for p in range(parts)], axis=1)
    errors = sum(((x[:, p] - books[p][codes[:, p]]) ** 2).sum(axis=1) for p in range(parts))
    return sorted((str(k[0]), bytes(c.astype("u1")), int(e)) for k, c, e in zip(kept, codes, errors, strict=True)), books


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, code string")


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(7, 16))
    rows = [(int(i), (centres[i % 7] + rng.normal(size=16) * 0.2).round(3).tolist(), [None, 1, 2][i % 3]) for i in rng.permutation(300)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(60)]  # one very common vector
    rows += [(2000, None, 1), (2001, [], 1), (2002, [1.0] * 15 + [None], 1), (2003, [float("inf")] * 16, None), (2004, [float("nan")] * 16, 2)]
    rows += [(None, [0.1] * 16, None), (None, [0.1] * 16, None), (4, [-0.00001] * 16, 2)]
    return rows


@pytest.mark.parametrize("parts, entries, rounds", [(4, 16, 6), (8, 16, 3), (2, 5, 4), (16, 3, 2), (1, 1, 2), (4, 2, 0), (2, 256, 1)])
def test_equals_brute_force(spark, vectors, parts, entries, rounds):
    found, books = compress(table(spark, vectors).repartition(5), parts, entries, rounds)
    expected, expected_books = brute_force(vectors, parts, entries, rounds, 4096)
    assert found.columns == ["vec_id", "label", "code", "error"]
    assert sorted((str(r.vec_id), bytes(r.code), r.error) for r in found.collect()) == expected
    assert (books == expected_books).all()


def test_codes_stand_for_their_vectors(spark, vectors):
    rows = [r for r in vectors if r[0] is not None and r[0] < 300]
    found, books = compress(table(spark, rows), 4)
    errors = {r.vec_id: r.error for r in found.collect()}
    given_ = {r[0]: np.floor(4096 * np.array(r[1], np.float32).astype(float)) for r in rows if r[0] != 4}
    for r in decode(found, books).collect():
        if r.vec_id != 4:
            assert ((np.array(r.embedding) * 4096 - given_[r.vec_id]) ** 2).sum() == errors[r.vec_id]


def test_described(spark, vectors):
    found, books = compress(table(spark, vectors[:-1]), 4)  # of the same id there are rows of one label only
    labels = {str(r.vec_id): r.label for r in found.collect()}
    rows = described(found, books).collect()
    assert rows and {r.codebooks_sha256 for r in rows} == {codebooks_digest(books)}
    for label in set(labels.values()):
        mine = [r for r in rows if labels[str(r.vec_id)] == label]
        assert {r.label_error for r in mine} == {sum(r.error for r in mine)}
    assert all(len(r.code) == 8 and r.code == r.code.lower() for r in rows)


def test_odd_tables(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1)]):
        found, books = compress(table(spark, rows))
        assert described(found, books).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        compress(table(spark, [(1, [1.0] * 9, 1)]))
    found, _ = compress(table(spark, [(1, [1.0] * 16, 1), (2, [1.0] * 8, 1)]))
    assert [r.vec_id for r in found.collect()] == [1]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 20), st.integers(1, 6), st.integers(1, 40), st.sampled_from([3, 50, 4000]))
def test_bounds_never_hide_the_nearest_entry(seed, entries, size, rows, spread):
    """Entries that move at random, with lists whose lengths change, on a grid with many ties."""
    rng = np.random.default_rng(seed)
    x, book = rng.integers(-spread, spread, (rows, 3)), rng.integers(-spread, spread, (entries, 3))
    bounds, drift = PartBounds.unknown(rows), np.zeros(entries)
    for _ in range(6):
        bounds = bounds.moved(drift).resized(size).settled(x, book)
        apart = x[:, None, :] - book
        exact = (apart * apart).sum(axis=2)
        assert (bounds.near[:, 0] == exact.argmin(axis=1)).all()
        distance = np.sqrt(exact.astype(float))
        for i in range(rows):
            listed = [int(e) for e in bounds.near[i] if e >= 0]
            assert bounds.low[i, 0] >= distance[i, listed[0]]
            assert all(bounds.low[i, j] <= distance[i, e] for j, e in enumerate(bounds.near[i].tolist()) if j and e >= 0)
            assert all(bounds.outer[i] <= distance[i, e] for e in range(entries) if e not in listed)
        after = book + rng.integers(-2, 3, book.shape) * (rng.random((entries, 1)) < 0.5)
        drift = np.nextafter(np.sqrt(((after - book) ** 2).sum(axis=1).astype(float)), np.inf)
        book, size = after, int(rng.integers(1, 7))


def test_few_parts_are_measured_once_entries_hardly_move():
    rng = np.random.default_rng(1)
    x, book = rng.integers(-4000, 4000, (500, 8)), rng.integers(-4000, 4000, (16, 8))
    bounds = PartBounds.unknown(500).resized(4).settled(x, book)
    assert (bounds.need == 5).all()
    again = bounds.moved(np.full(16, 3.0)).settled(x, book)
    assert (again.need == 0).mean() > 0.9


def test_list_lengths_follow_the_need():
    assert adapted(4, np.array([1000, 0, 0, 0, 0, 0]), 16) == 2
    assert adapted(4, np.array([900, 0, 40, 60, 0, 0]), 16) == 3
    assert adapted(4, np.array([900, 0, 0, 0, 0, 100]), 16) == 8
    assert adapted(8, np.array([0] * 9 + [100]), 16) == 8
    assert adapted(1, np.array([0, 0, 5]), 1) == 1
