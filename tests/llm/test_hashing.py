from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa

from pactlake.llm.hashing import lower, shingle_sets, span_hashes, utf8, words


def hashes(texts, seed=0):
    data, offsets = utf8(pa.array(texts, pa.string()))
    begins, ends, _ = words(data, offsets)
    return span_hashes(data, begins, ends, seed)


def test_unlike_words_have_unlike_hashes():
    short = ["".join(x) for n in range(1, 12) for x in itertools.product("ab", repeat=n)]
    # Words made by doubling with letters exchanged are what a sum over letters cannot tell apart.
    a, b = "ab", "ba"
    grown = []
    for _ in range(12):
        a, b = a + b, b + a
        grown += [a, b]
    rng = np.random.default_rng(1)
    long = ["".join(rng.choice(["a", "b"], n)) for n in (9, 16, 17, 63, 64, 65, 1024) for _ in range(200)]
    said = list(dict.fromkeys(short + grown + long))
    assert len(set(hashes(said).tolist())) == len(said) and len(set(hashes(said, 1).tolist()) | set(hashes(said).tolist())) == 2 * len(said)


def test_a_hash_depends_on_the_word_alone():
    said = ["a", "abcdefgh", "abcdefghi", "x" * 64, "x" * 65, "ü" * 40, "y" * 5000]
    one = [int(hashes([w])[0]) for w in said]
    assert hashes([" ".join(said), *said[::-1]]).tolist() == one + one[::-1]
    assert hashes(["".join(said[:2]) + " " + said[2]]).tolist()[1] == one[2]
    assert hashes(["", None]).tolist() == []


def test_sets_of_structured_texts_differ():
    a, b = "ab", "ba"
    for _ in range(9):
        a, b = a + b, b + a
    values, starts = shingle_sets(pa.array([f"one two three four {a}", f"one two three four {b}", f"One TWO three four {a}"]))
    assert np.diff(starts).tolist() == [1, 1, 1] and values[0] != values[1] and values[0] == values[2]
    assert lower(np.frombuffer(b"AZaz", np.uint8)).tobytes() == b"azaz"
