from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from odd import odd_rows

from pactlake.llm.language import FOLD, ORDER, PpmModel, fit, identify
from pactlake.llm.lookup import Lookup
from pactlake.llm.sampling import bounded_sample, held_out, labelled_sample


def brute_bits(samples, text):
    """Code length by counting contexts one byte at a time."""
    out = []
    fold = lambda t: bytes(FOLD[b] for b in t.encode())
    for language in sorted(samples):
        seen = defaultdict(Counter)
        for sample in samples[language]:
            data = b" " * ORDER + fold(sample)
            for i in range(ORDER, len(data)):
                for k in range(ORDER + 1):
                    seen[data[i - k : i]][data[i]] += 1
        data, bits = b" " * ORDER + fold(text), 0.0
        for i in range(ORDER, len(data)):
            for k in range(ORDER, -1, -1):
                here = seen.get(data[i - k : i])
                if here:
                    whole = sum(here.values()) + len(here)
                    if data[i] in here:
                        bits -= math.log2(here[data[i]] / whole)
                        break
                    bits -= math.log2(len(here) / whole)
            else:
                bits += 8
        out.append(bits)
    return out


def test_code_lengths_equal_brute_force():
    samples = {"a": ["the cat sat on the mat", "a hat"], "b": ["der hund und die katze", "", "ein Hut"], "c": [""]}
    texts = ["the dog", "über den Hut!", "", "zzz", "t", "a cat\nand 12 hunde"]
    found = PpmModel(samples).bits(pa.array(texts))
    assert np.allclose(found, [brute_bits(samples, t) for t in texts], atol=1e-3)


def test_lookup():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 32, 5000, dtype=np.uint32))
    rng.shuffle(keys)
    table = Lookup(keys)
    asked = np.concatenate([keys, rng.integers(0, 1 << 32, 5000, dtype=np.uint32), np.zeros(1, np.uint32)])
    place = {int(k): i for i, k in enumerate(keys)}
    assert table(asked).tolist() == [place.get(int(k), -1) for k in asked]
    assert Lookup(keys[:0])(keys[:3]).tolist() == [-1, -1, -1]


def prose(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_held_out_accuracy(spark, documents):
    rng = random.Random(6)
    kinds = {"x": "aeioubcd", "y": "aeoutsrn", "z": "äöüaekst"}
    rows = [(i, prose(rng, kinds[k], rng.randint(5, 60)), k, "a") for i in range(300) for k in [rng.choice("xyz")]]
    table = documents(rows)
    found = identify(table, fit(table)).select("doc_id", "lang", "lang_pred", "score", held_out().alias("held")).collect()
    tested = [r for r in found if r["held"]]
    assert len(tested) > 30 and sum(r["lang"] == r["lang_pred"] for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_odd_rows(documents):
    table = documents([*odd_rows(), (20, "12 + 34 = 46", "en", "a")])
    found = identify(table, fit(table))
    assert found.columns == [*[c for c in table.columns if c != "score"], "lang_pred", "score", "bits_per_byte"]
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1, 2, 3, 20))
    assert by_id[6]["lang_pred"] == by_id[7]["lang_pred"] == "en" and found.count() == 10
    assert identify(documents([]), fit(documents([]))).count() == 0
    unlearned = identify(table, fit(documents([]))).collect()
    assert {r["lang_pred"] for r in unlearned} == {"und"}


@pytest.mark.parametrize("limit,byte_limit", [(5, 10**6), (50, 300)])
def test_sample_is_bounded_and_stable(documents, limit, byte_limit):
    rows = [(i, "x" * 50 + str(i), "en" if i % 3 else "de", "a") for i in range(200)] + [(500, None, "fr", "a"), (501, "y", None, "a")]
    one = sorted(r["doc_id"] for r in bounded_sample(documents(rows), "lang", limit, byte_limit).collect())
    two = sorted(r["doc_id"] for r in bounded_sample(documents(rows[::-1]).repartition(7), "lang", limit, byte_limit).collect())
    assert one == two and one
    for lang in (0, 1):
        mine = [d for d in one if bool(d % 3) == bool(lang)]
        assert 0 < len(mine) <= limit and sum(len(rows[d][1]) for d in mine) <= byte_limit


def test_long_texts_neither_end_nor_empty_a_sample(documents):
    short = [(i, f"kort {i}", "nl", "a") for i in range(40)]
    long = [(100 + i, "lang " * 100 + str(i), "nl", "a") for i in range(40)]
    blank = [(200 + i, " ", "fi", "a") for i in range(40)]
    rows = [*short, *long, *blank, (300, "vain " * 30, "fi", "a"), (301, "seul " * 1000, "fr", "a"), (302, "\u20ac" * 5000, "xx", "a")]
    found = bounded_sample(documents(rows), "lang", 20, 400).collect()
    texts = lambda lang: [r["text"] for r in found if r["lang"] == lang]
    assert len(texts("nl")) == 20 and all(t.startswith("kort") for t in texts("nl"))
    assert "vain " * 30 in texts("fi")
    assert texts("fr") == [("seul " * 1000)[:100]] and texts("xx") == ["\u20ac" * 100]
    assert all(sum(len(t.encode()) for t in texts(lang)) <= 400 for lang in ("nl", "fi", "fr", "xx"))
    assert set(fit(documents([(r[0] + 1, *r[1:]) for r in rows] + [(r[0] + 2, *r[1:]) for r in rows]), 20, 400).languages) >= {"nl", "fi", "fr"}


def test_labels_of_long_and_short_texts(documents, labels):
    rows = [(i, "lang " * 100 if i % 50 else f"kort {i}", "en", "a") for i in range(1000)] + [(2000, "seul " * 1000, "en", "a")]
    known = labels([(i, 1, 0, "x") for i in range(1000)] + [(2000, 1, 1, "x")] + [(3000 + i, 1, 1, "x") for i in range(1000)])
    found = labelled_sample(documents(rows), known, "toxic", 10, 400).collect()
    assert sorted(r["text"][:4] for r in found) == ["kort"] * 10 + ["seul"] and {r["label"] for r in found} == {0, 1}
