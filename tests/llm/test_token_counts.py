from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from odd import PROSE, odd_rows

from pactlake.llm import token_counts as module
from pactlake.llm.queries import COUNTED
from pactlake.llm.token_counts import count_in_row, encoder, token_counts

MODEL = public_tokenizers.path(COUNTED)


@pytest.fixture(scope="module")
def plain():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return lambda text: len(library.encode(text or ""))


def varied(seed: int, size: int) -> str:
    rng = np.random.default_rng(seed)
    letters = ["ab", "aaaa b", "xy \n\t", "日本語 \U0001f9ff é", "0123 .,;", "▁_ -=", "the internationalization of "][seed % 7]
    return "".join(rng.choice(list(letters), size))


TEXTS = [varied(s, 100 + 37 * s) for s in range(70)] + ["x" * 3000, " " * 2500, "ab" * 900, "=" * 777, "<s></s><unk><0x41>" * 40, PROSE * 9, "né" * 500, "\0\r\n" * 300]


@pytest.mark.parametrize("chunk, overlap", [(64, 8), (130, 30), (50, 1)])
def test_spliced_in_a_row_equals_the_library(plain, chunk, overlap):
    coder = encoder(MODEL)
    for text in TEXTS:
        assert count_in_row(coder, text, chunk, overlap) == plain(text), repr(text[:80])


@pytest.mark.parametrize("chunk, overlap", [(64, 20), (200, 99), (40, 2)])
def test_spliced_chunks_equal_the_library(spark, documents, plain, chunk, overlap):
    rows = [(i, text, "en", "a") for i, text in enumerate(TEXTS)]
    found = token_counts(documents(rows).repartition(4), MODEL, 100, chunk, overlap, long=chunk)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in found.collect()}
    assert got == {i: (len(t.encode()), plain(t), plain(t) > 100) for i, t, *_ in rows}


def test_both_ways_are_taken(spark, documents, monkeypatch):
    """Prose is spliced chunk by chunk; letters that are encoded by how many came before are not."""
    rows = [(1, PROSE * 30, "en", "a"), (2, "x" * 1001, "en", "a")]
    placed = module._placed(documents(rows).selectExpr("doc_id", "0L AS n_bytes", "text")).cache()
    ends = module._encoded(module._cut(placed, 101, 33), MODEL, 33)
    spliced = {r.place: r.n_tokens for r in module._spliced(ends).collect()}
    found = {r.doc_id: spliced[r.place] for r in placed.collect()}
    assert found[1] is not None and found[2] is None


def test_tokens_say_where_they_are():
    coder = encoder(MODEL)
    for text in TEXTS[:20]:
        begins, ends, proper = coder.tokens(text, True)
        assert ends[-1] == len(text) and (begins[1:] == ends[:-1]).all()
        ids = coder.whole.encode(text)
        said = [coder.whole.id_to_piece(int(i)).replace("▁", " ") for i in ids]
        assert all(s == (" " + text.replace("▁", " "))[b + 1 : e + 1] for s, b, e, p in zip(said, begins, ends, proper, strict=True) if p)


def test_odd_rows(documents, plain):
    rows = odd_rows()
    for long in (1 << 16, 1000):
        found = token_counts(documents(rows), MODEL, chunk=900, overlap=100, long=long)
        expected = sorted((str(i), len((t or "").encode()), plain(t)) for i, t, *_ in rows)
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found.collect()) == expected
    assert token_counts(documents([]), MODEL).collect() == []
    with pytest.raises(ValueError):
        token_counts(documents(rows), MODEL, chunk=10, overlap=5)
