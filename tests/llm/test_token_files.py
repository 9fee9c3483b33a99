from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
import zstandard
from odd import PROSE, odd_rows

from pactlake.llm.lookup import Pieces
from pactlake.llm.queries import END_ID, tokenizer_path
from pactlake.llm.token_files import TokenFile, checksum, encoder, read_digests, read_tokens, write_file, write_tokens


@pytest.fixture(scope="module")
def plain():
    """The library as it is."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def frame(ids):
    return (len(ids), checksum(raw(ids)), zstandard.ZstdCompressor().compress(raw(ids)))


def test_file_round_trip_and_single_documents(tmp_path):
    documents = [(None, [5, 0]), (3, [1, 2, 3, 0]), (9, [0])]
    path = str(tmp_path / "sub" / "a.zst")
    assert write_file(path, [(d, *frame(ids)) for d, ids in documents]) == (3, 7)
    found = TokenFile(path)
    assert len(found) == 3 and found.doc_ids.tolist() == [0, 3, 9] and found.null.tolist() == [True, False, False]
    assert found.ids(1).tolist() == [1, 2, 3, 0] and found.starts.tolist() == [0, 2, 6, 7]
    data = (tmp_path / "sub" / "a.zst").read_bytes()
    count, descriptor, magic = struct.unpack("<IBI", data[-9:])
    assert (count, descriptor, magic) == (3, 0x80, 0x8F92EAB1)
    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() for _ in (0,))
    assert whole == raw([5, 0, 1, 2, 3, 0, 0])


def test_damage_is_found(tmp_path):
    path = tmp_path / "a.zst"
    write_file(str(path), [(1, *frame(list(range(500)) + [0])), (2, *frame([7, 0]))])
    data = bytearray(path.read_bytes())
    data[20] ^= 0xFF
    path.write_bytes(data)
    damaged = TokenFile(str(path))
    with pytest.raises(ValueError):
        damaged.ids(0)
    assert damaged.ids(1).tolist() == [7, 0]
    (tmp_path / "b.zst").write_bytes(b"no table here at all")
    with pytest.raises(ValueError):
        TokenFile(str(tmp_path / "b.zst"))


def test_written_in_order_of_ids(spark, documents, tmp_path, plain):
    rows = [(i * 7 % 101, f"{PROSE} {i} <|endoftext|>" * (i % 5), "en", "a") for i in range(101)]
    manifest = write_tokens(documents(rows).repartition(5), f"file://{tmp_path}/tokens", tokenizer_path(), END_ID, shard_bytes=4000)
    assert manifest.count() > 1
    found = sorted(read_tokens(manifest).collect(), key=lambda r: r["doc_id"])
    digests = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in read_digests(manifest).collect()}
    start = 0
    for r, (doc_id, text, *_) in zip(found, sorted(rows), strict=True):
        ids = [*plain.encode(text, add_special_tokens=False).ids, END_ID]
        assert r["doc_id"] == doc_id and bytes(r["ids"]) == raw(ids) and r["start"] == start and r["n_tokens"] == len(ids)
        assert digests[doc_id] == (start, len(ids), zlib.crc32(raw(ids)))
        start += len(ids)
    assert manifest.agg({"tokens": "sum"}).first()[0] == start


def test_odd_rows(documents, tmp_path):
    manifest = write_tokens(documents(odd_rows()), str(tmp_path / "tokens"), tokenizer_path(), END_ID)
    found = read_tokens(manifest).collect()
    assert len(found) == 9 and [r["doc_id"] for r in found if r["start"] == 0] == [None]
    assert all(r["n_tokens"] == 1 for r in found if r["doc_id"] in (1, 2))
    assert len({bytes(r["ids"]) for r in found if r["doc_id"] in (5, None)}) == 1
    empty = write_tokens(documents([]), str(tmp_path / "none"), tokenizer_path(), END_ID)
    assert empty.count() == 0 and read_tokens(empty).count() == 0


def test_pieces_give_the_ids_of_whole_texts(plain):
    encode = encoder(tokenizer_path())
    assert encode.in_pieces
    texts = ["", " ", "a", " a", "a ", "  a  b \n\n c\n", "it's we'll\tI'd", "x \n\nword", "é  ü", "\r\n\r\nq", "<|endoftext|> 12  345", "a\x1c\n\nb", "\n", "日本 語\n  z"]
    texts += ["x \n\nq", "a  b", "a,b.c!d", "don't.'s 'st", "“x” — y", "a1.b2, 3.c"]
    texts += ["".join(np.random.default_rng(i).choice(list("ab '\n\t1.é, ! “€"), 60)) for i in range(300)]
    rng = np.random.default_rng(8)
    unlike = ["".join(rng.choice(["a", "b"], 1024)) for _ in range(40)]
    texts += [x for word in unlike for x in (word, f"{word} {word[::-1]}", word * 3)]
    for _ in range(2):  # the second time all pieces are known
        assert [x.tolist() for x in encode(texts)] == [plain.encode(x, add_special_tokens=False).ids for x in texts]
    assert 50256 in encode(["a <|endoftext|> b"])[0]


def test_pieces_table_grows_and_forgets():
    rng, table, known = np.random.default_rng(2), Pieces(1 << 20), {}
    for _ in range(6):
        keys = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
        checks = keys ^ np.uint64(5)
        counts = rng.integers(0, 4, len(keys))
        flat = rng.integers(0, 99, counts.sum()).astype(np.uint32)
        table.add(keys, checks, counts, flat)
        known.update(zip(keys.tolist(), np.split(flat, np.cumsum(counts)[:-1]), strict=True))
    asked = np.array(list(known), np.uint64)
    rows = table.find(asked, asked ^ np.uint64(5))
    starts, values = table.kept()
    assert len(table) == len(known) and (rows >= 0).all() and (table.find(asked, asked) < 0).all()
    assert all((values[starts[i] : starts[i + 1]] == known[k]).all() for i, k in zip(rows.tolist(), asked.tolist(), strict=True))
    for _ in range(50):
        keys = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
        table.add(keys, keys, np.full(5000, 3), np.zeros(15000, np.uint32))
        assert table.bytes < 2 << 20
    assert (table.find(asked, asked ^ np.uint64(5)) >= 0).all() and (table.find(keys, keys) < 0).all()
    table.forget()
    assert len(table) == 0 and (table.find(asked, asked ^ np.uint64(5)) < 0).all()
    table.add(keys[:0], keys[:0], np.zeros(0, np.int64), np.zeros(0, np.uint32))
    table.add(keys, keys, np.full(5000, 3), np.zeros(15000, np.uint32))
    assert (table.find(keys, keys) >= 0).all()


def test_long_texts_come_in_small_batches():
    import pyarrow as pa

    from pactlake.llm.hashing import parts

    texts = ["x" * n for n in (5, 900, 3000, 10, 10, 0, 20)] + [None, "y"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    cut = [x.column(0).to_pylist() for x in parts(batch, 0, 3, 1000)]
    assert [len(c) for c in cut] == [2, 1, 3, 3] and sum(cut, []) == texts
    assert list(parts(batch.slice(0, 0), 0, 3)) == []
