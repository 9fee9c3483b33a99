"""Operator 7: token files of independent Zstandard frames with a trailing seek table.

A file holds the documents of a range of ids, in ascending order: one frame per document (its ids as little-endian
unsigned 32-bit integers), a skippable frame with the documents' ids, and, in a last skippable frame, the seek table of the
public Zstandard Seekable Format: compressed and decompressed size and a checksum (low half of XXH64) of each frame. Any
zstd reader can decompress the file; a reader of single documents reads the table from the end and then only the frames
it wants.

    file        frame * | 0x184D2A50 size ids nulls | 0x184D2A5E size (packed raw checksum)* footer
    footer      number of frames, descriptor 0x80, 0x8F92EAB1

Texts are tokenized and compressed where they are read, so only compressed frames are shuffled; the files are then
written range by range, each under a temporary name first, so a task that runs again replaces what it left.
"""

from __future__ import annotations

import json
import math
import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactlake.llm.hashing import blanks, mix, parts, span_hashes, utf8
from pactlake.llm.lookup import Pieces
from pactlake.llm.scratch import Scratch
from pactlake.llm.shipping import ship
from pactlake.session import fresh_folder

SKIPPABLE_IDS, SKIPPABLE_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_ENTRY, _FOOTER = struct.Struct("<III"), struct.Struct("<IBI")


def _open(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pa.fs.LocalFileSystem(), uri)


def checksum(raw: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


#: Bytes of UTF-8 that may begin white space beyond the plain kind, or are control characters.
_SUSPECT = np.zeros(256, bool)
_SUSPECT[[*range(9), *range(14, 32), 127, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: Bytes in which a worker keeps the ids of pieces.
_KEPT_BYTES = 48 << 20
#: The share of a batch's pieces that may be unknown, when no more can be kept, before those that are kept are thought to
#: be of other texts.
_MISSED = 0.5


class Encoder:
    """Texts to arrays of ids as the tokenizers library gives them, a special token's string in a text being that token.

    A byte-level tokenizer cuts a text into words before anything else, and always where white space follows
    something else and where a mark follows a letter. So the ids of a text are those of its pieces between such places,
    and a worker tokenizes a piece once and knows it again by 128 bits of hash. Texts with unusual white space or with the
    string of a special token, and other tokenizers, are tokenized whole.
    """

    def __init__(self, tokenizer: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(tokenizer)
        made = json.loads(self._model.to_str())
        cut = made.get("pre_tokenizer") or {}
        self.in_pieces = (
            cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
            and not made.get("normalizer") and not made.get("truncation") and not made.get("padding")
        )
        self._added = [x["content"] for x in made.get("added_tokens", [])]
        self._known = Pieces(_KEPT_BYTES)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self._model.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if not self.in_pieces:
            return self.whole(texts)
        data, offsets = utf8(pa.array(texts, pa.string()))
        special = [i for i, text in enumerate(texts) if any(x in text for x in self._added)]
        odd = np.union1d(np.searchsorted(offsets, _odd_places(data), side="right") - 1, np.array(special, np.int64))
        out = self._pieced(data, offsets)
        for i, ids in zip(odd, self.whole([texts[i] for i in odd]), strict=True):
            out[i] = ids
        return out

    def _pieced(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        if not len(data):
            return [np.zeros(0, "<u4")] * (len(offsets) - 1)
        blank = blanks(data)
        first = blank | _MARK[data]
        first[1:] &= (blank[1:] & ~blank[:-1]) | _LETTER[data[:-1]]
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        begins = np.flatnonzero(first)
        ends = np.append(begins[1:], len(data))
        keys, checks = span_hashes(data, begins, ends), span_hashes(data, begins, ends, 1)
        rows = self._known.find(keys, checks).astype(np.int64)
        unknown = np.flatnonzero(rows < 0)
        starts, flat = self._known.kept()
        if len(unknown):
            _, one, which = np.unique(keys[unknown] ^ mix(checks[unknown]), return_index=True, return_inverse=True)
            at, raw = unknown[one], data.tobytes()
            # A text whose bytes make no text when cut is an odd one, and is tokenized whole.
            said = [raw[b:e].decode(errors="replace") for b, e in zip(begins[at].tolist(), ends[at].tolist(), strict=True)]
            found = [x.ids for x in self._model.encode_batch_fast(said, add_special_tokens=False)]
            counts = np.fromiter(map(len, found), np.int64, len(found))
            new = np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum()))
            rows[unknown] = len(starts) - 1 + which
            starts, flat = np.concatenate([starts, starts[-1] + np.cumsum(counts)]), np.concatenate([flat, new])
            if self._known.full and len(unknown) > _MISSED * len(rows):
                self._known.forget()
            self._known.add(keys[at], checks[at], counts, new)
        counts = starts[rows + 1] - starts[rows]
        upto = np.cumsum(counts)
        ids = flat[np.repeat(starts[rows] - (upto - counts), counts) + np.arange(upto[-1])]
        cuts = np.concatenate([[0], upto])[np.searchsorted(begins, offsets)]
        return [ids[a:b].astype("<u4") for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _odd_places(data: np.ndarray) -> np.ndarray:
    """Where control characters and white space stand that a tokenizer may treat in its own way: U+0080 to U+00A0 and the
    spaces and marks of the blocks that have any."""
    at = np.flatnonzero(_SUSPECT[data])
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    one, two, three = data[at], padded[at + 1], padded[at + 2]
    latin = (one == 0xC2) & (two <= 0xA0)
    general = (one == 0xE2) & (((two == 0x80) & ((three < 0x90) | (three >= 0xA8))) | (two == 0x81))
    other = ((one == 0xE1) & ((two == 0x9A) | (two == 0xA0))) | ((one == 0xE3) & (two == 0x80)) | ((one == 0xEF) & (two == 0xBB))
    return at[(one < 0x80) | latin | general | other]


@cache
def encoder(tokenizer: str) -> Encoder:
    """One encoder per worker and tokenizer file."""
    return Encoder(tokenizer)


def frames(documents: DataFrame, tokenizer: str, end_id: int, level: int = 3) -> DataFrame:
    """(doc_id, n_tokens, checksum, frame): every text's ids and the end id, compressed. A null text is empty."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        ids_of, compressor, end = encoder(tokenizer), zstandard.ZstdCompressor(level=level), np.array([end_id], "<u4")
        for whole in batches:
            for batch in parts(whole, 1, 1000, 1 << 20):
                raw = [np.concatenate([ids, end]).tobytes() for ids in ids_of(batch.column(1).fill_null("").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array([len(x) // 4 for x in raw], pa.int64()),
                        pa.array([checksum(x) for x in raw], pa.int64()), pa.array([compressor.compress(x) for x in raw], pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "checksum", "frame"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, checksum long, frame binary")


def write_file(uri: str, rows: Iterable[tuple[int | None, int, int, bytes]]) -> tuple[int, int]:
    """Write (doc_id, n_tokens, checksum, frame) rows in their order; the number of documents and of ids."""
    system, path = _open(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    temporary, table, ids, nulls, tokens = f"{path}.{uuid.uuid4().hex}.tmp", bytearray(), bytearray(), bytearray(), 0
    with system.open_output_stream(temporary) as out:
        for doc_id, n, check, frame in rows:
            out.write(frame)
            table += _ENTRY.pack(len(frame), 4 * n, check)
            ids += struct.pack("<q", doc_id or 0)
            nulls.append(doc_id is None)
            tokens += n
        out.write(struct.pack("<II", SKIPPABLE_IDS, len(ids) + len(nulls)) + bytes(ids) + bytes(nulls))
        out.write(struct.pack("<II", SKIPPABLE_TABLE, len(table) + _FOOTER.size) + bytes(table))
        out.write(_FOOTER.pack(len(nulls), 0x80, SEEKABLE))
    system.move(temporary, path)
    return len(nulls), tokens


class TokenFile:
    """Reads a file's table, then any of its documents by position."""

    def __init__(self, uri: str):
        system, path = _open(uri)
        self._file = system.open_input_file(path)
        size = self._file.size()
        count, _, magic = _FOOTER.unpack(self._file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != SEEKABLE:
            raise ValueError(f"{uri} has no seek table")
        end = size - _FOOTER.size
        table = np.frombuffer(self._file.read_at(12 * count, end - 12 * count), "<u4").reshape(count, 3).astype(np.int64)
        ids = self._file.read_at(9 * count, end - 12 * count - 8 - 9 * count)
        self.doc_ids = np.frombuffer(ids[: 8 * count], "<i8")
        self.null = np.frombuffer(ids[8 * count :], "u1") > 0
        self.packed, self.raw, self.checksums = table[:, 0], table[:, 1], table[:, 2]
        self.offsets = np.concatenate([[0], np.cumsum(self.packed)])
        self.starts = np.concatenate([[0], np.cumsum(self.raw // 4)])

    def __len__(self) -> int:
        return len(self.packed)

    def ids(self, i: int) -> np.ndarray:
        """The ids of the i-th document, from its frame alone; ValueError if the frame is damaged."""
        import zstandard

        frame = self._file.read_at(int(self.packed[i]), int(self.offsets[i]))
        try:
            raw = zstandard.ZstdDecompressor().decompress(frame, max_output_size=int(self.raw[i]))
        except zstandard.ZstdError as e:
            raise ValueError(f"frame {i} is damaged") from e
        if len(raw) != self.raw[i] or checksum(raw) != self.checksums[i]:
            raise ValueError(f"frame {i} is damaged")
        return np.frombuffer(raw, "<u4")


def write_tokens(documents: DataFrame, folder: str, tokenizer: str, end_id: int, shard_bytes: int = 32 << 20) -> DataFrame:
    """Tokenize every text and write the files `tokens-NNNNN.zst` below `folder`, documents in ascending order of id (a
    null first; equal ids in order of their contents' checksum). Returns the manifest, a row per file: shard, path, documents, tokens, start (ids in all
    files before it), which is also kept as Parquet in `folder`/manifest. An empty table writes no file.
    """
    spark = documents.sparkSession
    with Scratch(spark, "tokens") as scratch:
        packed = scratch.table(frames(documents, tokenizer, end_id))
        size = packed.agg(F.sum(F.length("frame"))).first()[0] or 0
        shards = max(1, math.ceil(size / shard_bytes))

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard = TaskContext.get().partitionId()
            path = f"{folder}/tokens-{shard:05d}.zst"
            rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
            first = next(rows, None)
            if first is not None:
                count, tokens = write_file(path, (r for part in ((first,), rows) for r in part))
                yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "documents": [count], "tokens": [tokens]})

        ranged = packed.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "checksum", "n_tokens", "frame")
        written = scratch.table(ranged.mapInArrow(write, "shard long, path string, documents long, tokens long"))
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        manifest = written.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))
        manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
        return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of the files, a file per task; start counts the ids of all
    documents before it. Fails if a frame does not match its checksum."""
    return _read(manifest, "ids binary", lambda ids: ids.tobytes(), pa.binary())


def read_digests(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), the checksum being the CRC-32 of the ids' bytes."""
    return _read(manifest, "ids_crc32 long", lambda ids: zlib.crc32(ids.tobytes()), pa.int64())


def _read(manifest: DataFrame, column: str, value, kind: pa.DataType) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source = TokenFile(path)
                for begin in range(0, len(source), 256):
                    part = range(begin, min(begin + 256, len(source)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(source.doc_ids[part.start : part.stop], mask=source.null[part.start : part.stop]),
                            pa.array(source.starts[part.start : part.stop] + start),
                            pa.array(source.raw[part.start : part.stop] // 4),
                            pa.array([value(source.ids(i)) for i in part], kind),
                        ],
                        ["doc_id", "start", "n_tokens", column.split()[0]],
                    )

    ship(manifest.sparkSession)
    files = max(1, manifest.count())
    rows = manifest.select("path", "start").repartition(files)
    return rows.mapInArrow(read, f"doc_id long, start long, n_tokens long, {column}")


def fresh_token_folder(spark) -> str:
    return fresh_folder(spark, "token-files")
