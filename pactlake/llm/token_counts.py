"""Operator 13: token counts of whole texts, huge ones in overlapping chunks that are spliced where both agree.

A text longer than `LONG` characters is cut into chunks that overlap, which are encoded on their own, as rows that Spark deals out. A chunk's
tokens near its ends depend on where it was cut, so neighbours are spliced at a boundary inside their overlap that does
not. That is proven, not assumed, by a property of byte-pair encoding: merges are taken in order of rank, so a sequence of
tokens is the encoding of its text exactly if every two neighbouring tokens are the encoding of the two together (were a
merge to cross a boundary, the first to do so would join the ends of its two neighbours, and would do so in the two alone).
If both chunks have the same token at the same place, the left chunk vouches for all pairs up to it and the right chunk for all
pairs after it. So the left chunk's tokens through that one and the right chunk's after it are the encoding of the whole.

Where an overlap has no token in common, the text is encoded anew in a row of chunks that each begin at a token of the one
before, so that both start alike; the overlap is doubled until they have a token in common, and where there is none back to the beginning of a
chunk, the chunk grows. In the worst case that is the whole text, which is right by definition.

The vocabulary is a SentencePiece model of byte-pair kind without normalization, whose pieces tell how many characters
they stand for; this gives the offsets. Texts encode one by one, so nothing depends on how they are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlake.llm.hashing import parts
from pactlake.llm.scratch import Scratch

#: Characters: of a chunk without its overlaps, of an overlap on either side of a cut, and up to which a text is encoded whole.
CHUNK, OVERLAP, LONG = 1 << 15, 1 << 9, 1 << 16
LIMIT = 4096
_CHUNKS = "place long, chunk int, begin long, left long, right long, text string"
_ENDS = "place long, chunk int, n long, fits boolean, left array<long>, left_rank array<int>, right array<long>, right_rank array<int>"


class Encoder:
    """Tokens of texts and where they end. A chunk from inside a text is encoded without the space that the model puts
    before a text."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        made = sentencepiece_model_pb2.ModelProto()
        with open(model, "rb") as source:
            made.ParseFromString(source.read())
        spec = made.normalizer_spec
        if made.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("splicing needs byte-pair encoding without normalization")
        self._prefix = int(spec.add_dummy_prefix)
        self.whole = SentencePieceProcessor(model_file=model)
        spec.add_dummy_prefix = False
        self._inside = SentencePieceProcessor(model_proto=made.SerializeToString())
        # Bytes of a character outside the vocabulary are tokens of their own, of which the first stands for the character.
        kinds = np.array([p.type for p in made.pieces])
        spelled = kinds == 6
        byte = np.array([int(p.piece[1:-1], 16) if p.type == 6 else 0 for p in made.pieces])
        self._chars = np.where(spelled, (byte < 0x80) | (byte >= 0xC0), [len(p.piece) for p in made.pieces])
        self._proper = ~spelled & (kinds == 1)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.whole.encode(texts, num_threads=1)]

    def tokens(self, text: str, first: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of each token of a chunk, in characters of the chunk, and whether it is a piece of the vocabulary."""
        ids = np.array((self.whole if first else self._inside).encode(text), np.int64)
        ends = np.cumsum(self._chars[ids]) - (self._prefix if first else 0)
        return ends - self._chars[ids], ends, self._proper[ids]


@cache
def encoder(model: str) -> Encoder:
    """One encoder per worker and model file."""
    return Encoder(model)


def _spans(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each span; a piece has fewer than 1,024 characters."""
    return begins * 1024 + (ends - begins)


def count_in_row(encode: Encoder, text: str, chunk: int, overlap: int) -> int:
    """How many tokens a text has, encoded in chunks that each begin at a token of the one before."""
    begin, end = 0, min(chunk, len(text))
    begins, ends, proper = encode.tokens(text[:end], True)
    done = 0  # tokens before `begins`
    while end < len(text):
        back, spliced = overlap, False
        while not spliced:
            starts = begins[proper & (begins > begin) & (begins <= end - back)]
            if not len(starts):  # back to the beginning of the chunk: it grows
                end = min(len(text), end + max(chunk, back))
                begins, ends, proper = encode.tokens(text[begin:end], begin == 0)
                begins, ends = begins + begin, ends + begin
                break
            start, stop = int(starts[-1]), min(len(text), end + chunk)
            b, e, p = encode.tokens(text[start:stop], False)
            b, e = b + start, e + start
            common = np.intersect1d(_spans(begins, ends)[proper], _spans(b, e)[p])
            if len(common):
                mine = int(np.flatnonzero((_spans(begins, ends) == common[-1]) & proper)[-1])
                yours = int(np.flatnonzero((_spans(b, e) == common[-1]) & p)[-1])
                # The chunk from the common token on, which the next splice may use again.
                done += mine
                begin, end, spliced = int(b[yours]), stop, True
                begins, ends, proper = b[yours:], e[yours:], p[yours:]
            back *= 2
    return done + len(begins)


def _cut(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """The chunks of the long texts, without a step that would hold a text once for each of them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, 1, 1):
                place, text = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
                count = -(-len(text) // chunk)
                for first in range(0, count, 64):
                    numbers = np.arange(first, min(first + 64, count))
                    begins = np.maximum(numbers * chunk - overlap, 0)
                    said = [text[b : (i + 1) * chunk + overlap] for i, b in zip(numbers.tolist(), begins.tolist(), strict=True)]
                    # The middles of the overlaps, -1 where there is none.
                    left = np.where(numbers > 0, numbers * chunk, -1)
                    right = np.where(numbers < count - 1, (numbers + 1) * chunk, -1)
                    columns = [np.full(len(numbers), place), numbers.astype(np.int32), begins, left, right]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(said, pa.string())], [c.split()[0] for c in _CHUNKS.split(", ")])

    return long.select("place", "text").mapInArrow(cut, _CHUNKS)


def _encoded(chunks: DataFrame, model: str, overlap: int) -> DataFrame:
    """Per chunk its number of tokens, and of the pieces that lie in its two overlaps the spans and how many tokens the
    chunk has through each; `fits` if the pieces add up to the text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        for whole in batches:
            for batch in parts(whole, 5, 16):
                rows: list[list] = [[] for _ in range(6)]
                for row in batch.to_pylist():
                    begins, ends, proper = coder.tokens(row["text"], row["begin"] == 0)
                    rows[0].append(len(ends))
                    rows[1].append(bool(len(ends)) and int(ends[-1]) == len(row["text"]))
                    begins, ends = begins + row["begin"], ends + row["begin"]
                    for i, middle in ((2, row["left"]), (4, row["right"])):
                        there = np.flatnonzero(proper & (begins >= middle - overlap) & (ends <= middle + overlap) & (middle >= 0))
                        rows[i].append(_spans(begins[there], ends[there]))
                        rows[i + 1].append((there + 1).astype(np.int32))
                kinds = (pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *(pa.array(r, k) for r, k in zip(rows, kinds, strict=True))],
                    [c.split()[0] for c in _ENDS.split(", ")],
                )

    return chunks.mapInArrow(encode, _ENDS)


def _spliced(ends: DataFrame) -> DataFrame:
    """(place, n_tokens): the chunks' tokens without those beyond the splices; null where a splice was not found."""
    left = ends.select("place", F.col("chunk").alias("cut"), "n", "fits", F.col("right").alias("a"), F.col("right_rank").alias("a_rank"))
    right = ends.select("place", (F.col("chunk") - 1).alias("cut"), F.col("left").alias("b"), F.col("left_rank").alias("b_rank"))
    joined = left.join(right, ["place", "cut"], "left")
    common = F.array_intersect("a", "b")
    joined = joined.withColumn("token", F.get(common, F.floor(F.size(common) / 2).cast("int")))
    rank = lambda spans, ranks: F.get(ranks, (F.array_position(spans, F.col("token")) - 1).cast("int"))
    beyond = (F.col("n") - rank("a", "a_rank")) + rank("b", "b_rank")
    own = F.when(F.col("b").isNull(), F.col("n")).otherwise(F.col("n") - beyond)
    own = F.when(F.col("fits"), own)
    return joined.groupBy("place").agg(F.when(F.count_if(own.isNull()) == 0, F.sum(own)).alias("n_tokens"))


def _in_row(long: DataFrame, model: str, chunk: int, overlap: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        for whole in batches:
            for batch in parts(whole, 1, 1):
                n = count_in_row(coder, batch.column(1)[0].as_py(), chunk, overlap)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n], pa.int64())], ["place", "n_tokens"])

    return long.select("place", "text").mapInArrow(count, "place long, n_tokens long")


def _whole(short: DataFrame, model: str) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        for whole in batches:
            for batch in parts(whole, 2, 1000):
                counts = coder.counts(batch.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return short.select("doc_id", "n_bytes", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")


def _placed(long: DataFrame) -> DataFrame:
    """The long texts, numbered by the task that read them and their order in it; to be stored, as a task that runs again may number them otherwise."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for whole in batches:
            for batch in parts(whole, 2, 1000):
                places = pa.array(np.arange(at, at + batch.num_rows))
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([places, *batch.columns], ["place", "doc_id", "n_bytes", "text"])

    return long.select("doc_id", "n_bytes", "text").mapInArrow(number, "place long, doc_id long, n_bytes long, text string")


def token_counts(documents: DataFrame, model: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP, long: int = LONG) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than `limit` tokens), as the library
    counts the whole text without begin and end tokens.

    A null text is empty and has no tokens. Rows that share an id, or have none, each get a row. Texts of more than `long`
    characters are encoded in chunks of `chunk` characters and `overlap` more on either side; a chunk must be longer than both overlaps. Other columns are not read. An
    empty table gives an empty result.
    """
    if chunk < 2 * overlap + 1 or overlap < 1:
        raise ValueError("a chunk must be longer than its two overlaps")
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    # Characters are counted only where the bytes leave it open.
    is_long = (F.col("n_bytes") > long) & (F.length("text") > long)
    with Scratch(documents.sparkSession, "token-counts") as scratch:
        placed = scratch.table(_placed(rows.where(is_long)))
        counted = _whole(rows.where(~is_long), model)
        if not placed.isEmpty():
            ends = scratch.table(_encoded(_cut(placed, chunk, overlap).repartition("place", "chunk"), model, overlap))
            spliced = scratch.table(_spliced(ends))
            known = placed.drop("text").join(spliced.where("n_tokens is not null"), "place")
            left = placed.join(spliced.where("n_tokens is null").select("place"), "place", "left_semi")
            again = placed.drop("text").join(_in_row(left, model, chunk, overlap), "place")
            for more in (known, again):
                counted = counted.union(more.select("doc_id", "n_bytes", "n_tokens"))
        return scratch.result(counted.withColumn("over_limit", F.col("n_tokens") > limit))
