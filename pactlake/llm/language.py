"""Operator 9: language identification by prediction by partial matching.

For each language, contexts of up to three bytes are counted with the byte that follows. The code length of a byte is the
negative logarithm of its share in its longest context that has been seen (count / (total + distinct)); where the byte is
new to a context, an escape (distinct / (total + distinct)) is paid and the next shorter context is asked, down to a
uniform byte. Statistics are frozen after learning, so the code length of every string of four bytes is a constant: all
are worked out once, for all languages at a time, and a text's code length is a sum of looked-up rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pactlake.llm.hashing import parts, utf8
from pactlake.llm.lookup import Lookup
from pactlake.llm.sampling import bounded_sample, held_out
from pactlake.llm.shipping import ship

#: Bounds of the sample that a language is learned from: documents, and bytes of text.
SAMPLE_DOCUMENTS, SAMPLE_BYTES = 400, 2 << 20
ORDER = 3
_STEP = 1 << 19
#: A-Z in lower case; every other ASCII character but letters is a space.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[:128] = 32
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The folded bytes with `ORDER` spaces before each text, and the places of the texts' own bytes."""
    sizes = np.diff(offsets)
    where = np.arange(len(data)) + np.repeat(ORDER * np.arange(1, len(offsets)), sizes)
    out = np.full(len(data) + ORDER * len(sizes), 32, np.uint8)
    out[where] = FOLD[data]
    return out, where


def grams(data: np.ndarray, where: np.ndarray, size: int) -> np.ndarray:
    """The `size` bytes that end at each place, as one number."""
    out = np.zeros(len(where), np.uint32)
    for i in range(size):
        out |= data[where - i].astype(np.uint32) << np.uint32(8 * i)
    return out


class PpmModel:
    """Frozen statistics of all languages, as code lengths in bits."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        counted = []
        for language in self.languages:
            data, where = padded(*utf8(pa.array(samples[language], pa.string())))
            counted.append([np.unique(grams(data, where, size), return_counts=True) for size in range(1, ORDER + 2)])
        lower = np.full((1, len(self.languages)), 8.0)
        self.keys: list[np.ndarray] = []
        self.cost: list[np.ndarray] = []
        self.escape: list[np.ndarray] = []
        self.contexts: list[Lookup] = []
        for size in range(1, ORDER + 2):
            keys = np.unique(np.concatenate([c[size - 1][0] for c in counted] + [np.zeros(0, np.uint32)]))
            contexts, context = np.unique(keys >> np.uint32(8), return_inverse=True)
            escape, cost = np.zeros((len(contexts), len(counted))), np.zeros((len(keys), len(counted)))
            shorter = self._shorter(keys, size, lower)
            for column, by_size in enumerate(counted):
                seen, count = by_size[size - 1]
                row = np.searchsorted(keys, seen)
                total = np.bincount(context[row], weights=count, minlength=len(contexts))
                kinds = np.bincount(context[row], minlength=len(contexts))
                with np.errstate(divide="ignore"):
                    escape[:, column] = np.where(kinds > 0, np.log2(np.maximum(total + kinds, 1)) - np.log2(np.maximum(kinds, 1)), 0)
                    cost[:, column] = shorter[:, column] + escape[context, column]
                    cost[row, column] = np.log2((total + kinds)[context[row]]) - np.log2(count)
            self.keys.append(keys)
            self.cost.append(cost.astype(np.float32))
            self.escape.append(escape.astype(np.float32))
            self.contexts.append(Lookup(contexts))
            lower = cost
        self.lookups = [Lookup(keys) for keys in self.keys]

    def _shorter(self, keys: np.ndarray, size: int, lower: np.ndarray) -> np.ndarray:
        if size == 1:
            return np.repeat(lower, len(keys), axis=0)
        return lower[np.searchsorted(self.keys[-1], keys & np.uint32((1 << (8 * (size - 1))) - 1))]

    def _lengths(self, codes: np.ndarray) -> np.ndarray:
        """Code lengths of the last byte of each four, given the three before it: a row per code, a column per language."""
        out = np.zeros((len(codes), len(self.languages)), np.float32)
        rest = np.arange(len(codes))
        for size in range(ORDER + 1, 0, -1):
            mine = codes[rest] & np.uint32((1 << (8 * size)) - 1)
            row = self.lookups[size - 1](mine)
            hit = row >= 0
            out[rest[hit]] += self.cost[size - 1][row[hit]]
            rest, mine = rest[~hit], mine[~hit]
            if not len(rest):
                return out
            context = self.contexts[size - 1](mine >> np.uint32(8))
            known = context >= 0
            out[rest[known]] += self.escape[size - 1][context[known]]
        out[rest] += 8.0
        return out

    def bits(self, texts: pa.Array) -> np.ndarray:
        """Code length of each text under each language, in bits."""
        data, offsets = utf8(texts)
        data, where = padded(data, offsets)
        out = np.zeros((len(texts), len(self.languages)))
        owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
        for begin in range(0, len(where), _STEP):
            part = where[begin : begin + _STEP]
            lengths = self._lengths(grams(data, part, ORDER + 1))
            mine = owner[begin : begin + _STEP]
            first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
            out[mine[first]] += np.add.reduceat(lengths, first, axis=0, dtype=np.float64)
        return out


def fit(documents: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, sample_bytes: int = SAMPLE_BYTES) -> PpmModel:
    """Learn from a bounded sample of the documents that are not held out and have a language."""
    rows = documents.select("doc_id", "text", "lang").where(~held_out())
    sample = bounded_sample(rows, "lang", sample_documents, sample_bytes)
    samples: dict[str, list[str]] = {}
    for row in sample.select("lang", "text").collect():
        samples.setdefault(row["lang"], []).append(row["text"])
    return PpmModel(samples)


def identify(documents: DataFrame, model: PpmModel) -> DataFrame:
    """`documents` with lang_pred, score and bits_per_byte added (existing columns of these names are replaced).

    The prediction is the language of the shortest code (the first by name among equals), the score its share of the
    probability of all languages. `und` with score 0 where the text is null or has no letter, or nothing was learned.
    """
    ship(documents.sparkSession)
    added = ("lang_pred", "score", "bits_per_byte")
    documents = documents.select(*[c for c in documents.columns if c not in added])
    names = [f"c{i}" for i in range(len(documents.columns))]
    plain = documents.toDF(*names)
    text = plain["c" + str(documents.columns.index("text"))]
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in parts(whole, len(names), 1000):
                letters = batch.column(len(names) + 1).fill_null(False).to_numpy(zero_copy_only=False)
                predicted: list[str] = ["und"] * batch.num_rows
                score, rate = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
                if model.languages:
                    texts = batch.column(len(names))
                    bits = model.bits(texts)
                    best = bits.argmin(axis=1)
                    least = bits[np.arange(len(bits)), best]
                    score = np.where(letters, 1 / np.exp2(np.minimum(0, least[:, None] - bits)).sum(axis=1), 0)
                    rate = np.where(letters, least / np.maximum(1, np.diff(utf8(texts)[1])), 0)
                    predicted = [model.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
                columns = [*batch.columns[: len(names)], pa.array(predicted, pa.string()), pa.array(score), pa.array(rate)]
                yield pa.RecordBatch.from_arrays(columns, [*names, *added])

    rows = plain.select(*names, text.alias("__text"), text.rlike(r"\p{L}").alias("__letters"))
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())]
    schema = T.StructType([*plain.schema.fields, *new])
    return rows.mapInArrow(score, schema).toDF(*documents.columns, *added)
