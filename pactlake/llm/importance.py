"""Operator 1: quality by importance resampling over hashed n-grams.

Two generative models of a text's features (words and pairs of words, A-Z in lower case, hashed to a fixed number of
buckets) are estimated: one from texts labelled good, one from the whole corpus. A document's importance is the
logarithm of the ratio of its probabilities under both. Gumbel noise is added and the k largest sums are taken, which
draws k documents without replacement in proportion to their importance.

The corpus model counts all words of all documents. The target model is learned from a bounded sample of labelled
documents. What crosses the shuffle is one row per bucket and task, and a double per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlake.llm.hashing import U64, lower, mix, parts, span_hashes, utf8, words
from pactlake.llm.sampling import labelled_sample
from pactlake.llm.scratch import Scratch
from pactlake.llm.selection import mark_largest
from pactlake.llm.shipping import ship

BUCKETS = 10_000
SAMPLE_DOCUMENTS, SAMPLE_BYTES = 4000, 32 << 20


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words and word pairs of all texts end to end, and to which text each belongs."""
    data, offsets = utf8(texts)
    data = lower(data)
    begins, ends, firsts = words(data, offsets)
    hashes = span_hashes(data, begins, ends)
    owner = np.repeat(np.arange(len(texts)), np.diff(firsts))
    pair = owner[1:] == owner[:-1]
    pairs = mix(hashes[:-1][pair] + mix(hashes[1:][pair] ^ U64(3)))
    out = np.concatenate([mix(hashes), pairs]) % U64(buckets)
    return out.astype(np.int64), np.concatenate([owner, owner[1:][pair]])


def corpus_counts(documents: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in parts(whole, 0, 2000):
                total += np.bincount(features(batch.column(0), buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": some, "n": total[some]})

    ship(documents.sparkSession)
    rows = documents.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Logarithm of the ratio of both models' bucket probabilities, every bucket counted once more than seen."""
    return np.log((target + 1) / (target + 1).sum()) - np.log((raw + 1) / (raw + 1).sum())


def log_weights(documents: DataFrame, ratio: np.ndarray) -> DataFrame:
    """(doc_id, n_features, log_weight): the sum of the ratios of a text's features; null where it has none."""
    buckets = len(ratio)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, 1, 2000):
                found, owner = features(batch.column(1), buckets)
                n = np.bincount(owner, minlength=batch.num_rows)
                weight = np.bincount(owner, weights=ratio[found], minlength=batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n), pa.array(weight, mask=n == 0)], ["doc_id", "n_features", "log_weight"]
                )

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(weigh, "doc_id long, n_features long, log_weight double")


def resample(
    documents: DataFrame, labels: DataFrame, label: str = "quality", share: float | None = None, buckets: int = BUCKETS,
    sample_documents: int = SAMPLE_DOCUMENTS, sample_bytes: int = SAMPLE_BYTES, seed: str = "gumbel",
) -> DataFrame:
    """One row per document: doc_id, n_features, log_weight, noisy (log_weight and Gumbel noise, what is ranked), selected
    (among the k largest).

    k is `share` of all rows, by default the share of labelled documents that are labelled good. The noise depends on the
    id alone. A text without words (or a null) has no weight and is never selected. Rows with the same id get the same
    noise; equal sums are taken by id. Without labels nothing is known of the target and every weight is 0.
    """
    good = labelled_sample(documents, labels.where(F.col(label) == 1), label, sample_documents, sample_bytes)
    texts = [r["text"] for r in good.select("text").collect()]
    raw = corpus_counts(documents, buckets)
    target = np.zeros(buckets, np.int64) if texts else raw
    for part in parts(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), 0, 2000):
        target += np.bincount(features(part.column(0), buckets)[0], minlength=buckets)
    if share is None:
        known = labels.groupBy("doc_id").agg(F.max(label).alias("label")).agg(F.avg("label")).first()[0]
        share = 1.0 if known is None else float(known)
    draw = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    with Scratch(documents.sparkSession, "importance") as scratch:
        weights = log_weights(documents, log_ratio(target, raw))
        ranked = scratch.table(weights.withColumn("noisy", F.col("log_weight") - F.log(-F.log(draw))))
        return scratch.result(mark_largest(ranked, "noisy", "doc_id", round(share * ranked.count()), "selected"))
