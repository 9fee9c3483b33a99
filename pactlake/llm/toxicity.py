"""Operator 4: toxicity by a bidirectional gated recurrent network over word and character inputs.

A word's input is the embedding of the word beside the greatest components of the embeddings of its character n-grams, so
an unknown word is known by its parts. Texts are cut into overlapping windows; each is read in both directions, its states
are pooled by attention, and a document scores as its highest window, however long it is.

The network is trained in numpy on the driver from a bounded sample of labelled documents: a label is the document's, so
each pass trains on the window that scores highest by then. Embeddings begin with the log-odds of their word or n-gram.
Scoring is per text and never shuffles; the model travels as a broadcast variable of a few megabytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlake.llm import recurrent
from pactlake.llm.hashing import U64, mix, parts, span_hashes, utf8, words
from pactlake.llm.lookup import Lookup
from pactlake.llm.sampling import held_out, labelled_sample
from pactlake.llm.shipping import ship

#: Bounds of the training sample for either label: documents, and bytes of text.
SAMPLE_DOCUMENTS, SAMPLE_BYTES = 1000, 3 << 20
WINDOW, STRIDE = 48, 36
EMBEDDING, HIDDEN, PASSES, BATCH, RATE = 8, 8, 5, 64, 0.02
#: Documents of the sample that a word or n-gram must occur in.
LEAST_DOCUMENTS = 3
_GRAMS = (3, 4, 5)
_ROWS = 2500
#: A-Z in lower case; every other ASCII character but letters and digits is a space.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
for _first, _last in ((48, 58), (97, 123)):
    _FOLD[_first:_last] = np.arange(_first, _last)
_FOLD[65:91] = np.arange(97, 123)


class Batch:
    """The words of some texts: distinct ones with their n-grams, and which of them stand where."""

    def __init__(self, texts: pa.Array):
        data, offsets = utf8(texts)
        data = _FOLD[data]
        begins, ends, self.firsts = words(data, offsets)
        hashes, first, self.index = np.unique(span_hashes(data, begins, ends), return_index=True, return_inverse=True)
        self.words = (hashes >> U64(32)).astype(np.uint32)
        self.grams, self.gram_owner = _grams(data, begins[first], ends[first])

    def only(self, used: np.ndarray) -> Batch:
        """The distinct words of the given numbers (ascending), numbered anew, without the texts."""
        out = Batch.__new__(Batch)
        first = np.searchsorted(self.gram_owner, used)
        counts = np.searchsorted(self.gram_owner, used, side="right") - first
        at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        out.words, out.grams, out.gram_owner = self.words[used], self.grams[at], np.repeat(np.arange(len(used)), counts)
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each window begins, and of which text it is; a text has at least one unless it has no word."""
        lengths = np.diff(self.firsts)
        counts = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE)), 0)
        owner = np.repeat(np.arange(len(lengths)), counts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.firsts[:-1][owner] + number * STRIDE, owner

    def laid_out(self, begins: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of distinct words (time, window) and the mask of what is inside the text."""
        at = begins[None, :] + np.arange(WINDOW)[:, None]
        mask = at < self.firsts[1:][owner][None, :]
        return self.index[np.minimum(at, len(self.index) - 1)], mask.astype(np.float32)


def _grams(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of words with a mark before and after, and to which word each belongs, in order."""
    sizes = ends - begins
    starts = np.cumsum(sizes + 2) - (sizes + 2)
    marked = np.full(int((sizes + 2).sum()) + 8, 94, np.uint64)
    inside = np.repeat(starts + 1 - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    marked[inside] = data[np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]
    marked[starts + sizes + 1] = 36
    out, owners = [], []
    owner = np.repeat(np.arange(len(sizes)), sizes + 2)
    left = np.repeat(starts + sizes + 2, sizes + 2) - np.arange(len(owner))
    for size in _GRAMS:
        at = np.flatnonzero(left >= size)
        code = np.full(len(at), size, np.uint64)
        for i in range(size):
            code = (code << U64(8)) | marked[at + i]
        out.append((mix(code) >> U64(32)).astype(np.uint32))
        owners.append(owner[at])
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(out)[order], np.concatenate(owners)[order]


class Model:
    def __init__(self, word_keys: np.ndarray, gram_keys: np.ndarray, params: recurrent.Params):
        self.words, self.grams, self.params = Lookup(word_keys), Lookup(gram_keys), params
        self.n_words, self.n_grams = len(word_keys), len(gram_keys)

    def inputs(self, batch: Batch, traced: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input of each distinct word, the row of its embedding, and (word, component) the greatest value of its n-grams,
        or, if traced, the n-gram that gives it."""
        row = self.words(batch.words)
        row = np.where(row < 0, self.n_words, row)
        gram = self.grams(batch.grams)
        known = gram >= 0
        gram, owner = gram[known], batch.gram_owner[known]
        table = self.params["gram"]
        best = np.full((len(row), table.shape[1]), self.n_grams, np.int64) if traced else np.repeat(table[-1:], len(row), axis=0)
        if len(gram) and not traced:
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best[owner[first]] = np.maximum.reduceat(table[gram], first, axis=0)
        elif len(gram):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            values = table[gram]
            top = np.maximum.reduceat(values, first, axis=0)
            run = np.cumsum(np.concatenate([[0], owner[1:] != owner[:-1]]))
            is_top = values == top[run]
            place = np.where(is_top, np.arange(len(gram))[:, None], len(gram))
            best[owner[first]] = gram[np.minimum.reduceat(place, first, axis=0)]
        chars = table[best, np.arange(table.shape[1])] if traced else best
        return np.concatenate([self.params["word"][row], chars], axis=1), row, best

    def window_logits(self, batch: Batch, begins: np.ndarray, owner: np.ndarray) -> np.ndarray:
        projected = recurrent.project(self.params, self.inputs(batch)[0])
        out = np.zeros(len(begins), np.float32)
        for at in range(0, len(begins), 2048):
            part = slice(at, at + 2048)
            out[part] = recurrent.logits(self.params, projected, *batch.laid_out(begins[part], owner[part]))
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The chance of label 1 for each text: that of its highest window, 0 for a text without words."""
        batch = Batch(texts)
        if not len(batch.index):
            return np.zeros(len(texts))
        begins, owner = batch.windows()
        highest = np.full(len(texts), -np.inf)
        np.maximum.at(highest, owner, self.window_logits(batch, begins, owner))
        return np.where(np.isfinite(highest), recurrent.sigmoid(highest), 0.0)


def _presence(keys: np.ndarray, owner: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, in how many texts each is, and in how many with label 1."""
    pairs = np.unique(keys.astype(U64) << U64(32) | owner.astype(U64))
    key, text = (pairs >> U64(32)).astype(np.uint32), (pairs & U64(0xFFFFFFFF)).astype(np.int64)
    kinds, kind = np.unique(key, return_inverse=True)
    return kinds, np.bincount(kind, minlength=len(kinds)), np.bincount(kind, weights=label[text], minlength=len(kinds))


def _log_odds(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of enough texts, and the log-odds of label 1 that their presence gives; from the counts of parts of the texts."""
    keys, totals, positives = (np.concatenate(x) for x in zip(*parts, strict=True))
    kinds, kind = np.unique(keys, return_inverse=True)
    total = np.bincount(kind, weights=totals, minlength=len(kinds))
    ones = np.bincount(kind, weights=positives, minlength=len(kinds))
    odds = np.log((ones + 0.5) / (label.sum() + 1)) - np.log((total - ones + 0.5) / ((1 - label).sum() + 1))
    return kinds[total >= LEAST_DOCUMENTS], odds[total >= LEAST_DOCUMENTS].astype(np.float32)


def train(texts: list[str], labels: list[int], passes: int = PASSES, seed: int = 7) -> Model:
    """Fit the network to texts and their labels (0 or 1); the same sample gives the same model."""
    rng = np.random.default_rng(seed)
    batch, label = Batch(pa.array(texts, pa.string())), np.array(labels, np.float32)
    nothing = (np.zeros(0, np.uint32), np.zeros(0), np.zeros(0))
    word_parts, gram_parts = [nothing], [nothing]
    for begin in range(0, len(texts), 50):
        part = Batch(pa.array(texts[begin : begin + 50], pa.string()))
        spoken = np.repeat(np.arange(begin, min(begin + 50, len(texts))), np.diff(part.firsts))
        word_parts.append(_presence(part.words[part.index], spoken, label))
        pairs = np.unique(part.index.astype(np.int64) * len(texts) + spoken)
        word, text = pairs // len(texts), pairs % len(texts)
        counts = np.bincount(part.gram_owner, minlength=len(part.words))
        first, counts = (np.cumsum(counts) - counts)[word], counts[word]
        at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        gram_parts.append(_presence(part.grams[at], np.repeat(text, counts), label))
    (word_keys, word_odds), (gram_keys, gram_odds) = _log_odds(word_parts, label), _log_odds(gram_parts, label)
    params = recurrent.initial(len(word_keys), len(gram_keys), EMBEDDING, HIDDEN, rng)
    params["word"][:-1, 0], params["gram"][:-1, 0] = word_odds / 4, gram_odds / 4
    params["gram"][-1] = -1
    model = Model(word_keys, gram_keys, params)
    begins, owner = batch.windows()
    if not len(begins) or label.min() == label.max():
        params["out"][:] = 0
        params["bias"][:] = -6 if not label.sum() else 6
        return model
    odds = (model.inputs(batch)[0][:, [0, EMBEDDING]]).sum(axis=1)[batch.index]
    peak = np.array([odds[b : min(b + WINDOW, batch.firsts[o + 1])].max() for b, o in zip(begins, owner, strict=True)])
    adam = recurrent.Adam(params, RATE)
    for _ in range(passes):
        order = np.lexsort((-peak, owner))
        top = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]
        zero = np.flatnonzero(label[owner] == 0)
        chosen = np.concatenate([top, rng.choice(zero, min(len(zero), len(top) // 2), replace=False)])
        ones = chosen[label[owner[chosen]] == 1]
        more = max(0, (len(chosen) - len(ones)) // max(1, len(ones)) - 1)
        chosen = np.concatenate([chosen, *[ones] * min(more, 4)])
        rng.shuffle(chosen)
        for i in range(0, len(chosen), BATCH):
            _learn(model, adam, batch, begins, owner, label, chosen[i : i + BATCH])
        peak = model.window_logits(batch, begins, owner)
    return model


def _learn(model: Model, adam: recurrent.Adam, batch: Batch, begins, owner, label, windows: np.ndarray) -> None:
    index, mask = batch.laid_out(begins[windows], owner[windows])
    used, local = np.unique(index, return_inverse=True)
    x, row, best = model.inputs(batch.only(used), traced=True)
    _, g, d_x = recurrent.gradients(model.params, x, local.reshape(index.shape), mask, label[owner[windows]])
    rows, at = np.unique(row, return_inverse=True)
    d_word = np.zeros((len(rows), EMBEDDING), np.float32)
    np.add.at(d_word, at, d_x[:, :EMBEDDING])
    grams, at = np.unique(best, return_inverse=True)
    d_gram = np.zeros((len(grams), EMBEDDING), np.float32)
    np.add.at(d_gram, (at.reshape(best.shape), np.arange(EMBEDDING)), d_x[:, EMBEDDING:])
    adam.step(g, {"word": (rows, d_word), "gram": (grams, d_gram)})


def fit(documents: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Learn `toxic` from a bounded sample of the labelled documents that are not held out."""
    known = labels.select("doc_id", "toxic").where(~held_out())
    rows = labelled_sample(documents, known, "toxic", sample_documents, sample_bytes).select("text", "label", "doc_id").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"] for r in rows], [r["label"] for r in rows])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    A null text and a text without words score 0. Repeated rows get a row each; other columns are not read. With no labelled
    document, or with one label only, every document with words scores alike.
    """
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in parts(whole, 2, _ROWS):
                scores = model.scores(batch.column(2)).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(read, "doc_id long, held_out boolean, score double, predicted int")
