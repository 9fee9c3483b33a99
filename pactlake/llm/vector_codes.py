"""Operator 12: vectors compressed to codes, their codebooks learned with adaptive distance bounds (Drake and Hamerly).

A vector is cut into equal parts; each part position has a codebook, and a part's code is its nearest entry. Learning a
codebook is a clustering of that position's parts, and most assignments do not change from round to round. So with every part
are kept its b closest entries in order, an upper bound of the distance to the first, lower bounds of the distances to
the others, and one outer bound below the distance of every entry that is not listed. When the entries move, the bounds are
widened by how far each has moved. As long as the upper bound is below all lower ones the code is certain and nothing
is measured. Otherwise the distance to the first entry is measured, and if that does not settle it the listed entries that can
still be nearest, or, where the outer bound is passed, all entries; then the list is made anew.

Measured distances are squared and integer, and equal ones go to the lower index: bounds only ever decide what need not
be measured. They are kept as 32-bit floats rounded outwards, and certainty asks for a strict inequality, so rounding
cannot make a wrong code certain. How long the lists are is chosen anew each round, by position: as long as all but a
small share of the parts needed, and twice that where many fell back to all entries.

A round's state is a table in the shared folder that takes the place of the one before. To the driver come sums and counts of
entries and of list places, whose number the parameters bound. Vectors are not shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactlake.llm.scratch import Scratch
from pactlake.llm.vectors import floor_means, integers, lists, matrix, sound

#: Share of the parts whose lists may prove too short before lists are made longer.
SHORT_SHARE = 1 / 32
_ROWS = 4096
_NONE = -1
_TALLY = "kind int, part int, slot int, n long, sums array<long>"


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of each row of x to its own entries (rows, entries, components)."""
    apart = x[:, None, :] - entries
    return (apart * apart).sum(axis=2)


class PartBounds:
    """Nearest entries and bounds of many parts of one position: `near` (b entries in order, -1 for none), `low` (b bounds, the
    first an upper one), `outer`; and `need`, the list place up to which entries had to be measured (b: all entries)."""

    def __init__(self, near: np.ndarray, low: np.ndarray, outer: np.ndarray):
        self.near, self.low, self.outer = near, low, outer
        self.need = np.zeros(len(near), np.int64)

    @classmethod
    def unknown(cls, rows: int) -> PartBounds:
        return cls(np.full((rows, 1), _NONE, np.int16), np.full((rows, 1), np.inf, np.float32), np.full(rows, -np.inf, np.float32))

    def resized(self, size: int) -> PartBounds:
        """Lists of `size` entries. What is left out is covered by the outer bound; what is not known is covered already."""
        rows, old = self.near.shape
        if size < old:
            outer = np.minimum(self.outer, self.low[:, size:].min(axis=1))
            return PartBounds(self.near[:, :size], self.low[:, :size], outer)
        near = np.concatenate([self.near, np.full((rows, size - old), _NONE, np.int16)], axis=1)
        return PartBounds(near, np.concatenate([self.low, np.repeat(self.outer[:, None], size - old, axis=1)], axis=1), self.outer)

    def moved(self, drift: np.ndarray) -> PartBounds:
        """The bounds after every entry has moved by at most its drift."""
        by = np.where(self.near >= 0, drift[self.near], drift.max(initial=0.0))
        low = self.low.astype(np.float64)
        low = np.concatenate([_up(low[:, :1] + by[:, :1]), _down(low[:, 1:] - by[:, 1:])], axis=1)
        outer = _down(self.outer.astype(np.float64) - drift.max(initial=0.0))
        # Each bound also holds for what comes after it, so that they are in order.
        after = np.minimum.accumulate(np.concatenate([low[:, 1:], outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
        low[:, 1:] = after[:, :-1]
        return PartBounds(self.near, low, outer)

    def settled(self, x: np.ndarray, codebook: np.ndarray) -> PartBounds:
        """With the right nearest entry first: what the bounds leave open is measured."""
        near, low, outer = self.near.copy(), self.low.copy(), self.outer.copy()
        out = PartBounds(near, low, outer)
        size = near.shape[1]
        least = low[:, 1] if size > 1 else outer
        open_ = np.flatnonzero((low[:, 0] >= least) | (near[:, 0] < 0))
        known = open_[near[open_, 0] >= 0]
        low[known, 0] = _up(np.sqrt(_squared(x[known], codebook[near[known, 0]][:, None, :])[:, 0].astype(np.float64)))
        open_ = open_[(low[open_, 0] >= least[open_]) | (near[open_, 0] < 0)]
        beyond = (outer[open_] <= low[open_, 0]) | (near[open_, 0] < 0)
        listed, everything = open_[~beyond], open_[beyond]
        # Listed entries up to the last whose bound does not rule it out.
        out.need[listed] = 1 + (low[listed, 1:] <= low[listed, :1]).sum(axis=1)
        out.need[everything] = size + 1
        if len(listed):
            place = np.arange(size)[None, :] < out.need[listed][:, None]
            index = near[listed].astype(np.int64)
            exact = _squared(x[listed], codebook[np.maximum(index, 0)])
            measured = np.where(place & (index >= 0), exact, np.iinfo(np.int64).max)
            order = np.lexsort((index, measured), axis=-1)
            # What was not measured keeps its place: it comes after all that was.
            bound = np.where(place, _down(np.sqrt(exact.astype(np.float64))), low[listed])
            order = np.where(place, order, np.arange(size)[None, :])
            near[listed] = np.take_along_axis(index, order, axis=1).astype(np.int16)
            low[listed] = np.take_along_axis(bound, order, axis=1)
            first = np.take_along_axis(exact, order[:, :1], axis=1)[:, 0]
            low[listed, 0] = _up(np.sqrt(first.astype(np.float64)))
        if len(everything):
            exact = _squared(x[everything], codebook[None, :, :])
            order = np.argsort(exact, axis=1, kind="stable")
            sorted_ = np.sqrt(np.take_along_axis(exact, order, axis=1).astype(np.float64))
            filled = min(size, len(codebook))
            near[everything, :filled] = order[:, :filled]
            near[everything, filled:] = _NONE
            low[everything, :filled], low[everything, filled:] = _down(sorted_[:, :filled]), np.inf
            low[everything, 0] = _up(sorted_[:, 0])
            outer[everything] = _down(sorted_[:, filled]) if filled < len(codebook) else np.inf
        return out


class Layout:
    """How a vector's parts lie in the columns of the state: `sizes` is the list length of each position."""

    def __init__(self, sizes: list[int]):
        self.sizes = sizes
        self.near = np.concatenate([[0], np.cumsum(sizes)])
        self.bounds = np.concatenate([[0], np.cumsum([s + 1 for s in sizes])])

    def read(self, near: pa.Array, bounds: pa.Array) -> list[PartBounds]:
        index = matrix(near, int(self.near[-1]), np.int16)
        values = matrix(bounds, int(self.bounds[-1]), np.float32)
        out = []
        for p, size in enumerate(self.sizes):
            mine = values[:, self.bounds[p] : self.bounds[p + 1]]
            out.append(PartBounds(index[:, self.near[p] : self.near[p + 1]], mine[:, :size], mine[:, size]))
        return out

    @staticmethod
    def columns(parts: list[PartBounds]) -> list[pa.Array]:
        near = np.concatenate([p.near for p in parts], axis=1)
        bounds = np.concatenate([x for p in parts for x in (p.low, p.outer[:, None])], axis=1)
        need = np.stack([p.need for p in parts], axis=1)
        return [lists(near, pa.int16()), lists(bounds, pa.float32()), lists(need, pa.int16())]


def _assigned(batch: pa.RecordBatch, layout: Layout | None, sizes: list[int], codebooks: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, list[PartBounds]]:
    """The parts of a batch (vec_id, label, x, near, bounds) and their settled bounds; without a layout nothing is known yet."""
    count, _, width = codebooks.shape
    x = matrix(batch.column(2), count * width).reshape(-1, count, width)
    known = layout.read(batch.column(3), batch.column(4)) if layout else [PartBounds.unknown(len(x))] * count
    settled = []
    for p in range(count):
        bounds = known[p].moved(drift[p]).resized(sizes[p])
        settled.append(bounds.settled(x[:, p], codebooks[p]))
    return x, settled


def _round(state: DataFrame, layout: Layout | None, sizes: list[int], codebooks: np.ndarray, drift: np.ndarray, label: T.DataType) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(begin, _ROWS)
                _, parts = _assigned(batch, layout, sizes, codebooks, drift)
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *Layout.columns(parts)], ["vec_id", "label", "x", "near", "bounds", "need"])

    schema = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("label", label), T.StructField("x", T.ArrayType(T.IntegerType()))]
        + [T.StructField("near", T.ArrayType(T.ShortType())), T.StructField("bounds", T.ArrayType(T.FloatType())), T.StructField("need", T.ArrayType(T.ShortType()))]
    )
    columns = ["vec_id", "label", "x"] + (["near", "bounds"] if layout else [])
    return state.select(*columns).mapInArrow(assign, schema)


def _coded(state: DataFrame, layout: Layout | None, sizes: list[int], codebooks: np.ndarray, drift: np.ndarray, label: T.DataType) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(begin, _ROWS)
                x, parts = _assigned(batch, layout, sizes, codebooks, drift)
                index = np.stack([p.near[:, 0] for p in parts], axis=1).astype(np.int64)
                apart = x - codebooks[np.arange(len(parts))[None, :], index]
                codes = [row.tobytes() for row in index.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(codes, pa.binary()), pa.array((apart * apart).sum(axis=(1, 2)))],
                    ["vec_id", "label", "code", "error"],
                )

    schema = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("label", label), T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]
    )
    columns = ["vec_id", "label", "x"] + (["near", "bounds"] if layout else [])
    return state.select(*columns).mapInArrow(assign, schema)


def _tally(state: DataFrame, sizes: list[int], shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Counts and component sums of every entry, and for each position how many parts needed each length of list."""
    count, entries, width = shape
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((count, entries), np.int64), np.zeros((count, entries, width), np.int64)
        needs = [np.zeros(s + 2, np.int64) for s in sizes]
        for batch in batches:
            x = matrix(batch.column(0), count * width).reshape(-1, count, width)
            code = matrix(batch.column(1), sum(sizes), np.int16)[:, starts]
            need = matrix(batch.column(2), count)
            for p in range(count):
                counts[p] += np.bincount(code[:, p], minlength=entries)
                for j in range(width):  # sums of a batch are far below 2**53, so the doubles are exact
                    sums[p, :, j] += np.bincount(code[:, p], weights=x[:, p, j], minlength=entries).astype(np.int64)
                needs[p] += np.bincount(need[:, p], minlength=sizes[p] + 2)
        rows = [(0, p, e, counts[p, e], sums[p, e].tolist()) for p in range(count) for e in range(entries) if counts[p, e]]
        rows += [(1, p, i, n, [0] * width) for p in range(count) for i, n in enumerate(needs[p].tolist()) if n]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["kind", "part", "slot", "n", "sums"])

    parts = state.select("x", "near", "need").mapInArrow(total, _TALLY)
    added = parts.groupBy("kind", "part", "slot").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(width)]).alias("sums"))
    counts, sums = np.zeros((count, entries), np.int64), np.zeros((count, entries, width), np.int64)
    needs = [np.zeros(s + 2, np.int64) for s in sizes]
    for row in added.collect():
        if row["kind"] == 0:
            counts[row["part"], row["slot"]], sums[row["part"], row["slot"]] = row["n"], row["sums"]
        else:
            needs[row["part"]][row["slot"]] = row["n"]
    return counts, sums, needs


def adapted(size: int, needs: np.ndarray, entries: int) -> int:
    """The list length that all but `SHORT_SHARE` of the parts could do with, from an eighth to half of the entries; twice
    as long as now where more than that share needed all entries."""
    most = max(1, entries // 2)
    allowed = SHORT_SHARE * needs.sum()
    if needs[size + 1] > allowed:
        return min(most, 2 * size)
    longer = needs[::-1].cumsum()[::-1]  # how many needed at least so much
    enough = next((b for b in range(1, size + 1) if longer[b + 1] <= allowed), size)
    return int(np.clip(enough, min(most, max(2, entries // 8)), most))


def compress(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks): a row per kept vector with vec_id, label, code (a byte per part, the index of its entry) and error (the
    squared distances of its parts to their entries, summed), and the codebooks as integers by part, entry and component.

    Kept are vectors that are not null and have no null or non-finite component, a component x becoming floor(scale * x) (saturating at
    `vectors.LARGEST`). All vectors have as many components as the first of them by id that has any, a multiple of `parts`, or a
    ValueError is raised; kept vectors of another width are dropped. A codebook starts as that part of the vectors with the smallest
    ids (null ids last, equal ids by vector; with fewer vectors than `entries` there are fewer). Each round assigns every part to
    the nearest entry, ties to the lower index, and replaces each used entry by the floored mean of its parts; then
    parts are assigned once more. A round that changes no entry is the last, since all others would repeat it. Repeated
    rows count as often as they come, other columns are not read, an empty table gives no rows.
    """
    if entries > 256:
        raise ValueError("an index is one byte")
    with Scratch(vectors.sparkSession, "codes") as scratch:
        rows = vectors.where(sound(F.col(vector).cast("array<double>")) & (F.size(vector) > 0))
        rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), integers(rows, vector, scale).alias("x"))
        kept = scratch.table(rows)
        by_id = (F.col("vec_id").asc_nulls_last(), F.col("x"))
        first = kept.orderBy(*by_id).first()
        kind = kept.schema["label"].dataType
        if first is None:
            none = kept.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
            return scratch.result(none), np.zeros((parts, 0, 0), np.int64)
        width, odd = divmod(len(first["x"]), parts)
        if odd:
            raise ValueError(f"vectors of {len(first['x'])} components cannot be cut into {parts} equal parts")
        state = kept.where(F.size("x") == width * parts)
        starting = np.array([r["x"] for r in state.select("x", "vec_id").orderBy(*by_id).limit(entries).collect()], np.int64)
        codebooks = starting.reshape(-1, parts, width).transpose(1, 0, 2).copy()
        drift, layout = np.zeros(codebooks.shape[:2]), None
        sizes = [max(2, codebooks.shape[1] // 4)] * parts
        for _ in range(rounds):
            state, listed = scratch.state(_round(state, layout, sizes, codebooks, drift, kind)), layout is not None
            layout = Layout(sizes)
            counts, sums, needs = _tally(state, sizes, codebooks.shape)
            after = np.stack([floor_means(sums[p], counts[p], codebooks[p]) for p in range(parts)])
            apart = after - codebooks
            drift = np.nextafter(np.sqrt((apart * apart).sum(axis=2).astype(np.float64)), np.inf)
            drift[~apart.any(axis=2)] = 0
            if listed:  # in the first round no part had a list
                sizes = [adapted(s, n, codebooks.shape[1]) for s, n in zip(sizes, needs, strict=True)]
            codebooks = after
            if not apart.any():
                break
        return scratch.result(_coded(state, layout, sizes, codebooks, drift, kind)), codebooks


def decode(codes: DataFrame, codebooks: np.ndarray, scale: int = 4096) -> DataFrame:
    """(vec_id, embedding) that the codes stand for."""
    width = codebooks.shape[0] * codebooks.shape[2]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, len(codebooks))
            values = codebooks[np.arange(len(codebooks))[None, :], index].reshape(-1, width) / scale
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(values, pa.float64())], ["vec_id", "embedding"])

    return codes.select("vec_id", "code").mapInArrow(read, "vec_id long, embedding array<double>")


def codebooks_digest(codebooks: np.ndarray) -> str:
    """The sha256 of all components as decimal integers, by part, entry and component, joined by commas, in lower-case hex."""
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def described(codes: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, code as hex, error, label_error, codebooks_sha256). Errors are summed by label before the join, in which
    nulls are one label."""
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256")
    )
