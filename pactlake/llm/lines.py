"""Operator 10: removal of repeated lines across documents by an exact set-similarity join.

A line is the set of its words in lower case; a later line goes if an earlier one, by document id and line number, is at
least 0.8 similar (Jaccard). Words are ordered by rarity, and a line's sequence in that order is filtered four ways:

* *Positional.* Keys are runs of two neighbours in the order, not single words. Two lines of
  n and m words that share o of them have at least o - (q - 1)(1 + n + m - 2o) runs of q words in common, for each word that
  only one of them has interrupts at most q - 1 runs of shared ones. A run of rare words is far rarer than a word, so few
  unlike lines meet however large the corpus.
* *Prefix.* With that many common runs the rarest ones of both lines, all but as many as they must share and one, hold a
  common one; only those are keys.
* *Length.* How many that is follows from the least partner that 0.8 allows, and pairs outside that range are dropped.
* *Bits.* With its keys a line carries 64 bits, each the parity of how many of its words belong to it. A word that only one of
  two lines has turns one bit, so lines whose bits differ in more places than similar lines have such words are dropped.

Equal lines stand for one another: what they meet is carried over to the first of them, and of those that a task remembers
one alone makes keys.

Lines that share a key are each compared with the first few of them; those that these do not settle are compared with the
other earlier ones. So a family of thousands of variants of a line costs a few comparisons per variant, unless its variants
are hardly similar to one another. Comparison counts the common words of both lines in full.

Rarity is counted in hash buckets over all words of all lines. Only the counts of buckets come to the driver, a fixed
number, and any order gives the same result. Words are compared as 64-bit hashes. Keys are made and met in numpy, packed to a
few bytes each; what meets is joined, compared and removed by DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlake.llm.hashing import U64, mix, parts, span_hashes, utf8, words
from pactlake.llm.scratch import Scratch

SIMILAR = 80
BUCKETS = 1 << 16
#: Text bytes whose keys one task gathers, and members up to which a group of lines with a key is listed pair by pair.
KEY_BYTES, FEW = 24 << 20, 64
#: Of a larger group, the first members that all others are compared with before any others are.
HEADS = 4
#: Words of a key.
RUN = 2
#: Digests of lines that a task remembers, so that a line that it sees again does not sign again.
KNOWN = 1 << 17
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SPACES = r"[\x20\x09\x0B-\x0D]+"
_ROWS = 1000
_BREAK = 10


def _split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines with words, end to end: text, number in it, hashes of the words, and where each line's words begin."""
    data, offsets = utf8(texts)
    ends = np.union1d(np.flatnonzero(data == _BREAK) + 1, offsets)
    begins, finishes, _ = words(data, offsets)
    hashes = span_hashes(data, begins, finishes)
    line = np.searchsorted(ends, begins, side="right") - 1
    text = np.searchsorted(offsets, ends[:-1], side="right") - 1 if len(ends) > 1 else np.zeros(0, np.int64)
    breaks = np.concatenate([[0], np.cumsum(data == _BREAK)])
    number = breaks[ends[:-1]] - breaks[offsets[text]] if len(ends) > 1 else text
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
    own = line[first]
    return text[own], number[own], hashes, np.append(first, len(line))


def _in_order(hashes: np.ndarray, starts: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of each line, the rarest first: by the place of the word's bucket, then by hash."""
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    place = places[(hashes % U64(BUCKETS)).astype(np.int64)]
    # Line, place and as much of the hash as fits make one number to sort by; where that cannot tell words apart, all three do.
    spare = U64(64 - BUCKETS.bit_length() + 1 - max(len(starts) - 1, 1).bit_length())
    packed = ((owner.astype(U64) * U64(BUCKETS) + place.astype(U64)) << spare) | (hashes >> (U64(64) - spare))
    order = np.argsort(packed)
    packed = packed[order]
    if np.any((packed[1:] == packed[:-1]) & (hashes[order[1:]] != hashes[order[:-1]])):
        order = np.lexsort((hashes, place, owner))
    hashes, owner = hashes[order], owner[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    out = np.zeros(len(starts), np.int64)
    np.cumsum(np.bincount(owner[keep], minlength=len(starts) - 1), out=out[1:])
    return hashes[keep], out


def least_common(n, m):
    """The least number of words that sets of n and m words share if they are similar: 4 (n + m) / 9, rounded up."""
    return -(-(SIMILAR * (n + m)) // (100 + SIMILAR))


def key_count(n: np.ndarray, run: int) -> np.ndarray:
    """How many of the rarest runs of a line of n words are keys: all but as many as any similar line shares, and one. Nine
    words more of the other line are four more common ones, and never fewer common runs, so the fewest are shared with one of
    the nine least sizes."""
    least, largest = -(-(SIMILAR * n) // 100), (100 * n) // SIMILAR
    shared = np.full(len(n), 1 << 40)
    for m in (least + i for i in range(9)):
        common = least_common(n, m)
        common_runs = common - (run - 1) * (1 + n + m - 2 * common)
        shared = np.where(m <= largest, np.minimum(shared, common_runs), shared)
    runs = n - run + 1
    return np.clip(runs - shared + 1, 0, runs)


def keys_of(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of all lines: their rarest runs of two words."""
    counts = key_count(np.diff(starts), RUN)
    line = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(line)) + np.repeat(starts[:-1] - (np.cumsum(counts) - counts), counts)
    key = np.full(len(line), RUN, U64)
    for i in range(RUN):
        key = mix(key ^ values[at + i])
    return line, key


def _digests(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each line's set of words, whatever its order."""
    sums = []
    for seed in (3, 5):
        total = np.zeros(len(values) + 1, U64)
        np.cumsum(mix(values + U64(seed)), out=total[1:])
        sums.append(mix(total[starts[1:]] - total[starts[:-1]]))
    return sums[0], sums[1]


def _parities(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64 bits of each line, each the parity of how many of its words belong to the bit."""
    total = np.zeros(len(values) + 1, U64)
    np.bitwise_xor.accumulate(U64(1) << (mix(values + U64(7)) >> U64(58)), out=total[1:])
    return total[starts[1:]] ^ total[starts[:-1]]


def may_be_similar(n, m, differing):
    """Whether lines of n and m words, whose bits differ in so many places, may be similar: a word that only one of them has
    turns one bit, and similar lines have at most a ninth of their words, counted together, in one of them only."""
    sizes = (100 * n >= SIMILAR * m) & (100 * m >= SIMILAR * n) & ((100 + SIMILAR) * differing <= (100 - SIMILAR) * (n + m))
    return sizes | (n >= _WIDE) | (m >= _WIDE)


def _sets(documents: DataFrame) -> DataFrame:
    """(doc_id, line, a, b): two hashes of each line's set of words. After its lines a task tells (bucket, n): how many words it saw."""
    names = ["doc_id", "line", "a", "b", "bucket", "n"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def row(columns, size):
        return pa.RecordBatch.from_arrays([pa.nulls(size, k) if c is None else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def digest(batches):
        total = np.zeros(BUCKETS, np.int64)
        for whole in batches:
            for batch in parts(whole, 1, _ROWS):
                text, number, hashes, starts = _split(batch.column(1))
                total += np.bincount((hashes % U64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
                a, b = _digests(*_in_order(hashes, starts, np.arange(BUCKETS)))
                yield row([batch.column(0).to_numpy()[text], number, a.view(np.int64), b.view(np.int64), None, None], len(text))
        some = np.flatnonzero(total)
        yield row([None] * 4 + [some, total[some]], len(some))

    return documents.mapInArrow(digest, "doc_id long, line int, a long, b long, bucket long, n long")


def rarity(sets: DataFrame) -> np.ndarray:
    """The place of each bucket among all, the one with the fewest words first."""
    counts = np.zeros(BUCKETS, np.int64)
    for row in sets.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    out = np.empty(BUCKETS, np.int64)
    out[np.argsort(counts, kind="stable")] = np.arange(BUCKETS)
    return out


_NULL = -(1 << 63)
_PACKED = "pid int, docs binary, counts binary, line binary, low binary, high binary, size binary, bits binary"
_MET = "doc_id long, line int, to_doc long, to_line int, list long, size int, bits long"
#: Sizes from here on are kept as this one.
_WIDE = (1 << 16) - 1


def _met(documents: DataFrame, places: np.ndarray, pids: int) -> DataFrame:
    """Lines and earlier lines that share a key: every pair of a small group; of a larger one each line and the first ones, and the
    group's lines under the number of a list (to_doc and to_line null). Of equal lines that a task remembers one signs for all."""

    def sign(batches):
        known = np.zeros((2, KNOWN), U64)
        for whole in batches:
            for batch in parts(whole, 1, _ROWS):
                text, number, hashes, starts = _split(batch.column(1))
                values, starts = _in_order(hashes, starts, places)
                a, b = _digests(values, starts)
                slot = (a % U64(KNOWN)).astype(np.int64)
                new = np.flatnonzero((known[0][slot] != a) | (known[1][slot] != b))
                new = new[np.unique(np.stack([a[new], b[new]], axis=1), axis=0, return_index=True)[1]] if len(new) else new
                new.sort()
                known[0][slot[new]], known[1][slot[new]] = a[new], b[new]
                line, key = keys_of(values, starts)
                signs = np.zeros(len(a), bool)
                signs[new] = True
                line, key = line[signs[line]], key[signs[line]]
                ids = batch.column(0).to_numpy()
                pid = (key >> U64(40)) % U64(pids)
                order = np.argsort(pid, kind="stable")
                line, key = line[order], key[order]
                cuts = np.searchsorted(pid[order], np.arange(pids + 1, dtype=U64))
                sizes, bits = np.minimum(np.diff(starts), _WIDE), _parities(values, starts)
                rows: dict[str, list] = {name.split()[0]: [] for name in _PACKED.split(", ")}
                for p in np.flatnonzero(np.diff(cuts)):
                    part = slice(cuts[p], cuts[p + 1])
                    owner = text[line[part]]
                    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                    rows["pid"].append(int(p))
                    rows["docs"].append(ids[owner[first]].astype("<i8").tobytes())
                    rows["counts"].append(np.diff(np.append(first, len(owner))).astype("<u4").tobytes())
                    rows["line"].append(number[line[part]].astype("<u4").tobytes())
                    rows["low"].append(key[part].astype("<u4").tobytes())
                    rows["high"].append((key[part] >> U64(32)).astype("u1").tobytes())
                    rows["size"].append(sizes[line[part]].astype("<u2").tobytes())
                    rows["bits"].append(bits[line[part]].astype("<u8").tobytes())
                kinds = [("pid", pa.int32())] + [(c, pa.binary()) for c in rows if c != "pid"]
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(kinds))

    def meet(table: pa.Table) -> pa.Table:
        read = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
        doc = np.repeat(read("docs", "<i8"), read("counts", "<u4"))
        line = read("line", "<u4").astype(np.int64)
        key = read("low", "<u4").astype(U64) | (read("high", "u1").astype(U64) << U64(32))
        order = np.lexsort((line, doc, key))
        doc, line, key, n, bits = doc[order], line[order], key[order], read("size", "<u2")[order].astype(np.int64), read("bits", "<u8")[order]
        # One place may hold several lines, where rows share an id, and a line the same key twice.
        keep = np.ones(len(key), bool)
        keep[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (line[1:] != line[:-1]) | (n[1:] != n[:-1]) | (bits[1:] != bits[:-1])
        doc, line, key, n, bits = doc[keep], line[keep], key[keep], n[keep], bits[keep]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(key)))
        left, right = [], []

        def candidates(later: np.ndarray, earlier: np.ndarray) -> None:
            near = may_be_similar(n[later], n[earlier], np.bitwise_count(bits[later] ^ bits[earlier]).astype(np.int64))
            left.append(later[near])
            right.append(earlier[near])

        group = np.flatnonzero((size > 1) & (size <= FEW))
        for back in range(1, FEW):
            group = group[size[group] > back]
            counts = size[group] - back
            later = np.arange(int(counts.sum())) + np.repeat(first[group] + back - (np.cumsum(counts) - counts), counts)
            candidates(later, later - back)
        group = np.flatnonzero(size > FEW)
        counts = size[group]
        member = np.arange(int(counts.sum())) + np.repeat(first[group] - (np.cumsum(counts) - counts), counts)
        head = np.repeat(first[group], counts)
        for early in range(HEADS):
            later = member > head + early
            candidates(member[later], head[later] + early)
        left, right = np.concatenate(left), np.concatenate(right)
        pairs = np.unique(np.stack([doc[left], line[left], doc[right], line[right]], axis=1), axis=0) if len(left) else np.zeros((0, 4), np.int64)
        # Equal groups are one list; its number is a hash of its members.
        named = mix(doc[member].astype(U64) + mix(line[member].astype(U64) + U64(9)))
        total = np.zeros(len(named) + 1, U64)
        np.cumsum(named, out=total[1:])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        number = mix(total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)
        one = np.zeros(len(group), bool)
        one[np.unique(number, return_index=True)[1]] = True
        listed = np.repeat(one, counts)
        lists, member = np.repeat(number, counts)[listed], member[listed]
        k, m = len(pairs), len(member)
        whole = lambda a, b, kind: pa.concat_arrays([pa.array(a, kind), pa.array(b, kind) if b is not None else pa.nulls(m, kind)])
        return pa.table(
            {
                "doc_id": whole(pairs[:, 0], doc[member], pa.int64()), "line": whole(pairs[:, 1], line[member], pa.int32()),
                "to_doc": whole(pairs[:, 2], None, pa.int64()), "to_line": whole(pairs[:, 3], None, pa.int32()),
                "list": pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(lists, pa.int64())]),
                "size": pa.concat_arrays([pa.nulls(k, pa.int32()), pa.array(n[member], pa.int32())]),
                "bits": pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(bits[member].view(np.int64), pa.int64())]),
            }
        )

    return documents.mapInArrow(sign, _PACKED).groupBy("pid").applyInArrow(meet, _MET).distinct()


def _here() -> Column:
    return F.struct("doc_id", "line")


def _there() -> Column:
    return F.struct(F.col("to_doc").alias("doc_id"), F.col("to_line").alias("line"))


def similar(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return 100 * common >= SIMILAR * (F.size(a) + F.size(b) - common)


def repeated_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, line) of every line that an earlier line is similar to, exact repeats included; lines count from 0.

    The order is by doc_id (null first, as if the least long) and line number. A null text has no line; a line without
    words is never removed. Rows that share an id have their lines at the same places: lines at one place are not earlier
    than one another, and a place is given once if any of its lines is removed. Other columns are not read.
    """
    spark = documents.sparkSession
    documents = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("doc_id"), F.col("text"))
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lowered = documents.withColumn("text", F.lower("text"))
    pids = max(math.ceil(size / KEY_BYTES), spark.sparkContext.defaultParallelism)
    with _shuffles_freed(spark), Scratch(spark, "lines") as scratch:
        told = scratch.table(_sets(lowered))
        sets = told.where("bucket IS NULL")
        firsts = sets.groupBy("a", "b").agg(F.min(_here()).alias("first"), F.count(F.lit(1)).alias("lines")).where("lines > 1").drop("lines")
        exact = sets.join(firsts, ["a", "b"]).where(_here() > F.col("first")).select("doc_id", "line", "first").distinct()
        exact = scratch.table(exact)
        met = scratch.table(_met(lowered, rarity(told), pids))
        pairs = scratch.table(_between_firsts(met.where("list IS NULL"), exact))
        lists = met.where("list IS NOT NULL").select("doc_id", "line", "list", "size", "bits")
        lists = scratch.table(_or_first(lists, exact).distinct())
        settled = scratch.table(_verified(documents, pairs, scratch))
        open_ = _without(_without(lists, exact), settled)
        others = lists.select("list", *[F.col(c).alias(f"to_{c}") for c in ("line", "size", "bits")], F.col("doc_id").alias("to_doc"))
        near = may_be_similar(F.col("size"), F.col("to_size"), F.bit_count(F.col("bits").bitwiseXOR(F.col("to_bits"))))
        more = open_.join(others, "list").where((_there() < _here()) & near).select("doc_id", "line", "to_doc", "to_line").distinct()
        more = scratch.table(more.join(pairs, ["doc_id", "line", "to_doc", "to_line"], "left_anti"))
        out = exact.select("doc_id", "line").union(settled).union(_verified(documents, more, scratch)).distinct()
        return scratch.result(out.select(F.when(F.col("doc_id") != _NULL, F.col("doc_id")).alias("doc_id"), "line"))


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the table they were made for is written; nothing here runs a plan twice."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def _without(rows: DataFrame, places: DataFrame) -> DataFrame:
    return rows.join(places.select("doc_id", "line"), ["doc_id", "line"], "left_anti")


def _or_first(rows: DataFrame, exact: DataFrame) -> DataFrame:
    """The rows, and those whose place (doc_id, line) repeats an earlier line again with the place of the first such line: one
    place may hold several lines, where rows share an id."""
    again = rows.join(exact, ["doc_id", "line"])
    moved = [F.col("first")[c].alias(c) if c in ("doc_id", "line") else F.col(c) for c in rows.columns]
    return rows.union(again.select(*moved))


def _between_firsts(pairs: DataFrame, exact: DataFrame) -> DataFrame:
    """Pairs of places, the later one first, with every line that repeats another replaced by the first it repeats."""
    turned = lambda df: df.select(F.col("to_doc").alias("doc_id"), F.col("to_line").alias("line"), F.col("doc_id").alias("to_doc"), F.col("line").alias("to_line"))
    both = turned(_or_first(turned(_or_first(pairs.select("doc_id", "line", "to_doc", "to_line"), exact)), exact))
    ordered = both.where(_there() < _here()).union(turned(both.where(_here() < _there())))
    return _without(ordered, exact).distinct()


def _words_of(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc_id, line, words) of the lines at the places of the pairs, words as 64-bit hashes."""
    both = pairs.select("doc_id", "line").union(pairs.select("to_doc", "to_line")).distinct()
    wanted = both.groupBy("doc_id").agg(F.collect_list("line").alias("wanted"))
    lines = documents.join(wanted, "doc_id").select("doc_id", "wanted", F.posexplode(F.split("text", "\n", -1)).alias("line", "said"))
    words = F.array_distinct(F.transform(F.split(F.lower("said"), _SPACES), lambda w: F.xxhash64(w)))
    words = F.array_remove(words, F.xxhash64(F.lit("")))
    return lines.where(F.array_contains("wanted", F.col("line"))).select("doc_id", "line", words.alias("words"))


def _verified(documents: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """The places of pairs (doc_id, line, to_doc, to_line) whose lines are similar, compared by their words."""
    said = scratch.table(_words_of(documents, pairs))
    left = said.select("doc_id", "line", F.col("words").alias("l"))
    right = said.select(F.col("doc_id").alias("to_doc"), F.col("line").alias("to_line"), F.col("words").alias("r"))
    joined = pairs.join(left.hint("shuffle_merge"), ["doc_id", "line"]).join(right.hint("shuffle_merge"), ["to_doc", "to_line"])
    near = (F.size("l") > 0) & similar(F.col("l"), F.col("r"))
    return joined.where(near).select("doc_id", "line").distinct()


def line_figures(documents: DataFrame, removed: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed."""
    gone = removed.groupBy(F.col("doc_id").alias("gone_doc")).agg(F.count(F.lit(1)).alias("n"))
    lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("text").isNull(), 0).otherwise(lines).cast("long").alias("n_lines"))
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_doc")), "left")
    return joined.select("doc_id", "n_lines", F.coalesce("n", F.lit(0)).cast("long").alias("n_removed"))


def without_lines(documents: DataFrame, removed: DataFrame) -> DataFrame:
    """The documents with the removed lines taken out of their texts."""
    gone = removed.groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_set("line").alias("__gone"))
    joined = documents.join(gone, F.col("doc_id").eqNullSafe(F.col("__doc")), "left")
    kept = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains("__gone", i))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[text.alias("text") if c == "text" else documents[c] for c in documents.columns])
