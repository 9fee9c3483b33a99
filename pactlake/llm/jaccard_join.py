"""Operator 5: exact join of documents on the Jaccard similarity of their word shingles, by PartEnum signatures.

The feature domain (hashes of shingles) is cut into partitions, as many as a band of set sizes calls for. Sets that differ
in few features agree on the whole of some partitions, and a hash of what a set has in a partition is a signature that
both share. (In PartEnum's terms, first-level partitions have two cells, one of which may differ, so the subsets
enumerated are single cells.) There are more cells than similar sets can differ in, so similar sets share many signatures,
which is used twice. The work goes in steps, each of which only ever errs by letting too much through:

1. *Screen.* A set of n features differs from a similar one in at most a ninth of their joint size, so it shares all but
   that many of its signatures with others. Signatures travel packed, 5 bytes each; sets that share too few are done.
2. *Clusters.* The rest sign in finer cells. Signatures are ordered by how many sets have them, and a set's most common ones,
   as many as it shares with any similar set but one, are left out: passages that many documents quote no longer
   meet. Sets with a common signature left fall into one cluster (each is linked to the least of its signature's group).
3. *Verification.* A cluster's sets meet in a task, large clusters in blocks of comparable sizes, and the sizes of all
   intersections are counted exactly. A block gives the links that hold its components together, not all pairs.
4. *Components* over those links. Equal sets are one set from the start, so copies cost nothing after step 1.

Hashes have 64 bits, and equal sets are recognised by 128.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactlake.llm.components import components
from pactlake.llm.hashing import U64, mix, parts, shingle_sets
from pactlake.llm.scratch import Scratch

#: Text bytes whose screening signatures one task gathers, and features of sets whose subset signatures one does.
SCREEN_BYTES, CLUSTER_FEATURES = 24 << 20, 2_000_000
#: Sets in a block of a large cluster.
BLOCK = 512
#: Features per cell at the upper end of a band, in the screen and for clusters.
SCREEN_FILL, CLUSTER_FILL = 3, 2
_RATIO = 2


def most_different(n: np.ndarray) -> np.ndarray:
    """The largest symmetric difference of a set of n features with one at least 0.8 similar."""
    return (n + (5 * n) // 4) // 9


def _bounds() -> np.ndarray:
    """Least size of each band."""
    return np.array([_RATIO**i for i in range(1, 41)])


def _levels(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every set the index of the set and a size band in which it signs: its own, and the next one if a similar set
    may lie there. A pair meets in the band of its larger set."""
    own = np.searchsorted(_bounds(), n, side="right") - 1
    above = np.searchsorted(_bounds(), (5 * n) // 4, side="right") - 1
    index = np.arange(len(n))
    also = above > own
    return np.concatenate([index, index[also]]), np.concatenate([own, own[also] + 1])


def _take(values: np.ndarray, starts: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the indexed sets end to end, and to which place of `index` each belongs."""
    counts = np.diff(starts)[index]
    ends = np.cumsum(counts)
    where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[:-1][index] - (ends - counts), counts)
    return values[where], np.repeat(np.arange(len(index)), counts)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of the values of each, modulo 2**64."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


def signatures(values: np.ndarray, starts: np.ndarray, fill: int):
    """For all sets end to end: (index of set, band, signatures, most differences) of each entry, a set in a band; and
    (entry, signature) of each signature.

    Features are dealt to cells by hash, `fill` to a cell at the upper end of the band; the signature of a cell is a hash
    of the features in it. Empty cells sign nothing: a set that has f non-empty cells and differs in at most d features shares
    at least f - d signatures. Where that is nothing, all such sets of the band share one more signature.
    """
    n = np.diff(starts)
    index, level = _levels(n)
    most = most_different(n[index])
    live = most > 0
    index, level, most = index[live], level[live], most[live]
    elements, entry = _take(values, starts, index)
    cells = np.maximum(4, _bounds()[level] * _RATIO // fill).astype(U64)
    cell = mix(elements ^ mix(level.astype(U64) + U64(31 * fill))[entry]) % cells[entry]
    keys, sums = _sums((entry.astype(U64) << U64(40)) | cell, mix(elements + U64(7)))
    entry = (keys >> U64(40)).astype(np.int64)
    filled = np.bincount(entry, minlength=len(index))
    signature = mix(sums ^ mix(keys & U64((1 << 40) - 1)) ^ mix(level.astype(U64) + U64(99))[entry])
    weak = np.flatnonzero(filled <= most)
    return (
        index, level, filled, most,
        np.concatenate([entry, weak]), np.concatenate([signature, mix(mix(level[weak].astype(U64) + U64(1234)))]),
    )


# -- packing -----------------------------------------------------------------------------------------------------------

PACKED = "pid int, keys binary, counts binary, low binary, high binary, docs binary"


def _pack(pids: int, keys: np.ndarray, entry: np.ndarray, signature: np.ndarray, docs=None) -> pa.RecordBatch:
    """A row for each task that a batch has signatures for: the entries' keys, how many signatures each has there, and
    40 bits of every signature (the number of the task being further bits of it)."""
    pid = (signature >> U64(40)) % U64(pids)
    order = np.lexsort((entry, pid))
    pid, entry, signature = pid[order], entry[order], signature[order]
    rows: dict[str, list] = {name.split()[0]: [] for name in PACKED.split(", ")}
    cuts = np.searchsorted(pid, np.arange(pids + 1, dtype=U64))
    for p in range(pids):
        part = slice(cuts[p], cuts[p + 1])
        mine = docs[p] if docs is not None else b""
        if part.start == part.stop and not mine:
            continue
        own, counts = np.unique(entry[part], return_counts=True)
        rows["pid"].append(p)
        rows["keys"].append(keys[own].tobytes())
        rows["counts"].append(counts.astype("<u4").tobytes())
        rows["low"].append(signature[part].astype("<u4").tobytes())
        rows["high"].append((signature[part] >> U64(32)).astype("u1").tobytes())
        rows["docs"].append(mine)
    return pa.RecordBatch.from_pydict(
        rows, schema=pa.schema([("pid", pa.int32())] + [(c, pa.binary()) for c in rows if c != "pid"])
    )


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _unpack(table: pa.Table, named: bool = False) -> tuple[np.ndarray, ...]:
    """Distinct keys, and for every distinct (signature, key) the group of its signature and the index of its key, and the
    signature if named."""
    keys, counts = _joined(table["keys"], "<i8"), _joined(table["counts"], "<u4")
    signature = _joined(table["low"], "<u4").astype(U64) | (_joined(table["high"], "u1").astype(U64) << U64(32))
    keys, key = np.unique(keys, return_inverse=True)
    key = np.repeat(key, counts)
    order = np.lexsort((key, signature))
    signature, key = signature[order], key[order]
    keep = np.ones(len(key), bool)
    keep[1:] = (signature[1:] != signature[:-1]) | (key[1:] != key[:-1])
    signature, key = signature[keep], key[keep]
    new = np.ones(len(key), bool)
    new[1:] = signature[1:] != signature[:-1]
    return (keys, np.cumsum(new) - 1, key) + ((signature,) if named else ())


# -- steps -------------------------------------------------------------------------------------------------------------

_DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("mark", "<i8"), ("n", "<i8"), ("digest", "<i8"), ("check", "<i8"),
                 ("key", "<i8", 2), ("need", "<i8", 2)])
_SCREENED = "kind int, doc_id long, mark long, n long, digest long, check long, key long, need long, also long, also_need long, shared long"


def _digests(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for seed in (17, 71):
        total = np.zeros(len(values) + 1, U64)
        np.cumsum(mix(values ^ mix(np.array([seed], U64))), out=total[1:])
        out.append(mix(total[starts[1:]] - total[starts[:-1]]).view(np.int64))
    return out[0], out[1]


def _screened(documents: DataFrame, pids: int) -> DataFrame:
    def sign(batches):
        for whole in batches:
            for batch in parts(whole, 1, 2000):
                values, starts = shingle_sets(batch.column(1))
                digest, check = _digests(values, starts)
                index, level, filled, most, entry, signature = signatures(values, starts, SCREEN_FILL)
                need = filled - most
                keys = (digest[index].view(U64) ^ mix(level.astype(U64) + U64(5))).view(np.int64)
                docs = np.zeros(batch.num_rows, _DOC)
                docs["doc_id"] = batch.column(0).fill_null(0).to_numpy()
                docs["null"] = batch.column(0).is_null().to_numpy(zero_copy_only=False)
                docs["mark"] = batch.column(2).to_numpy()
                docs["n"], docs["digest"], docs["check"] = np.diff(starts), digest, check
                docs["need"] = 1 << 60
                order = np.argsort(index, kind="stable")
                repeat = np.zeros(len(index), np.int64)
                repeat[order[1:]] = index[order][1:] == index[order][:-1]
                docs["key"][index, repeat], docs["need"][index, repeat] = keys, need
                home = (digest.view(U64) % U64(pids)).astype(np.int64)
                packed = [docs[home == p].tobytes() for p in range(pids)]
                yield _pack(pids, keys, entry, signature, packed)

    def share(table: pa.Table) -> pa.Table:
        docs = _joined(table["docs"], _DOC)
        keys, group, key = _unpack(table)
        shared = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        counts = np.bincount(key[shared], minlength=len(keys))
        some = counts > 0
        k, d = int(some.sum()), len(docs)
        nothing = pa.nulls(k, pa.int64())
        both = lambda shared_rows, doc_rows: pa.concat_arrays([shared_rows.cast(pa.int64()), pa.array(doc_rows, pa.int64())])
        columns = {"kind": pa.array(np.repeat([0, 1], [k, d]), pa.int32())}
        columns["doc_id"] = both(nothing, pa.array(docs["doc_id"], mask=docs["null"] > 0))
        for name, mine in (("mark", "mark"), ("n", "n"), ("digest", "digest"), ("check", "check")):
            columns[name] = both(nothing, docs[mine])
        columns["key"] = both(pa.array(keys[some]), docs["key"][:, 0])
        columns["need"] = both(nothing, docs["need"][:, 0])
        columns["also"], columns["also_need"] = both(nothing, docs["key"][:, 1]), both(nothing, docs["need"][:, 1])
        columns["shared"] = pa.concat_arrays([pa.array(counts[some], pa.int64()), pa.nulls(d, pa.int64())])
        return pa.table(columns)

    return documents.mapInArrow(sign, PACKED).groupBy("pid").applyInArrow(share, _SCREENED)


def _sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """The set of each wanted (class_id, mark, digest), read from a row with that mark, as the bytes of its sorted hashes."""

    def gather(batches):
        for whole in batches:
            for batch in parts(whole, 1, 2000):
                values, starts = shingle_sets(batch.column(1))
                right = _digests(values, starts)[0] == batch.column(2).to_numpy()
                sets = [values[starts[i] : starts[i + 1]].tobytes() if ok else None for i, ok in enumerate(right)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.diff(starts)), pa.array(sets, pa.binary())], ["class_id", "n", "features"]
                )

    rows = documents.hint("shuffle_merge").join(wanted, "mark").select("class_id", "text", "digest")
    return rows.mapInArrow(gather, "class_id long, n long, features binary").where("features is not null").dropDuplicates(["class_id"])


def _read_sets(column) -> tuple[np.ndarray, np.ndarray]:
    sets = [np.frombuffer(x, U64) for x in column.to_pylist()]
    starts = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(x) for x in sets], out=starts[1:])
    return np.concatenate(sets) if sets else np.zeros(0, U64), starts


_KEPT = np.dtype([("size", "<u4"), ("signature", "<u8")])


def _cluster_edges(sets: DataFrame, pids: int) -> DataFrame:
    def entries(batches, emit):
        for whole in batches:
            for batch in parts(whole, 1, 500, 8 << 20):
                values, starts = _read_sets(batch.column(1))
                index, level, filled, most, entry, signature = signatures(values, starts, CLUSTER_FILL)
                keys = (_digests(values, starts)[0][index].view(U64) ^ mix(level.astype(U64) + U64(6))).view(np.int64)
                yield emit(batch, index, keys, filled, most, entry, signature)

    def sign(batches):
        return entries(batches, lambda batch, index, keys, filled, most, entry, signature: _pack(pids, keys, entry, signature))

    def describe(batches):
        def emit(batch, index, keys, filled, most, entry, signature):
            ids = batch.column(0).take(pa.array(index))
            return pa.RecordBatch.from_arrays([ids, pa.array(keys), pa.array(filled.astype(np.int64)), pa.array(most)], ["class_id", "key", "filled", "most"])

        return entries(batches, emit)

    def count(table: pa.Table) -> pa.Table:
        """For each key its signatures that others have too, and how many sets have them."""
        home = U64(table["pid"][0].as_py()) << U64(40)
        keys, group, key, signature = _unpack(table, True)
        sizes = np.bincount(group)[group] if len(group) else group
        some = sizes > 1
        order = np.argsort(key[some], kind="stable")
        key, found = key[some][order], np.zeros(int(some.sum()), _KEPT)
        found["size"], found["signature"] = sizes[some][order], signature[some][order] | home
        cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        ends = np.append(cuts[1:], len(key))
        return pa.table({"key": pa.array(keys[key[cuts]], pa.int64()), "found": pa.array([found[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary())})

    def choose(batches):
        """Signs anew with the least common signatures of each set, as many as it may differ in and one more; those that no
        other set has come first and need not travel."""
        for batch in batches:
            found = [np.sort(np.frombuffer(b"".join(x), _KEPT), order=("size", "signature")) for x in batch.column(3).to_pylist()]
            filled, most = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            kept = [f if w <= m else f[: max(0, m + 1 - (w - len(f)))] for f, w, m in zip(found, filled, most, strict=True)]
            entry = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
            signature = np.concatenate([k["signature"] for k in kept]) if kept else np.zeros(0, U64)
            yield _pack(pids, batch.column(0).to_numpy(), entry, mix(signature))

    def stars(table: pa.Table) -> pa.Table:
        keys, group, key = _unpack(table)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else group
        least = key[first][group]
        other = least != key
        pairs = np.unique(least[other].astype(U64) << U64(32) | key[other].astype(U64))
        a, b = (pairs >> U64(32)).astype(np.int64), (pairs & U64(0xFFFFFFFF)).astype(np.int64)
        return pa.table({"a": pa.array(keys[a], pa.int64()), "b": pa.array(keys[b], pa.int64())})

    features = sets.select("class_id", "features")
    counted = features.mapInArrow(sign, PACKED).groupBy("pid").applyInArrow(count, "key long, found binary")
    described = features.mapInArrow(describe, "class_id long, key long, filled long, most long")
    listed = counted.groupBy("key").agg(F.collect_list("found").alias("found")).hint("shuffle_merge")
    chosen = listed.join(described, "key").select("class_id", "filled", "most", "found")
    return chosen.mapInArrow(choose, PACKED).groupBy("pid").applyInArrow(stars, "a long, b long").distinct()


def intersections(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sizes of the intersections of all sets given. Features of many sets are counted by a matrix product, those of
    few sets pair by pair."""
    size = len(starts) - 1
    owner = np.repeat(np.arange(size), np.diff(starts))
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(values)))
    out = np.zeros((size, size), np.int64)
    for few in range(2, 12):
        begin = first[counts == few]
        if not len(begin):
            continue
        for i in range(few):
            for j in range(i + 1, few):
                codes = owner[begin + i] * size + owner[begin + j]
                out += np.bincount(codes, minlength=size * size).reshape(size, size)
    out += out.T
    many = np.flatnonzero(counts >= 12)
    for begin in range(0, len(many), 4096):
        columns = many[begin : begin + 4096]
        which = np.repeat(np.arange(len(columns)), counts[columns])
        where = np.arange(len(which)) + np.repeat(first[columns] - (np.cumsum(counts[columns]) - counts[columns]), counts[columns])
        matrix = np.zeros((size, len(columns)), np.float32)
        matrix[owner[where], which] = 1
        out += np.rint(matrix @ matrix.T).astype(np.int64)
    np.fill_diagonal(out, np.diff(starts))
    return out


def _verified(table: pa.Table) -> pa.Table:
    """The links of a block's sets, as edges from the least member of each connected part to its others."""
    table = table.sort_by("class_id")
    ids = table["class_id"].to_numpy()
    values, starts = _read_sets(table["features"])
    n = np.diff(starts)
    common = intersections(values, starts)
    linked = 100 * common >= 80 * (n[:, None] + n[None, :] - common)
    label = np.arange(len(ids))
    while True:
        least = np.where(linked, label[None, :], len(ids)).min(axis=1, initial=len(ids))
        least = np.minimum(label, least)
        least = least[least]
        if (least == label).all():
            break
        label = least
    other = label != np.arange(len(ids))
    return pa.table({"a": ids[label[other]], "b": ids[other]})


def _links(sets: DataFrame, clusters: DataFrame) -> DataFrame:
    """Verified links within clusters. A cluster above a block's size is cut by size of set, and each cut by hash; only
    blocks whose sizes allow a similarity of 0.8 meet, and each meeting is a group of its own."""
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    rows = sets.select("class_id", "n").join(clusters.withColumnRenamed("node", "class_id"), "class_id").join(sizes, "component")
    rows = rows.withColumn(
        "cut", F.when(F.col("members") <= 2 * BLOCK, F.lit(0)).otherwise(F.floor(F.log("n") / math.log(1.25)))
    )
    cuts = rows.groupBy("component", "cut").agg(F.count(F.lit(1)).alias("in_cut"), F.first("members").alias("m"))
    cuts = cuts.withColumn("blocks", F.when(F.col("m") <= 2 * BLOCK, F.lit(1)).otherwise(F.ceil(F.col("in_cut") / BLOCK)))
    cuts = cuts.select("component", "cut", "blocks")
    rows = rows.join(cuts, ["component", "cut"])
    rows = rows.select("class_id", "component", "cut", F.pmod(F.xxhash64("class_id"), "blocks").alias("block"))
    blocks = cuts.select("component", "cut", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"))
    right = blocks.select(F.col("component").alias("c"), F.col("cut").alias("cut2"), F.col("block").alias("block2"))
    near = (
        (F.col("component") == F.col("c"))
        & F.col("cut2").between(F.col("cut"), F.col("cut") + 1)
        & ((F.col("cut2") > F.col("cut")) | (F.col("block2") >= F.col("block")))
    )
    alone = (F.col("cut2") == F.col("cut")) & (F.col("block2") == F.col("block"))
    # A block meets itself within every meeting; alone it is needed only where it has no other.
    meetings = blocks.join(right, near).withColumn("alone", alone)
    meetings = meetings.select(
        F.xxhash64("component", "cut", "block", "cut2", "block2").alias("meeting"),
        "component",
        F.explode(
            F.array_distinct(F.array(F.struct("cut", "block"), F.struct(F.col("cut2").alias("cut"), F.col("block2").alias("block"))))
        ).alias("side"),
    ).select("meeting", "component", "side.cut", "side.block")
    dealt = rows.join(meetings, ["component", "cut", "block"]).select("meeting", "class_id")
    return dealt.join(sets.hint("shuffle_merge"), "class_id").select("meeting", "class_id", "features").groupBy("meeting").applyInArrow(_verified, "a long, b long")


def _mark() -> Column:
    """A hash of id and text, by which rows are told apart whose id is null or not theirs alone."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def _grouped(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """A row for each document: doc_id, mark, n (size of its set), group (a number that linked documents share; of no use
    where n is 0) and component_id (the least doc_id of the group)."""
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _mark().alias("mark"))
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pids = max(math.ceil(size / SCREEN_BYTES), spark.sparkContext.defaultParallelism)
    screened = scratch.table(_screened(documents, pids))
    members = screened.where("kind = 1")
    shared = screened.where("kind = 0").groupBy("key").agg(F.sum("shared").alias("have"))
    classes = members.groupBy("digest", "check", "n").agg(
        F.min("doc_id").alias("doc_id"),
        F.min("mark").alias("mark"),
        *[F.first(c).alias(c) for c in ("key", "need", "also", "also_need")],
    )
    # Stored, for the numbers are given anew whenever they are computed.
    classes = scratch.table(classes.withColumn("class_id", F.monotonically_increasing_id()))
    entries = F.inline(F.array(F.struct("key", "need"), F.struct(F.col("also").alias("key"), F.col("also_need").alias("need"))))
    signed = classes.select("class_id", "mark", "digest", entries).where(f"need < {1 << 60}")
    wanted = signed.join(shared, "key", "left").where("coalesce(have, 0) >= need").select("class_id", "mark", "digest").distinct()
    sets = scratch.table(_sets(documents, scratch.table(wanted)))
    features = sets.agg(F.sum("n")).first()[0] or 0
    pids = max(math.ceil(features / CLUSTER_FEATURES), spark.sparkContext.defaultParallelism)
    clusters = scratch.table(components(_cluster_edges(sets, pids), scratch))
    linked = components(_links(sets, clusters), scratch).withColumnRenamed("node", "class_id")
    named = classes.select("digest", "check", "n", "class_id", "doc_id").join(linked, "class_id", "left")
    named = named.withColumn("group", F.coalesce("component", "class_id"))
    named = scratch.table(named.select("digest", "check", "n", "group", F.col("doc_id").alias("least")))
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    named = named.drop("least").join(least, "group")
    out = members.select("doc_id", "mark", "digest", "check", "n").join(named, ["digest", "check", "n"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "mark", "n", "group", component.alias("component_id"))


def jaccard_components(documents: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_shingles (size of its set), component_id (least doc_id reachable by links).

    Documents are linked when the Jaccard similarity of their sets of five-word shingles is at least 0.8; a text of fewer
    words is one shingle, and a text without words (or a null) has none and no link. Repeated rows are returned as often
    as given, and different texts under one id are documents of their own. A null doc_id keeps its row and is linked like
    others; its component is null if no document in it has an id. Other columns are not read. An empty table gives an
    empty result.
    """
    with Scratch(documents.sparkSession, "jaccard") as scratch:
        return scratch.result(_grouped(documents, scratch).select("doc_id", F.col("n").alias("n_shingles"), "component_id"))


def one_of_each_component(documents: DataFrame) -> DataFrame:
    """Of documents that are linked by similarity, the one with the least id (one without an id only if none has any); of rows
    with the same id and text, one. A text without words is linked to none and stays. All columns are returned."""
    with Scratch(documents.sparkSession, "components") as scratch:
        rows = _grouped(documents, scratch)
        first = rows.where("n > 0").groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first"))
        kept = scratch.result(first.select(F.col("first.mark").alias("__kept")).union(rows.where("n = 0").select("mark")).distinct())
    marked = documents.withColumn("__mark", _mark())
    found = marked.join(kept.hint("shuffle_merge"), F.col("__mark") == F.col("__kept"), "left_semi")
    return found.dropDuplicates(["__mark", "doc_id"]).drop("__mark")
