"""Rows by key that arrive batch by batch, in sorted runs of growing size that are merged while batches go on arriving.

Every batch is appended as a run of level 0, at the cost of its own rows. Once there are `fan` of those they are merged
with the run of level 1, if that gets too large also with the run of level 2, and so on: from level 1 there is one run
a level, each level holds about `fan` times as many rows as the one before, and every key is once in a run. So what a
reader folds is at most a small multiple of the keys, and a row is written again as often as there are levels.

The runs are layers of a versioned folder. A merge replaces its runs by its result in one commit, while others append;
two merges of the same runs cannot both go through. A batch that is delivered again after a failure is recognised by its
number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from threading import Event, Thread

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pactlake.sources.versions import LAYER, Folder, Layer, Version

#: Versions that readers may still be reading.
KEPT_VERSIONS = 8
#: How long a run without a version may be a write that has not committed yet.
GRACE_MS = 24 * 3_600_000

Fold = Callable[[DataFrame], DataFrame]


class MergedRuns:
    """Runs at `location`. `fold` makes the rows of several runs one row per key, in the same columns; the rows of any
    runs may be folded before others are added."""

    def __init__(self, spark: SparkSession, location: str, keys: list[str], fold: Fold, fan: int = 4):
        self.folder, self.keys, self.fold, self.fan = Folder(spark, location), keys, fold, fan

    def append(self, rows: DataFrame, batch_id: int, writer: str = "stream") -> bool:
        """Add the folded rows of a batch; False if the writer's batch of that number, or a later one, is in already."""
        if self.folder.current().marks.get(writer, -1) >= batch_id:
            return False
        folded = self.fold(rows)
        layer, count = self.folder.write(folded, sort=self.keys)
        layer = replace(layer, facts={"level": 0, "rows": count, "schema": folded.schema.jsonValue()})

        def change(now: Version) -> Version | None:
            if now.marks.get(writer, -1) >= batch_id:
                return None
            layers = (*now.layers, layer) if count or not now.layers else now.layers
            return replace(now, layers=layers, marks=now.marks | {writer: batch_id})

        return layer in self.folder.commit("append", change).layers

    def rows(self) -> int:
        """How many rows a reader folds."""
        return sum(layer.facts["rows"] for layer in self.folder.current().layers)

    def read(self) -> DataFrame:
        """One row per key. ValueError if nothing was ever appended."""
        return self.fold(self._read(self.folder.current().layers))

    def _read(self, layers) -> DataFrame:
        if not layers:
            raise ValueError(f"nothing was written to {self.folder.location} yet")
        schema = T.StructType.fromJson(layers[0].facts["schema"])
        return self.folder.read_layers(schema, [], layers).drop(LAYER)

    def merge(self) -> int:
        """Merge until there is nothing to merge; returns how many merges went through."""
        done = 0
        while chosen := self._chosen(self.folder.current().layers):
            layers, level = chosen
            merged = self.fold(self._read(layers))
            layer, count = self.folder.write(merged, sort=self.keys)
            layer = replace(layer, facts={"level": level, "rows": count, "schema": merged.schema.jsonValue()})
            gone = {x.name for x in layers}

            def change(now: Version, layer=layer, gone=gone) -> Version | None:
                left = tuple(x for x in now.layers if x.name not in gone)
                if len(left) != len(now.layers) - len(gone):
                    return None  # another merge was faster
                return replace(now, layers=(*left, layer))

            done += layer in self.folder.commit("merge", change).layers
            self.folder.expire(KEPT_VERSIONS, GRACE_MS)
        return done

    def _chosen(self, layers: tuple[Layer, ...]) -> tuple[list[Layer], int] | None:
        """The runs to merge next and the level of the result."""
        chosen = [x for x in layers if x.facts["level"] == 0]
        if len(chosen) < self.fan:
            return None
        new, level = sum(x.facts["rows"] for x in chosen), 1
        while True:
            chosen += [x for x in layers if x.facts["level"] == level]
            if sum(x.facts["rows"] for x in chosen) <= new * self.fan**level:
                return chosen, level
            level += 1


class Merger:
    """Merges runs in the background until it is stopped."""

    def __init__(self, runs: list[MergedRuns], seconds: float = 30.0):
        self._runs, self._seconds, self._stopped = runs, seconds, Event()
        self._thread = Thread(target=self._work, name="merger", daemon=True)
        self._thread.start()

    def _work(self) -> None:
        while not self._stopped.wait(self._seconds):
            for runs in self._runs:
                runs.merge()

    def stop(self) -> None:
        self._stopped.set()
        self._thread.join()
