"""Tables between the steps of an operator, in the application's part of the shared folder (see `session.release`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pactlake.llm.shipping import ship
from pactlake.session import fresh_folder


class Scratch:
    """A folder of its own.

    `table` writes a frame there and reads it back, which cuts its lineage: what follows does not depend on files that
    are lost with an executor. `state` does the same for a table that takes the place of the state before it, which is
    removed once the new one is whole. `result` writes to a folder that stays. Leaving the `with` block removes the rest.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        ship(spark)
        self.spark = spark
        self.folder = fresh_folder(spark, purpose)
        self._tables = 0
        self._state: str | None = None

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        remove(self.spark, self.folder)

    def table(self, df: DataFrame) -> DataFrame:
        self._tables += 1
        return stored(df, f"{self.folder}/{self._tables}")

    def state(self, df: DataFrame) -> DataFrame:
        out, before = self.table(df), self._state
        self._state = f"{self.folder}/{self._tables}"
        if before:
            remove(self.spark, before)
        return out

    def result(self, df: DataFrame) -> DataFrame:
        return stored(df, f"{self.folder}-result")


def stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
