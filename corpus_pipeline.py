"""From raw documents to token files: the stages of corpus preparation, each a table that the next one reads.

Every stage works on all rows that the one before kept, and all but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlake.llm.decontaminate import without_contaminated
from pactlake.llm.jaccard_join import one_of_each_component
from pactlake.llm.language import fit, identify
from pactlake.llm.mixing import mix
from pactlake.llm.queries import END_ID, tokenizer_path
from pactlake.llm.scratch import Scratch
from pactlake.llm.token_files import fresh_token_folder, read_digests, write_tokens

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Bits per byte from which a text is in no learned language; uniformly drawn letters need about so many, prose half.
MOST_BITS = 6.0


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; a missing `lang` is filled with the prediction."""
    found = identify(docs, fit(docs)).where((F.col("lang_pred") != "und") & (F.col("bits_per_byte") <= MOST_BITS))
    return found.select(*[F.coalesce("lang", "lang_pred").alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by similarity, the one with the least id; of rows with the same id and text, one."""
    return one_of_each_component(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares, in the order of the mix; a document comes as often as the mix takes it."""
    return mix(docs).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: a row per document with its place and the checksum of its ids."""
    return read_digests(write_tokens(docs, fresh_token_folder(spark), tokenizer_path(), END_ID))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("weighted_mixing", mixed),
    ("token_output", token_files),
]

#: The first stage fits a model and the last one calls a tokenizer, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`, each result written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark, "pipeline") as scratch:
        for i, (_, stage) in enumerate(STAGES, 1):
            docs = stage(spark, docs, sf_dir)
            docs = scratch.result(docs) if i == len(STAGES) else scratch.table(docs)
    return docs
