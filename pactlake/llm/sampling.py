"""Bounded samples of labelled rows, for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The learned part of a table and the part it is measured on.
FOLDS = 5
#: The part of a sample's bytes above which a text is long: one over so many.
SHARE = 16


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True for a fifth of all ids, by their CRC-32; a null id counts as the empty text, which is held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _size_class(text: str, byte_limit: int) -> Column:
    """0 for texts of at most a `SHARE`th of the byte limit, 1 for longer ones within it, 2 above it, 3 for blank texts."""
    size = F.octet_length(text).cast("long")
    return F.when(~F.col(text).rlike(r"\S"), 3).when(size * SHARE <= byte_limit, 0).when(size <= byte_limit, 1).otherwise(2)


def _wanted(size_class: Column, limit: int) -> Column:
    """How many texts of a class a sample may have room for."""
    return F.when(size_class.isin(1, 2), min(limit, SHARE)).otherwise(limit)


def bounded_sample(rows: DataFrame, by: str, limit: int, byte_limit: int, text: str = "text", seed: str = "sample") -> DataFrame:
    """At most `limit` rows with at most `byte_limit` bytes of text for each value of `by`: the first ones in an order
    given by a hash of text and id, so the same rows at every run. Null texts and values are left out.

    A text longer than a `SHARE`th of the byte limit comes after all shorter ones, the shorter first, so it neither ends
    nor empties a sample that they can fill. Texts are whole, but of one longer than the byte limit itself only the
    beginning can be in the sample; such beginnings come after whole texts, and blank texts come last. So a value with any
    text is in the sample.

    Rows of each size class are thinned out by that hash before they are ordered, to about four times the number wanted for
    each value, so the shuffle does not grow with the table.
    """
    rows = rows.where(F.col(by).isNotNull() & F.col(text).isNotNull())
    columns = rows.columns
    rows = rows.withColumn("__draw", F.pmod(F.xxhash64(F.lit(seed), text, "doc_id"), F.lit(1 << 30)) / float(1 << 30))
    rows = rows.withColumn("__class", _size_class(text, byte_limit))
    counts = rows.groupBy(F.col(by).alias("__by"), F.col("__class").alias("__of")).agg(F.count(F.lit(1)).alias("__rows"))
    # A row for each class of each value, of which a label or language has few.
    thin = rows.join(F.broadcast(counts), (F.col(by) == F.col("__by")) & (F.col("__class") == F.col("__of")))
    thin = thin.where(F.col("__draw") * F.col("__rows") < 4.0 * _wanted(F.col("__class"), limit))
    # A character has at most four bytes.
    beginning = F.substring(text, 1, max(1, byte_limit // 4))
    thin = thin.withColumn(text, F.when(F.col("__class") == 2, beginning).otherwise(F.col(text)))
    size = F.octet_length(text).cast("long")
    order = Window.partitionBy("__by").orderBy("__class", F.when(F.col("__class") > 0, size).otherwise(0), "__draw", "doc_id")
    first = thin.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= limit)
    used = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return first.withColumn("__used", used).where(F.col("__used") <= byte_limit).select(*columns)


def labelled_sample(documents: DataFrame, labels: DataFrame, by: str, limit: int, byte_limit: int, seed: str = "sample") -> DataFrame:
    """(doc_id, text, label): a bounded sample of the documents whose label `by` is known, of each label. A document that is
    labelled more than once counts with its largest label.

    At most four times the number wanted of ids are drawn per label and size class, by a hash, before any text is shuffled,
    so the ids can be broadcast; labels are small integers.
    """
    known = labels.where(F.col(by).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(by).alias("label"))
    documents = documents.select("doc_id", "text").where(F.col("text").isNotNull())
    sizes = documents.select("doc_id", _size_class("text", byte_limit).alias("__class")).groupBy("doc_id").agg(F.min("__class").alias("__class"))
    known = known.join(sizes, "doc_id")
    known = known.withColumn("__draw", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30))
    counts = known.groupBy(F.col("label").alias("__label"), F.col("__class").alias("__of")).agg(F.count(F.lit(1)).alias("__rows"))
    drawn = known.join(F.broadcast(counts), (F.col("label") == F.col("__label")) & (F.col("__class") == F.col("__of")))
    wanted = _wanted(F.col("__class"), limit)
    drawn = drawn.where(F.col("__draw") * F.col("__rows") < 2.0 * wanted)
    drawn = drawn.withColumn("__rank", F.row_number().over(Window.partitionBy("label", "__class").orderBy("__draw", "doc_id")))
    drawn = drawn.where(F.col("__rank") <= 4 * wanted).select("doc_id", "label")
    rows = documents.join(F.broadcast(drawn), "doc_id")
    return bounded_sample(rows, "label", limit, byte_limit, seed=seed)
