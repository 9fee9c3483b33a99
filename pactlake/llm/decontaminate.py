"""Operator 3: benchmark decontamination by size-partitioned MinHash containment search.

A test item is contained in a document when the document has at least 0.8 of the item's five-word shingles. The item is
the small set and the document the large one, so a document's own minima say nothing of the item; what is asked is
whether elements of the item's bottom sketch (its least hashes) are in the document. An item of q shingles that is
contained misses at most q - ceil(0.8 q) of them, so a sketch of one more finds every document that contains it. Items are
partitioned by size, each class with the sketch length of its largest size and the least number of shingles that a document needs; documents
below that do not meet the class. What is found is verified on the shingles themselves.

Documents are read where they lie: their shingles meet the sketches, which are small and joined by their measured size,
and only found (document, item) pairs move. Nothing but built-in functions is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactlake.llm.scratch import Scratch

SIZE, CONTAINED = 5, 80
_SPACES = r"[\x20\x09-\x0D]+"


def word_list(text: Column) -> Column:
    """Words in lower case, none for a null text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPACES), lambda w: w != "")


def shingle_list(words: Column, hashed: bool) -> Column:
    """All windows of five words, the whole of fewer words as one, none without words; as text or as the text's hash."""

    def of(part: Column) -> Column:
        text = F.array_join(part, " ")
        return F.xxhash64(text) if hashed else text

    several = F.transform(F.sequence(F.lit(1), F.size(words) - (SIZE - 1)), lambda i: of(F.slice(words, i, SIZE)))
    return F.when(F.size(words) >= SIZE, several).when(F.size(words) > 0, F.array(of(words)))


def needed(size: Column, contained: int = CONTAINED) -> Column:
    """The least number of shared shingles that makes an item contained."""
    return F.ceil(size * contained / 100).cast("int")


def sketches(items: DataFrame, contained: int = CONTAINED) -> DataFrame:
    """A row per sketch element: item_id, hash, least (shingles that a document needs to be asked).

    Sizes are partitioned by powers of two. Sketches have the length that the largest item of the class needs; a smaller item
    gives a few hashes more than it must.
    """
    sized = items.withColumn("class", F.floor(F.log2("n_item")).cast("int"))
    limits = sized.groupBy("class").agg(F.max(F.col("n_item") - needed(F.col("n_item"), contained) + 1).alias("length"), F.min(needed(F.col("n_item"), contained)).alias("least"))
    return sized.join(limits, "class").select(
        "item_id", "least", F.explode(F.slice(F.array_sort(F.transform("shingles", lambda s: F.xxhash64(s))), F.lit(1), F.col("length"))).alias("hash")
    )


def contamination(documents: DataFrame, benchmark: DataFrame, contained: int = CONTAINED) -> DataFrame:
    """A row per document and item that it contains: doc_id, item_id, n_item (the item's distinct shingles), n_shared,
    containment.

    Texts are compared as words in lower case. An item of fewer than five words is one shingle and is found only where it is
    the whole document. An item or document without words (or null) is never found. Rows that share a doc_id count as one document
    with the shingles of its best row; rows that share an item_id are items of their own and the largest share counts. A
    null id is an id like any other. Other columns are not read.
    """
    with Scratch(documents.sparkSession, "decontaminate") as scratch:
        # Lists of words are columns of their own wherever windows are taken of them: inside the windows' expression they
        # would be split anew for every window.
        items = benchmark.select("item_id", word_list(F.col("text")).alias("words"))
        items = items.select("item_id", F.array_distinct(shingle_list(F.col("words"), False)).alias("shingles"))
        items = items.where("shingles IS NOT NULL").withColumn("n_item", F.size("shingles"))
        items = scratch.table(items.withColumn("item", F.xxhash64(F.array_join("shingles", "\n"))))
        sketch = scratch.table(sketches(items.withColumn("item_id", F.col("item")).dropDuplicates(["item"]), contained))
        sketch = sketch.select(F.col("item_id").alias("item"), "least", "hash")
        words = documents.select("doc_id", word_list(F.col("text")).alias("words"))
        hashes = words.select("doc_id", F.size("words").alias("n"), F.explode(shingle_list(F.col("words"), True)).alias("hash"))
        found = hashes.join(sketch, "hash").where(F.greatest(F.col("n") - (SIZE - 1), F.lit(1)) >= F.col("least"))
        found = scratch.table(found.select("doc_id", "item").distinct())
        pairs = found.select(F.col("doc_id").alias("found_id"), "item")
        wanted = documents.select("doc_id", "text").join(pairs, F.col("doc_id").eqNullSafe(F.col("found_id")))
        wanted = wanted.select("doc_id", "item", word_list(F.col("text")).alias("words"))
        wanted = wanted.select("doc_id", "item", shingle_list(F.col("words"), False).alias("said"))
        with_items = wanted.join(items.withColumnRenamed("item", "i"), F.col("item") == F.col("i"))
        shared = F.size(F.array_intersect("said", "shingles"))
        checked = with_items.select("doc_id", "item_id", "n_item", shared.alias("n_shared"))
        checked = checked.where(F.col("n_shared") >= needed(F.col("n_item"), contained))
        checked = checked.withColumn("containment", F.col("n_shared") / F.col("n_item"))
        best = checked.groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_item", "n_shared")).alias("best"))
        return scratch.result(best.select("doc_id", "item_id", F.col("best.n_item").cast("long").alias("n_item"), F.col("best.n_shared").cast("long").alias("n_shared"), "best.containment"))


def without_contaminated(documents: DataFrame, benchmark: DataFrame, contained: int = CONTAINED) -> DataFrame:
    """The documents that contain no item."""
    bad = contamination(documents, benchmark, contained).select(F.col("doc_id").alias("__bad")).distinct()
    return documents.join(bad, F.col("doc_id").eqNullSafe(F.col("__bad")), "left_anti")

