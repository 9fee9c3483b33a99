"""Operator 8: quality rules by distribution divergence.

Every document's histogram of character classes and of its language's common words is compared with that of all documents
of the language, by Jensen-Shannon distance (the root of the divergence to base 2, 0 to 1). Documents too short for a
histogram are guarded by a minimum length and judged by the base rules alone.

References are counts over all documents. Common words are found without counting all words: words are counted by hash
bucket first, and only those in buckets that could hold a common word are counted by word. A document's figures are worked
out inside its row, so documents are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactlake.llm.scratch import Scratch

BLANKS = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Character classes in the order of the histogram; what is in none is the last bin.
CLASSES = (r"\p{Ll}", r"\p{Lu}", r"\p{N}", r"[\x20\x09-\x0D]", r"[.,;:!?]", SYMBOLS)
BLANK, SYMBOL = 3, 5
#: Common words of a language, the least share of its words that one must have, and buckets of the first count.
COMMON, LEAST_SHARE, BUCKETS = 32, 0.002, 4096
#: Places by hash that tell which words can be a common one.
SLOTS = 1024
#: Words from which histograms are judged.
MIN_WORDS = 80
#: The largest distances of a kept document of n words: the first plus the second over the root of n, by which the distance of a
#: sample from its own source falls.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = (0.2, 1.0), (0.29, 0.75)
#: The base rules.
BASE_WORDS, BASE_REPEAT_PERCENT = 50, 50


def words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed != "", F.split(trimmed, SPACES)).otherwise(F.array().cast("array<string>"))


def base_figures(documents: DataFrame) -> DataFrame:
    """`documents` (doc_id, text, lang) with the list of words, the counts of character classes and the figures of the base rules.

    Windows are hashes of the hashes of their three words. Only where two windows of a text are equal are all of them put in
    order with their places, so that equal ones are neighbours.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = with_class_counts(documents.withColumn("words", words(F.col("text"))))
    rows = rows.withColumn("hashed", F.transform("words", lambda w: F.xxhash64(w)))
    following = lambda i, k: F.get(F.col("hashed"), i + k)
    begun = F.slice("hashed", F.lit(1), F.greatest(F.size("hashed") - 2, F.lit(0)))
    rows = rows.withColumn("windows", F.transform(begun, lambda h, i: F.xxhash64(h, following(i, 1), following(i, 2))))
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("placed", F.when(repeats, placed))
    beside = lambda j: F.get(F.col("placed"), j)["h"]
    equal = F.filter("placed", lambda x, j: x["h"].eqNullSafe(beside(j - 1)) | x["h"].eqNullSafe(beside(j + 1)))
    rows = rows.withColumn("places", F.sort_array(F.transform(equal, lambda x: x["i"])))
    reach = F.transform("places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get(F.col("places"), i + 1), p + 3) - p))
    covered = F.coalesce(F.aggregate(reach, F.lit(0), lambda a, b: a + b), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("lines", lines)
    return rows.select(
        *documents.columns, "words", "counts", F.size("words").cast("long").alias("n_words"),
        (F.length(text) - F.get("counts", F.lit(BLANK))).cast("long").alias("word_chars"),
        F.get("counts", F.lit(SYMBOL)).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )


def with_class_counts(rows: DataFrame) -> DataFrame:
    """Adds `counts`, the characters of `text` by class. A class's count is by how much its removal shortens the text, and the
    first class and the blanks, most of any text, are taken away before the others are counted; no character is of two classes."""
    size = lambda c: F.length(c).cast("long")
    text, rest, few = F.coalesce(F.col("text"), F.lit("")), F.col("__rest"), F.col("__few")
    rows = rows.withColumn("__rest", F.regexp_replace(text, f"{CLASSES[0]}+", ""))
    rows = rows.withColumn("__few", F.regexp_replace(rest, f"{CLASSES[BLANK]}+", ""))
    by_class = [size(few) - size(F.regexp_replace(few, f"{c}+", "")) for c in CLASSES]
    by_class[0], by_class[BLANK] = size(text) - size(rest), size(rest) - size(few)
    rows = rows.withColumn("__classes", F.array(*by_class))
    unclassed = size(text) - F.aggregate("__classes", F.lit(0).cast("long"), lambda x, y: x + y)
    return rows.withColumn("counts", F.concat("__classes", F.array(unclassed))).drop("__rest", "__few", "__classes")


def _language(documents: DataFrame) -> DataFrame:
    return documents.withColumn("language", F.coalesce(F.col("lang"), F.lit("")))


def references(documents: DataFrame, common: int = COMMON, least_share: float = LEAST_SHARE) -> DataFrame:
    """One row per language (a null one is empty): language, classes and shares (histograms that sum to 1, the last bin of
    `shares` being all other words), common (the words).

    A word is common if it has at least `least_share` of the language's words and is among the most frequent; equal counts are taken by word.
    """
    with Scratch(documents.sparkSession, "references") as scratch:
        rows = _language(documents.select("lang", "text")).withColumn("text", F.coalesce("text", F.lit("")))
        classes = with_class_counts(rows).select("language", F.col("counts").alias("c")).groupBy("language").agg(
            *[F.sum(F.get("c", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES) + 1)]
        )
        total = sum(F.col(f"c{i}") for i in range(len(CLASSES) + 1))
        classes = classes.select("language", F.array(*[F.col(f"c{i}") / F.greatest(total, F.lit(1)) for i in range(len(CLASSES) + 1)]).alias("classes"))
        spoken = rows.select("language", F.explode(words(F.lower("text"))).alias("word"))
        bucket = F.pmod(F.xxhash64("word"), F.lit(BUCKETS))
        buckets = scratch.table(spoken.groupBy("language", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")))
        sizes = scratch.table(buckets.groupBy("language").agg(F.sum("n").alias("all_words")))
        heavy = buckets.join(sizes, "language").where(F.col("n") >= F.col("all_words") * least_share).select("language", "bucket", "all_words")
        heavy = scratch.table(heavy)
        counted = spoken.withColumn("bucket", bucket).join(heavy, ["language", "bucket"]).groupBy("language", "word").agg(
            F.count(F.lit(1)).alias("n"), F.first("all_words").alias("all_words")
        )
        order = Window.partitionBy("language").orderBy(F.desc("n"), "word")
        counted = counted.where(F.col("n") >= F.col("all_words") * least_share).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= common)
        listed = counted.groupBy("language").agg(
            F.sort_array(F.collect_list(F.struct("rank", "word", (F.col("n") / F.col("all_words")).alias("share")))).alias("l")
        )
        listed = listed.select("language", F.transform("l", lambda x: x["word"]).alias("common"), F.transform("l", lambda x: x["share"]).alias("known"))
        other = F.lit(1.0) - F.aggregate("known", F.lit(0.0), lambda a, b: a + b)
        out = classes.join(listed, "language", "left").select(
            "language", "classes", F.coalesce("common", F.array().cast("array<string>")).alias("common"),
            F.when(F.col("known").isNotNull(), F.concat("known", F.array(F.greatest(other, F.lit(0.0))))).otherwise(F.array(F.lit(1.0))).alias("shares"),
        )
        return scratch.result(out)


def _slot(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(SLOTS))


def with_slots(reference: DataFrame) -> DataFrame:
    """Adds `slots`, whether a common word has that place by hash. Few others share one, so only few words are looked for in the list."""
    taken = F.transform("common", _slot)
    return reference.withColumn("slots", F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.array_contains(taken, i.cast("long"))))


def common_words(words: Column, common: Column, slots: Column) -> Column:
    """Which common word each word is, counted from 1, in order, so that equal ones are neighbours; 0 for some others, the rest left out."""
    lowered = F.filter(F.transform(words, lambda w: F.lower(w)), lambda w: F.get(slots, _slot(w).cast("int")))
    return F.sort_array(F.transform(lowered, lambda w: F.coalesce(F.array_position(common, w), F.lit(0).cast("long"))))


def _term(p: Column, m: Column) -> Column:
    return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms given as arrays of equal length."""
    parts = F.zip_with(p, q, lambda a, b: (_term(a, (a + b) / 2) + _term(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.aggregate(parts, F.lit(0.0), lambda x, y: x + y))))


def judge(documents: DataFrame, min_words: int = MIN_WORDS, max_class: tuple[float, float] = MAX_CLASS_DISTANCE, max_word: tuple[float, float] = MAX_WORD_DISTANCE) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance, kept.

    Kept is what passes the base rules (at least 50 words, at most half of them in repeated windows) and, from
    `min_words` words on, lies within both distances of its language's reference. A null language is a language of its own. A null
    text has no words. Repeated rows get a row each; other columns are not read. An empty table gives an empty result.
    """
    reference = with_slots(references(documents))
    figures = base_figures(_language(documents.select("doc_id", "text", "lang")))
    joined = figures.join(reference, "language")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = joined.withColumn("found", common_words(F.col("words"), F.col("common"), F.col("slots")))
    rows = rows.withColumn("kinds", F.array_distinct("found"))
    rows = rows.withColumn("ends", F.transform("kinds", lambda k: F.array_position("found", k)))
    runs = F.transform("ends", lambda e, i: F.coalesce(F.get(F.col("ends"), i + 1), F.size("found") + F.lit(1).cast("long")) - e)
    rows = rows.withColumn("by_kind", F.map_from_arrays("kinds", runs))
    n = F.greatest(F.col("n_words"), F.lit(1).cast("long")).cast("double")
    times = lambda kind: F.coalesce(F.try_element_at("by_kind", kind), F.lit(0).cast("long"))
    others = F.col("n_words") - F.size("found") + times(F.lit(0).cast("long"))
    shares = F.concat(F.transform("common", lambda _, i: times((i + 1).cast("long")) / n), F.array(others / n))
    length = F.greatest(F.length(text), F.lit(1))
    class_distance = js_distance(F.transform("counts", lambda c: c / length), F.col("classes"))
    rows = rows.withColumn("class_distance", class_distance).withColumn("word_distance", js_distance(shares, F.col("shares")))
    failed = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words"))
    limit = lambda pair: F.lit(pair[0]) + F.lit(pair[1]) / F.sqrt(n)
    near = (F.col("n_words") < min_words) | (
        (F.col("class_distance") <= limit(max_class)) & (F.col("word_distance") <= limit(max_word))
    )
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & near).alias("kept"), "class_distance", "word_distance",
    )
