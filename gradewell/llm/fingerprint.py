"""Bottom-k sketches of word-shingle hashes; DataFrame functions only.

A sketch is the ``K`` smallest distinct 64-bit hashes of a text's five-word
shingles, ascending. Sketches of parts merge by union; resemblance, containment
and the number of distinct shingles are read off sketches alone. A text of one
to four words is one shingle; a null or empty text has an empty sketch. Two
empty sketches resemble each other fully, an empty and a full one not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewell.llm.tables import pin

K, WORDS = 128, 5
SPACE = r"[\x09-\x0D\x20]+"
HALF = 2.0**63


def shingle_hashes(word_hashes: Column) -> Column:
    """One hash per five words in a row, from the array of word hashes."""
    n = F.size(word_hashes)
    many = F.transform(
        F.sequence(F.lit(0), F.greatest(n - WORDS, F.lit(0))),
        lambda i: F.xxhash64(*[F.coalesce(F.get(word_hashes, i + j), F.lit(0)) for j in range(WORDS)]),
    )
    return F.when(n > 0, many).otherwise(F.array().cast("array<bigint>"))


def split_words(text: Column) -> Column:
    """Words between white space; texts without tabs and breaks are split at single spaces, which is faster."""
    parts = F.when(text.rlike(r"[\x09-\x0D]"), F.split(text, SPACE)).otherwise(F.split(text, " "))
    return F.array_remove(parts, "")


def word_hashes(text: Column) -> Column:
    return F.transform(split_words(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w))


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(hashes), 1, k)


def with_sketch(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """``df`` with the sketch of a text column. Steps are columns of their own, so none is computed twice."""
    step = f"__{name}_words"
    df = df.withColumn(step, word_hashes(F.col(text)))
    return df.withColumn(name, smallest(F.array_distinct(shingle_hashes(F.col(step))), k)).drop(step)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return smallest(F.array_union(a, b), k)


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(sketch, -1).cast("double") + HALF) / (2 * HALF)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets."""
    both = merge(a, b, k)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def next_ids(docs: DataFrame) -> DataFrame:
    """Each id, its successor in descending order (the last one's is the first), and its longest text.

    Ids are cut into sorted ranges; only each range's border is seen together,
    one row per range. Rows without id have no place in the order.
    """
    ids = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.char_length(F.coalesce("text", F.lit("")))).alias("longest"))
    cut = pin(ids.repartitionByRange("doc_id").withColumn("__part", F.spark_partition_id()))
    borders = cut.groupBy("__part").agg(F.max("doc_id").alias("__most"))
    over = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borders = borders.select("__part", F.coalesce(F.max("__most").over(over), F.max("__most").over(everything)).alias("__before"))
    inside = F.lag("doc_id").over(Window.partitionBy("__part").orderBy("doc_id"))
    return cut.withColumn("__inside", inside).join(F.broadcast(borders), "__part").select("doc_id", F.coalesce("__inside", "__before").alias("next_id"), "longest")


def fingerprint_edited(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likenesses.

    Of rows that repeat an id, all have the same next document, and of a next id
    with several rows the one with the least text hash is taken. Rows without id
    have no next document: the tail goes and nothing comes.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = texts.where("doc_id IS NOT NULL")
    # Both joins deal out the same columns by the same key, so the texts are shuffled once.
    order = pin(next_ids(docs)).select(F.col("doc_id").alias("borrower"), F.col("next_id").alias("doc_id"), "longest")
    lent = with_sketch(known.join(order, "doc_id"), "text", "next_sketch", k).select(
        F.col("borrower").alias("doc_id"),
        F.struct(
            F.xxhash64("text").alias("hash"),
            F.left("text", F.floor(F.col("longest") / 3).cast("int")).alias("head"),
            "next_sketch",
        ).alias("lent"),
    )
    one = lent.groupBy("doc_id").agg(F.min("lent").alias("lent")).select("doc_id", "lent.head", "lent.next_sketch")
    n = F.char_length("text")
    tail = F.floor(n / 3).cast("int")
    edited = F.concat(F.left("text", n - tail), F.coalesce(F.left("head", tail), F.lit("")))
    nameless = texts.where("doc_id IS NULL").select("*", F.lit(None).cast("string").alias("head"), F.lit(None).cast("array<bigint>").alias("next_sketch"))
    joined = known.join(one, "doc_id", "left").unionByName(nameless).withColumn("edited", edited)
    sketched = with_sketch(with_sketch(joined, "text", "sketch", k), "edited", "edited_sketch", k)
    return sketched.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        F.coalesce(resemblance(F.col("sketch"), F.col("next_sketch"), k), F.lit(0.0)).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("n_shingles"),
        containment(F.col("edited_sketch"), F.col("sketch"), k).alias("edited_in_text"),
    )
