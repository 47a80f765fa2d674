"""Line dedup by a deletion-neighbourhood join; DataFrame functions only.

Lines are compared as word sequences. A line goes if an earlier line, by
(doc_id, place), is equal to it, or is within one word edit (a word put in,
left out or replaced) and both have at least ``SHORTEST`` words. Lines are
judged on the input. Lines without words stay.

1. Equal lines: an aggregate finds the first of each 96-bit hash of the words.
2. Two lines within one edit share the first half or the rest of the shorter
   one's length, so lines whose half keys nobody shares need no variants. This
   is exact and leaves a small part of a corpus.
3. The others emit all variants with one word deleted. A variant's hash is the
   XOR of (word, place) hashes, so a running XOR gives all of a line's variants
   in one pass. Equal variants at one place are a replacement; a variant equal
   to a whole line is an insertion. A group keeps only its earliest line, so no
   pairs within a group are made, and the word lists decide at the end.

The rows of a hot line, half or variant are spread over salts (``lookup_join``).

Rows that repeat a doc_id with the same text are one document with one result;
null doc_ids come last; null and empty texts have one line without words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewell.llm.fingerprint import split_words
from gradewell.llm.tables import pin, row_id, text_key
from gradewell.operators.joins import lookup_join

SHORTEST = 8


def line_list(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def half_keys(hashes: Column, n: Column) -> Column:
    """Keys of both halves: numbers 0 and 1 at the line's own length, 2 and 3 against lines one word shorter."""

    def keys(m: Column, number: int) -> list[Column]:
        half = F.floor(m / 2).cast("int")
        rest = (m - half).cast("int")
        parts = F.slice(hashes, F.lit(1), half), F.slice(hashes, (n - rest + 1).cast("int"), rest)
        return [F.struct(F.lit(number + i).cast("byte").alias("number"), F.xxhash64(F.lit(i), m, x).alias("half")) for i, x in enumerate(parts)]

    none = F.array().cast("array<struct<number:tinyint,half:bigint>>")
    own = F.when(n >= SHORTEST, F.array(*keys(n, 0))).otherwise(none)
    return F.concat(own, F.when(n > SHORTEST, F.array(*keys(n - 1, 2))).otherwise(none))


def line_table(texts: DataFrame) -> DataFrame:
    """One row per line with words: place, two hashes, half keys."""
    cut = texts.select("id", "key", F.posexplode(line_list()).alias("pos", "line"))
    worded = cut.withColumn("words", split_words(F.col("line"))).where(F.size("words") > 0)
    hashed = worded.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    return hashed.select(
        "id",
        "key",
        "pos",
        F.xxhash64("hashes").alias("h"),
        F.hash("hashes").alias("g"),
        half_keys(F.col("hashes"), F.size("words")).alias("halves"),
    )


def candidates(table: DataFrame) -> DataFrame:
    """Per line hash, which variants can meet another line.

    Two lines of one length, or one and a longer one, must share a half; the
    edit is then in the other half. ``early`` and ``late`` ask for replacement
    variants, ``cut_early`` and ``cut_late`` for deletions, ``whole`` for the line.
    """
    halves = table.select("h", F.explode("halves").alias("k")).select("h", "k.number", "k.half")
    own = F.when(F.col("number") < 2, F.col("h"))
    shared = (
        halves.groupBy("half")
        .agg(F.min(own).alias("a"), F.max(own).alias("b"), F.max("number").alias("most"))
        .select("half", F.coalesce(F.col("a") != F.col("b"), F.lit(False)).alias("equal"), (F.col("a").isNotNull() & (F.col("most") >= 2)).alias("longer"))
        .where("equal OR longer")
    )
    number = F.col("number")
    flags = {
        "late": (number == 0) & F.col("equal"),
        "early": (number == 1) & F.col("equal"),
        "cut_late": (number == 2) & F.col("longer"),
        "cut_early": (number == 3) & F.col("longer"),
        "whole": (number < 2) & F.col("longer"),
    }
    met = lookup_join(halves, shared, ["half"], "inner").groupBy("h").agg(*[F.max(c).alias(name) for name, c in flags.items()])
    return met.where(" OR ".join(flags))


def variant_rows(lines: DataFrame) -> DataFrame:
    """Hashed keys of each line's variants: role 0 by place, 1 against whole lines, 2 the whole line."""
    flags = ["early", "late", "cut_early", "cut_late", "whole"]
    word = lines.select("id", "pos", "h", "g", *flags, F.size("words").alias("n"), F.posexplode("words").alias("i", "word"))
    line = Window.partitionBy("id", "pos", "h", "g")
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    left, right = F.xxhash64("word", "i"), F.xxhash64("word", F.col("i") - 1)
    run = word.select("id", "pos", "h", "g", *flags, "n", "i", left.alias("z0"), right.alias("z1")).select(
        "*",
        F.bit_xor("z0").over(upto).alias("x0"),
        F.bit_xor("z1").over(upto).alias("x1"),
        F.bit_xor("z0").over(line).alias("t0"),
        F.bit_xor("z1").over(line).alias("t1"),
    )
    variant = F.col("x0").bitwiseXOR(F.col("z0")).bitwiseXOR(F.col("t1")).bitwiseXOR(F.col("x1"))
    half, cut = F.floor(F.col("n") / 2), F.floor((F.col("n") - 1) / 2)
    i = F.col("i")
    replaced = F.when(i >= half, F.col("late")).otherwise(F.col("early"))
    deleted = (F.col("cut_late") & (i >= cut)) | (F.col("cut_early") & (i <= cut))

    def row(role: int, key: Column) -> Column:
        return F.struct(F.lit(role).cast("byte").alias("role"), key.alias("key"))

    rows = F.array(
        F.when(replaced, row(0, F.xxhash64(F.lit(0), variant, "i", "n"))),
        F.when(deleted, row(1, F.xxhash64(F.lit(1), variant, F.col("n") - 1))),
        F.when(F.col("whole") & (i == 0), row(2, F.xxhash64(F.lit(1), "t0", "n"))),
    )
    place = F.struct("id", "pos", "h", "g", "i").alias("line")
    return run.select(place, F.explode(F.array_compact(rows)).alias("r")).select("line", "r.role", "r.key")


def near_lines(lines: DataFrame) -> DataFrame:
    """(h, g) of the lines with an earlier one within one word edit; ``lines`` has words and should be pinned."""
    rows = pin(variant_rows(lines))
    groups = (
        rows.groupBy("key")
        .agg(
            F.min("line").alias("first"),
            F.max("line").alias("last"),
            F.min(F.when(F.col("role") == 1, F.col("line"))).alias("variant"),
            F.min(F.when(F.col("role") == 2, F.col("line"))).alias("whole"),
        )
        .where(F.struct("first.h", "first.g") != F.struct("last.h", "last.g"))
    )
    other = F.when(F.col("role") == 0, F.col("first")).when(F.col("role") == 1, F.col("whole")).otherwise(F.col("variant"))
    met = lookup_join(rows, groups, ["key"], "inner").withColumn("other", other)
    pairs = met.where(F.struct("other.id", "other.pos") < F.struct("line.id", "line.pos")).select(
        F.col("line.h").alias("h"),
        F.col("line.g").alias("g"),
        F.col("other.h").alias("oh"),
        F.col("other.g").alias("og"),
        "role",
        # The place of the deleted word in the longer line.
        F.when(F.col("role") == 2, F.col("other.i")).otherwise(F.col("line.i")).alias("i"),
    )
    mine = lines.select("h", "g", F.col("words").alias("a"))
    theirs = lines.select(F.col("h").alias("oh"), F.col("g").alias("og"), F.col("words").alias("b"))
    both = pairs.distinct().join(mine, ["h", "g"]).join(theirs, ["oh", "og"])

    def without(words: Column, there: Column) -> Column:
        """The words but the one at i, or all of them."""
        i = F.col("i")
        cut = F.concat(F.slice(words, F.lit(1), i), F.slice(words, i + 2, F.size(words)))
        return F.when(there, cut).otherwise(words)

    same = without(F.col("a"), F.col("role") != 2) == without(F.col("b"), F.col("role") != 1)
    return both.where(same).select("h", "g").distinct()


def repeated_lines(texts: DataFrame) -> DataFrame:
    """(id, key, pos) of the lines that go."""
    table = pin(line_table(texts))
    first = table.groupBy("h", "g").agg(F.min(F.struct("id", "pos", "key")).alias("first"))
    places = lookup_join(table.select("id", "key", "pos", "h", "g"), first, ["h", "g"], "inner")
    later = places.where(F.struct("id", "pos") != F.struct("first.id", "first.pos"))
    wanted = first.join(candidates(table), "h").select(
        "first.id", "first.key", F.struct("first.pos", "h", "g", "early", "late", "cut_early", "cut_late", "whole").alias("at")
    )
    per_text = wanted.groupBy("id", "key").agg(F.collect_list("at").alias("ats"))
    found = texts.join(per_text, ["id", "key"]).select("id", "key", line_list().alias("lines"), F.explode("ats").alias("at"))
    lines = pin(
        found.select("id", "key", "at.*", split_words(F.get("lines", F.col("at.pos"))).alias("words")).dropDuplicates(["h", "g"])
    )
    near = near_lines(lines).join(lines.select("h", "g", "id", "key", "pos"), ["h", "g"]).select("id", "key", "pos")
    return later.select("id", "key", "pos").unionByName(near)


def line_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with n_lines, n_removed and kept_text, the lines that stay.

    Other columns stay; old ones of these three names are replaced.
    """
    docs = docs.drop("n_lines", "n_removed", "kept_text")
    # The row as one struct: its columns may have any names.
    keyed = docs.select(row_id().alias("__id"), text_key().alias("__key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    texts = docs.select(row_id().alias("id"), text_key().alias("key"), "text")
    gone = pin(repeated_lines(texts).groupBy("id", "key").agg(F.collect_set("pos").alias("__gone")))
    gone = gone.withColumnsRenamed({"id": "__id", "key": "__key"})
    joined = keyed.join(gone, ["__id", "__key"], "left").withColumn("__lines", line_list("row.text"))
    places = F.sequence(F.lit(0), F.size("__lines") - 1)
    stay = F.array_except(places, F.coalesce("__gone", F.array().cast("array<int>")))
    kept = F.array_join(F.transform(stay, lambda i: F.get("__lines", i)), "\n")
    return joined.select(
        *[F.col("row")[c].alias(c) for c in docs.columns],
        F.size("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
        kept.alias("kept_text"),
    )
