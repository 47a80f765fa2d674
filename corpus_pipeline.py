"""The corpus pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of ``documents``; the last returns the pieces and their places in
sequences. ``run`` writes each stage's rows to the shared folder and reads them
back, which also cuts lineage. No stage can be said in SQL, so ``ORACLE_SQL`` is None.

A stage changes the text of the rows it keeps, never their other columns but
``n_chars``, which follows the text. Empty and null texts pass every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewell.llm import lines, minhash, packing, private, toxicity
from gradewell.llm.tables import load, pin, row_id, text_key

ORACLE_SQL = None
REJECT = 0.5


def with_text(docs: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """``docs`` under its old columns with another text; a null text stays null."""
    new = F.when(F.col("text").isNotNull(), F.col(text))
    values = {"text": new, "n_chars": F.coalesce(F.char_length(new), F.lit(0)).cast("long")}
    return docs.select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under ``REJECT``; the model learns from the labelled ones."""
    labels = load(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.where(F.col("score") < REJECT).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand earlier; one of which nothing is left goes."""
    done = lines.line_dedup(docs)
    left = (F.col("n_removed") == 0) | (F.trim("kept_text") != "")
    return with_text(done.where(left), "kept_text", docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The earliest document of each near-duplicate class, once also where its whole row repeats."""
    kept = pin(minhash.classify(docs).where("stays").select(*[F.col(f"`{c}`") for c in docs.columns]))
    # Rows of a class share id and text only where they repeat: few keys, counted on narrow rows.
    twice = pin(kept.groupBy(row_id().alias("__id"), text_key().alias("__key")).count().where("count > 1").drop("count"))
    if twice.isEmpty():
        return kept
    # The row as one struct: its columns may have any names.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = kept.select(row_id().alias("__id"), text_key().alias("__key"), row)
    once = rows.join(twice, ["__id", "__key"], "left_anti")
    first = rows.join(twice, ["__id", "__key"], "left_semi").dropDuplicates(["__id", "__key"])
    return once.unionByName(first).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by the kind in brackets."""
    keyed = docs.select(F.struct(row_id().alias("id"), text_key().alias("key")).alias("doc_id"), "text")
    found = private.find_private(keyed).select("doc_id.*", "spans").where("spans <> ''")
    return with_text(private.mask_spans(docs, found).withColumn("__masked", F.col("text")), "__masked", docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of sequences."""
    return packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near duplicates", drop_near_copies),
    ("personal data", mask_private),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir))
    return docs
