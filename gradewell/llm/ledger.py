"""Secret scan over an incremental blob ledger; DataFrame functions only.

Every historical version of every path is addressed by the SHA-256 of its text; a null
text is an empty one. The ledger is a table in a folder all executors share, with one row
per blob and scan: the rules, each with its version, that the blob was scanned for, and
what they hit. ``update`` scans the pairs of blob and rule version that the ledger does
not hold yet, each blob once however many paths and versions share it. ``report`` joins
the hits back to every row. A rule whose version goes up is scanned anew; the hits of its
old version stay in the ledger and out of reports.

Hits are kept as gap and length, in order, which one pass of a rule over a text gives;
``findings`` adds them up to places. A blob's copies meet after map-side
aggregation, and the rows of a blob that many share are spread over salts, so
neither a hot blob nor a hot path gathers in a task. A ledger write that a lost executor
repeats adds equal rows, which do not change a report.

Rows that repeat, null ids and empty texts each give their row, the last two kinds
without findings. Columns of the input other than ``text`` come back; one named ``blob``
or ``findings`` is replaced.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradewell.llm.tables import pin
from gradewell.operators.joins import lookup_join
from gradewell.operators.spread import directory


@dataclass(frozen=True)
class Rule:
    """A pattern, its version, and what a match needs besides: ``least`` characters of ``group``.

    ``sign`` is a text that every match contains; texts without it are not searched.
    """

    version: int
    pattern: str
    group: int = 0
    least: int = 0
    sign: str = ""


# The patterns and lengths of the three base kinds. A run of the last two is
# matched from its first character, so asking for the length in the pattern drops the same runs.
WORDS = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
BASE = {
    "assign": Rule(1, rf"""({WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": Rule(1, "AKIA[A-Z0-9]{14,}", sign="AKIA"),
    "hex": Rule(1, "[0-9a-f]{16,}"),
}
RULES = {
    **BASE,
    "private_key": Rule(1, "-----BEGIN [A-Z ]*PRIVATE KEY-----", sign="PRIVATE KEY-----"),
    "github": Rule(1, "gh[pousr]_[A-Za-z0-9]{36,}", sign="gh"),
    "slack": Rule(1, "xox[abprs]-[A-Za-z0-9-]{10,}", sign="xox"),
    "jwt": Rule(1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", sign="eyJ"),
}
HITS = "array<struct<rule: string, nth: int, gap: int, length: int, kept: boolean>>"
SCHEMA = f"blob binary, rules array<string>, hits {HITS}"


def pair(kind: str, rule: Rule) -> str:
    return f"{kind}@{rule.version}"


def address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class Ledger:
    """The scanned pairs and their hits, in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def add(self, scanned: DataFrame) -> None:
        scanned.write.mode("append").parquet(self.path)


def unseen(blobs: DataFrame, known: DataFrame | None, rules: Mapping[str, Rule]) -> DataFrame:
    """Distinct ``blob`` with the pairs in ``todo`` that the ledger does not hold for it."""
    wanted = F.array(*[F.lit(pair(k, r)) for k, r in rules.items()])
    each = blobs.select("blob").distinct()
    if known is None:
        return each.withColumn("todo", wanted)
    done = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("__done"))
    left = F.array_except(wanted, F.coalesce("__done", F.array().cast("array<string>")))
    return each.join(done, "blob", "left").select("blob", left.alias("todo")).where(F.size("todo") > 0)


def scan(contents: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """Ledger rows of ``contents`` (blob, text, todo)."""
    parts = contents
    for k, (kind, rule) in enumerate(rules.items()):
        likely = F.array_contains("todo", pair(kind, rule))
        likely = likely & (F.col("text").contains(rule.sign) if rule.sign else F.col("text").rlike(rule.pattern))
        parts = parts.withColumns(
            {
                f"__found{k}": F.when(likely, F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))),
                f"__gaps{k}": F.when(likely, F.split("text", rule.pattern, -1)),
            }
        )

    def hits(k: int, kind: str, rule: Rule) -> Column:
        def hit(match: Column, nth: Column) -> Column:
            measured = F.regexp_extract(match, rule.pattern, rule.group) if rule.group else match
            return F.struct(
                F.lit(pair(kind, rule)).alias("rule"),
                nth.alias("nth"),
                F.char_length(F.get(f"__gaps{k}", nth)).alias("gap"),
                F.char_length(match).alias("length"),
                (F.char_length(measured) >= rule.least).alias("kept"),
            )

        return F.coalesce(F.transform(f"__found{k}", hit), F.array().cast(HITS))

    every = F.concat(*[hits(k, kind, rule) for k, (kind, rule) in enumerate(rules.items())])
    return parts.select("blob", F.col("todo").alias("rules"), every.alias("hits"))


def update(versions: DataFrame, ledger: Ledger, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """Scan what the ledger lacks for the texts of ``versions`` and add it; the rows added."""
    texts = versions.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", address(F.col("text")))
    known = ledger.rows()
    if known is None:
        wanted = F.array(*[F.lit(pair(k, r)) for k, r in rules.items()])
        contents = texts.groupBy("blob").agg(F.first("text").alias("text")).withColumn("todo", wanted)
    else:
        new = pin(unseen(texts, known, rules))
        some = lookup_join(texts, new, ["blob"], "inner")
        contents = some.groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
    scanned = pin(scan(contents, rules))
    ledger.add(scanned)
    return scanned


def findings(known: DataFrame, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """Blobs with secrets under the given rule versions, and their spans.

    ``findings`` has (start, rank, kind, end) by start, then order of the rules; places are
    code points, ends exclusive.
    """
    current = {pair(kind, rule): (n, kind) for n, (kind, rule) in enumerate(rules.items())}
    ranks = F.create_map(*[F.lit(x) for p, (n, _) in current.items() for x in (p, n)])
    kinds = F.create_map(*[F.lit(x) for p, (_, kind) in current.items() for x in (p, kind)])
    hits = (
        known.where(F.size("hits") > 0)
        .select("blob", F.inline("hits"))
        .where(F.col("rule").isin(*current))
        .groupBy("blob", "rule", "nth")
        .agg(*[F.first(c).alias(c) for c in ("gap", "length", "kept")])
    )
    ends = F.sum(F.col("gap") + F.col("length")).over(Window.partitionBy("blob", "rule").orderBy("nth"))
    placed = hits.withColumn("end", ends).where("kept")
    spans = F.struct(
        (F.col("end") - F.col("length")).alias("start"),
        ranks[F.col("rule")].alias("rank"),
        kinds[F.col("rule")].alias("kind"),
        "end",
    )
    return placed.groupBy("blob").agg(F.sort_array(F.collect_list(spans)).alias("findings"))


def report(versions: DataFrame, ledger: Ledger, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """Every row of ``versions`` with its ``blob`` and ``findings`` in place of the text."""
    kept = [F.col(f"`{c}`") for c in versions.columns if c not in ("text", "blob", "findings")]
    paths = pin(versions.select(*kept, address(F.col("text")).alias("blob")))
    known = ledger.rows()
    assert known is not None, "update the ledger first"
    found = lookup_join(paths, pin(findings(known, rules)), ["blob"], "left", directory(paths, ["blob"]))
    none = F.array().cast("array<struct<start: bigint, rank: int, kind: string, end: bigint>>")
    return found.select(*[F.col(f"`{c}`") for c in paths.columns], F.coalesce("findings", none).alias("findings"))
