"""One query per operator on its whole table, and the SQL it must equal where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

import public_tokenizers
from gradewell.llm import bpe, fingerprint, ledger, license, lines, minhash, neighbours, packing, periodic, private, ranked, substring, toxicity
from gradewell.llm.tables import load
from gradewell.session import scratch_path

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def enter(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return enter


@query(
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    g AS (SELECT doc_id, i, words[i:i + 19] AS g
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w)),
    f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM g),
    r AS (SELECT doc_id, list(DISTINCT p) AS gone
          FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM f WHERE n > 1) GROUP BY doc_id),
    k AS (SELECT doc_id, len(words) AS n_words,
                 list_transform(list_filter(range(1, len(words) + 1), lambda p: gone IS NULL OR NOT list_contains(gone, p)),
                                lambda p: words[p]) AS kept
          FROM w LEFT JOIN r USING (doc_id))
    SELECT doc_id, n_words, n_words - len(kept) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k"""
)
def op1_substring_dedup(spark, folder):
    return substring.substring_dedup(load(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op2_best_fit_packing(spark, folder):
    return packing.best_fit_packing(load(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op8_license_scan(spark, folder):
    return license.scan(load(spark, folder, "documents"))


@query()
def op10_fingerprint(spark, folder):
    return fingerprint.fingerprint_edited(load(spark, folder, "documents"))


@query(
    r"""WITH l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
    w AS (SELECT *, regexp_extract_all(line, '[^ 	-
]+') AS words FROM l),
    c AS (SELECT *, len(words) AS n, row_number() OVER (PARTITION BY words ORDER BY doc_id, pos) AS copy FROM w),
    d AS (SELECT words, n, doc_id * 100000000 + pos AS place FROM c WHERE copy = 1 AND n >= 8),
    v AS (SELECT words, n, place, i, list_concat(words[1:i - 1], words[i + 1:]) AS cut
          FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM d)),
    s AS (SELECT place, min(place) OVER (PARTITION BY n, i, cut) AS other FROM v),
    x AS (SELECT v.place AS longer, d.place AS shorter FROM v JOIN d ON v.cut = d.words),
    near AS (SELECT place FROM s WHERE other < place
             UNION SELECT longer FROM x WHERE shorter < longer
             UNION SELECT shorter FROM x WHERE longer < shorter)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM (SELECT *, n > 0 AND (copy > 1 OR doc_id * 100000000 + pos IN (SELECT place FROM near)) AS gone FROM c)
    GROUP BY doc_id"""
)
def op4_line_dedup(spark, folder):
    docs = lines.line_dedup(load(spark, folder, "documents"))
    return docs.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query()
def op9_byte_bpe(spark, folder):
    return bpe.encode(load(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query()
def op3_private_data(spark, folder):
    found = private.find_private(load(spark, folder, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


@query()
def op5_toxicity(spark, folder):
    docs, labels = load(spark, folder, "documents"), load(spark, folder, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(docs, labels.where(~held_out).select("doc_id", "toxic"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op6_minhash(spark, folder):
    return minhash.classify(load(spark, folder, "documents")).select("doc_id", "class_id", "n_links", "stays")


@query()
def op7_neighbours(spark, folder):
    rows = load(spark, folder, "embeddings")
    return neighbours.nearest(rows, rows.where("vec_id % 20 = 0").select(F.col("vec_id").cast("long").alias("query_id")).distinct())


def with_planted_runs(docs):
    """One document in ten goes on periodically from one of its words, by the hash of its id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    some = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.when(some, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    n, g = F.size("__words"), F.floor(F.col("__h") / 10)
    a = (g % F.col("__n")).cast("int")
    p = F.floor((F.col("__n") - F.col("__a")) / (3 + g % 8)).cast("int") + 1
    i = F.sequence(F.lit(0), F.col("__n") - 1)
    planted = F.transform(i, lambda k: F.get("__words", F.when(k < F.col("__a"), k).otherwise(F.col("__a") + (k - F.col("__a")) % F.col("__p"))))
    # One column after the other, so that none is worked out once for each word.
    return (
        docs.select("doc_id", "text", h.alias("__h"), words.alias("__words"))
        .withColumn("__n", F.when(n > 0, n))
        .withColumn("__a", a)
        .withColumn("__p", p)
        .select("doc_id", F.when(F.col("__n").isNull(), F.col("text")).otherwise(F.array_join(planted, " ")).alias("text"))
    )


@query()
def op11_periodic_runs(spark, folder):
    found = periodic.periodic_runs(with_planted_runs(load(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    greater = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda best, r: F.when(greater(best, r), r).otherwise(best))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )


def secrets_sql(rules) -> str:
    """Spans by pattern: a match starts after the gaps and matches before it."""
    each = " UNION ALL ".join(
        f"""SELECT doc_id, {k} AS k, '{kind}' AS kind, found, gaps, unnest(range(1, len(found) + 1)) AS i, {rule.least} AS least,
              list_transform(found, lambda x: length(regexp_extract(x, '{p}', {rule.group}))) AS sizes
            FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS found, string_split_regex(t, '{p}') AS gaps FROM d)"""
        for k, (kind, rule) in enumerate(rules.items())
        for p in [rule.pattern.replace("'", "''")]
    )
    count = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in ledger.BASE)
    base = ", ".join(f"'{kind}'" for kind in ledger.BASE)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    m AS ({each}),
    s AS (SELECT doc_id, k, kind, length(found[i]) AS n,
                 list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
          FROM m WHERE sizes[i] >= least),
    g AS (SELECT doc_id, {count},
                 string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY start, k) FILTER (kind IN ({base})) AS base,
                 string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY start, k) AS spans FROM s GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)"""


@query(secrets_sql(ledger.RULES))
def op13_secret_ledger(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "text")
    book = ledger.Ledger(spark, scratch_path(spark, "ledger"))
    ledger.update(docs, book)
    found = ledger.report(docs, book)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kinds):
        return F.filter("findings", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of([kind])).cast("long").alias(f"n_{kind}") for kind in ledger.BASE],
        F.sha2(joined(of(ledger.BASE)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
    )


@query(
    r"""WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
    c AS (SELECT count(*) FILTER (len(ws) > 0)::BIGINT AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM t),
    p AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM t) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, c GROUP BY term, n_docs),
    q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
          FROM q JOIN w USING (term) JOIN p USING (term), c GROUP BY ALL),
    r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
    SELECT * FROM r WHERE rank <= 20"""
)
def op12_ranked_search(spark, folder):
    return ranked.search(load(spark, folder, "documents"), load(spark, folder, "benchmark"))
