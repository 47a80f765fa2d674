"""Links and titles of the pages table."""

from __future__ import annotations

from gradewell.plans.date_ranges import measure_date_ranges
from gradewell.sources import pages
from pyspark.sql import functions as F
from querybook.tools import load, register

QUERIES: dict = {}
SQL: dict[str, str] = {}

VISIBLE = r"""regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g')"""
CLEAN = """replace(replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'),
           '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"""
TAGS = rf"""list_transform(regexp_extract_all({VISIBLE}, '(?i)<a\s[^>]*\shref="[^"]*"|<a href="[^"]*"'),
            lambda tag: regexp_extract(tag, '(?i)href="([^"]*)"', 1))"""


@register(
    QUERIES,
    SQL,
    f"""WITH found AS (SELECT page_id, {TAGS} AS links FROM pages)
        SELECT page_id, CAST(pos - 1 AS INTEGER) AS position, {CLEAN.format('links[pos]')} AS href
        FROM (SELECT page_id, links, unnest(range(1, len(links) + 1)) AS pos FROM found)""",
)
def extract_links(spark, folder):
    return pages.extract_links(load(spark, folder, "pages"))


@register(
    QUERIES,
    SQL,
    rf"""WITH found AS (SELECT page_id, {TAGS} AS links,
                regexp_extract({VISIBLE}, '(?is)<h1\b[^>]*>(.*?)</h1>', 1) AS heading FROM pages)
        SELECT page_id, {CLEAN.format("regexp_replace(heading, '<[^>]*>', '', 'g')")} AS "Name",
               replace({CLEAN.format('links[1]')}, 'json', 'csv') AS "Link"
        FROM found""",
)
def link_catalog(spark, folder):
    return pages.link_catalog(load(spark, folder, "pages"))


MARKED = r"""SELECT page_id, regexp_replace(CASE WHEN page_id % 3 <> 0 THEN replace(html, '<h1>', '<h1 id="title">') ELSE html END,
    '<a href="(/[^"]{1,4})"', '<a class="exec ga-track" href="\1"', 'g') AS html FROM pages"""


@register(
    QUERIES,
    SQL,
    rf"""WITH found AS (SELECT page_id, {VISIBLE} AS visible FROM ({MARKED})),
        parts AS (SELECT page_id, visible, regexp_extract_all(visible, '<a class="exec ga-track" href="([^"]*)"', 1) AS links,
                         regexp_extract(visible, '(?is)<h1 id="title">(.*?)</h1>', 1) AS heading FROM found)
        SELECT page_id, CASE WHEN contains(visible, '<h1 id="title">')
                             THEN {CLEAN.format("regexp_replace(heading, '<[^>]*>', '', 'g')")} END AS "Name",
               replace({CLEAN.format('links[1]')}, 'json', 'csv') AS "Link" FROM parts""",
)
def link_catalog_by_class(spark, folder):
    """Headings with a given id and first links of a given class, on pages marked with both."""
    html = F.when(F.col("page_id") % 3 != 0, F.replace("html", F.lit("<h1>"), F.lit('<h1 id="title">'))).otherwise(F.col("html"))
    marked = F.regexp_replace(html, r'<a href="(/[^"]{1,4})"', '<a class="exec ga-track" href="$1"')
    raw = load(spark, folder, "pages").select("page_id", marked.alias("html"))
    return pages.link_catalog(raw, link_class="ga-track", title_id="title")


@register(
    QUERIES,
    SQL,
    r"""SELECT replace(lang || ', ' || source || ': ' || text, ',', ';') AS measure_name,
               replace(CAST(n_chars AS VARCHAR) || ', ' || CAST(doc_id AS VARCHAR), ',', ';')
                 AS measure_date_range
        FROM documents
        WHERE NOT (contains(text, 'Average') OR contains(text, '31 days')
                   OR contains(text, 'medication issues') OR contains(text, 'ulcers'))""",
)
def date_range_table(spark, folder):
    raw = load(spark, folder, "documents").select(
        F.concat_ws(": ", F.concat_ws(", ", "lang", "source"), "text").alias("Measure Name"),
        F.concat_ws(", ", "n_chars", "doc_id").alias("Measure (Date) Range"),
    )
    return measure_date_ranges(raw)
