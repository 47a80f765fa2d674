"""Links and titles out of a table of fetched web pages, with native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.functions.text import swap
from gradewell.operators.columns import quoted

HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
ANCHOR = r"""(?is)<a\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
# Character references that occur in titles and links (fixed values); "&amp;" goes last.
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&nbsp;": " ",
    "&amp;": "&",
}


def unescape(c: Column) -> Column:
    for entity, char in ENTITIES.items():
        c = swap(c, entity, char)
    return c


def attribute(tag: Column, name: str) -> Column:
    """Value of one attribute of a tag, quoted or bare; NULL when absent."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    groups = [F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]
    return F.when(tag.rlike(pattern), unescape(F.concat(*groups)))


def has_class(tag: Column, wanted: str) -> Column:
    """The class attribute is ``wanted``, or has it among its words."""
    value = attribute(tag, "class")
    return F.coalesce(
        (value == wanted) | F.array_contains(F.split(value, r"\s+"), wanted), F.lit(False)
    )


def page_links(html: Column, link_class: str | None = None) -> Column:
    """All link targets of a page in page order."""
    tags = F.regexp_extract_all(F.regexp_replace(html, HIDDEN, ""), F.lit(ANCHOR), 0)
    if link_class is not None:
        tags = F.filter(tags, lambda t: has_class(t, link_class))
    links = F.transform(tags, lambda t: attribute(t, "href"))
    return F.filter(links, lambda h: h.isNotNull())


def page_title(html: Column, title_id: str | None = None) -> Column:
    """Text of the first h1 (the one with the given id); NULL when there is none."""
    visible = F.regexp_replace(html, HIDDEN, "")
    ident = rf"""(?=[^>]*\sid\s*=\s*["']?{title_id}\b)""" if title_id else ""
    heading = rf"(?is)<h1\b{ident}[^>]*>(.*?)</h1>"
    text = F.regexp_replace(F.regexp_extract(visible, heading, 1), r"<[^>]*>", "")
    return F.when(visible.rlike(heading), unescape(text))


def extract_links(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", link_class: str | None = None
) -> DataFrame:
    """One row per link: page, position from 0, target."""
    links = page_links(quoted(html_col), link_class)
    return pages.select(quoted(id_col), F.posexplode(links).alias("position", "href"))


def link_catalog(
    pages: DataFrame,
    id_col: str = "page_id",
    html_col: str = "html",
    link_class: str | None = None,
    title_id: str | None = None,
) -> DataFrame:
    """One row per page: title and first link, with ``json`` turned into ``csv`` in the link."""
    first = F.get(page_links(quoted(html_col), link_class), 0)
    return pages.select(
        quoted(id_col),
        page_title(quoted(html_col), title_id).alias("Name"),
        swap(first, "json", "csv").alias("Link"),
    )
