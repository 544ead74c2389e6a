"""Page-table extraction (A7 list items, A8 headline ids). JVM regex only:
one row per page in, one row per item out (``posexplode``, M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A list item is an <li> whose first child is a link.
LIST_ITEM = r'<li>\s*<a\s+href="([^"]*)"[^>]*>([^<]*)</a>'


def list_items(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
               pattern: str = LIST_ITEM) -> DataFrame:
    """(id, pos, url, title) for every list item of every page."""
    z = F.arrays_zip(F.regexp_extract_all(F.col(html_col), F.lit(pattern), 1).alias("url"),
                     F.regexp_extract_all(F.col(html_col), F.lit(pattern), 2).alias("title"))
    return (pages.select(id_col, F.posexplode(z).alias("pos", "item"))
                 .select(id_col, "pos", F.col("item.url").alias("url"), F.col("item.title").alias("title")))


def headline_ids(pages: DataFrame, html_col: str = "html", section: str = "/news/",
                 id_pattern: str = r"(\d+)\.aspx") -> DataFrame:
    """Distinct ids of links into ``section`` (A8): distinct runs of digits
    before ``.aspx`` in hrefs that contain the section path."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(r'href="([^"]*)"'), 1)
    links = pages.select(F.explode(hrefs).alias("href")).filter(F.col("href").contains(section))
    return (links.select(F.regexp_extract("href", id_pattern, 1).alias("pid"))
                 .filter(F.col("pid") != "").distinct())
