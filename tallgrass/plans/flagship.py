"""The flagship query: pages to works, by host."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..functions import urls as U
from ..operators import frontier, joins
from .book import Book
from .views import table

book = Book()

SQL = r"""
WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, CAST(len(regexp_extract_all(html, '(?s)<a\s[^>]*href="[^"]+"[^>]*>.*?</a>')) AS BIGINT) AS links FROM pages),
f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS n FROM p)
SELECT host, count(*) AS pages, CAST(sum(links) AS BIGINT) AS links, count(*) FILTER (WHERE url NOT IN (SELECT url FROM p WHERE page_id % 3 = 0)) AS new_works FROM f WHERE n = 1 GROUP BY host"""


@book.add(SQL)
def host_report(spark: SparkSession, sf: str) -> DataFrame:
    """Per host: pages first seen under an address, their links, and works that are not stored yet."""
    pages = table(spark, sf, "pages")
    read = pages.select(F.regexp_replace("url", "[?#].*$", "").alias("url"), "page_id", U.host(F.col("url")).alias("host"), F.size(H.links(F.col("html"))).alias("links"))
    seen = frontier.first_seen(read, ["url"], ["page_id"])
    new = joins.new_works(seen, read.filter("page_id % 3 = 0"), U.slug(F.col("url"))).select("url", F.lit(1).alias("is_new"))
    return seen.join(new, "url", "left").groupBy("host").agg(F.count("*").alias("pages"), F.sum("links").cast("long").alias("links"), F.count("is_new").alias("new_works"))


@book.add(r"SELECT page_id, CAST(len(list_filter(regexp_split_to_array(regexp_replace(html, '(?s)<[^>]*>', ' ', 'g'), '\s+'), lambda x: x <> '')) AS BIGINT) AS words FROM pages")
def page_words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", T.word_count(F.regexp_replace("html", "(?s)<[^>]*>", " ")).cast("long").alias("words"))
