"""Queries in SQL text only, by the registered functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.register import register
from .book import Book
from .views import sql

book = Book()
_P = r"trim(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/')"


@book.add(rf"""SELECT page_id, CASE WHEN {_P} = '' THEN 'novel' ELSE replace({_P}, '/', '_') END AS slug, regexp_matches(url, '^https?://') AS http, 'p/' || substr(md5(url), 1, 12) || CASE WHEN contains(lower(url), '.png') THEN '.png' WHEN contains(lower(url), '.webp') THEN '.webp' ELSE '.jpg' END AS path,
sha256(html) AS hash, coalesce(TRY_CAST(nullif(regexp_replace(url, '[^0-9]', '', 'g'), '') AS BIGINT), 0) AS digits, CASE page_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'permanent' WHEN 2 THEN 'throttled' ELSE 'retryable' END AS outcome, links.n AS links
FROM pages JOIN (SELECT page_id, len(regexp_extract_all(html, '<a\s')) AS n FROM pages) AS links USING (page_id)""")
def sql_text(spark: SparkSession, sf: str) -> DataFrame:
    """Pages by a query that is SQL from end to end, the parse of a page included."""
    register(spark)
    return sql(
        spark, sf,
        """SELECT page_id, url_slug(url) AS slug, is_http(url) AS http, asset_path('p', url) AS path, content_hash(html) AS hash, digits_to_int(url) AS digits, fetch_outcome(element_at(array(200, 404, 503, 500, 418), CAST(page_id % 5 + 1 AS INT))) AS outcome, links
        FROM pages, LATERAL (SELECT count(*) AS links FROM html_nodes(html, array('a')))""",
    )
