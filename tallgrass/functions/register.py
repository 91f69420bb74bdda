"""The expressions of this package as functions that SQL text can call, and the parser of pages as a table function."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from .html import _Chosen, parse
from .text import NOTICE_PHRASES
from .urls import WORK_PREFIXES

_PATH = r"regexp_replace(regexp_extract(url, R'^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), R'^/+|/+$', '')"
_PREFIXES = ", ".join(f"'{p}'" for p in WORK_PREFIXES)
_UNITS = ("B", "KB", "MB", "GB", "TB")

#: name: (parameters, result, body). Bodies are SQL of their own; tests hold them against the column forms.
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "url_slug": ("url STRING", "STRING", f"CASE WHEN size(split({_PATH}, '/')) >= 2 AND get(split({_PATH}, '/'), 0) IN ({_PREFIXES}) THEN get(split({_PATH}, '/'), 1) WHEN {_PATH} = '' THEN 'novel' ELSE replace({_PATH}, '/', '_') END"),
    "url_work_id": ("url STRING", "BIGINT", r"try_cast(regexp_extract(url_slug(url), R'^(\d+)', 1) AS BIGINT)"),
    "url_item_id": ("url STRING", "BIGINT", r"try_cast(regexp_extract(regexp_extract(url, R'^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), R'(?:^|/)c(\d+)', 1) AS BIGINT)"),
    "is_http": ("url STRING", "BOOLEAN", "url RLIKE '^https?://'"),
    "slug_to_url": ("x STRING, base STRING", "STRING", "CASE WHEN startswith(x, 'http') THEN x ELSE concat(base, '/truyen/', x) END"),
    "asset_ext": ("url STRING", "STRING", "CASE WHEN contains(lower(url), '.png') THEN '.png' WHEN contains(lower(url), '.webp') THEN '.webp' ELSE '.jpg' END"),
    "asset_path": ("folder STRING, url STRING", "STRING", "concat(folder, '/', substring(md5(url), 1, 12), asset_ext(url))"),
    "cover_path": ("name STRING, url STRING", "STRING", "concat(name, asset_ext(url))"),
    "clean_text": ("s STRING", "STRING", r"regexp_replace(regexp_replace(regexp_replace(s, R'\r\n|\r', '\n'), R'\n{3,}', '\n\n'), R'^\s+|\s+$', '')"),
    "sanitize_filename": ("s STRING", "STRING", r"""coalesce(nullif(rtrim(substring(trim(regexp_replace(regexp_replace(s, R'[\\/*?:"<>|]', ''), R'\s+', ' ')), 1, 120)), ''), 'untitled')"""),
    "content_hash": ("s STRING", "STRING", "sha2(s, 256)"),
    "format_bytes": ("n BIGINT", "STRING", "CASE " + " ".join(f"WHEN n < {1024 ** (i + 1)}D THEN format_string('%.1f {u}', rint(n / {1024**i}D * 10) / 10)" for i, u in enumerate(_UNITS)) + f" ELSE format_string('%.1f PB', rint(n / {1024**5}D * 10) / 10) END"),
    "format_duration": ("s DOUBLE", "STRING", "CASE WHEN CAST(s AS BIGINT) >= 3600 THEN format_string('%dh %02dm %02ds', CAST(s AS BIGINT) div 3600, CAST(s AS BIGINT) % 3600 div 60, CAST(s AS BIGINT) % 60) WHEN CAST(s AS BIGINT) >= 60 THEN format_string('%dm %02ds', CAST(s AS BIGINT) div 60, CAST(s AS BIGINT) % 60) ELSE format_string('%ds', CAST(s AS BIGINT)) END"),
    "first_nonempty": ("a STRING, b STRING", "STRING", "coalesce(nullif(a, ''), b)"),
    "digits_to_int": ("s STRING", "BIGINT", "coalesce(try_cast(regexp_replace(s, '[^0-9]', '') AS BIGINT), 0L)"),
    "word_count": ("s STRING", "INT", r"size(filter(split(s, R'\s+'), x -> x != ''))"),
    "is_notice": ("s STRING", "BOOLEAN", " OR ".join(f"contains(lower(s), '{p}')" for p in NOTICE_PHRASES)),
    "fetch_outcome": ("status INT", "STRING", "CASE WHEN status = 200 THEN 'ok' WHEN status IN (403, 404) THEN 'permanent' WHEN status IN (429, 502, 503, 504) THEN 'throttled' ELSE 'retryable' END"),
    "json_strings": ("s STRING", "ARRAY<STRING>", "coalesce(from_json(coalesce(nullif(s, ''), '[]'), 'array<string>'), CAST(array() AS ARRAY<STRING>))"),
    "escape_html": ("s STRING", "STRING", """replace(replace(replace(replace(replace(s, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), "'", '&#x27;')"""),
}


@udtf(returnType="pos int, last int, tag string, classes array<string>, id string, href string, text string")
class HtmlNodes:
    """The elements of a page that a list of selectors (a tag, .class or #id) chooses, by one parse."""

    def eval(self, html: str, wanted: list[str]) -> Iterator[tuple]:
        for n in parse(html or "", _Chosen({"": wanted or []}), _Chosen({}), False):
            yield n[0], n[1], n[2], n[3], n[4], dict(n[5]).get("href"), n[6]


def register(spark: SparkSession) -> None:
    """Make all functions known to the session; SQL text may then call them by name, and ``html_nodes`` in LATERAL joins."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    spark.udtf.register("html_nodes", HtmlNodes.asDeterministic())
