"""Queries of scalar functions and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..functions import vietnamese as V
from .book import Book
from .views import sql, table

book = Book()
LANGS = ("en", "fr", "de", "es")
_PATH = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
_SLUGGED = f"""SELECT *, CASE WHEN len(parts) >= 2 AND parts[1] IN ('en', 'fr', 'de', 'es') THEN parts[2] WHEN p = '' THEN 'novel' ELSE replace(p, '/', '_') END AS slug
FROM (SELECT *, string_split(p, '/') AS parts FROM (SELECT *, trim({_PATH}, '/') AS p, {_PATH} AS path FROM pages))"""


@book.add(f"SELECT page_id, slug FROM ({_SLUGGED})")
def url_slug(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", U.slug(F.col("url"), LANGS).alias("slug"))


@book.add(rf"SELECT page_id, TRY_CAST(nullif(regexp_extract(slug, '^(\d+)', 1), '') AS BIGINT) AS work_id, TRY_CAST(nullif(regexp_extract('/w' || path || '/c' || page_id || '-x', '(?:^|/)c(\d+)', 1), '') AS BIGINT) AS item_id FROM ({_SLUGGED})")
def url_ids(spark: SparkSession, sf: str) -> DataFrame:
    item = F.concat(F.lit("/w"), U.path(F.col("url")), F.lit("/c"), F.col("page_id"), F.lit("-x"))
    return table(spark, sf, "pages").select("page_id", U.work_id(F.col("url"), LANGS).alias("work_id"), U.item_id(item).alias("item_id"))


_LINKS = r"""SELECT page_id, url, CAST(i - 1 AS BIGINT) AS pos, regexp_extract(a, 'href="([^"]*)"', 1) AS href, trim(regexp_replace(a, '(?s)<[^>]*>', '', 'g')) AS text
FROM (SELECT page_id, url, generate_subscripts(a, 1) AS i, unnest(a) AS a FROM (SELECT page_id, url, regexp_extract_all(html, '(?s)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>') AS a FROM pages)) WHERE regexp_extract(a, 'href="([^"]*)"', 1) <> ''"""


@book.add(rf"""SELECT page_id, pos, CASE WHEN href LIKE '//%' THEN 'https:' || href WHEN regexp_matches(href, '^https?://') THEN href WHEN href LIKE '/%' THEN 'https://site.example' || href ELSE 'https://site.example/' || href END AS link,
'https://site.example/d/' || (page_id + pos) AS up FROM ({_LINKS})""")
def normalize_url(spark: SparkSession, sf: str) -> DataFrame:
    """Links of all pages, and a relative address with dot segments, joined to a base."""
    rows = extract_links(spark, sf)
    dots = F.concat(F.lit("./a/../"), (F.col("page_id") + F.col("pos")).cast("string"))
    return rows.select("page_id", "pos", U.normalize(F.col("href"), "https://site.example").alias("link"), U.normalize(dots, "https://site.example/d/x").alias("up"))


@book.add(f"SELECT page_id, pos, href, text FROM ({_LINKS})")
def extract_links(spark: SparkSession, sf: str) -> DataFrame:
    """Anchors of all pages, of which a third is brought to capitals and single quotes and a third to none."""
    from ..functions.html import links

    k, plain = F.col("page_id") % 3, '<a href="([^"]*)"'
    single = F.regexp_replace(F.regexp_replace("html", plain, "<A class=x HREF = '$1'"), "</a>", "</A>")
    html = F.when((k == 1) & ~F.col("html").contains("'"), single).when(k == 2, F.regexp_replace("html", """<a href="([^" '>]+)\"""", '<a id="1" href=$1')).otherwise(F.col("html"))
    return table(spark, sf, "pages").select("page_id", F.posexplode(links(html)).alias("pos", "p")).select("page_id", F.col("pos").cast("long").alias("pos"), "p.href", "p.text")


@book.add(r"""SELECT doc_id, CASE WHEN f = '' THEN 'untitled' ELSE f END AS file_name FROM (SELECT doc_id, rtrim(substr(trim(regexp_replace(regexp_replace(text, '[\\/*?:"<>|]', '', 'g'), '\s+', ' ', 'g')), 1, 120)) AS f FROM documents)""")
def file_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", T.file_name(F.col("text")).alias("file_name"))


@book.add(r"SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(replace(text, '.', chr(13) || chr(10)), '\r\n|\r', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS cleaned FROM documents")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    broken = F.replace("text", F.lit("."), F.lit("\r\n"))
    return table(spark, sf, "documents").select("doc_id", F.sha2(T.clean(broken), 256).alias("cleaned"))


_BROKEN = {".": " ", "an": "a ` n", "on": "ô n", "ed": "e\u0302 \u00b4 t", "er": "ư\u00a0\u0323\u200bơ ng", "la": "nga\u0303\u00ad i"}


def vn_sql(s: str = "text") -> str:
    """A text that came apart, repaired, in SQL."""
    for a, b in _BROKEN.items():
        s = f"replace({s}, '{a}', '{b}')"
    s = "regexp_replace(replace(%s, chr(160), ' '), '[\\x{200B}\\x{200C}\\x{200D}\\x{FEFF}\\x{00AD}\\r]', '', 'g')" % s
    s = "regexp_replace(%s, '([a-zA-Z\\x{00C0}-\\x{1EF9}])\\s+([\\x{0300}-\\x{036F}\\x{1DC0}-\\x{1DFF}\\x{1AB0}-\\x{1AFF}])', '\\1\\2', 'g')" % s
    for mark, forms in V.TONES.items():
        s = f"regexp_replace({s}, '([{V.VOWELS}])\\s*[{forms}]', '\\1{mark}', 'g')"
    s = f"nfc_normalize({s})"
    for _ in range(2):
        s = f"regexp_replace({s}, '(?i)([a-z\\x{{00C0}}-\\x{{1EF9}}]*[{V.MARKED}])\\s+({V.TAILS})([^\\p{{L}}\\p{{N}}_\\x{{00C0}}-\\x{{1EF9}}]|$)', '\\1\\2\\3', 'g')"
    return f"regexp_replace(regexp_replace({s}, '[ \\t]+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"


def came_apart(text: Column) -> Column:
    """Common letter pairs become syllables that came apart."""
    for a, b in _BROKEN.items():
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


@book.add(f"SELECT doc_id, sha256({vn_sql()}) AS repaired FROM documents")
def vn_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Texts in which common letter pairs became syllables that came apart."""
    return table(spark, sf, "documents").select("doc_id", F.sha2(V.repair(came_apart(F.col("text"))), 256).alias("repaired"))


@book.add("SELECT page_id, concat('work/', substr(md5(u), 1, 12), CASE WHEN contains(lower(u), '.png') THEN '.png' WHEN contains(lower(u), '.webp') THEN '.webp' ELSE '.jpg' END) AS asset_path FROM (SELECT page_id, concat(url, CASE page_id % 3 WHEN 0 THEN '.PNG' WHEN 1 THEN '.webp' ELSE '' END) AS u FROM pages)")
def asset_path(spark: SparkSession, sf: str) -> DataFrame:
    u = F.concat("url", F.when(F.col("page_id") % 3 == 0, ".PNG").when(F.col("page_id") % 3 == 1, ".webp").otherwise(""))
    return table(spark, sf, "pages").select("page_id", U.asset_path(F.lit("work"), u).alias("asset_path"))


@book.add("SELECT doc_id, sha256(text) AS content_hash FROM documents")
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))


@book.add("""SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN b < 1024 THEN printf('%.1f B', b) WHEN b < 1048576 THEN printf('%.1f KB', b / 1024) WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576) ELSE printf('%.1f GB', b / 1073741824) END AS bytes,
CASE WHEN s >= 3600 THEN printf('%dh %02dm %02ds', s // 3600, s % 3600 // 60, s % 60) WHEN s >= 60 THEN printf('%dm %02ds', s // 60, s % 60) ELSE printf('%ds', s) END AS duration
FROM (SELECT *, floor(l_extendedprice * l_quantity * l_quantity) AS b, CAST(floor(l_extendedprice) AS BIGINT) AS s FROM lineitem)""")
def format_units(spark: SparkSession, sf: str) -> DataFrame:
    size = F.floor(F.col("l_extendedprice") * F.col("l_quantity") * F.col("l_quantity"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", T.format_bytes(size).alias("bytes"), T.format_duration(F.floor("l_extendedprice")).alias("duration"))


@book.add("SELECT c_custkey, CASE WHEN starts_with(x, 'http') THEN x ELSE 'https://site.example/truyen/' || x END AS url FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'http://a/' || c_custkey ELSE lower(c_name) END AS x FROM customer)")
def slug_to_url(spark: SparkSession, sf: str) -> DataFrame:
    x = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("http://a/"), F.col("c_custkey"))).otherwise(F.lower("c_name"))
    return table(spark, sf, "customer").select("c_custkey", U.from_slug(x, "https://site.example").alias("url"))


@book.add("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type || '|' || user_id END AS back FROM events""")
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    encoded = F.when(F.col("event_id") % 4 == 0, F.when(F.col("event_id") % 8 == 0, "")).otherwise(F.to_json(F.array("event_type", F.col("user_id").cast("string"))))
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.array_join(T.json_array(encoded), "|").alias("back"))


@book.add("SELECT c_custkey, coalesce(TRY_CAST(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') AS BIGINT), 0) AS n, CAST(0 AS BIGINT) AS none FROM customer")
def digits_to_int(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", T.digits_to_int(F.col("c_name")).alias("n"), T.digits_to_int(F.col("c_mktsegment")).alias("none"))


_STATUS = "CASE CAST(floor(value) AS BIGINT) % 7 WHEN 0 THEN 403 WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 503 WHEN 4 THEN 500 ELSE 200 END"


@book.add(f"SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN s = 200 THEN 'ok' WHEN s IN (403, 404) THEN 'permanent' WHEN s IN (429, 502, 503, 504) THEN 'throttled' ELSE 'retryable' END AS outcome FROM (SELECT {_STATUS} AS s FROM events)) GROUP BY outcome")
def fetch_outcome(spark: SparkSession, sf: str) -> DataFrame:
    rows = sql(spark, sf, f"SELECT {_STATUS} AS status FROM events")
    return rows.groupBy(T.fetch_outcome(F.col("status")).alias("outcome")).agg(F.count("*").alias("n"))


@book.add(r"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS BIGINT) AS words FROM documents")
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", T.word_count(F.col("text")).cast("long").alias("words"))


@book.add("SELECT doc_id FROM documents WHERE contains(lower(text), 'all rights reserved') OR contains(lower(text), 'released under')")
def ad_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter(T.is_notice(F.col("text"), ("all rights reserved", "released under"))).select("doc_id")


@book.add("SELECT page_id, url FROM (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN replace(url, 'http', 'ftp') ELSE url END AS url FROM pages) WHERE regexp_matches(url, '^https?://')")
def http_filter(spark: SparkSession, sf: str) -> DataFrame:
    mixed = table(spark, sf, "pages").select("page_id", F.when(F.col("page_id") % 5 == 0, F.replace("url", F.lit("http"), F.lit("ftp"))).otherwise(F.col("url")).alias("url"))
    return mixed.filter(U.is_http(F.col("url")))


@book.add(rf"""SELECT page_id, coalesce(CASE WHEN page_id % 4 = 0 THEN false WHEN w IS NOT NULL AND w <> 0 THEN page_id % 4 <> 1 ELSE page_id % 4 <> 1 OR contains(item, slug) OR slug = 'novel' END, false) AS belongs FROM (
SELECT *, TRY_CAST(nullif(regexp_extract(slug, '^(\d+)', 1), '') AS BIGINT) AS w, 'https://h/en/999999999-other/c5-x' AS item FROM ({_SLUGGED}))""")
def belongs(spark: SparkSession, sf: str) -> DataFrame:
    """Item addresses of the work itself, of another work, and without an item part."""
    own = F.concat(F.lit("https://h/en/"), U.slug(F.col("url"), LANGS), F.lit("/c5-x"))
    item = F.when(F.col("page_id") % 4 == 0, F.lit("https://h/en/x")).when(F.col("page_id") % 4 == 1, F.lit("https://h/en/999999999-other/c5-x")).otherwise(own)
    return table(spark, sf, "pages").select("page_id", U.belongs_to_work(item, F.col("url"), LANGS).alias("belongs"))


@book.add("SELECT o_orderkey, concat_ws(',', least(o_custkey % 9, o_orderkey % 7), CASE WHEN o_custkey % 9 <> o_orderkey % 7 THEN greatest(o_custkey % 9, o_orderkey % 7) END) AS pages FROM orders")
def page_selection(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.frontier import page_selection as select

    spec = F.concat_ws(",", (F.col("o_custkey") % 9).cast("string"), F.lit(" x"), F.concat(F.lit(" "), (F.col("o_orderkey") % 7).cast("string")), F.lit("-3"), (F.col("o_custkey") % 9).cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(select(spec).cast("array<string>"), ",").alias("pages"))


@book.add("SELECT page_id, 'w' || page_id || CASE page_id % 2 WHEN 0 THEN '.png' ELSE '.jpg' END AS cover, 'retry/' || substr(md5(url || CASE page_id % 2 WHEN 0 THEN '.PNG' ELSE '' END), 1, 12) || '.jpg' AS recovered FROM pages")
def other_asset_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Where covers and assets that a retry fetched are stored."""
    u = F.concat("url", F.when(F.col("page_id") % 2 == 0, ".PNG").otherwise(""))
    name = F.concat(F.lit("w"), F.col("page_id").cast("string"))
    return table(spark, sf, "pages").select("page_id", U.cover_path(name, F.concat(F.lit("x"), F.when(F.col("page_id") % 2 == 0, ".PNG").otherwise(""))).alias("cover"), U.recovered_path(u).alias("recovered"))


@book.add("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE o_orderstatus END AS value FROM orders")
def first_nonempty(spark: SparkSession, sf: str) -> DataFrame:
    given = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).when(F.col("o_orderkey") % 2 == 0, "")
    return table(spark, sf, "orders").select("o_orderkey", T.first_nonempty(given, F.col("o_orderpriority")).alias("value"))
