"""Queries of HTML extraction: pages as they are, and tables rendered into markup and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..functions import urls as U
from .book import Book
from .views import table

book = Book()
BASE = "https://site.example"


def _dealt(spark: SparkSession, sf: str, name: str, key: str) -> DataFrame:
    """A table's rows dealt out to tasks: they become pages, whose parse takes far longer than the few bytes of a row let Spark expect."""
    return table(spark, sf, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)


def _tag(name: str, cls: str, *body) -> F.Column:
    return F.concat(F.lit(f'<{name} class="{cls}">'), *[F.lit(b) if isinstance(b, str) else b for b in body], F.lit(f"</{name}>"))


def _pair(kind: str, name: str, value: F.Column) -> F.Column:
    return _tag("div", f"{kind}-item", _tag("span", f"{kind}-name", name), _tag("span", f"{kind}-value", value.cast("string")))


@book.add(r"SELECT page_id, CASE WHEN regexp_matches(html, '(?s)<h1[^>]*>.*?</h1>') THEN trim(regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')) ELSE url END AS title FROM pages")
def page_title(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", H.page_title(F.col("html"), F.col("url")).alias("title"))


def _plain(s: str) -> str:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        s = f"replace({s}, '{a}', '{b}')"
    return s


_HEAD = "regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)"
_CUT = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?is)<noscript[^>]*>.*?</noscript>', '', 'g'), '(?is)<!--.*?-->|<div class="ad">.*?</div>', '', 'g')"""


@book.add(rf"""SELECT page_id, sha256(array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_extract({_CUT}, '(?is)<article[^>]*>(.*?)(?:</article>|$)', 1), '(?i)<p[^>]*>')[2:],
lambda x: {_plain(r"regexp_replace(regexp_replace(regexp_replace(x, '(?is)</p>.*', '', 'g'), '(?s)<[^>]*>', '', 'g'), '^\s+|\s+$', '', 'g')")}), lambda x: x <> '' AND x <> trim({_HEAD})), chr(10) || chr(10))) AS body FROM pages""")
def body_text(spark: SparkSession, sf: str) -> DataFrame:
    title = F.trim(F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1))
    return table(spark, sf, "pages").select("page_id", F.sha2(H.body_text(F.col("html"), title), 256).alias("body"))


@book.add(r"SELECT host, max(n) AS max_page FROM (SELECT regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, greatest(1, coalesce(TRY_CAST(nullif(regexp_extract(url, 'page=(\d+)', 1), '') AS BIGINT), 1)) AS n FROM pages) GROUP BY host")
def host_max_page(spark: SparkSession, sf: str) -> DataFrame:
    """Largest page number in the addresses of a host's pages."""
    n = F.coalesce(F.regexp_extract("url", r"page=(\d+)", 1).try_cast("long"), F.lit(1))
    return table(spark, sf, "pages").groupBy(U.host(F.col("url")).alias("host")).agg(F.greatest(F.lit(1), F.max(n)).cast("long").alias("max_page"))


@book.add("SELECT url, min(page_id) AS first_page FROM (SELECT url, page_id FROM pages WHERE contains(url, '/en/') OR contains(url, '/fr/')) GROUP BY url")
def language_urls(spark: SparkSession, sf: str) -> DataFrame:
    urls = table(spark, sf, "pages").select("page_id", U.normalize(F.col("url"), BASE).alias("url")).filter(F.col("url").rlike("/(en|fr)/"))
    return urls.groupBy("url").agg(F.min("page_id").alias("first_page"))


@book.add("SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://site.example/i/' || page_id || '.png' WHEN 1 THEN url ELSE 'https:' || replace(replace(url, 'https:', ''), 'http:', '') END AS cover FROM pages")
def cover_url(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses in a style, in src, and in data-src only."""
    k = F.col("page_id") % 3
    style = F.when(k == 0, F.concat(F.lit("width:1px;background:url('/i/"), "page_id", F.lit(".png')")))
    src = F.when(k == 1, F.col("url")).otherwise("")
    return table(spark, sf, "pages").select("page_id", H.cover_url(style, src, F.regexp_replace("url", "^https?:", ""), BASE).alias("cover"))


@book.add("SELECT c_custkey, c_name AS author, c_mktsegment AS artist, CASE WHEN c_custkey % 2 = 0 THEN 'n' || c_nationkey END AS status, 'b' || c_custkey AS other_names FROM customer")
def info_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as labelled lists; the last of two authors counts, an item without value does not."""
    page = F.concat(
        _pair("info", "Tác giả:", F.lit("nobody")), _pair("info", "Tác giả:", F.col("c_name")), _pair("info", "Minh họa:", F.col("c_mktsegment")),
        F.when(F.col("c_custkey") % 2 == 0, _pair("info", "Tình trạng:", F.concat(F.lit("n"), "c_nationkey"))).otherwise('<div class="info-item"><span class="info-name">Tình trạng:</span></div>'),
        _pair("info", "Tên khác:", F.concat(F.lit("b"), "c_custkey")),
    )
    nodes = H.html_pages(_dealt(spark, sf, "customer", "c_custkey").select("c_custkey", page.alias("html")), "c_custkey", "html", [".info-name", ".info-value"], scopes={"item": [".info-item"]})
    return H.info_pairs(nodes, H.INFO_LABELS, "info-name", "info-value").select(F.col("page").cast("long").alias("c_custkey"), *H.INFO_LABELS)


@book.add("SELECT s_suppkey, s_suppkey * 1234 AS words, s_suppkey + 5 AS views, 0 AS bookmarks, (s_suppkey % 50) / 10.0::DOUBLE AS rating, s_suppkey AS rating_count, 'n ' || s_nationkey AS updated FROM supplier")
def stat_pairs(spark: SparkSession, sf: str) -> DataFrame:
    page = F.concat(
        _pair("statistic", "Số từ", F.format_number(F.col("s_suppkey") * 1234, 0)), _pair("statistic", "Lượt xem", F.concat((F.col("s_suppkey") + 5).cast("string"), F.lit(" lần"))), _pair("statistic", "Theo dõi", F.lit("-")),
        _pair("statistic", "Đánh giá", F.concat(F.regexp_replace(F.format_string("%.1f", F.col("s_suppkey") % 50 / 10), r"\.", ","), F.lit(" / "), "s_suppkey")), _pair("statistic", "Lần cuối", F.concat(F.lit("n\n"), "s_nationkey")),
    )
    nodes = H.html_pages(_dealt(spark, sf, "supplier", "s_suppkey").select("s_suppkey", page.alias("html")), "s_suppkey", "html", [".statistic-name", ".statistic-value"], scopes={"item": [".statistic-item"]})
    return H.typed_stats(H.info_pairs(nodes, H.STAT_LABELS, "statistic-name", "statistic-value")).withColumn("page", F.col("page").cast("long")).withColumnRenamed("page", "s_suppkey")


@book.add("SELECT p_partkey, CASE WHEN p_type = p_brand THEN p_name || '|' || p_type ELSE p_name || '|' || p_type || '|' || p_brand END AS tags FROM part")
def ordered_tags(spark: SparkSession, sf: str) -> DataFrame:
    link = lambda c: F.concat(F.lit('<a href="/the-loai/x"> '), c, F.lit(" </a>"))
    page = F.concat(link(F.col("p_name")), _tag("span", "badge-genre", F.col("p_type")), link(F.col("p_name")), F.lit('<a href="/other">no</a>'), _tag("b", "badge-genre", " "), link(F.col("p_brand")))
    nodes = H.html_pages(_dealt(spark, sf, "part", "p_partkey").select("p_partkey", page.alias("html")), "p_partkey", "html", ["a", ".badge-genre"])
    return H.ordered_tags(nodes).select(F.col("page").cast("long").alias("p_partkey"), F.array_join("tags", "|").alias("tags"))


@book.add("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Truyện dịch' ELSE source END AS work_type, CASE WHEN doc_id % 5 = 0 THEN '' ELSE lang || chr(10) || chr(10) || doc_id END AS summary FROM documents")
def type_summary(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("doc_id") % 4 == 0, "").otherwise(_tag("div", "series-type", F.col("source")))
    summary = F.when(F.col("doc_id") % 5 == 0, "").otherwise(_tag("div", "summary-content", F.concat(F.lit("\r\n"), F.col("lang"), F.lit("\n\n\n\n"), F.col("doc_id").cast("string"), F.lit("\n"))))
    page = F.concat(F.lit("<p>x</p>"), kind, summary, F.lit('<div class="series-end"></div>'))
    nodes = H.html_pages(_dealt(spark, sf, "documents", "doc_id").select("doc_id", page.alias("html")), "doc_id", "html", [".series-type", ".summary-content"])
    return H.type_and_summary(nodes).withColumn("page", F.col("page").cast("long")).withColumnRenamed("page", "doc_id")


@book.add("SELECT doc_id, 'https://site.example/i/' || source || '.jpg|https://cdn.example/' || doc_id || '.webp' AS assets FROM documents")
def asset_urls(spark: SparkSession, sf: str) -> DataFrame:
    page = F.concat(F.lit('<p id="1"><img src="/i/'), "source", F.lit('.jpg" alt=""></p><img data-src="//cdn.example/'), F.col("doc_id").cast("string"), F.lit('.webp"/><img src="/i/'), "source", F.lit('.jpg"><img alt="none">'))
    nodes = H.html_pages(_dealt(spark, sf, "documents", "doc_id").select("doc_id", page.alias("html")), "doc_id", "html", ["img"])
    return H.asset_urls(nodes, BASE).select(F.col("page").cast("long").alias("doc_id"), F.array_join("assets", "|").alias("assets"))


@book.add("SELECT doc_id, sha256(text) AS content FROM documents")
def segments(spark: SparkSession, sf: str) -> DataFrame:
    """Texts cut into numbered base64 segments in reverse order, with segments that say nothing, and put together again."""
    n = F.length("text")
    third = F.greatest(F.ceil(n / 3), F.lit(1)).cast("int")
    piece = lambda i: F.concat(F.format_string("%04d", F.lit(i)), F.regexp_replace(F.base64(F.encode(F.substring(F.col("text"), i * third + 1, third), "UTF-8")), r"\s", ""))
    packed = F.to_json(F.array(F.lit("0009"), piece(2), F.lit("0007====a"), piece(1), piece(0)))
    return table(spark, sf, "documents").select("doc_id", F.sha2(T.reassemble(packed), 256).alias("content"))


_TOC = """SELECT conv_id, CASE WHEN swept THEN max(role) FILTER (WHERE NOT swept) OVER (PARTITION BY conv_id) ELSE role END AS section, row_number() OVER (PARTITION BY conv_id ORDER BY swept, role, turn) AS item_index,
turn, CASE WHEN swept THEN '' ELSE 'd' || turn END AS date, swept FROM (SELECT *, turn % 5 = 4 AS swept FROM conversations)"""


@book.add(f"SELECT conv_id, coalesce(section, 'Quyển 1') AS section, item_index, 'https://site.example/truyen/' || conv_id || '-w/c' || turn || '-x' AS item_url, CASE WHEN turn % 3 = 0 THEN 'Chương ' || item_index ELSE 't' || turn END AS title, date FROM ({_TOC})")
def toc_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as work pages: a section per role, a turn as item, every fifth outside of lists, links in comments."""
    c = table(spark, sf, "conversations")
    link = F.concat(F.lit('<a href="/truyen/'), F.col("conv_id").cast("string"), F.lit("-w/c"), F.col("turn").cast("string"), F.lit('-x">'), F.when(F.col("turn") % 3 == 0, "").otherwise(F.concat(F.lit("t"), F.col("turn").cast("string"))), F.lit("</a>"))
    inside = F.concat(F.lit('<li><div class="chapter-name">'), link, F.lit('</div><div class="chapter-time">d'), F.col("turn").cast("string"), F.lit("</div></li>"))
    rows = c.select("conv_id", "role", "turn", (F.col("turn") % 5 == 4).alias("swept"), link.alias("link"), inside.alias("inside"))
    joined = lambda col, order: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, col))), lambda x: x[col]), "")
    sections = rows.filter("NOT swept").groupBy("conv_id", "role").agg(joined("inside", "turn").alias("b"))
    sections = sections.withColumn("b", F.concat(F.lit('<section class="volume-list"><header class="sect-title">'), "role", F.lit('</header><ul class="list-chapters">'), "b", F.lit("</ul></section>")))
    sections = sections.groupBy("conv_id").agg(joined("b", "role").alias("listed"))
    loose = rows.filter("swept").groupBy("conv_id").agg(joined("link", "turn").alias("loose"))
    pages = c.select("conv_id").distinct().join(sections, "conv_id", "left").join(loose, "conv_id", "left")
    noise = F.concat(F.lit('<section id="series-comments"><a href="/truyen/'), F.col("conv_id").cast("string"), F.lit('-w/c999-no">no</a></section><a href="/truyen/7777777-other/c1-x">other</a>'))
    pages = pages.select(F.concat(F.lit(f"{BASE}/truyen/"), F.col("conv_id").cast("string"), F.lit("-w")).alias("url"), F.concat(noise, F.coalesce("listed", F.lit("")), F.coalesce("loose", F.lit(""))).alias("html"))
    out = H.table_of_contents(H.html_pages(pages, "url", "html", **H.CONTENTS), BASE)
    return out.select(F.regexp_extract("page", r"/(\d+)-w", 1).cast("long").alias("conv_id"), "section", "item_index", "item_url", "title", "date")


@book.add("""SELECT o_custkey, 'https://site.example/truyen/' || o_orderkey AS work_url, 'w' || o_orderkey AS title, CASE WHEN o_custkey % 3 <> 0 AND o_orderkey % 4 <> 0 THEN 'c' || o_orderstatus ELSE '' END AS latest_title,
CASE WHEN o_custkey % 3 <> 0 AND o_orderkey % 4 <> 0 THEN 'https://site.example/c/' || o_orderkey ELSE '' END AS latest_url, CASE WHEN o_custkey % 3 <> 0 THEN o_orderpriority ELSE '' END AS updated FROM orders WHERE o_custkey % 3 = 0 OR o_orderkey % 10 <> 7""")
def feed_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as cards on a page per customer; a third of the pages has bare links only, some cards no title."""
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    title = F.concat(F.lit('<div class="thumb_attr series-title"><a href="/truyen/'), key, F.lit('">w'), key, F.lit("</a></div>"))
    item = F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.concat(F.lit('<div class="thumb_attr chapter-title"><a href="/c/'), key, F.lit('">c'), "o_orderstatus", F.lit("</a></div>")))
    card = F.concat(F.lit('<div class="thumb-item-flow">'), F.when(F.col("o_orderkey") % 10 == 7, "").otherwise(title), item, F.lit("<time>"), "o_orderpriority", F.lit("</time></div>"))
    rows = o.select("o_custkey", "o_orderkey", F.when(F.col("o_custkey") % 3 == 0, title).otherwise(card).alias("b"))
    pages = rows.groupBy("o_custkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", "b"))), lambda x: x["b"]), "").alias("html"))
    return H.feed_entries(H.html_pages(pages, "o_custkey", "html", **H.FEED), BASE).select(F.col("page").cast("long").alias("o_custkey"), "work_url", "title", "latest_title", "latest_url", "updated")


def _joined(rows: DataFrame, key: str, order: str, part: str) -> DataFrame:
    """(key, html): parts of a page in order."""
    return rows.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, part))), lambda x: x[part]), "").alias("html"))


@book.add("""SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY min(o_orderkey)) AS item_index, url FROM (SELECT o_custkey, o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'https://site.example/truyen/' || o_orderkey
WHEN 1 THEN 'https://site.example/sang-tac/' || o_orderkey % 50 WHEN 2 THEN 'https://other.example/convert/' || o_orderkey END AS url FROM orders) WHERE url IS NOT NULL GROUP BY o_custkey, url""")
def catalog_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as links of a catalogue page per customer: titles and covers, repeated ones, other sites, and links that are no works."""
    key = F.col("o_orderkey").cast("string")
    link = lambda href, cls="": F.concat(F.lit(f'<a class="{cls}" href="'), href, F.lit('">x</a>'))
    title = lambda href: F.concat(F.lit('<div class="thumb_attr series-title">'), link(href), F.lit("</div>"))
    cover = lambda href: F.concat(F.lit('<div class="thumb-item-flow">'), link(href, "series-cover"), F.lit("</div>"))
    own, shared = F.concat(F.lit("/truyen/"), key), F.concat(F.lit("sang-tac/"), (F.col("o_orderkey") % 50).cast("string"))
    foreign = F.concat(F.lit("//other.example/convert/"), key)
    k = F.col("o_orderkey") % 4
    part = F.when(k == 0, F.concat(title(own), cover(own))).when(k == 1, cover(shared)).when(k == 2, title(foreign)).otherwise(F.concat(title(F.concat(F.lit("/tin-tuc/"), key)), link(own)))
    pages = _joined(table(spark, sf, "orders").select("o_custkey", "o_orderkey", part.alias("part")), "o_custkey", "o_orderkey", "part")
    found = H.catalog_urls(H.html_pages(pages, "o_custkey", "html", **H.CATALOG), BASE)
    return found.select(F.col("page").cast("long").alias("o_custkey"), "item_index", "url")


@book.add("SELECT c_custkey, greatest(1, CASE WHEN c_custkey % 5 = 0 THEN 1 WHEN c_custkey % 5 = 1 THEN c_nationkey + 2 ELSE greatest(c_nationkey, 3) END) AS max_page FROM (SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer)")
def max_page(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as pages with pagination: numbers, a last page known by its address only, numbers that are no pages, or none."""
    c = _dealt(spark, sf, "customer", "c_custkey")
    n, k = F.col("c_nationkey").cast("long"), F.col("c_custkey") % 5
    link = lambda text, href: F.concat(F.lit('<a href="'), href, F.lit('">'), text, F.lit("</a>"))
    plain = F.lit("/danh-sach")
    wrap = F.concat(F.lit('<div class="pagination_wrap">'), link(F.lit(" 2 "), plain), link(F.lit("Cuối"), F.concat(F.lit("/danh-sach?a=1&amp;page="), (n + 2).cast("string"))), F.lit("</div>"))
    listed = F.concat(F.lit('<ul class="pagination"><li>'), link(n.cast("string"), F.lit("/x?page=999")), F.lit("</li><li>"), link(F.lit("3"), plain), F.lit("</li>"), link(F.lit("777"), plain), F.lit("</ul>"))
    html = F.concat(link(F.lit("888"), plain), F.when(k == 0, "").when(k == 1, wrap).otherwise(listed))
    found = H.largest_pages(H.html_pages(c.select("c_custkey", html.alias("html")), "c_custkey", "html", **H.PAGINATION))
    return found.select(F.col("page").cast("long").alias("c_custkey"), "max_page")


@book.add("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN '' ELSE c_custkey || '-w' END AS title FROM customer")
def work_title(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as work pages: with a name, with an empty one, and with none."""
    k = F.col("c_custkey") % 3
    name = F.when(k == 0, F.concat(F.lit('<span class="series-name"><a href="/x"> '), "c_name", F.lit(' </a></span><h1 class="series-name">second</h1>'))).when(k == 1, '<h1 class="series-name"> </h1>').otherwise("<h1>no</h1>")
    pages = _dealt(spark, sf, "customer", "c_custkey").select(F.concat(F.lit(f"{BASE}/truyen/"), F.col("c_custkey").cast("string"), F.lit("-w/")).alias("page"), name.alias("html"))
    found = H.work_titles(H.html_pages(pages, "page", "html", [".series-name"]))
    return found.select(F.regexp_extract("page", r"/(\d+)-w", 1).cast("long").alias("c_custkey"), "title")


_ITEM_LINES = r"list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')"


@book.add(rf"""SELECT doc_id, title, section, CASE WHEN doc_id % 3 = 0 THEN doc_id * 1234 + 1 ELSE len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) END AS words, CASE WHEN doc_id % 4 = 0 THEN '' ELSE doc_id || ' giờ trước' END AS date, sha256(text) AS text
FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'Chương' ELSE 'T ' || source END AS title, trim(CASE WHEN doc_id % 3 = 0 THEN 'S Độ dài: ' || format('{{:,}}', doc_id * 1234 + 1) || ' từ' ELSE 'S' END || CASE WHEN doc_id % 4 = 0 THEN '' ELSE chr(10) || 'Cập nhật: ' || doc_id || ' giờ trước' END) AS section,
array_to_string({_ITEM_LINES}, chr(10) || chr(10)) AS text FROM documents)""")
def item_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as item pages: header with words and date, paragraphs or bare lines, hidden parts, boxes, shop links, notices, repeated titles."""
    d = table(spark, sf, "documents")
    i = F.col("doc_id").cast("string")
    title = F.concat(F.lit("T "), "source")
    length = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("S Độ dài: "), F.format_number(F.col("doc_id") * 1234 + 1, 0), F.lit(" từ"))).otherwise("S")
    date = F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.concat(F.lit("\nCập nhật: "), i, F.lit(" giờ trước")))
    head = F.concat(F.lit('<div class="title-top"><h2>no</h2>'), F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.concat(F.lit("<h4>"), T.escape_html(title), F.lit(" </h4>"))), F.lit('<h6 class="title-item">'), length, date, F.lit("</h6></div>"))
    noise = F.concat(F.lit('<script>var p = "<p>no</p>";</script><div class="alert x"><p>no</p></div><p style="color:red;display: none">no</p><a href="https://shopee.example/1">no</a><noscript>no</noscript>'))
    notice = "Mã FREE ship nhé"
    paragraphs = F.array_join(F.transform(F.split("text", "\n"), lambda x: F.concat(F.lit("<p id='1'>"), T.escape_html(x), F.lit("</p>"))), "\n")
    with_p = F.concat(noise, paragraphs, F.lit(f"<p>{notice}</p><p>"), T.escape_html(F.when(F.col("doc_id") % 7 == 0, "Chương").otherwise(title)), F.lit("</p><p> </p>"))
    without = F.concat(F.lit("<style>p {}</style>"), T.escape_html(F.col("text")), F.lit(f"\n{notice}\n\n\n\n<div class='reading-notice'>no</div>\n"))
    body = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit('<div id="chapter-content">'), without)).otherwise(F.concat(F.lit('<div class="long-text reading-content">'), with_p))
    pages = d.select("doc_id", F.concat(head, F.lit("<p>outside</p>"), body, F.lit("</div><p>after</p>")).alias("html"))
    return H.item_pages(H.html_pages(pages, "doc_id", "html", text_only=True, **H.ITEM_NODES)).select(F.col("page").cast("long").alias("doc_id"), "title", "section", "words", "date", F.sha2("text", 256).alias("text"))
