"""Queries that run the given tables through streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import retry
from ..sources.tables import new_folder
from ..streaming import pipelines, site
from .book import Book
from .curation import _LEDGER, _ROWS
from .views import table, view

book = Book()


def _as_stream(df: DataFrame, name: str, order: str, batches: int = 3) -> DataFrame:
    """A stream of the rows in so many batches by ``order``, each of as many files as it has rows for."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    bounds, rows = df.select(F.percentile_approx(order, [i / batches for i in range(1, batches)], 10_000), F.count("*")).first()
    part = F.lit(0)
    for b in bounds or []:
        part = part + F.when(F.col(order) > b, 1).otherwise(0)
    # every batch has the same number of files, none empty, so that a trigger reads one batch
    files = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // (10_000 * batches)))
    for i in range(batches):
        df.filter(part == i).repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


@book.add("SELECT DISTINCT regexp_replace(url, '[?#].*$', '') AS url FROM pages")
def stream_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("url"))
    stream = pipelines.first_seen(_as_stream(pages, "urls", "page_id").select("url"), ["url"])
    return pipelines.run_to_end(stream, new_folder(spark, "seen")).select("url")


@book.add("SELECT DISTINCT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def stream_first_seen_recent(spark: SparkSession, sf: str) -> DataFrame:
    """First events of a user, type and day, whose keys are forgotten two days behind the newest event; batches come in order of time."""
    events = table(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")).withColumn("at", F.unix_micros("ts"))
    events = events.withColumn("day", F.to_date("ts").cast("string"))
    stream = pipelines.first_seen(_as_stream(events, "recent", "at"), ["user_id", "event_type", "day"], event_time="ts", watermark="2 days")
    return pipelines.run_to_end(stream, new_folder(spark, "recent")).select("user_id", "event_type", "day")


@book.add(_LEDGER)
def stream_retry_ledger(spark: SparkSession, sf: str) -> DataFrame:
    actions = view(spark, sf, "retry_actions").filter("action != 'skip'")
    path = new_folder(spark, "ledger")
    pipelines.ledger_table(_as_stream(actions, "actions", "seq"), path).awaitTermination()
    rows = pipelines.current(spark, f"{path}/ledger")
    return rows.select("target_url", "attempts", "status") if rows is not None else retry.ledger(actions)


@book.add("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_stats(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type")
    out = pipelines.run_to_end(pipelines.status_counts(_as_stream(events, "events", "event_id"), "event_type"), new_folder(spark, "counts"), mode="complete")
    return out.groupBy("event_type").agg(F.max_by("n", "batch").alias("n"))


_URL = "regexp_replace(url, '[?#].*$', '')"


@book.add(f"SELECT {_URL} AS url, count(*) AS seen FROM pages GROUP BY 1")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Works after all batches of pages, and how many pages each was seen on."""
    path = new_folder(spark, "ingest")
    pipelines.ingest(_as_stream(table(spark, sf, "pages"), "pages", "page_id"), path).awaitTermination()
    works = pipelines.current(spark, f"{path}/works")
    return works.select("url", "seen")


@book.add(_ROWS)
def stream_ledger_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whole ledger rows after three batches of actions."""
    path = new_folder(spark, "ledger-rows")
    actions = view(spark, sf, "ledger_actions").filter("action != 'skip'").select("item_type", "target_url", "seq", "action", F.col("target_id").cast("long").alias("target_id"), F.col("max_attempts").cast("long").alias("max_attempts"), "error", "extra")
    site.ledger_stream(_as_stream(actions, "ledger-actions", "seq"), path, buckets=8).awaitTermination()
    return site.TableSet(spark, path, {"ledger": site.SCHEMAS["ledger"]}, "target_url", 8).read("ledger")


BASE = "https://site.example"


def site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as a site in four phases: work pages that list the first turns, items, of which some fail, work pages that list all (some fail), and failed items again."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.concat(F.col("role"), F.lit(" "), F.col("text")).alias("text"))
    k, t = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    work = F.concat(F.lit(f"{BASE}/truyen/"), k, F.lit("-w"))
    entry = F.concat(F.lit('<li><a href="/truyen/'), k, F.lit("-w/c"), t, F.lit('-x">t'), t, F.lit("</a></li>"))
    in_order = lambda cond: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(cond, F.struct("turn", entry.alias("e"))))), lambda x: x["e"]), "")
    lists = c.groupBy("conv_id").agg(in_order(F.col("turn") < 3).alias("few"), in_order(F.lit(True)).alias("all"))

    def listing(phase: int, name: str, items: str, html_ok: F.Column) -> DataFrame:
        html = F.concat(F.lit(f'<h1 class="series-name">{name} '), k, F.lit('</h1><section class="volume-list"><p class="sect-title">one</p><ul class="list-chapters">'), items, F.lit("</ul></section>"))
        return lists.select((F.lit(phase * 10**12) + F.col("conv_id") * 1000).alias("page_id"), work.alias("url"), F.when(html_ok, html).alias("html"))

    body = F.concat(F.lit('<div class="title-top"><h4>T'), t, F.lit('</h4></div><div class="chapter-content"><img src="/i/'), "role", F.lit('.png"><p>'), F.translate("text", "<>&", "   "), F.lit("</p></div>"))

    def pages(phase: int, chosen: F.Column, html_ok: F.Column) -> DataFrame:
        return c.filter(chosen).select((F.lit(phase * 10**12) + F.col("conv_id") * 1000 + F.col("turn") + 1).alias("page_id"), F.concat(work, F.lit("/c"), t, F.lit("-x")).alias("url"), F.when(html_ok, body).alias("html"))

    n = F.col("turn")
    first, again = pages(1, n % 4 != 2, n % 4 != 1), pages(3, (n % 4 == 1) | (n % 8 == 3), n % 4 == 1)
    return listing(0, "Old", "few", F.lit(True)).union(first).union(listing(2, "Work", "all", F.col("conv_id") % 10 != 7)).union(again)


_SITE_ITEMS = r"""SELECT conv_id, turn, role, listed, CASE WHEN turn % 8 = 3 THEN 'failed' WHEN turn % 4 = 2 THEN 'pending' ELSE 'completed' END AS status, CASE WHEN turn % 4 = 2 THEN 't' ELSE 'T' END || turn AS title,
CASE WHEN turn % 8 = 3 OR turn % 4 = 2 THEN 0 ELSE len(list_filter(regexp_split_to_array(role || ' ' || translate(text, '<>&', '   '), '\s+'), lambda x: x <> '')) END AS words
FROM (SELECT *, conv_id % 10 <> 7 OR turn < 3 AS listed FROM conversations) WHERE turn % 4 <> 2 OR listed"""
_SITE = f"""WITH i AS ({_SITE_ITEMS})
SELECT 'item' AS kind, conv_id || '/' || turn AS id, title, status, CAST(words AS BIGINT) AS n FROM i
UNION ALL SELECT 'work', CAST(conv_id AS VARCHAR), CASE WHEN conv_id % 10 = 7 THEN 'Old ' ELSE 'Work ' END || conv_id, CASE WHEN conv_id % 10 = 7 THEN 'error' WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'partial' WHEN count(*) FILTER (WHERE status = 'pending') > 0 THEN 'crawling' ELSE 'completed' END, 0 FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN i USING (conv_id) GROUP BY conv_id
UNION ALL SELECT 'section', CAST(conv_id AS VARCHAR), 'one', '', 1 FROM i WHERE listed GROUP BY conv_id
UNION ALL SELECT 'asset', '{BASE}/i/' || role || '.png', 'chapter_illustration', 'pending', 0 FROM i WHERE turn % 4 <> 2 GROUP BY role
UNION ALL SELECT 'retry', conv_id || '/' || turn, 'item', CASE WHEN turn % 4 = 1 THEN 'resolved' ELSE 'pending' END, 0 FROM i WHERE turn % 4 = 1 OR turn % 8 = 3
UNION ALL SELECT 'retry', CAST(conv_id AS VARCHAR), 'work', 'pending', 0 FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 10 = 7)
UNION ALL SELECT 'run', 'errors', '', '', (SELECT count(*) FROM conversations WHERE turn % 4 = 1 OR turn % 8 = 3) + (SELECT count(DISTINCT conv_id) FROM conversations WHERE conv_id % 10 = 7)
UNION ALL SELECT 'run', 'new_items', '', '', (SELECT count(*) FROM conversations WHERE turn % 4 <> 2)"""


@book.add(f"""WITH i AS ({_SITE_ITEMS}), w AS (SELECT conv_id, CASE WHEN conv_id % 10 = 7 THEN 'error' WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'partial' WHEN count(*) FILTER (WHERE status = 'pending') > 0 THEN 'crawling' ELSE 'completed' END AS status FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN i USING (conv_id) GROUP BY conv_id)
SELECT * FROM (SELECT count(*) AS works, count(*) FILTER (WHERE status = 'error') AS failed_works, count(*) FILTER (WHERE status <> 'completed') AS incomplete_works FROM w), (SELECT count(DISTINCT conv_id) FILTER (WHERE listed) AS sections, count(*) FILTER (WHERE status = 'completed') AS completed_items, count(*) FILTER (WHERE status = 'failed') AS failed_items, count(DISTINCT role) FILTER (WHERE turn % 4 <> 2) AS assets, 0 AS downloaded_assets FROM i),
(SELECT (SELECT count(*) FROM i WHERE turn % 8 = 3) + (SELECT count(*) FROM w WHERE status = 'error') AS pending_retries, 0 AS dead_retries)""")
def stream_corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics after all batches of a site's pages, kept current by what each batch changed."""
    path = new_folder(spark, "site-counts")
    site.ingest(_as_stream(site_pages(spark, sf), "site-pages", "page_id"), path, BASE, buckets=8).awaitTermination()
    return site.corpus_stats(site.tables(spark, path, 8))


@book.add(_SITE)
def stream_site(spark: SparkSession, sf: str) -> DataFrame:
    """Works, sections, items, assets, retries and sums of runs after all batches of a site's pages."""
    path = new_folder(spark, "site")
    site.ingest(_as_stream(site_pages(spark, sf), "site-pages", "page_id"), path, BASE, buckets=8).awaitTermination()
    t = site.tables(spark, path, 8)
    conv = lambda c: F.regexp_extract(c, r"/(\d+)-w", 1)
    key = lambda c: F.concat(conv(c), F.regexp_replace(F.regexp_extract(c, r"/c\d+", 0), "/c", "/"))
    zero = F.lit(0).cast("long").alias("n")
    row = lambda kind, id_, title, status, n=zero: [F.lit(kind).alias("kind"), id_.alias("id"), title.alias("title"), status.alias("status"), n.alias("n")]
    none, runs = F.lit(""), t.read("runs")
    out = t.read("items").select(*row("item", key("item_url"), F.coalesce(F.nullif("title", F.lit("")), "listed_title"), F.col("status"), F.coalesce("words", F.lit(0))))
    for df in (
        t.read("works").select(*row("work", conv("work_url"), F.col("title"), F.col("status"))), t.read("sections").select(*row("section", conv("work_url"), F.col("title"), none, F.col("section_index"))),
        t.read("assets").select(*row("asset", F.col("asset_url"), F.col("asset_type"), F.col("status"))), t.read("ledger").select(*row("retry", key("target_url"), F.col("item_type"), F.col("status"), F.col("attempts"))),
        *(runs.agg(F.sum(c).alias("s")).select(*row("run", F.lit(c), none, none, F.col("s"))) for c in ("errors", "new_items")),
    ):
        out = out.union(df)
    return out
