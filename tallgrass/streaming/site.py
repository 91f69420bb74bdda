"""A stream of site pages kept as tables of works, sections, items, assets, retries, runs and counts, which change together."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import urls as U
from ..operators import merge, retry, stats
from ..sources.versions import TableSet

SCHEMAS = {
    "works": "work_url string, slug string, title string, fetch string, status string, error_message string",
    "sections": "work_url string, title string, section_index long",
    "items": "work_url string, item_url string, section string, item_index long, listed_title string, listed_date string, title string, publish_date string, words long, text string, status string, error_message string",
    "assets": "asset_url string, work_url string, item_url string, asset_type string, status string",
    "ledger": "item_type string, target_url string, target_id long, attempts long, max_attempts long, status string, last_error string, extra_data string",
    "runs": "run_id long, run_type string, status string, checked long, updated long, new_items long, errors long, details map<string,long>",
    "counts": "of string, status string, n long",
}
#: What deals out the rows of each table: all of a work lies in one bucket, so its completion needs no other.
KEYS = {"works": "work_url", "sections": "work_url", "items": "work_url", "assets": "asset_url", "ledger": "target_url", "runs": "run_id", "counts": "of"}
#: Tables whose rows are counted, and by which column.
COUNTED = {"works": "status", "sections": None, "items": "status", "assets": "status", "ledger": "status"}
_ITEM = r"/c\d+[^/]*/?$"
NOT_FETCHED = "page not fetched"


def tables(spark: SparkSession, path: str, buckets: int = 64) -> TableSet:
    return TableSet(spark, path, SCHEMAS, KEYS, buckets)


def read_pages(pages: DataFrame, base: str) -> dict[str, DataFrame]:
    """What a batch of pages (page_id, url, html; null html: not fetched) tells, as events in the order of page_id.

    A page whose address ends in an item's part is an item, another a work. Each kind is parsed once.
    """
    url = F.regexp_replace("url", "[?#].*$", "")
    d = pages.select(F.col("page_id").cast("long").alias("seq"), url.alias("page"), F.regexp_replace(url, _ITEM, "").alias("work_url"), "html", F.col("html").isNotNull().alias("ok"))
    works = H.html_pages(d.filter(~F.col("page").rlike(_ITEM)), "page", "html", [*H.CONTENTS["wanted"], ".series-name"], scopes=H.CONTENTS["scopes"], keep=["seq", "ok", "work_url"]).persist()
    items = H.html_pages(d.filter(F.col("page").rlike(_ITEM)), "page", "html", [*H.ITEM_NODES["wanted"], "img"], scopes=H.ITEM_NODES["scopes"], text_only=True, keep=["seq", "ok", "work_url"]).persist()
    title = H.first_node(F.col("nodes"), lambda n: H.has_class(n, "series-name"))["text"]
    slug = U.slug(F.col("page"))
    read = works.select("work_url", "seq", slug.alias("slug"), F.when(F.col("ok"), F.coalesce(title, slug)).alias("title"), F.when(F.col("ok"), "ok").otherwise("error").alias("fetch"))
    listed = H.contents_lists(works.filter("ok"), base, keep=["seq"]).select(F.col("page").alias("work_url"), "seq", F.inline_outer("items")).filter("item_url IS NOT NULL").persist()
    contents = H.item_pages(items, keep=["seq", "ok", "work_url"]).select(
        "work_url", F.col("page").alias("item_url"), "seq", F.when(F.col("ok"), F.col("title")).otherwise("").alias("title"), F.when(F.col("ok"), F.col("date")).otherwise("").alias("publish_date"),
        F.when(F.col("ok"), F.col("words")).otherwise(0).cast("long").alias("words"), F.when(F.col("ok"), F.col("text")).otherwise("").alias("text"),
        F.when(F.col("ok"), "completed").otherwise("failed").alias("status"), F.when(F.col("ok"), "").otherwise(NOT_FETCHED).alias("error_message"),
    ).persist()
    src = lambda n: F.coalesce(F.nullif(n["attrs"]["src"], F.lit("")), F.nullif(n["attrs"]["data-src"], F.lit("")))
    found = F.filter(F.transform(F.filter("nodes", lambda n: n["tag"] == "img"), src), lambda x: x.isNotNull())
    assets = items.select(F.explode(F.array_distinct(U.normalize_each(found, base))).alias("asset_url"), "work_url", F.col("page").alias("item_url"), "seq", F.lit("chapter_illustration").alias("asset_type"))
    kind = lambda name: F.lit(name).alias("item_type")
    act = F.when(F.col("ok"), "resolve").otherwise("add").alias("action")
    tries = works.select(kind("work"), F.col("page").alias("target_url"), "seq", act).union(items.select(kind("item"), F.col("page").alias("target_url"), "seq", act))
    none = F.lit(None)
    tries = tries.select("*", none.cast("long").alias("target_id"), none.cast("long").alias("max_attempts"), F.lit(NOT_FETCHED).alias("error"), F.lit("{}").alias("extra"))
    return {"works": read, "listed": listed, "items": contents, "assets": assets, "tries": tries, "_held": [listed, contents, works, items]}


def fold(events: Mapping[str, DataFrame], stored: Mapping[str, DataFrame], run: int) -> dict[str, DataFrame]:
    """The tables after a batch of events, from what is stored of the buckets that it touches."""
    works = merge.fold_merge(merge.with_existing(stored["works"].drop("status", "error_message"), events["works"], "seq"), ["work_url"], "seq", {"slug": "keep_if_null", "title": "keep_if_null", "fetch": "overwrite"})
    heads = events["listed"].groupBy("work_url", "seq", F.col("section").alias("title")).agg(F.max("section_index").alias("section_index"))
    sections = merge.fold_merge(merge.with_existing(stored["sections"], heads, "seq"), ["work_url", "title"], "seq", {"section_index": "overwrite"})
    listing = events["listed"].select("work_url", "item_url", "seq", "section", "item_index", F.col("title").alias("listed_title"), F.col("date").alias("listed_date"))
    history = merge.with_existing(stored["items"], listing.unionByName(events["items"], allowMissingColumns=True), "seq")
    rules = dict.fromkeys(["section", "item_index", "words", "text", "status", "error_message"], "keep_if_null") | dict.fromkeys(["listed_title", "listed_date", "title", "publish_date"], "keep_if_empty")
    items = merge.fold_merge(history, ["work_url", "item_url"], "seq", rules).withColumn("status", F.coalesce("status", F.lit("pending")))
    # a work's state follows from its last fetch and from all of its items, which lie in the same bucket
    counts = items.groupBy(F.col("work_url").alias("_w")).agg(F.count_if(F.col("status") == "failed").alias("_failed"), F.count_if(F.col("status") == "pending").alias("_open"))
    works = works.join(counts, F.col("work_url") == F.col("_w"), "left")
    failed = F.coalesce("_failed", F.lit(0))
    wrong = F.col("fetch") == "error"
    status = F.when(wrong, "error").when(failed > 0, "partial").when(F.coalesce("_open", F.lit(0)) > 0, "crawling").otherwise("completed")
    message = F.when(wrong, NOT_FETCHED).when(failed > 0, F.concat(failed.cast("string"), F.lit(" chapter(s) failed during crawl")))
    works = works.select("work_url", "slug", F.coalesce("title", "slug").alias("title"), "fetch", status.alias("status"), message.alias("error_message"))
    assets = merge.fold_merge(merge.with_existing(stored["assets"].drop("status"), events["assets"], "seq"), ["asset_url"], "seq", {"work_url": "keep_if_null", "item_url": "keep_if_null", "asset_type": "overwrite"}).withColumn("status", F.lit("pending"))
    ledger = retry.ledger_rows(events["tries"], stored["ledger"])
    # a run: works looked at, works read, items that are new, pages that failed
    done = stored["items"].filter("status = 'completed'").select("item_url").distinct()
    new = events["items"].filter("status = 'completed'").select("item_url").distinct().join(done, "item_url", "left_anti").agg(F.count("*").alias("new_items"))
    seen = events["works"].agg(F.count("*").alias("checked"), F.count_if(F.col("fetch") == "ok").alias("updated"), F.count_if(F.col("fetch") == "error").alias("_a"))
    missed = events["items"].agg(F.count("*").alias("_n"), F.count_if(F.col("status") == "failed").alias("_b"))
    errors = (F.col("_a") + F.col("_b")).alias("errors")
    runs = seen.crossJoin(missed).crossJoin(new)  # one row each
    runs = runs.select(F.lit(run).cast("long").alias("run_id"), F.lit("daily").alias("run_type"), F.when(F.col("_a") + F.col("_b") == 0, "success").otherwise("partial").alias("status"), "checked", "updated", "new_items", errors, F.create_map(F.lit("pages"), F.col("checked") + F.col("_n")).alias("details"))
    runs = stored["runs"].filter(F.col("run_id") != run).unionByName(runs)  # those of earlier runs that share its bucket
    return {"works": works, "sections": sections, "items": items, "assets": assets, "ledger": ledger, "runs": runs}


def missing_items(set_: TableSet, *, at: int | None = None) -> DataFrame:
    """Items that are listed or failed and not completed, as of a commit."""
    return set_.read("items", at=at).filter("status != 'completed'").select("work_url", "item_url", "section", "item_index", "status")


def corpus_stats(set_: TableSet, *, at: int | None = None) -> DataFrame:
    """The counts of the corpus as of a commit, from a few rows that every commit keeps current."""
    return stats.stats_of_counts(set_.read("counts", at=at))


def ingest_batch(set_: TableSet, pages: DataFrame, number: int, base: str) -> bool:
    """Fold one batch of pages into all tables under one commit; one that is there already changes nothing."""
    if number in set_.commits():
        return False
    events = read_pages(pages, base)
    held = events.pop("_held")
    try:
        by_work = set_.touched(events["works"].select("work_url").union(events["items"].select("work_url")), "work_url")
        only = {"works": by_work, "sections": by_work, "items": by_work, "assets": set_.touched(events["assets"], "asset_url"), "ledger": set_.touched(events["tries"], "target_url")}
        only["runs"] = set_.touched(set_.spark.range(number, number + 1), "id")
        stored = {t: set_.read(t, only=b) for t, b in only.items()}
        # counts change by what the touched buckets gain and lose, and are never taken over whole tables
        changes = lambda new: [stats.count_changes(t, stored[t], new[t], c) for t, c in COUNTED.items()]
        return set_.commit(number, fold(events, stored, number), then=lambda new: {"counts": stats.add_counts(set_.read("counts"), *changes(new))})
    finally:
        for d in held:
            d.unpersist()


def ingest(pages: DataFrame, path: str, base: str, *, interval: str | None = None, buckets: int = 64, keep: int = 2):
    """Keep the tables under ``path`` current with a stream of pages; returns the query.

    Each batch is one commit of all tables: readers see all of it or none. A batch that runs again after a failure
    finds its commit, or else the state before it, and so changes nothing twice. Only the buckets that a batch touches are
    read and written. Versions older than the last ``keep`` commits are deleted. Without an interval, what is there is read
    and the query ends.
    """
    set_ = tables(pages.sparkSession, path, buckets)

    def step(batch: DataFrame, number: int) -> None:
        ingest_batch(set_, batch, number, base)
        set_.clean(keep)

    w = pages.writeStream.option("checkpointLocation", f"{path}/state").foreachBatch(step)
    return (w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)).start()


def ledger_stream(actions: DataFrame, path: str, *, buckets: int = 64, max_attempts: int = 3):
    """Keep whole ledger rows current with a stream of actions, by the same fold as in a batch; returns the query.

    A batch is summed up by key, with partial aggregates, before it meets the stored row, so a key with very many
    actions in one batch needs no memory for them.
    """
    spark = actions.sparkSession
    set_ = TableSet(spark, path, {"ledger": SCHEMAS["ledger"]}, KEYS["ledger"], buckets)

    def step(batch: DataFrame, number: int) -> None:
        if number not in set_.commits():
            state = set_.read("ledger", only=set_.touched(batch, "target_url"))
            set_.commit(number, {"ledger": retry.ledger_rows(batch, state, max_attempts=max_attempts)})

    return actions.writeStream.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(step).start()
