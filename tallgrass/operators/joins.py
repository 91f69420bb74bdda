"""Diffs and look-ups between a listing and what is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_items(listing: DataFrame, items: DataFrame, key: Sequence[str], *, force: bool = False) -> DataFrame:
    """Items of the listing that are not stored as completed; with ``force`` all."""
    if force:
        return listing
    return listing.join(items.filter("status = 'completed'").select(*key), list(key), "left_anti")


def new_works(catalog: DataFrame, works: DataFrame, slug: Column, key: str = "url") -> DataFrame:
    """Stubs for works that are not stored yet."""
    new = catalog.select(key).distinct().join(works.select(key), key, "left_anti")
    return new.select(key, slug.alias("slug"), slug.alias("title"), F.lit("pending").alias("crawl_status"))


def classify_feed(feed: DataFrame, works: DataFrame, completed: DataFrame, *, work: str, item: str, force: bool = False) -> DataFrame:
    """Label feed rows new_work, new_item or recheck; all are queued.

    A known work has a new item if its latest one has an address that is neither null nor '' and is not completed; with
    ``force`` every known work counts as having one.
    """
    w = works.select(F.col(work).alias("_w")).distinct()
    c = completed.select(F.col(item).alias("_i")).distinct()
    j = feed.join(w, feed[work] == F.col("_w"), "left").join(c, feed[item] == F.col("_i"), "left")
    fresh = F.lit(force) | ((F.coalesce(F.col(item).cast("string"), F.lit("")) != "") & F.col("_i").isNull())
    return j.select(*feed.columns, F.when(F.col("_w").isNull(), "new_work").when(fresh, "new_item").otherwise("recheck").alias("reason"), F.lit(True).alias("queued"))


def attach(left: DataFrame, right: DataFrame, key: str, value: str, fallback: Column) -> DataFrame:
    """Left join of one value; where it is missing, the fallback."""
    r = right.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    j = left.join(r, left[key] == r["_k"], "left")
    return j.withColumn(value, F.coalesce("_v", fallback)).drop("_k", "_v")


def section_titles(items: DataFrame, sections: DataFrame, key: str = "section_id", title: str = "section_title") -> DataFrame:
    """Items with the title of their section; null where the section is unknown, so that a group's number can stand for it."""
    return attach(items.withColumn(title, F.lit(None).cast("string")), sections, key, title, F.lit(None).cast("string"))


def asset_status(assets: DataFrame, inventory: DataFrame, path: str = "path", *, least: int = 100) -> DataFrame:
    """Downloaded if a stored file over ``least`` bytes is there, failed without a web address, else to fetch."""
    stored = inventory.filter(F.col("length") > least).select(F.col(path).alias("_p"), F.col("length").alias("_n"))
    j = assets.join(stored, assets[path] == stored["_p"], "left")
    status = F.when(F.col("_p").isNotNull(), "downloaded").when(~F.coalesce(F.col("url").rlike("^https?://"), F.lit(False)), "failed").otherwise("fetch")
    return j.select(*assets.columns, status.alias("status"), F.col("_n").alias("file_size"))


def remaining(urls: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    return urls.join(done.select(key), key, "left_anti")


def resolve_sections(listing: DataFrame, sections: DataFrame, key: Sequence[str]) -> DataFrame:
    """Item rows with the merged section of their work and title."""
    return listing.join(sections, list(key))
