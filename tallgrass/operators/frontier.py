"""Frontiers: first-seen order, unions, page ranges, stops, and lists by order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_seen(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of every key by ``order``.

    The least row is a partial aggregate, so a key that fills a third of the table is no larger for a task than its
    own part of it.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    least = F.min(F.struct(*order, *rest)).alias("_r")
    return df.groupBy(*key).agg(least).select(*[F.col(c) if c in key and c not in order else F.col(f"_r.{c}") for c in df.columns])


def running_index(df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "running_index") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)).cast("long"))


def union_frontier(catalog: DataFrame, works: DataFrame, key: str = "url", seq: str = "seq", limit: int | None = None) -> DataFrame:
    """Catalog first, then stored works; each URL once, where it was first seen. A positive limit takes a prefix."""
    both = catalog.select(key, seq, F.lit(0).alias("source_rank")).unionByName(works.select(key, seq, F.lit(1).alias("source_rank")))
    out = first_seen(both, [key], ["source_rank", seq])
    return out.orderBy("source_rank", seq, key).limit(limit) if limit and limit > 0 else out


def seed_pages(specs: DataFrame, template: str, start: str = "start", end: str = "stop", most: str = "most") -> DataFrame:
    """One row per page of each range; an end of 0 or less, or past the last page, is the last page."""
    last = F.when((F.col(end) <= 0) | (F.col(end) > F.col(most)), F.col(most)).otherwise(F.col(end))
    pages = F.when(F.col(start) <= last, F.sequence(F.col(start), last)).otherwise(F.array().cast("array<bigint>"))
    out = specs.select("*", F.explode(pages).alias("page"))
    p = F.col("page").cast("string")
    url = F.lit(template)
    url = F.replace(F.replace(url, F.lit("{page}"), p), F.lit("{i}"), p) if "{page}" in template or "{i}" in template else F.concat(url, p)
    return out.withColumn("url", url)


def page_selection(spec: Column) -> Column:
    """The numbers of a comma list, distinct and sorted; other tokens are dropped."""
    tokens = F.filter(F.transform(F.split(spec, ","), lambda x: F.trim(x)), lambda x: x.rlike(r"^\d+$"))
    return F.sort_array(F.array_distinct(F.transform(tokens, lambda x: x.cast("long"))))


def take_until_empty(counts: DataFrame, key: Sequence[str], page: str, n: str) -> DataFrame:
    """Of pages in order, those before the first without entries."""
    stop = counts.groupBy(*key).agg(F.min(F.when(F.col(n) == 0, F.col(page))).alias("_stop"))
    return counts.join(stop, list(key)).filter(F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))).drop("_stop")


def second_pass(found: DataFrame, failed: DataFrame, recovered: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Results of both passes, and what the second left unresolved."""
    return found.unionByName(recovered), failed.join(recovered.select(key), key, "left_anti")


def resume_page(known: DataFrame, per_page: int = 42) -> DataFrame:
    return known.agg((F.floor(F.count("*") / per_page) + 1).cast("long").alias("resume_page"))


def ordered(df: DataFrame, order: Sequence[Column | str], limit: int | None = None, offset: int | None = None) -> DataFrame:
    """Sorted, with a limit only if positive."""
    out = df.orderBy(*order)
    out = out.offset(offset) if offset else out
    return out.limit(limit) if limit and limit > 0 else out
