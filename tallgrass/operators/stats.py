"""Counts of the corpus, completeness of works, summaries of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corpus_stats(works: DataFrame, sections: DataFrame, items: DataFrame, assets: DataFrame, retries: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Ten counts in one row, and ``store_bytes`` where stored files (length) are given; every table is read once, and one-row results are put side by side."""
    is_ = lambda *v: F.col("status").isin(*v)
    out = works.agg(F.count("*").alias("works"), F.count_if(is_("error", "failed")).alias("failed_works"), F.count_if(~is_("completed")).alias("incomplete_works"))
    for part in (
        sections.agg(F.count("*").alias("sections")),
        items.agg(F.count_if(is_("completed")).alias("completed_items"), F.count_if(is_("failed")).alias("failed_items")),
        assets.agg(F.count("*").alias("assets"), F.count_if(is_("downloaded")).alias("downloaded_assets")),
        retries.agg(F.count_if(is_("pending")).alias("pending_retries"), F.count_if(is_("dead")).alias("dead_retries")),
    ):
        out = out.crossJoin(part)  # one row each
    return out if files is None else out.crossJoin(files.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("store_bytes")))


def count_changes(of: str, before: DataFrame, after: DataFrame, column: str | None = "status") -> DataFrame:
    """What a change of rows adds to the counts by status: (of, status, n), n below zero where rows left a status.

    ``before`` and ``after`` are the old and new versions of the rows that a merge touched, no others, so this costs as
    much as the merge. Without a column all rows are of one status, ''.
    """
    value = F.col(column) if column else F.lit("")
    one = lambda df, n: df.select(value.alias("status"), F.lit(n).cast("long").alias("n"))
    return one(before, -1).union(one(after, 1)).groupBy("status").agg(F.sum("n").alias("n")).select(F.lit(of).alias("of"), "status", "n")


def add_counts(counts: DataFrame, *changes: DataFrame) -> DataFrame:
    """Counts after changes: a row for each table and status that ever was, at zero where none is left."""
    for c in changes:
        counts = counts.unionByName(c)
    return counts.groupBy("of", "status").agg(F.sum("n").alias("n"))


def stats_of_counts(counts: DataFrame) -> DataFrame:
    """The row of ``corpus_stats`` from counts by table and status."""
    n = lambda of, *cond: F.coalesce(F.sum(F.when((F.col("of") == of) & (cond[0] if cond else F.lit(True)), F.col("n"))), F.lit(0))
    is_ = lambda *v: F.col("status").isin(*v)
    return counts.agg(
        n("works").alias("works"), n("works", is_("error", "failed")).alias("failed_works"), n("works", ~is_("completed")).alias("incomplete_works"), n("sections").alias("sections"),
        n("items", is_("completed")).alias("completed_items"), n("items", is_("failed")).alias("failed_items"), n("assets").alias("assets"), n("assets", is_("downloaded")).alias("downloaded_assets"),
        n("ledger", is_("pending")).alias("pending_retries"), n("ledger", is_("dead")).alias("dead_retries"),
    )


def run_summary(feed: DataFrame, run: str, work: str, outcome: str, items: str) -> DataFrame:
    """Per run: works checked and updated, new items, errors, and success only without errors."""
    errors = F.count_if(F.col(outcome) == "error")
    return feed.groupBy(run).agg(
        F.countDistinct(work).alias("checked"),
        F.count_if(F.col(outcome) == "ok").alias("updated"),
        F.coalesce(F.sum(items), F.lit(0)).cast("long").alias("new_items"),
        errors.alias("errors"),
        F.when(errors == 0, "success").otherwise("partial").alias("status"),
    )


def work_completion(items: DataFrame, work: str) -> DataFrame:
    """Completed if every item is; else partial with a message on the failed ones."""
    failed = F.count_if(F.col("status") == "failed")
    out = items.groupBy(work).agg(failed.alias("failed"), F.count("*").alias("items"), F.every(F.col("status") == "completed").alias("_all"))
    message = F.when(F.col("failed") > 0, F.concat(F.col("failed").cast("string"), F.lit(" item(s) failed during crawl")))
    return out.select(work, "items", "failed", F.when(F.col("_all"), "completed").otherwise("partial").alias("status"), message.alias("error_message"))


def work_totals(items: DataFrame, work: str, words: str) -> DataFrame:
    return items.groupBy(work).agg(F.count("*").alias("items"), F.sum(words).cast("long").alias("words"))


def status_counts(df: DataFrame, column: str = "status") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))
