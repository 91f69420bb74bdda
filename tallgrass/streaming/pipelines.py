"""Structured Streaming forms of ingest, first-seen dedup, the retry ledger and status counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.utils import AnalysisException

from ..functions import html as H
from ..functions import text as T
from ..functions import urls as U
from ..operators import joins, merge, retry


def first_seen(stream: DataFrame, key: list[str], *, event_time: str | None = None, watermark: str | None = None) -> DataFrame:
    """Rows whose key was not seen before; with a watermark the memory of keys is bounded by event time.

    The watermark after a batch is the newest event time so far, less the delay. A batch drops rows behind the watermark
    that the batch before it worked with, so a row that is late by one batch only still counts. A key is forgotten, at the
    end of a batch, once the watermark that the batch works with has passed its first row's time and the delay: until
    then all its rows are repeats, and one that comes later is first again.
    """
    if event_time and watermark:
        return stream.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(key)
    return stream.dropDuplicates(key)


def status_counts(stream: DataFrame, column: str) -> DataFrame:
    """Counts by status, for complete output."""
    return stream.groupBy(column).agg(F.count("*").alias("n"))


_STATE = "attempts long, status string"


def _ledger_step(max_attempts: int):
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        attempts, status = state.get if state.exists else (0, None)
        actions = pd.concat(list(frames)).sort_values("seq")
        for action in actions["action"]:
            if status is None:
                if action in ("add", "sync"):
                    attempts, status = 0, "pending"
            elif action in ("add", "fail"):
                attempts += 1
                status = "dead" if attempts >= max_attempts else "pending"
            elif action == "resolve":
                status = "resolved"
            elif action == "sync" and status != "dead":
                status = "pending"
        if status is not None:
            state.update((attempts, status))
            yield pd.DataFrame({"target_url": [key[0]], "attempts": [attempts], "status": [status]})

    return step


def retry_ledger(actions: DataFrame, *, max_attempts: int = 3) -> DataFrame:
    """The state of every key after each batch that touches it; actions (target_url, seq, action) come in order of seq.

    A key's state is its attempts and status, whatever the number of its actions. Every key of a batch is a call of a
    Python function, so this is for batches of some thousand keys; ``ledger_table`` folds large ones.
    """
    return actions.groupBy("target_url").applyInPandasWithState(_ledger_step(max_attempts), f"target_url string, {_STATE}", _STATE, "update", GroupStateTimeout.NoTimeout)


def run_to_end(stream: DataFrame, path: str, *, mode: str = "append") -> DataFrame:
    """Run what is there through the stream and read the result: (batch, row) of every output."""
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        # a batch that runs again after a failure replaces its own folder
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={number}")

    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema.add("batch", "long")).parquet(f"{path}/out")


def current(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """A table written in buckets by batch: of each bucket the last version (before a batch), or None without any."""
    try:
        versions = spark.read.option("basePath", path).parquet(path)
    except AnalysisException:
        return None
    if before is not None:
        versions = versions.filter(F.col("batch") < before)
    last = versions.groupBy("bucket").agg(F.max("batch").alias("batch"))  # a row for each bucket
    return versions.join(F.broadcast(last), ["bucket", "batch"]).drop("batch")


def ingest_batch(pages: DataFrame, works: DataFrame | None, number: int, langs: tuple[str, ...] = ("en", "fr", "de", "es")) -> DataFrame:
    """Works after a batch of pages: new ones as stubs, all with title and words of their pages, merged by URL."""
    url = F.regexp_replace("url", "[?#].*$", "")
    read = pages.select(url.alias("url"), H.page_title(F.col("html"), F.lit("")).alias("title"), T.word_count(H.body_text(F.col("html"), F.lit(None).cast("string"))).cast("long").alias("words"), F.col("page_id").alias("seq"))
    stored = works if works is not None else read.limit(0).select("url", F.lit("").alias("slug"), "title", "words", F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("since"))
    new = joins.new_works(read, stored, U.slug(F.col("url"), langs)).select("url", "slug", F.lit(number).cast("long").alias("since"))
    rows = read.join(new, "url", "left").select("url", "slug", "title", "words", F.lit(1).cast("long").alias("seen"), "since", "seq")
    history = merge.with_existing(stored, rows, "seq")
    rules = {"slug": "keep_if_null", "title": "keep_if_empty", "words": "overwrite", "since": "insert_only"}
    merged = merge.fold_merge(history, ["url"], "seq", rules)
    return merged.join(history.groupBy("url").agg(F.sum("seen").alias("seen")), "url")


def ingest(pages: DataFrame, path: str, *, interval: str | None = None, buckets: int = 64):
    """Keep the works table under ``path`` current with a stream of pages; returns the query.

    Works lie in buckets by the hash of their address. Each batch writes new versions of the buckets it touches in a
    folder of its number, so a small batch rewrites little, and a batch that runs again changes nothing.
    Without an interval, what is there is read and the query ends.
    """
    return _folded(pages, f"{path}/works", f"{path}/state", F.regexp_replace("url", "[?#].*$", ""), ingest_batch, interval, buckets)


def ledger_table(actions: DataFrame, path: str, *, max_attempts: int = 3, interval: str | None = None, buckets: int = 64):
    """Keep attempts and status of every key under ``path`` current with a stream of actions, as ``ingest`` keeps works.

    Actions (target_url, seq, action) come in order of seq. A batch is folded with the stored rows by ``retry.ledger``:
    groups with partial aggregates, so neither many keys nor many actions of a key cost Python or a task's memory. Read
    it by ``current(spark, f"{path}/ledger")``.
    """

    def fold(batch: DataFrame, known: DataFrame | None, number: int) -> DataFrame:
        return retry.ledger(batch, max_attempts=max_attempts, state=known)

    return _folded(actions, f"{path}/ledger", f"{path}/state", F.col("target_url"), fold, interval, buckets)


def _folded(stream: DataFrame, path: str, checkpoint: str, key: Column, fold: Callable[[DataFrame, DataFrame | None, int], DataFrame], interval: str | None, buckets: int):
    """Fold every batch with the rows stored in the buckets that it touches, and write these buckets anew."""
    spark = stream.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def step(batch: DataFrame, number: int) -> None:
        known = current(spark, path, number) if number else None
        if known is not None:
            touched = [r[0] for r in batch.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets``
            known = known.filter(F.col("bucket").isin(touched)).drop("bucket")
        rows = fold(batch, known, number).withColumn("bucket", bucket)
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch={number}")

    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    return (w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)).start()
