"""Field-wise merge of repeated writes: one group per key, one rule per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overwrite(c: str, seq: str) -> Column:
    """The last write, also when it is null."""
    return F.max_by(c, seq)


def keep_if_empty(c: str, seq: str) -> Column:
    """The last write that is neither null nor ''; '' if there is none."""
    full = F.nullif(F.col(c), F.lit("")).isNotNull()
    return F.coalesce(F.max_by(c, F.when(full, F.col(seq))), F.lit(""))


def keep_if_null(c: str, seq: str) -> Column:
    """The last write that is not null."""
    return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq)))


def insert_only(c: str, seq: str) -> Column:
    """The first write."""
    return F.min_by(c, seq)


RULES = {"overwrite": overwrite, "keep_if_empty": keep_if_empty, "keep_if_null": keep_if_null, "insert_only": insert_only}


def fold_merge(history: DataFrame, key: Sequence[str], seq: str, rules: Mapping[str, str]) -> DataFrame:
    """Fold all writes of a key, in the order of ``seq``, into one row; the rules name what a later write may change.

    Equal to applying the writes one by one. Existing rows join the history with the smallest ``seq``. One shuffle by
    key with partial aggregates, so a key with very many writes costs a task one row of each other task.
    """
    return history.groupBy(*key).agg(*[RULES[r](c, seq).alias(c) for c, r in rules.items()])


def with_existing(existing: DataFrame, batch: DataFrame, seq: str) -> DataFrame:
    """A history of the stored rows, before everything, and a batch."""
    return existing.withColumn(seq, F.lit(-1).cast("long")).unionByName(batch, allowMissingColumns=True)


WORK_RULES = {
    **dict.fromkeys(["slug", "title", "status", "novel_type", "genres", "total_words", "views", "likes", "bookmarks", "rating", "rating_count", "site_last_updated", "crawl_status", "error_message"], "overwrite"),
    **dict.fromkeys(["alternative_titles", "author", "artist", "cover_url", "summary"], "keep_if_empty"),
    "cover_local_path": "keep_if_null",
    "created_at": "insert_only",
}


def merge_works(history: DataFrame, seq: str = "seq", rules: Mapping[str, str] = WORK_RULES, key: Sequence[str] = ("url",)) -> DataFrame:
    """Works by URL; only columns that the history has are merged."""
    return fold_merge(history, key, seq, {c: r for c, r in rules.items() if c in history.columns})


def merge_sections(history: DataFrame, seq: str = "seq", key: Sequence[str] = ("work_id", "title"), index: str = "vol_index", url: str = "url_id") -> DataFrame:
    return fold_merge(history, key, seq, {index: "overwrite", url: "keep_if_null"})


def merge_items(history: DataFrame, key: Sequence[str], seq: str = "seq", *, section: str = "section_id", date: str = "publish_date", overwritten: Sequence[str] = ("status",), body: str | None = None, preserve_body_on_failure: bool = False) -> DataFrame:
    """Items by URL. A failed write carries an empty body, which overwrites, unless bodies are to be preserved."""
    rules = {**dict.fromkeys(overwritten, "overwrite"), date: "keep_if_empty", section: "keep_if_null"}
    if body:
        rules[body] = "keep_if_empty" if preserve_body_on_failure else "overwrite"
    return fold_merge(history, key, seq, rules)


def register_assets(history: DataFrame, seq: str = "seq") -> DataFrame:
    """New assets are pending; later writes may fill in work and item and change the type only."""
    merged = fold_merge(history, ["asset_key"], seq, {"work_id": "keep_if_null", "item_id": "keep_if_null", "asset_type": "overwrite"})
    return merged.withColumn("status", F.lit("pending"))


def mark_assets(assets: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Apply one outcome per asset (ok, path, size, error): success sets path and size and clears the error."""
    o = outcomes.toDF("_key", "_ok", "_path", "_size", "_error")
    j = assets.join(o, assets["asset_key"] == o["_key"], "left")
    done = F.coalesce(F.col("_ok"), F.lit(False))
    failed = F.col("_key").isNotNull() & ~done
    return j.select(
        "asset_key",
        F.when(done, "downloaded").when(failed, "failed").otherwise(F.col("status")).alias("status"),
        F.when(done, F.col("_path")).alias("local_path"),
        F.when(done, F.col("_size")).alias("file_size"),
        F.when(failed, F.col("_error")).alias("error_message"),
    )


def update_status(works: DataFrame, changes: DataFrame, key: str, status: str = "status", error: str = "error_message", filled: Sequence[str] = ()) -> DataFrame:
    """New status by key; the message stays unless a new one is given, and so do the columns ``filled``, as a cover's path."""
    kept = [error, *filled]
    c = changes.select(F.col(key).alias("_key"), F.col(status).alias("_status"), *[F.col(x).alias(f"_new_{x}") for x in kept])
    j = works.join(c, works[key] == c["_key"], "left")
    return j.withColumns({status: F.coalesce("_status", status), **{x: F.coalesce(f"_new_{x}", x) for x in kept}}).drop(*c.columns)


def close_runs(opened: DataFrame, closed: DataFrame, key: str = "run_id", seq: str = "seq") -> DataFrame:
    """Runs with all that the last close of each tells; a close without its run does nothing.

    A run without a close is running, with 0 items, and null for whatever else closes tell, as when it ended or its details.
    """
    told = [c for c in closed.columns if c not in (key, seq)]
    last = closed.groupBy(F.col(key).alias("_key")).agg(*[F.max_by(c, seq).alias(f"_{c}") for c in told])
    unknown = {"status": F.lit("running"), "items": F.lit(0)}
    value = lambda c: F.coalesce(f"_{c}", unknown[c]) if c in unknown else F.col(f"_{c}")
    j = opened.join(last, opened[key] == last["_key"], "left")
    return j.select(*opened.columns, *[(value(c).cast("long") if c == "items" else value(c)).alias(c) for c in told])


def run_seconds(began: Column, ended: Column) -> Column:
    """How long a run took, to the microsecond; null while it runs."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return (micros(ended) - micros(began)) / 1e6


def failed_work_stubs(failures: DataFrame, works: DataFrame, key: str) -> DataFrame:
    """For failed fetches: known works get an error status, unknown ones a stub; every row is also a ledger action."""
    known = works.select(F.col(key).alias("_key"), F.col("title").alias("_title"))
    j = failures.join(known, failures[key] == known["_key"], "left")
    return j.select(key, F.when(F.col("_key").isNotNull(), "update").otherwise("stub").alias("change"), F.coalesce("_title", F.concat(F.lit("work-"), F.col(key).cast("string"))).alias("title"), F.lit("error").alias("status"), F.col("error_message"), F.lit("add").alias("ledger_action"))
