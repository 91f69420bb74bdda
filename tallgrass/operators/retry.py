"""The retry ledger as a fold of its actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ledger(actions: DataFrame, key: Sequence[str] = ("target_url",), *, seq: str = "seq", action: str = "action", max_attempts: int = 3, state: DataFrame | None = None) -> DataFrame:
    """Fold add, sync, fail and resolve into (key, attempts, status), from an earlier such state if there is one.

    The first add or sync inserts with no attempts; later adds and fails count one, and die at ``max_attempts``; a
    resolve resolves; a sync leaves the dead dead and makes all others pending. What comes before the insert is void.

    In closed form: attempts are the adds and fails after the insert; the last action that is no sync decides, and a
    sync after it turns all but death into pending. So the insert is one group by key, joined back so that the actions
    of a hot key can be split, and the fold another; both have partial aggregates. A stored row is an insert before all
    actions, with the attempts and the status that it has.
    """
    a = F.col(action)
    known = actions.filter(a.isin("add", "sync", "fail", "resolve"))
    if state is not None:
        known = known.select(*key, F.col(seq).cast("long").alias(seq), action, F.lit(0).cast("long").alias("_attempts"), F.lit(None).cast("string").alias("_status"))
        known = known.unionByName(state.select(*key, F.lit(-(1 << 62)).alias(seq), F.lit("stored").alias(action), F.col("attempts").alias("_attempts"), F.col("status").alias("_status")))
    first = known.filter(a.isin("add", "sync", "stored")).groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.min(seq).alias("_first"))
    after = known.join(first, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]).filter(F.col(seq) >= F.col("_first"))
    later = F.col(seq) > F.col("_first")
    counted = a.isin("add", "fail") & later
    kept = (F.sum("_attempts"), F.max("_status")) if state is not None else (F.lit(0), F.lit(None).cast("string"))
    folded = after.groupBy(*key).agg(
        (kept[0] + F.count_if(counted)).alias("attempts"),
        kept[1].alias("_before"),
        F.max_by(a, F.when((a != "sync") & later, F.col(seq))).alias("_last"),
        F.max(F.when((a != "sync") & later, F.col(seq))).alias("_last_seq"),
        F.max(F.when(a == "sync", F.col(seq))).alias("_sync_seq"),
    )
    dead = F.col("attempts") >= max_attempts
    base = F.when(F.col("_last").isNull(), F.coalesce("_before", F.lit("pending"))).when(F.col("_last") == "resolve", "resolved").when(dead, "dead").otherwise("pending")
    synced = F.col("_sync_seq").isNotNull() & (F.col("_sync_seq") > F.coalesce("_last_seq", F.lit(-(1 << 63))))
    status = F.when(synced & (base != "dead"), "pending").otherwise(base)
    return folded.select(*key, F.col("attempts").cast("long").alias("attempts"), status.alias("status"))


#: Columns of a whole ledger row besides its key, and of the actions that make it.
ROW = ["target_id", "attempts", "max_attempts", "status", "last_error", "extra_data"]


def ledger_rows(actions: DataFrame, state: DataFrame | None = None, key: Sequence[str] = ("item_type", "target_url"), *, max_attempts: int = 3) -> DataFrame:
    """Fold actions into whole ledger rows, from an earlier state if there is one: the key and the columns of ROW.

    Actions have the key, seq, action (add, sync, fail, resolve), target_id, max_attempts (null: the parameter), error
    and extra. Attempts and status as ``ledger`` says, with each row's own limit. The insert alone sets target_id and
    max_attempts; last_error is that of the last insert, add or fail, also null, or of a later sync that has one; extra_data
    that of the insert or the last add. A stored row counts as an insert before all actions, so folding batch by batch gives what
    folding all at once does. One group finds a key's insert and another folds, both with partial aggregates, so a key
    with very many actions costs a task one row of each other task. Rows with a null key are left out.
    """
    a, n = F.col("action"), F.col("seq")
    mine = actions.filter(a.isin("add", "sync", "fail", "resolve")).select(*key, F.col("seq").cast("long").alias("seq"), "action", F.col("target_id"), F.coalesce("max_attempts", F.lit(max_attempts)).cast("long").alias("max_attempts"), "error", "extra", F.lit(0).cast("long").alias("attempts"), F.lit(None).cast("string").alias("status"))
    if state is not None:
        stored = state.select(*key, F.lit(-(1 << 62)).alias("seq"), F.lit("stored").alias("action"), "target_id", "max_attempts", F.col("last_error").alias("error"), F.col("extra_data").alias("extra"), "attempts", "status")
        mine = mine.unionByName(stored)
    is_insert = a.isin("add", "sync", "stored")
    first = mine.filter(is_insert).groupBy(*key).agg(F.min("seq").alias("_first"))
    after = mine.join(first, list(key)).filter(n >= F.col("_first"))
    later, at_first = n > F.col("_first"), n == F.col("_first")
    decides = later & (a != "sync")
    speaks = at_first | a.isin("add", "fail") | ((a == "sync") & F.col("error").isNotNull())
    folded = after.groupBy(*key).agg(
        F.min_by("target_id", "seq").alias("target_id"), F.min_by("max_attempts", "seq").alias("max_attempts"),
        (F.min_by("attempts", "seq") + F.count_if(a.isin("add", "fail") & later)).alias("attempts"),
        F.max_by("error", F.when(speaks, n)).alias("last_error"), F.max_by("extra", F.when(at_first | (a == "add"), n)).alias("extra_data"),
        F.max_by(a, F.when(decides, n)).alias("_last"), F.max(F.when(decides, n)).alias("_last_seq"), F.max(F.when((a == "sync") & later, n)).alias("_sync_seq"), F.min_by("status", "seq").alias("_before"),
    )
    base = F.when(F.col("_last").isNull(), F.coalesce("_before", F.lit("pending"))).when(F.col("_last") == "resolve", "resolved").when(F.col("attempts") >= F.col("max_attempts"), "dead").otherwise("pending")
    synced = F.col("_sync_seq").isNotNull() & (F.col("_sync_seq") > F.coalesce("_last_seq", F.lit(-(1 << 63))))
    return folded.withColumn("status", F.when(synced & (base != "dead"), "pending").otherwise(base)).select(*key, *ROW)


# What a failed item says without a message of its own, and what a retry takes where the payload tells nothing.
MARKED_FAILED, DEFAULT_TITLE, DEFAULT_IMAGE = "Chapter marked failed", "Chương", "chapter_illustration"


def sync_actions(items: DataFrame, seq: int, *, url: str = "url", error: str = "error_message", payload: Sequence[str] = ("novel_id", "volume_id", "chapter_index", "title")) -> DataFrame:
    """Failed items as sync actions of the ledger, with what a retry needs as JSON."""
    failed = items.filter("status = 'failed'")
    return failed.select(
        F.lit("item").alias("item_type"), F.col(url).alias("target_url"), F.lit(seq).cast("long").alias("seq"), F.lit("sync").alias("action"), F.lit(None).cast("long").alias("target_id"), F.lit(3).cast("long").alias("max_attempts"),
        F.coalesce(error, F.lit(MARKED_FAILED)).alias("error"), F.to_json(F.struct(*payload)).alias("extra"),
    )


def payloads(ledger: DataFrame) -> DataFrame:
    """Entries that may be tried again with what each type needs: (item_type, target_url, target_id, item, image, work), one of the last three set.

    The payload is read once, as a variant, and routed by type in one pass over the ledger; a malformed one counts as empty.
    """
    extra = F.try_parse_json(F.coalesce("extra_data", F.lit("{}")))
    d = ledger.filter((F.col("status") == "pending") & (F.col("attempts") < F.col("max_attempts"))).withColumn("_v", extra)
    of = lambda path, kind: F.try_variant_get("_v", f"$.{path}", kind)
    item = F.struct(of("novel_id", "long").alias("work_id"), of("volume_id", "long").alias("section_id"), F.coalesce(of("chapter_index", "long"), F.lit(0)).cast("long").alias("item_index"), F.coalesce(of("title", "string"), F.lit(DEFAULT_TITLE)).alias("title"))
    image = F.struct(F.col("target_id").alias("image_id"), F.coalesce(of("image_type", "string"), F.lit(DEFAULT_IMAGE)).alias("image_type"))
    kind = F.col("item_type")
    return d.select("item_type", "target_url", "target_id", F.when(kind == "item", item).alias("item"), F.when(kind == "image", image).alias("image"), F.when(kind == "work", F.struct(F.col("target_url").alias("url"))).alias("work"))


def pending(state: DataFrame, key: Sequence[str] = ("target_url",), *, max_attempts: int = 3, limit: int | None = None) -> DataFrame:
    """Pending entries with attempts left, by their own limit if they have one, fewest attempts first; no limit unless positive."""
    most = F.col("max_attempts") if "max_attempts" in state.columns else F.lit(max_attempts)
    out = state.filter((F.col("status") == "pending") & (F.col("attempts") < most)).orderBy("attempts", *key)
    return out.limit(limit) if limit and limit > 0 else out


def sync_failed(items: DataFrame, key: Sequence[str], state: DataFrame) -> DataFrame:
    """Put failed items into the ledger: dead entries stay dead, others and new ones are pending; attempts stay."""
    failed = items.filter("status = 'failed'").select(*key).distinct()
    s = state.toDF(*[f"_{c}" for c in state.columns])
    cond = [failed[k] == s[f"_{k}"] for k in key]
    return failed.join(s, cond, "left").select(*key, F.coalesce("_attempts", F.lit(0)).cast("long").alias("attempts"), F.when(F.col("_status") == "dead", "dead").otherwise("pending").alias("status"))


def targets(state: DataFrame, works: DataFrame, items: DataFrame) -> DataFrame:
    """Pending entries joined to the table that their type names."""
    open_ = state.filter("status = 'pending'")
    w = open_.filter("item_type = 'work'").join(works, "target_id").select("item_type", "target_id", "title")
    i = open_.filter("item_type = 'item'").join(items, "target_id").select("item_type", "target_id", "title")
    return w.unionByName(i)


def backoff(attempts: DataFrame, key: Sequence[str], seq: str, *, base: float = 2.0) -> DataFrame:
    """The delay before each further try, base^k, and the wait so far."""
    w = Window.partitionBy(*key).orderBy(seq)
    k = F.row_number().over(w)
    out = attempts.withColumn("attempt", k.cast("long")).withColumn("delay", F.pow(F.lit(base), F.least(F.col("attempt"), F.lit(60))))
    return out.withColumn("waited", F.sum("delay").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
