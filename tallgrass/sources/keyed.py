"""Tables in buckets by key, sorted within, which merges, joins and look-ups meet without moving what is stored."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import fold_merge


def write_keyed(df: DataFrame, name: str, key: str, *, buckets: int = 64, path: str | None = None, placed: bool = False) -> str:
    """Store rows as a new table of the catalogue, a file a bucket, and return its name: ``name`` and a number of its own.

    A table is never written twice, so readers of an older version stay with it. Rows whose tasks hold whole buckets
    already (``placed``) are written where they are.
    """
    version = f"{name}_{uuid.uuid4().hex}"
    w = (df if placed else df.repartition(buckets, key)).write.bucketBy(buckets, key).sortBy(key)
    (w.option("path", f"{path.rstrip('/')}/{version}") if path else w).saveAsTable(version)
    return version


def _after(stored: Column, new: Column, rule: str, is_new: Column, is_stored: Column) -> Column:
    """A column after a batch, from its stored value and the batch's own fold."""
    if rule == "overwrite":
        return F.when(is_new, new).otherwise(stored)
    if rule == "keep_if_empty":
        return F.coalesce(F.nullif(new, F.lit("")), stored, F.lit(""))
    if rule == "keep_if_null":
        return F.coalesce(new, stored)
    return F.when(is_stored, stored).otherwise(new)


def merged(spark: SparkSession, table: str, batch: DataFrame, key: str, seq: str, rules: Mapping[str, str]) -> DataFrame:
    """The rows of a keyed table after a batch of writes: those of ``merge.fold_merge`` over the stored rows and the batch.

    Only the batch is shuffled, folded by key and dealt out like the buckets; each bucket then meets its part of it.
    """
    new = fold_merge(batch, [key], seq, rules).select(F.col(key).alias("_key"), F.lit(True).alias("_new"), *[F.col(c).alias(f"_{c}") for c in rules])
    stored = spark.table(table).select(key, F.lit(True).alias("_stored"), *rules)
    j = stored.join(new, stored[key] == new["_key"], "full_outer")
    return j.select(F.coalesce(key, "_key").alias(key), *[_after(F.col(c), F.col(f"_{c}"), r, F.col("_new").isNotNull(), F.col("_stored").isNotNull()).alias(c) for c, r in rules.items()])


def merge_into(spark: SparkSession, table: str, batch: DataFrame, key: str, seq: str, rules: Mapping[str, str], *, name: str, buckets: int = 64, path: str | None = None) -> str:
    """Write the table after a batch as a new version, bucket by bucket, and return its name. Null keys are not merged with each other."""
    return write_keyed(merged(spark, table, batch, key, seq, rules), name, key, buckets=buckets, path=path, placed=True)


def look_up(spark: SparkSession, table: str, keys: DataFrame | Sequence, key: str) -> DataFrame:
    """Stored rows of some keys. Of a list of keys, only the files of their buckets are read; a table of keys is dealt out like the buckets, or sent to them if Spark knows it to be small."""
    stored = spark.table(table)
    if isinstance(keys, DataFrame):
        return stored.join(keys.select(key), key, "left_semi")
    return stored.filter(F.col(key).isin(list(keys)))
