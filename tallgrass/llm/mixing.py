"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, discard, stored, text_tag

#: Hex digits of the shuffle key that name a slice of a source for the running sums.
SLICE_DIGITS = 3


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, source: str, size: str, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """One row per source: ``source_size`` and its ``target`` in words.

    The sources, by code point with null last, get ``weights`` in turn and share the sum of all sizes in proportion.
    No target passes ``max_epochs`` times its source's size; what is cut off goes to the others by weight. That is
    min(max_epochs * size, weight * level) for the one level at which the targets add up to the sum, and the level
    follows from running sums over the sources in the order in which they reach their limits. The windows here run
    over one row per source, never over documents.
    """
    per = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    by_name = Window.orderBy(F.col(source).isNull(), F.col(source))
    choice = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("source_rank", F.row_number().over(by_name)).withColumn("weight", choice.cast("long"))
    per = per.withColumn("most", F.col("source_size") * max_epochs)
    filled = Window.orderBy((F.col("most") / F.col("weight")), "source_rank")
    everything = Window.partitionBy()
    per = per.withColumn("capped_before", F.coalesce(F.sum("most").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    per = per.withColumn("weight_left", F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)))
    per = per.withColumn("level_here", (F.sum("source_size").over(everything) - F.col("capped_before")) / F.col("weight_left"))
    per = per.withColumn("open", F.col("level_here") <= F.col("most") / F.col("weight"))
    level = F.min_by(F.when(F.col("open"), F.col("level_here")), F.when(F.col("open"), F.col("most") / F.col("weight"))).over(everything)
    per = per.withColumn("level", F.coalesce(level, F.lit(0.0)))
    target = F.when(F.col("most") / F.col("weight") <= F.col("level"), F.col("most").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return per.select(source, "source_rank", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    max_epochs: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """Choose how often each document enters a mixture whose sources come near their target weights.

    Every source is shuffled by the md5 of seed and id, then size and text, and may be read up to ``max_epochs`` times. A copy of a
    document finishes at the virtual time (words of its source up to and with it) / (target of the source). All copies
    are range-sorted by that time and taken until the next would pass the total budget, the number of words of all
    documents. A source's running sum is made of sums per slice of the shuffled order, so no task holds a whole source;
    the global running sum is made of sums per range partition.

    Returns doc_id, _t (tag of the text), size, source_size, target, copies and taken (copies * size). A null text has size 0; a null source is a source of its own, the last; null ids and repeated rows are
    documents like others (equal rows are interchangeable); an empty table gives no rows; empty documents are never
    taken. Other columns are not read.
    """
    sized = docs.select(
        F.col(doc_id).alias("doc_id"),
        text_tag(text).alias("_t"),
        F.col(source).alias("_source"),
        n_words(text).alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))).alias("_h"),
    )
    sized = stored(sized, "mix-sizes")
    # rows without an id share one key, so they have slices of their own, one for each size, in their place in the order
    none = F.md5(F.lit(seed))
    side = F.when(F.col("_h") < none, "0").when(F.col("doc_id").isNull(), F.concat(F.lit("1"), F.lpad(F.col("size").cast("string"), 18, "0"))).otherwise("2")
    slice_ = F.concat(F.substring("_h", 1, SLICE_DIGITS), side)
    targets = source_targets(sized, "_source", "size", weights, max_epochs)
    slices = sized.groupBy("_source", slice_.alias("_slice")).agg(F.sum("size").alias("_n"))
    ahead = Window.partitionBy("_source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    placed = sized.withColumn("_slice", slice_).withColumn(
        "_within", F.sum("size").over(Window.partitionBy("_source", "_slice").orderBy("_h", F.col("doc_id").asc_nulls_last(), "size", "_t").rowsBetween(Window.unboundedPreceding, 0))
    )
    placed = _null_join(_null_join(placed, slices, ["_source", "_slice"]), targets, ["_source"])
    placed = placed.withColumn("_at", F.col("_before") + F.col("_within")).select("doc_id", "_t", "size", "source_size", "target", "source_rank", "_at")
    placed = stored(placed, "mix-placed")
    discard(sized)

    def finish(epoch: Column) -> Column:
        return (epoch * F.col("source_size") + F.col("_at")) / F.col("target")

    copies = placed.filter("size > 0").select(F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("_e"), "*")
    copies = copies.select(finish(F.col("_e")).alias("_time"), "source_rank", "_at", "_e", "size")
    cut = first_beyond(copies, ["_time", "source_rank", "_at"], "size", placed.agg(F.sum("size")).first()[0] or 0)
    taken = F.lit(0)
    for e in range(max_epochs):
        key = F.struct(finish(F.lit(e)).alias("a"), F.col("source_rank").alias("b"), F.col("_at").alias("c"))
        inside = F.lit(True) if cut is None else key < F.struct(F.lit(cut[0]).alias("a"), F.lit(cut[1]).alias("b"), F.lit(cut[2]).alias("c"))
        taken = taken + F.when((F.col("size") > 0) & inside, 1).otherwise(0)
    return placed.select("doc_id", "_t", "size", "source_size", "target", taken.cast("long").alias("copies"), (taken * F.col("size")).cast("long").alias("taken"))


def first_beyond(df: DataFrame, keys: list[str], size: str, budget: int):
    """Keys of the first row, in their order, whose running sum of ``size`` passes ``budget``; None if there is none.

    Rows are range-sorted into partitions and written; the sums of the partitions, one row each, tell in which
    partition the budget ends, and only that one gets a running sum by row.
    """
    spark = df.sparkSession
    ranged = df.select(*keys, size).repartitionByRange(max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)
    ranged = stored(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    parts = ranged.groupBy("_part").agg(F.sum(size).alias("_n")).withColumn("_sum", F.sum("_n").over(Window.orderBy("_part")))
    last = parts.filter(F.col("_sum") > budget).orderBy("_part").first()
    if last is None:
        discard(ranged)
        return None
    run = F.sum(size).over(Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0))
    inside = ranged.filter(F.col("_part") == last["_part"]).withColumn("_run", run + F.lit(int(last["_sum"] - last["_n"])))
    found = inside.filter(F.col("_run") > budget).orderBy(*keys).select(*keys).first()
    discard(ranged)
    return found


def _null_join(a: DataFrame, b: DataFrame, names: list[str]) -> DataFrame:
    b = b.withColumnsRenamed({n: f"{n}_r" for n in names})
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).eqNullSafe(F.col(f"{n}_r"))
    return a.join(b, cond).drop(*[f"{n}_r" for n in names])


#: The same rows by window functions over whole tables.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS source_rank FROM sized GROUP BY source),
weighed AS (
  SELECT *, 3 * source_size AS most, CASE (source_rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM named),
filled AS (
  SELECT *, (CAST((SELECT sum(source_size) FROM named) AS BIGINT) - CAST(coalesce(sum(most) OVER (ORDER BY most / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
         / CAST(sum(weight) OVER (ORDER BY most / weight, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level_here FROM weighed),
leveled AS (
  SELECT *, coalesce((SELECT arg_min(level_here, most / weight) FROM filled WHERE level_here <= most / weight), 0.0) AS level FROM filled),
targets AS (
  SELECT source, source_rank, source_size, CASE WHEN most / weight <= level THEN CAST(most AS DOUBLE) ELSE weight * level END AS target FROM leveled),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.source_rank,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id NULLS LAST, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS pos
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT p.*, e.e, (e.e * source_size + pos) / target AS t FROM placed p JOIN (SELECT unnest([0, 1, 2]) AS e) e ON p.size > 0),
run AS (
  SELECT *, sum(size) OVER (ORDER BY t, source_rank, pos ROWS UNBOUNDED PRECEDING) AS total FROM copies),
kept AS (
  SELECT doc_id, pos, source_rank, sum(CASE WHEN total <= (SELECT sum(size) FROM sized) THEN size ELSE 0 END) AS taken FROM run GROUP BY doc_id, pos, source_rank)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(CASE WHEN p.size > 0 THEN coalesce(k.taken, 0) / p.size ELSE 0 END AS BIGINT) AS copies, CAST(CASE WHEN p.size > 0 THEN coalesce(k.taken, 0) ELSE 0 END AS BIGINT) AS taken
FROM placed p LEFT JOIN kept k ON p.size > 0 AND k.doc_id IS NOT DISTINCT FROM p.doc_id AND k.pos = p.pos AND k.source_rank = p.source_rank
"""
