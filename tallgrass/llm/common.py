"""What the operators of this subpackage share: stored intermediate tables, row keys, Arrow helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space as every operator here sees it: space and tab to carriage return.
WS_CLASS = r"\x20\x09-\x0D"
WORD = rf"[^{WS_CLASS}]+"

#: Rows up to which Spark may broadcast a side of a join by the size of its files.
BROADCAST_ROWS = 1 << 16

_own_dir: str | None = None
#: Paths made in the open ``scratch`` blocks, the innermost block last.
_scratch: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or where that is unset, one under the warehouse.

    A session with all its threads on one machine, as in tests, takes a folder of its own instead of the warehouse.
    """
    global _own_dir
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return f"{spark.conf.get('spark.sql.warehouse.dir')}/tallgrass-scratch"
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="spark-tallgrass-")
    return _own_dir


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Own the tables that operators store within the block: all of them are deleted at its end.

    Operators delete what their result does not read. What it reads has to stay until the result was used, which only
    the caller knows: ``with scratch(spark): operator(docs).write.parquet(path)``. Blocks nest; a table belongs to the
    innermost block that was open when its path was made. Results made within must not be used after the block.
    """
    mine: list[str] = []
    _scratch.append(mine)
    try:
        yield
    finally:
        _scratch.remove(mine)
        _delete(spark, *mine)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the lineage and survives lost executors.

    A ``path`` made before by ``new_path`` gives the table to the ``scratch`` block that was open then.
    """
    path = path or new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def unbroadcast(df: DataFrame, n: int) -> DataFrame:
    """A side of a join, not to be broadcast if it may have as many as ``n`` rows and those are many.

    Spark judges by the size of compressed files; in the driver, which builds what is broadcast, short rows take several
    times that (577,104 rows of two numbers, under 10 MB as files, took 67 MB).
    """
    return df.hint("merge") if n > BROADCAST_ROWS else df


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no result reads any more."""
    for t in tables:
        _delete(t.sparkSession, t._stored_at)


def _delete(spark: SparkSession, *paths: str) -> None:
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(path, True)


def text_tag(text: str | Column) -> Column:
    """Tells rows with the same id and different texts apart; equal rows share it."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns."""
    cond = a[names[0]].eqNullSafe(b[names[0]])
    for n in names[1:]:
        cond = cond & a[n].eqNullSafe(b[n])
    return cond


def held(doc_id: str, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder`` modulo 5 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == remainder, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_copies(docs: DataFrame, counts: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Repeat every row of ``docs`` as often as ``counts`` (_id, _t, n) says; rows without a count go.

    Rows with one id and text share their count: in order of the hashes of whole rows, the first of them get one copy
    more if it does not come out even. All columns stay as they are. Rows that are equal in all columns are counted
    with partial sums and reduced to one that carries the copies of all, so no task holds the repeats of a row; a
    window holds the different rows of one id and text, as counts. Texts move by key in a join whose hot keys can be split.
    """
    names = docs.columns
    key = F.xxhash64(docs[doc_id].cast("long"), text_tag(docs[text]))
    d = docs.select(F.struct(*[docs[n] for n in names]).alias("_row"), docs[doc_id].cast("long").alias("_d"), key.alias("_k"), F.xxhash64(*[docs[n] for n in names]).alias("_h"))
    kinds = d.groupBy("_k", "_d", "_h").agg(F.count("*").alias("_m"))
    mine = Window.partitionBy("_k", "_d")
    before = F.coalesce(F.sum("_m").over(mine.orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kinds = kinds.withColumn("_before", before).withColumn("_all", F.sum("_m").over(mine))
    c = counts.groupBy("_id", "_t").agg(F.sum("n").alias("_n")).withColumn("_c", F.xxhash64("_id", "_t"))
    kinds = kinds.join(c, (kinds["_k"] == c["_c"]) & kinds["_d"].eqNullSafe(c["_id"]))
    times = F.col("_m") * F.floor(F.col("_n") / F.col("_all")) + F.greatest(F.lit(0), F.least(F.col("_m"), F.col("_n") % F.col("_all") - F.col("_before")))
    kinds = kinds.select(F.col("_k").alias("_k2"), F.col("_d").alias("_d2"), F.col("_h").alias("_h2"), "_m", times.cast("int").alias("_times")).filter("_times > 0")
    j = d.join(kinds, (d["_k"] == kinds["_k2"]) & (d["_h"] == kinds["_h2"]) & d["_d"].eqNullSafe(kinds["_d2"])).select("_row", "_k", "_d", "_h", "_m", "_times")
    out = j.filter("_m = 1").union(j.filter("_m > 1").dropDuplicates(["_k", "_d", "_h"]))
    return out.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("_times"))).alias("_one")).select("_row.*")
