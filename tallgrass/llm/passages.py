"""Substring deduplication by words: repeated passages go wherever in a line they begin and end."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchors import anchors
from .common import discard, stored
from .filters import has_key, key_filter
from .textops import flat, ints, mix, pieces, powers, span_hash, word_hashes

#: Words of the gram that anchors a window; bytes of text looked at together.
GRAM = 16
CHUNK = 1 << 18


def _found(batch: pa.RecordBatch, window: int):
    """Anchors of a batch by word positions, with the hash of the words that their windows cover."""
    h, before = word_hashes(*flat(batch["_text"]))
    prefix = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(len(h))[0], out=prefix[1:])
    row, at, low, high, gram = anchors(h, before, window, min(GRAM, window), prefix)
    around = mix(span_hash(prefix, low, high + window) + ((at - low) << 16 | (high - low)).astype(np.uint64))
    return before, prefix, row, low, high, gram, around


def edge_key(around: np.ndarray, tag: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix(around + mix(tag + low.astype(np.uint64)))


def _ids(batch: pa.RecordBatch, row: np.ndarray) -> list[pa.Array]:
    return [batch["_id"].take(pa.array(row)), batch["_t"].take(pa.array(row))]


def _places(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in pieces(batches, "_text", CHUNK):
                before, _, row, low, high, gram, around = _found(batch, window)
                yield pa.RecordBatch.from_arrays([ints(gram), ints(around), *_ids(batch, row), ints(low - before[row]), ints(high - low)], ["gram", "words", "_id", "_t", "low", "more"])

    return run


def _edge_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            around, tag, low = (batch[c].to_numpy().astype(np.int64) for c in ("words", "_t", "low"))
            yield pa.RecordBatch.from_arrays([ints(edge_key(around.view(np.uint64), tag.view(np.uint64), low))], ["key"])


def _windows(window: int, edges):
    """The single windows of the anchors in the filter; others that it lets through are windows of the corpus too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in pieces(batches, "_text", CHUNK):
                before, prefix, row, low, high, gram, around = _found(batch, window)
                tag = batch["_t"].to_numpy().astype(np.int64).view(np.uint64)[row]
                on = has_key(edges.value, edge_key(around, tag, low - before[row]))
                row, low, high, gram = row[on], low[on], high[on], gram[on]
                each = high - low + 1
                of = np.repeat(np.arange(len(each)), each)
                start = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
                yield pa.RecordBatch.from_arrays([ints(gram[of]), ints(span_hash(prefix, start, start + window)), *_ids(batch, row[of]), ints(start - before[row[of]]), ints(np.zeros(len(of), np.int64))], ["gram", "words", "_id", "_t", "low", "more"])

    return run


def _firsts(places: DataFrame) -> DataFrame:
    """(gram, words, f_id, f_t, f_low, f_more, c): the first place of equal words, and how many there are."""
    rank = F.struct(F.col("_id").isNull().alias("n"), "_id", "_t", "low", "more")
    firsts = places.groupBy("gram", "words").agg(F.min(rank).alias("first"), F.count("*").alias("c"))
    return firsts.select("gram", "words", *[F.col(f"first.{c}").alias(f"f_{c.lstrip('_')}") for c in ("_id", "_t", "low", "more")], "c")


def _later(places: DataFrame, firsts: DataFrame, window: int) -> DataFrame:
    """(_id, _t, start, end): words of places that are not the first, less those of the first copy that overlaps them."""
    mine: Column = F.col("_id").eqNullSafe(F.col("f_id")) & (F.col("_t") == F.col("f_t"))
    start = F.when(mine, F.greatest("low", F.col("f_low") + window)).otherwise(F.col("low"))
    joined = places.join(firsts.filter("c > 1"), ["gram", "words"]).filter(~(mine & (F.col("low") == F.col("f_low"))))
    return joined.select("_id", "_t", start.alias("start"), (F.col("low") + F.col("more") + window).alias("end"))


def repeated_passages(rows: DataFrame, window: int) -> DataFrame:
    """(_id, _t, _spans): for texts that repeat passages of earlier ones, all runs of words that do.

    ``rows`` are _id, _t and _text. Every window of ``window`` words picks an anchor by its content, so equal windows
    pick equal grams. Where all the words around an anchor stood before, they go as one span; what remains are the
    edges of repeats, compared window by window. Both are groups by 128 bits of hash with partial aggregates.
    """
    spark = rows.sparkSession
    ddl = "gram long, words long, _id long, _t long, low long, more long"
    all_places = stored(rows.mapInArrow(_places(window), ddl), "passage-anchors")
    grams = stored(all_places.groupBy("gram").count().filter("count > 1").select("gram"), "passage-grams")
    places = stored(all_places.join(grams, "gram"), "passage-places")
    discard(all_places, grams)
    firsts = stored(_firsts(places), "passage-firsts")
    kinds = stored(firsts.groupBy("gram").count().filter("count > 1").select("gram"), "passage-kinds")
    edge = firsts.join(kinds, "gram").select("words", F.col("f_t").alias("_t"), F.col("f_low").alias("low"))
    edge_keys = stored(edge.mapInArrow(_edge_keys, "key long"), "edge-keys")
    edges = spark.sparkContext.broadcast(key_filter(edge_keys))
    discard(kinds, edge_keys)
    windows = stored(rows.mapInArrow(_windows(window, edges), ddl), "passage-windows")
    edges.destroy()  # the windows are a table now
    spans = _later(places, firsts, window).union(_later(windows, stored(_firsts(windows).filter("c > 1"), "first-windows"), window))
    return spans.groupBy("_id", "_t").agg(F.collect_set(F.struct("start", "end")).alias("_spans"))
