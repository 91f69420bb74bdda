"""Exact substring deduplication with a logarithmic family of suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import GRAM, anchors
from .common import discard, same, stored, text_tag
from .filters import has_twice, twice_filter
from .textops import flat, ints, pieces, prefix_hash, span_hash, spans_hash

#: Bytes of text that a task looks at together, and suffixes in a new array of the index.
CHUNK = 1 << 17
BATCH = 30_000
#: Windows of whole grams that are compared together.
SHARE = 1 << 18
#: Surroundings of one gram up to which one task takes them all; those of other grams are dealt out by window.
MANY = 1024
#: Bytes of surroundings for each task of the index.
TASK_BYTES = 1 << 26
_SPANS = "_id long, _t long, start long, end long"
_CONTENTS = "gram long, _id long, _t long, low long, end long, bytes binary"


class SuffixFamily:
    """Sorted arrays of suffixes, cut or padded to one width; the larger arrays are merged from smaller of equal rank."""

    def __init__(self):
        self.levels: list[np.ndarray | None] = []

    def add(self, suffixes: np.ndarray) -> np.ndarray:
        """Sort a batch into an array of its own, scan it against the levels, and tell which suffixes came before.

        Suffixes that are new become level 0; whenever a level is taken, both arrays merge into the next.
        """
        order = np.argsort(suffixes, kind="stable")
        keys = suffixes[order]
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        fresh = keys[first]
        found = np.zeros(len(fresh), bool)
        for level in self.levels:
            if level is not None:
                at = np.minimum(np.searchsorted(level, fresh), len(level) - 1)
                found |= level[at] == fresh
        seen = ~first
        seen[np.flatnonzero(first)] = found
        out = np.zeros(len(suffixes), bool)
        out[order] = seen
        self._push(fresh[~found])
        return out

    def _push(self, array: np.ndarray) -> None:
        rank = 0
        while len(array):
            rank = max(rank, max(0, (len(array) // BATCH).bit_length() - 1))
            while len(self.levels) <= rank:
                self.levels.append(None)
            if self.levels[rank] is None:
                self.levels[rank] = array
                return
            other, self.levels[rank] = self.levels[rank], None
            array = np.insert(other, np.searchsorted(other, array), array)
            rank += 1


def _grams(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in pieces(batches, "_text", CHUNK):
                gram = ints(anchors(*flat(batch["_text"]), window)[4])
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(gram)], pa.int32()), gram)], ["grams"])

    return run


def _ids(batch: pa.RecordBatch, row: np.ndarray) -> list[pa.Array]:
    return [batch["_id"].take(pa.array(row)), batch["_t"].take(pa.array(row))]


def _suffixes(data: np.ndarray, start: np.ndarray, end: np.ndarray, window: int) -> np.ndarray:
    """data[start:end] each as a string of one width: its length over the window, its bytes, zeros."""
    wide = 2 * window - GRAM
    out = np.zeros((len(start), wide + 2), np.uint8)
    extra = end - start - window
    out[:, 0], out[:, 1] = extra >> 8, extra & 255
    padded = np.concatenate([data, np.zeros(wide, np.uint8)])
    np.multiply(np.lib.stride_tricks.sliding_window_view(padded, wide)[start], np.arange(wide) < (end - start)[:, None], out=out[:, 2:])
    return out.view(f"S{wide + 2}").ravel()


def _repeats_last(data: np.ndarray, row: np.ndarray, low: np.ndarray, high: np.ndarray, window: int) -> np.ndarray:
    """Whether an anchor's surroundings are those of the anchor before it in the text, as in periodic texts."""
    ahead = np.arange(0, window, 7)
    same = np.zeros(len(row), bool)
    same[1:] = (row[1:] == row[:-1]) & (high[1:] - low[1:] == high[:-1] - low[:-1])
    for a in range(0, len(row), BATCH):  # by some bytes first, then by all
        on = np.flatnonzero(same[a : a + BATCH]) + a
        on = on[(data[low[on, None] + ahead] == data[low[on - 1, None] + ahead]).all(1)]
        equal = _suffixes(data, low[on], high[on] + window, window) == _suffixes(data, low[on - 1], high[on - 1] + window, window)
        same[a : a + BATCH] = False
        same[on[equal]] = True
    return same


def _contents(window: int, repeated):
    """Surroundings of the anchors whose grams are in the filter that this task, in order of the documents, sees first; the others as spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = SuffixFamily()
        last = None
        with np.errstate(over="ignore"):
            for batch in pieces(batches, "_text", CHUNK):
                keys = list(zip(batch["_id"].to_pylist(), batch["_t"].to_pylist(), strict=True))
                again = np.array([k == m for k, m in zip(keys, [last, *keys[:-1]], strict=True)])  # a repeated row is one document
                last = keys[-1]
                batch = batch.filter(pa.array(~again))
                data, off = flat(batch["_text"])
                row, _, low, high, gram = anchors(data, off, window)
                on = has_twice(repeated.value, gram)
                row, low, high, gram = row[on], low[on], high[on], gram[on]
                seen = _repeats_last(data, row, low, high, window)
                ask = np.flatnonzero(~seen)
                for a in range(0, len(ask), BATCH):
                    some = ask[a : a + BATCH]
                    seen[some] = family.add(_suffixes(data, low[some], high[some] + window, window))
                spans = _merged_rows(row[seen], low[seen] - off[row[seen]], high[seen] - off[row[seen]] + window)
                none = len(spans[0])
                yield pa.RecordBatch.from_arrays([pa.nulls(none, pa.int64()), *_ids(batch, spans[0]), ints(spans[1]), ints(spans[2]), pa.nulls(none, pa.binary())], ["gram", "_id", "_t", "low", "end", "bytes"])
                row, low, high, gram = row[~seen], low[~seen], high[~seen], gram[~seen]
                raw = data.tobytes()
                texts = pa.array([raw[a : b + window] for a, b in zip(low.tolist(), high.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([ints(gram), *_ids(batch, row), ints(low - off[row]), pa.nulls(len(row), pa.int64()), texts], ["gram", "_id", "_t", "low", "end", "bytes"])

    return run


def _window_places(off: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and place in the flat bytes of every window of rows of contents."""
    each = np.diff(off) - window + 1
    row = np.repeat(np.arange(len(each)), each)
    return row, np.arange(len(row)) + np.repeat(off[:-1] - np.cumsum(each) + each, each)


def _windows(batch: pa.RecordBatch, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of a batch of contents: as fixed-length bytes, their row, and their start in the row's document."""
    data, off = flat(batch["bytes"])
    row, at = _window_places(off, window)
    view = np.lib.stride_tricks.sliding_window_view(data, window)[at]
    return np.ascontiguousarray(view).view(f"S{window}").ravel(), row, at - off[:-1][row] + batch["low"].to_numpy()[row]


def _runs(batch: pa.RecordBatch, row: np.ndarray, start: np.ndarray, window: int) -> pa.RecordBatch:
    """Intervals of bytes that the given windows cover, a row for each run of neighbouring starts."""
    if not len(row):
        row = start = np.zeros(0, np.int64)
        first = last = row
    else:
        cut = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)])
        first = np.flatnonzero(cut)
        last = np.concatenate([first[1:], [len(row)]]) - 1
    return pa.RecordBatch.from_arrays([*_ids(batch, row[first]), ints(start[first]), ints(start[last] + window)], ["_id", "_t", "start", "end"])


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted batches without rows of the same place as the row before: what repeated rows of a document send twice."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        places = np.stack([np.asarray(x, np.int64) for c in ("_id", "_t", "low") for x in (batch[c].fill_null(0), batch[c].is_null())], axis=1)
        new = np.concatenate([[last is None or (places[0] != last).any()], (places[1:] != places[:-1]).any(axis=1)])
        last = places[-1]
        yield batch if new.all() else batch.filter(pa.array(new))


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Batches of some BATCH windows each."""
    for whole in batches:
        held = np.cumsum(pc.binary_length(whole["bytes"]).to_numpy(zero_copy_only=False).astype(np.int64) - window + 1)
        cuts = np.unique(np.searchsorted(held, np.arange(BATCH, int(held[-1]) if len(held) else 0, BATCH), side="right"))
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), whole.num_rows], strict=True):
            if b > a:
                yield whole.slice(a, b - a)


def _by_gram(table: pa.Table, window: int) -> Iterator[pa.RecordBatch]:
    """The contents of grams that have several, in batches of whole grams and some SHARE windows, each gram in order of the rows."""
    gram = table["gram"].to_numpy()
    order = np.argsort(gram, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], gram[order][1:] != gram[order][:-1]])[: len(gram)])
    n = np.diff(np.append(first, len(gram)))
    several = table.take(pa.array(order[np.repeat(n > 1, n)])).combine_chunks()
    if not several.num_rows:
        return
    ends = np.cumsum(n[n > 1])
    held = np.cumsum(pc.binary_length(several["bytes"]).to_numpy().astype(np.int64) - window + 1)[ends - 1]
    cuts = ends[np.flatnonzero(np.diff(held // SHARE))].tolist()
    batch = several.to_batches()[0]
    for a, b in zip([0, *cuts], [*cuts, several.num_rows], strict=True):
        yield batch.slice(a, b - a)


def _met_twice(keys: np.ndarray) -> np.ndarray:
    """Places of the keys that stand there twice or more."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    on = np.zeros(len(keys), bool)
    on[order[1:][same]] = on[order[:-1][same]] = True
    return np.flatnonzero(on)


def _scan(window: int):
    """Spans of the windows that came before, of all surroundings of some grams in order of the documents.

    Surroundings as wholes go through one family. Of those that came first, grams that have several are cut into
    windows, which go through others, again in order: equal windows have one gram, so a family holds some grams only,
    and of their windows those whose hash comes twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = SuffixFamily()
        first: list[pa.RecordBatch] = []  # bounded by TASK_BYTES
        for some in _once(batches):
            for a in range(0, some.num_rows, BATCH):
                batch = some.slice(a, BATCH)
                data, off = flat(batch["bytes"])
                seen = whole.add(_suffixes(data, off[:-1], off[1:], window))
                on = np.flatnonzero(seen)
                low = batch["low"].to_numpy()[on]
                yield pa.RecordBatch.from_arrays([*_ids(batch, on), pa.array(low), pa.array(low + np.diff(off)[on])], ["_id", "_t", "start", "end"])
                first.append(batch.filter(pa.array(~seen)))
        if not first:
            return
        del whole
        for batch in _by_gram(pa.Table.from_batches(first), window):
            single = SuffixFamily()
            data, off = flat(batch["bytes"])
            row, at = _window_places(off, window)
            with np.errstate(over="ignore"):
                on = _met_twice(spans_hash(prefix_hash(data), window)[at])
            row, at = row[on], at[on]
            view = np.lib.stride_tricks.sliding_window_view(data, window)
            seen = np.zeros(len(on), bool)
            for a in range(0, len(on), BATCH):
                seen[a : a + BATCH] = single.add(np.ascontiguousarray(view[at[a : a + BATCH]]).view(f"S{window}").ravel())
            start = at - off[:-1][row] + batch["low"].to_numpy()[row]
            yield _runs(batch, row[seen], start[seen], window)

    return run


def _single_windows(window: int):
    """What a task of hot surroundings finds by a family of its own, as spans, and the windows that it saw first, as lists of starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = SuffixFamily()
        with np.errstate(over="ignore"):
            for batch in _cut(_once(batches), window):
                suffixes, row, start = _windows(batch, window)
                seen = family.add(suffixes)
                spans = _runs(batch, row[seen], start[seen], window)
                none = spans.num_rows
                yield pa.RecordBatch.from_arrays([*spans.columns, pa.nulls(none, pa.list_(pa.int64())), pa.nulls(none, pa.list_(pa.int64())), pa.nulls(none, pa.binary())], [*spans.schema.names, "keys", "starts", "bytes"])
                row, start = row[~seen], start[~seen]
                data, off = flat(batch["bytes"])
                a = off[:-1][row] + start - batch["low"].to_numpy()[row]
                keys = span_hash(prefix_hash(data), a, a + window)
                cut = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(cut, ints(x)) for x in (keys, start)]
                none = pa.nulls(batch.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([batch["_id"], batch["_t"], batch["low"], none, *lists, batch["bytes"]], ["_id", "_t", "start", "end", "keys", "starts", "bytes"])

    return run


def _dealt_windows(window: int, twice):
    """The bytes of the windows that stand in more than one task, to be dealt out by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                keys, start = (batch[c].flatten().to_numpy().astype(np.int64) for c in ("keys", "starts"))
                row = np.repeat(np.arange(batch.num_rows), batch["keys"].value_lengths().to_numpy())
                with np.errstate(over="ignore"):
                    on = has_twice(twice.value, keys.view(np.uint64))
                keys, start, row = keys[on], start[on], row[on]
                data, off = flat(batch["bytes"])
                a = off[:-1][row] + start - batch["start"].to_numpy()[row]
                view = np.lib.stride_tricks.sliding_window_view(data, window)[a] if len(a) else np.zeros((0, window), np.uint8)
                cut = pa.py_buffer((np.arange(len(a) + 1, dtype=np.int32) * window).tobytes())
                texts = pa.Array.from_buffers(pa.binary(), len(a), [None, cut, pa.py_buffer(view.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(keys), *_ids(batch, row), pa.array(start), texts], ["gram", "_id", "_t", "low", "bytes"])

    return run


def _merged_rows(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals in order of row and start, joined where they touch."""
    if not len(row):
        return row, start, end
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] > end[:-1])]))
    last = np.concatenate([first[1:], [len(row)]]) - 1
    return row[first], start[first], end[last]


def _joined_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted spans of documents as maximal runs, a list for each document; spans of a document that two batches hold make two lists."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [np.asarray(batch[c].fill_null(0).to_numpy(zero_copy_only=False), np.int64) for c in ("_id", "_t")] + [np.asarray(batch["_id"].is_null().to_numpy(zero_copy_only=False))]
        new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in key], axis=0)])
        row = np.cumsum(new) - 1
        start, end = (batch[c].to_numpy().astype(np.int64) for c in ("start", "end"))
        shift = row * (int(end.max()) + 1)  # so that ends grow from row to row
        reach = np.maximum.accumulate(end + shift)
        first = np.flatnonzero(np.concatenate([[True], (start + shift)[1:] > reach[:-1]]) | new)
        last = np.concatenate([first[1:], [len(row)]]) - 1
        cut = pa.array(np.searchsorted(row[first], np.arange(row[-1] + 2)), pa.int32())
        spans = pa.StructArray.from_arrays([pa.array(start[first]), pa.array(reach[last] - shift[last])], ["start", "end"])
        yield pa.RecordBatch.from_arrays([*_ids(batch, np.flatnonzero(new)), pa.ListArray.from_arrays(cut, spans)], ["_id", "_t", "spans"])


def _merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the intervals cover."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    last = np.concatenate([first[1:], [len(start)]]) - 1
    return list(zip(start[first].tolist(), reach[last].tolist(), strict=True))


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "_text", CHUNK):
        data, off = flat(batch["_text"])
        raw = data.tobytes()
        spans = batch["_spans"].combine_chunks() if isinstance(batch["_spans"], pa.ChunkedArray) else batch["_spans"]
        cut = np.concatenate([[0], np.cumsum(np.array(pc.fill_null(pc.list_value_length(spans), 0)))]).astype(np.int64)
        starts, ends = (np.array(spans.flatten().field(k), np.int64) for k in ("start", "end"))
        out: list[list] = [[], [], [], [], []]
        for i in range(batch.num_rows):
            text = raw[off[i] : off[i + 1]]
            merged = _merged(starts[cut[i] : cut[i + 1]], ends[cut[i] : cut[i + 1]])
            at, kept = 0, []
            for a, b in merged:
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            left = b"".join(kept)
            for o, v in zip(out, (len(text), len(text) - len(left), len(merged), hashlib.sha256(left).hexdigest(), [{"start": a, "end": b} for a, b in merged]), strict=True):
                o.append(v)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch["_id"], batch["_t"], *(pa.array(o, pa.int64()) for o in out[:3]), pa.array(out[3], pa.string()), pa.array(out[4], span)], ["doc_id", "_t", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.sortWithinPartitions(F.col("_id").asc_nulls_last(), "_t", "low")


def scanned(contents: DataFrame, window: int) -> DataFrame:
    """Spans of the windows that came before, by families of suffix arrays, one for each share of the grams."""
    spark = contents.sparkSession
    size = contents.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES)
    return _in_order(contents.repartition(tasks, "gram")).mapInArrow(_scan(window), _SPANS)


def dedup_substrings(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = 100) -> DataFrame:
    """Find every byte covered by a string of ``window`` bytes that also starts earlier in the corpus.

    Texts are whole and as UTF-8; strings never cross texts; the order is (doc_id with null last, text tag, position).

    Every window picks an anchor by its content, so equal windows pick equal grams at equal places, and the text around
    an anchor holds all windows that pick it. Anchors whose gram stands once in the corpus are left out by a filter;
    the others are the suffixes of an index, a logarithmic family of suffix arrays: a batch of suffixes, in order of
    the documents, is sorted into an array, scanned against the levels for those that came before, and merged with
    levels of equal size. First each task asks a family of its own about the texts it reads, so that of copies in
    thousands only one a task goes on; then suffixes are dealt out by their grams and asked again. Of those that came
    first, grams with several surroundings are cut into windows, which go through a family in the same way; these find
    the edges of repeats. Grams with more than MANY surroundings, which would make a task grow, are dealt out in
    shares of about MANY by document, cut into windows there, and the windows that several tasks hold are dealt out by
    their own hash. All decisions compare
    bytes; hashes only deal and filter.

    Returns doc_id, _t (tag of the text), n_bytes, n_removed, n_spans, kept_sha256 of the bytes left, and removed, the
    maximal spans. Null and empty texts, and texts under ``window`` bytes, keep all. Equal rows (same id and text) are
    one document: each gets the same result. An empty table gives no rows; other columns are not read.
    """
    if window < GRAM:
        raise ValueError(f"the window must have {GRAM} bytes or more")
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), text_tag(text).alias("_t"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    repeated = spark.sparkContext.broadcast(twice_filter(rows.select("_text").mapInArrow(_grams(window), "grams array<long>"), "grams", 3 * size // window))
    in_order = rows.sortWithinPartitions(F.col("_id").asc_nulls_last(), "_t")
    found = stored(in_order.mapInArrow(_contents(window, repeated), _CONTENTS), "surroundings")
    repeated.destroy()
    contents = found.filter("gram IS NOT NULL").drop("end")
    hot = stored(contents.groupBy("gram").count().filter(F.col("count") > MANY), "hot")
    cold = scanned(contents.join(hot, "gram", "left_anti"), window)
    salt = F.pmod(F.xxhash64("_id", "_t"), F.ceil(F.col("count") / MANY))
    single = contents.join(hot, "gram").withColumn("salt", salt).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "gram", "salt")
    single = stored(_in_order(single).select("_id", "_t", "low", "bytes").mapInArrow(_single_windows(window), f"{_SPANS}, keys array<long>, starts array<long>, bytes binary"), "hot-windows")
    lists = single.filter("keys IS NOT NULL")
    twice = spark.sparkContext.broadcast(twice_filter(lists, "keys", lists.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]))
    dealt = lists.select("_id", "_t", "start", "keys", "starts", "bytes").mapInArrow(_dealt_windows(window, twice), "gram long, _id long, _t long, low long, bytes binary")
    local = found.filter("gram IS NULL").select("_id", "_t", F.col("low").alias("start"), "end").union(single.filter("keys IS NULL").select("_id", "_t", "start", "end"))
    spans = cold.union(scanned(dealt, window)).union(local).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_id", "_t", F.shiftright("start", 20)).sortWithinPartitions("_id", "_t", "start")
    spans = spans.mapInArrow(_joined_spans, "_id long, _t long, spans array<struct<start:long,end:long>>")
    spans = stored(spans.groupBy("_id", "_t").agg(F.flatten(F.collect_list("spans")).alias("_spans")), "spans")
    twice.destroy()
    discard(found, hot, single)
    joined = rows.join(spans, same(rows, spans, "_id", "_t"), "left").select(rows["_id"], rows["_t"], "_text", "_spans")
    return joined.mapInArrow(_removed, "doc_id long, _t long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>")
