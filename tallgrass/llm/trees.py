"""Quality classifier: histogram gradient-boosted trees over statistics of a document's text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, text_tag
from .textops import LOWER, flat, mix, pieces, prefix_hash, span_hash, word_spans

_CLASS = np.zeros(256, np.uint8)  # 0 others, 1 lower, 2 upper, 3 digit, 4 white space, 5 symbols, 6 stops, 7 non-ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 7
_CLASS[[32, 9, 10, 11, 12, 13]] = 4
_CLASS[[ord(c) for c in "#*$%&|<>@=+~^\\/_{}[]"]] = 5
_CLASS[[ord(c) for c in ".,;:!?"]] = 6

FEATURES = [
    "log_bytes", "log_words", "lower", "upper", "digit", "white", "symbol", "stop", "non_ascii", "other", "bangs", "bars", "newlines",
    "mean_word", "sd_word", "long_words", "short_words", "distinct_words", "top_word", "same_as_last", "distinct_pairs", "words_end_stop", "words_end_symbol",
    "distinct_lines", "words_a_line", "longest_line", "byte_entropy", "title_words", "capital_words",
]


def _sums(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[before[1:]] - total[before[:-1]]


def _distinct(keys: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the number of distinct keys and the count of the most frequent."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    h = np.sort(mix(keys + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & ~np.uint64(0xFFFFF) | row.astype(np.uint64) & np.uint64(0xFFFFF))
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    r, c = (h[first] & np.uint64(0xFFFFF)).astype(np.int64), np.diff(np.concatenate([first, [len(h)]]))
    top = np.zeros(n)
    np.maximum.at(top, r, c)
    return np.bincount(r, minlength=n).astype(float), top


def features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text (null: empty), all finite."""
    data, off = flat(column)
    n, size = len(off) - 1, np.diff(off).astype(float)
    kinds = np.bincount(np.repeat(np.arange(n), np.diff(off)) * 8 + _CLASS[data], minlength=8 * n).reshape(n, 8)
    part = kinds / np.maximum(size, 1)[:, None]
    starts, ends, before = word_spans(data, off)
    words, row = np.diff(before).astype(float), np.repeat(np.arange(n), np.diff(before))
    each = np.maximum(words, 1)
    length = (ends - starts).astype(float)
    mean = _sums(length, before) / each
    h = span_hash(prefix_hash(LOWER[data]), starts, ends)
    distinct, top = _distinct(h, row, n)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    pair = mix(h[:-1] * np.uint64(3) + h[1:])[row[1:] == row[:-1]] if len(h) else h
    pairs, _ = _distinct(pair, row[1:][row[1:] == row[:-1]] if len(h) else row, n)
    last = _CLASS[data[ends - 1]] if len(ends) else np.zeros(0, np.uint8)
    head = _CLASS[data[starts]] if len(starts) else np.zeros(0, np.uint8)
    # lines: runs between newlines; their hashes by the same prefix sums
    nl = np.flatnonzero(data == 10)
    cut = np.unique(np.concatenate([off, nl + 1]))
    a, b = cut[:-1], cut[1:]
    line_row = np.searchsorted(off, a, side="right") - 1
    lines = np.bincount(line_row, minlength=n).astype(float) if len(a) else np.zeros(n)
    different, _ = _distinct(span_hash(prefix_hash(data), a, b), line_row, n)
    longest = np.zeros(n)
    np.maximum.at(longest, line_row, (b - a).astype(float))
    byte = np.bincount(np.repeat(np.arange(n), np.diff(off)) * 256 + data, minlength=256 * n).reshape(n, 256) / np.maximum(size, 1)[:, None]
    entropy = -(byte * np.log2(np.where(byte > 0, byte, 1))).sum(1)
    count = lambda mask: np.bincount(np.searchsorted(off, np.flatnonzero(mask), side="right") - 1, minlength=n) / np.maximum(size, 1)
    upper_word = (head == 2) & (length > 1)
    if len(starts):
        upper_word &= _CLASS[data[np.minimum(starts + 1, len(data) - 1)]] == 2
    return np.column_stack([
        np.log1p(size), np.log1p(words), part[:, 1], part[:, 2], part[:, 3], part[:, 4], part[:, 5], part[:, 6], part[:, 7], part[:, 0], count(data == 33), count(data == 124), count(data == 10),
        mean, np.sqrt(np.maximum(_sums(length**2, before) / each - mean**2, 0)), _sums(length > 12, before) / each, _sums(length < 3, before) / each, distinct / each, top / each, _sums(same, before) / each, pairs / each, _sums(last == 6, before) / each, _sums(last == 5, before) / each,
        different / np.maximum(lines, 1), np.log1p(words / np.maximum(lines, 1)), longest / np.maximum(size, 1), entropy, _sums(head == 2, before) / each, _sums(upper_word, before) / each,
    ])


@dataclass
class Forest:
    """Complete binary trees of one depth as arrays; node i has children 2i+1 and 2i+2."""

    start: float
    feature: np.ndarray  # trees x (2^depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2^depth

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of ``x``."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = self.leaf.shape[1].bit_length() - 1
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += leaf[node - (leaf.size - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 1.0) -> Forest:
    """Fit by Newton boosting of the logistic loss over histograms of binned features."""
    y = y.astype(float)
    base = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    start = float(np.log(base / (1 - base)))
    n_nodes, n_leaves, k = 2**depth - 1, 2**depth, x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(1) for j in range(k)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]) if len(x) else np.zeros((0, k), int)
    flat_bins = binned + np.arange(k) * bins
    feature, threshold, leaf = np.zeros((trees, n_nodes), np.int64), np.full((trees, n_nodes), np.inf), np.zeros((trees, n_leaves))
    raw = np.full(len(x), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            slot = ((node - first)[:, None] * (k * bins) + flat_bins).ravel()
            g = np.bincount(slot, np.repeat(grad, k), width * k * bins).reshape(width, k, bins).cumsum(2)
            h = np.bincount(slot, np.repeat(hess, k), width * k * bins).reshape(width, k, bins).cumsum(2)
            gt, ht = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + l2) + (gt - g) ** 2 / (ht - h + l2) - gt**2 / (ht + l2)
            gain[(h < least) | (ht - h < least)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for i, b in enumerate(best):
                j, c = divmod(int(b), bins)
                if gain[i, j, c] > 1e-9 and c < len(edges[j]):
                    feature[t, first + i], threshold[t, first + i] = j, edges[j][c]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[t, node]] > threshold[t, node])
        at = node - n_nodes
        leaf[t] = rate * np.bincount(at, grad, n_leaves) / (np.bincount(at, hess, n_leaves) + l2)
        raw += leaf[t][at]
    return Forest(start, feature, threshold, leaf)


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_tag(text).alias("_t"), F.coalesce(F.col(text), F.lit("")).alias("_text"))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "_text", 1 << 20):
        x = features(batch["_text"])
        yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64())), batch["_y"].cast(pa.int32())], ["x", "y"])


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", most_rows: int = 20_000) -> Forest:
    """Fit a forest on labelled documents whose crc32(id) mod 5 is not 0, at most ``most_rows`` of them by id hash.

    The bound holds what the driver collects (29 doubles a row). Labels that are null, other than 0 and 1, or given
    for a null id are ignored; of several labels for an id the largest counts, of several texts the one with the
    smallest tag. Without labels the score is 0.5.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held(doc_id, 0)).groupBy(F.col(doc_id).alias("_k")).agg(F.max(label).alias("_y"))
    known = known.orderBy(F.xxhash64("_k"), "_k").limit(most_rows)
    rows = _rows(docs, doc_id, text)
    got = rows.join(F.broadcast(known), rows["doc_id"] == known["_k"]).groupBy("_k").agg(F.min_by("_text", "_t").alias("_text"), F.first("_y").alias("_y"))
    got = got.select("_text", "_y").mapInArrow(_features, "x array<double>, y int").toArrow()  # a row for each labelled id
    x = np.array(got["x"].to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    y = got["y"].to_numpy().astype(float) if len(x) else np.zeros(0)
    order = np.lexsort(np.column_stack([x, y]).T) if len(x) else np.zeros(0, int)  # the same model whatever order rows come in
    return fit(x[order], y[order])


def _scores(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", 1 << 20):
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["_t"], pa.array(forest.score(features(batch["_text"])))], ["doc_id", "_t", "score"])

    return run


def classify(docs: DataFrame, forest: Forest, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score the whole text of every document: doc_id, _t (tag of the text) and score, 0 to 1, higher for label 1.

    Only the text is an input. Null and empty texts are scored as empty; null ids and repeated rows are scored like
    others; an empty table gives no rows; other columns are not read. The forest (a few tens of kB) goes to the tasks.
    """
    return _rows(docs, doc_id, text).mapInArrow(_scores(forest), "doc_id long, _t long, score double")


def _passing(forest: Forest, text: str, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, 1 << 20):
            yield batch.filter(pa.array(forest.score(features(batch[batch.schema.get_field_index(text)])) >= least))

    return run


def keep_scored(docs: DataFrame, forest: Forest, *, text: str = "text", least: float = 0.3) -> DataFrame:
    """The rows whose text scores ``least`` or more, with all their columns; nothing moves between tasks."""
    return docs.mapInArrow(_passing(forest, text, least), docs.schema)
