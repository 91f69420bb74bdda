"""Packing documents into fixed-length sequences by minimum bin slack."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_tag
from .textops import flat, pieces, prefix_hash, span_hash, word_spans

#: Words whose ids a worker remembers, by hash, and runs of letters in each of two generations.
REMEMBERED = 1_000_000
RUNS = 100_000
_ASCII_MARKS = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())


class WordTokenizer:
    """Ids of whole texts from the ids of their words, for tokenizers that drop white space and never cross it.

    Words are known by 64-bit hashes of their bytes, checked by a second one; only new ones become strings. A run of letters at a word's start
    is a token sequence of its own if what follows is ASCII, so runs, lower-cased where that is plain, are encoded
    once, many at a time, and parted at the tokens that end a word.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for k, i in vocab.items() if k.endswith("</w>")]] = True
        self.runs: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.hash, self.other = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")

    def _alone(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_runs(self, runs: list[str]) -> None:
        if len(self.runs) > RUNS:
            self.older, self.runs = self.runs, {}
        new = []
        for w in runs:
            if w not in self.runs:
                if (found := self.older.get(w)) is not None:
                    self.runs[w] = found
                else:
                    new.append(w)
        for a in range(0, len(new), 5000):
            some = new[a : a + 5000]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            cut = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cut) == len(some):
                raw, at = ids.tobytes(), 0
                for w, end in zip(some, cut, strict=True):
                    self.runs[w] = raw[at:end]
                    at = end
            else:  # some letters came apart; one by one
                for w in some:
                    self.runs[w] = self._alone(w)

    def word_ids(self, words: list[str]) -> list[bytes]:
        split, rest = [], {"": b""}
        for w in words:
            run = w.rstrip(_ASCII_MARKS)
            split.append((run.lower() if run.isascii() else run, w[len(run) :]) if run.isalpha() else ("", w))
        self._encode_runs(list({x for x, _ in split if x}))
        out = []
        for x, y in split:
            if y not in rest:
                rest[y] = self._alone(y)
            out.append(self.runs[x] + rest[y] if x else rest[y])
        return out

    def _learn(self, hashes: np.ndarray, other: np.ndarray, words: list[str]) -> None:
        found = self.word_ids(words)
        length = np.array([len(x) // 4 for x in found], np.int64)
        start = len(self.ids) + np.cumsum(length) - length
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), "<u4")])
        at = np.searchsorted(self.hash, hashes)
        self.hash, self.other = np.insert(self.hash, at, hashes), np.insert(self.other, at, other)
        self.start, self.length = np.insert(self.start, at, start), np.insert(self.length, at, length)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a flat column, and where each text's begin."""
        s, e, before = word_spans(data, off)
        with np.errstate(over="ignore"):
            unique, first, inverse = np.unique(span_hash(prefix_hash(data), s, e), return_index=True, return_inverse=True)
            other = span_hash(prefix_hash(data ^ np.uint8(0x5B)), s, e)
        if len(self.hash) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.hash, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.hash)
        new[inside] = self.hash[at[inside]] != unique[inside]
        if new.any():
            raw = data.tobytes()
            self._learn(unique[new], other[first[new]], [raw[s[i] : e[i]].decode() for i in first[new]])
            at = np.searchsorted(self.hash, unique)
        if (self.other[at][inverse] != other).any():  # different words with one hash: each by itself
            raw = data.tobytes()
            each = [self._alone(raw[a:b].decode()) for a, b in zip(s.tolist(), e.tolist(), strict=True)]
            ahead = np.concatenate([[0], np.cumsum([len(x) // 4 for x in each])]).astype(np.int64)
            return np.frombuffer(b"".join(each), "<u4"), ahead[before]
        length = self.length[at][inverse]
        ahead = np.concatenate([[0], np.cumsum(length)])
        ids = self.ids[np.arange(ahead[-1]) + np.repeat(self.start[at][inverse] - ahead[:-1], length)]
        return ids, ahead[before]


def _cut(tokenizer_file: str, end_id: int, window: int):
    """Tokenise texts and cut each into pieces of the window's length and one rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        import sys
        import types

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        # one tokenizer for all tasks of a worker process, in a module of its own; loading it costs time and memory
        held = vars(sys.modules.setdefault("_tallgrass_worker", types.ModuleType("_tallgrass_worker"))).setdefault("tokenizers", {})
        words = held.get(tokenizer_file) or held.setdefault(tokenizer_file, WordTokenizer(tokenizer_file))
        repeats: Counter = Counter()
        end = np.array([end_id], "<u4").tobytes()
        for batch in pieces(batches, "_text", 1 << 20):
            every, cut = words.encode(*flat(batch["_text"]))
            raw, cut = every.tobytes(), (4 * cut).tolist()
            rows: list[tuple] = []
            for i, (d, t) in enumerate(zip(batch["_id"].to_pylist(), batch["_t"].to_pylist(), strict=True)):
                ids = raw[cut[i] : cut[i + 1]] + end
                repeats[d, t] += 1
                n = len(ids) // 4
                for a in range(0, n, window):
                    part = ids[4 * a : 4 * (a + window)]
                    rows.append((d, t, a, len(part) // 4, zlib.crc32(part), n, repeats[d, t]))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "_t", "start", "length", "ids_crc32", "doc_tokens", "_copy"])

    return run


def best_fill(counts: dict[int, int], window: int) -> list[tuple[int, int]]:
    """Which lengths, and how often each, fill the window best: the multiset with the largest sum not over ``window``.

    Reachable sums are bits of one integer. ``counts`` has the lengths in descending order; a length that is there c
    times is added in steps of 1, 2, 4, ... copies, so that all counts to c are covered. The bits before each step are
    kept, and the walk back from the best sum tells how many copies of each step it took. It stops early once the
    window is full.
    """
    full, bits, steps = (1 << (window + 1)) - 1, 1, []
    for n, c in counts.items():
        left, k = min(c, window // n), 1
        while left:
            k = min(k, left)
            steps.append((n, k, bits))
            bits |= (bits << (n * k)) & full
            left -= k
            k *= 2
            if bits >> window:
                break
        if bits >> window:
            break
    at, taken = bits.bit_length() - 1, {}
    for n, k, before in reversed(steps):
        if not before >> at & 1:
            at -= n * k
            taken[n] = taken.get(n, 0) + k
    return list(taken.items())


def plan_windows(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each length, the number of its window and its offset there."""
    order = np.argsort(-lengths, kind="stable")
    queues: dict[int, list[int]] = {}
    for i in order[::-1]:
        queues.setdefault(int(lengths[i]), []).append(int(i))
    counts = {n: len(queues[n]) for n in sorted(queues, reverse=True)}
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    number, left = 0, len(lengths)
    while left:
        at = 0
        fill = best_fill(counts, window)
        for n, k in fill:
            counts[n] -= k
            if not counts[n]:
                del counts[n]
            left -= k
            for _ in range(k):
                i = queues[n].pop()
                where[i], offset[i] = number, at
                at += n
        number += 1
    return where, offset


def _pack(window: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "_t", "start"], kind="stable").reset_index(drop=True)
        where, offset = plan_windows(group["length"].to_numpy(), window)
        # full windows are numbered by the documents that fill them, so numbers never meet across groups
        group["sequence_id"] = group["_group"].astype("int64") * (1 << 32) + where
        group["offset"] = offset
        return group.drop(columns=["_group", "_copy"])

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = 4096,
    end_id: int = 2,
    group_docs: int = 4000,
) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens.

    A document is its ids and ``end_id``. It is cut into pieces of ``window`` ids and a rest. Pieces are dealt by the
    hash of id, text and number among the equal rows of a task, so that repeats of a row spread, to groups of about ``group_docs`` documents; in each, sequences are filled one after the other
    with the multiset of remaining lengths whose sum comes nearest to the window (``best_fill``). Groups bound a
    task's memory at any input size; only the last sequences of a group have slack.

    The tokenizer is applied to the words of a text, which gives the ids of the whole text for tokenizers that drop
    white space and never cross it.

    Returns doc_id, _t (tag of the text), start, length, ids_crc32, doc_tokens, sequence_id, offset, one row per piece.
    A null or empty text is the one piece [end_id]. Null ids and repeated rows are documents of their own. An empty
    table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), text_tag(text).alias("_t"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    cut = rows.mapInArrow(_cut(tokenizer_file, end_id, window), "doc_id long, _t long, start long, length long, ids_crc32 long, doc_tokens long, _copy long")
    groups = max(1, -(-docs.count() // group_docs))
    cut = cut.withColumn("_group", F.pmod(F.xxhash64("doc_id", "_t", "_copy"), F.lit(groups)))
    return cut.groupBy("_group").applyInPandas(_pack(window), "doc_id long, _t long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
