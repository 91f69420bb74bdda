"""Alignment of two tokenizers over a corpus: each distinct text once, pair counts weighted by its copies."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored
from .textops import flat, ints, pieces, prefix_hash, span_hash

#: Chunks, and bytes of their texts and groups, that a worker remembers; pairs of one broadcast slice (24 bytes each).
REMEMBERED, REMEMBERED_BYTES = 300_000, 1 << 26
SLICE = 2_000_000
#: Fixed value: how the byte-level tokenizer parts a text, as published with it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# bytes that may end a character before a chunk, or begin one after its first byte: none that can belong to white space
_UNSAFE_NEXT = np.zeros(256, bool)
_UNSAFE_NEXT[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = True
_SPACE = "▁".encode()


def byte_level_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tables:
    """Bytes of ids, to compare joined tokens with their text."""

    def __init__(self, of: dict[int, bytes]):
        self.bytes = [of.get(i, b"") for i in range(max(of) + 1)]
        self.length = np.array([len(b) for b in self.bytes], np.int64)


class Aligner:
    """Token groups and links of texts by chunks, which both tokenizers treat alone.

    A chunk begins at a space or a line end that stands between two characters which can't be white space: there the
    byte-level tokenizer parts the text, and no piece of the other has a space or a line end behind another character.
    Chunks are known by 64-bit hashes checked by a second one; only new ones are encoded, many at a time.
    """

    def __init__(self, byte_bpe: str, piece_bpe: str):
        import sentencepiece
        import tiktoken

        with open(byte_bpe, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        letters = byte_level_letters()
        ranks = {bytes(letters[c] for c in k): i for k, i in vocab.items() if all(c in letters for c in k) and not (k.startswith("<|") and k.endswith("|>"))}
        self.a = tiktoken.Encoding("aligned", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_table = Tables({i: b for b, i in ranks.items()})
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        of = {i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names) if not (self.b.is_control(i) or self.b.is_unknown(i))}
        self.b_table = Tables(of)
        if any("▁" in p.lstrip("▁") or "\n" in p for p in names):
            raise ValueError("pieces may not hold a space behind other characters, nor a line end")
        self.wide = len(names)  # an id pair is the number a * wide + b
        self._forget()

    def _forget(self) -> None:
        self.hash, self.other, self.row = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.groups: list[bytes] = []
        self.counts = np.zeros((0, 4), np.int64)  # n_a, n_b, n_groups, bad
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.size = 0

    def _one(self, chunk: bytes) -> tuple[list[int], list[int]] | None:
        """Ids of both tokenizers for text that follows other text, or None where their bytes are not the chunk's."""
        text = chunk.decode("utf-8", "replace")
        a = self.a.encode_ordinary(text)
        b = self.b.encode(text[1:], num_threads=1) if text[0] == " " else self.b.encode(text, num_threads=1)[1:]
        if b"".join(self.a_table.bytes[i] for i in a) != chunk or b"".join(self.b_table.bytes[i] for i in b) != chunk:
            return None
        return a, b

    def _encode(self, chunks: list[bytes], plain: np.ndarray) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of every chunk; plain ones, which stay apart when joined, by one call for many."""
        out: list = [None] * len(chunks)
        some = np.flatnonzero(plain).tolist()
        for at in range(0, len(some), 5000):
            part = some[at : at + 5000]
            whole = b"".join(chunks[i] for i in part)
            both = self._one(whole)
            if both is None:
                for i in part:
                    out[i] = self._one(chunks[i])
                continue
            ends = np.cumsum([len(chunks[i]) for i in part])
            cut = []
            for ids, table in zip(both, (self.a_table, self.b_table), strict=True):
                ids = np.array(ids, np.int64)
                total = np.cumsum(table.length[ids])
                where = np.searchsorted(total, ends)
                if (total[where] != ends).any():
                    raise ValueError("a chunk did not stay apart")
                cut.append(np.split(ids, where[:-1] + 1))
            for i, a, b in zip(part, *cut, strict=True):
                out[i] = a, b
        for i in np.flatnonzero(~plain).tolist():
            out[i] = self._one(chunks[i])
        return out

    def _learn(self, chunks: list[bytes], plain: np.ndarray) -> None:
        """Align new chunks: every stretch between two ends of either tokenizer is one link, ends of both part groups."""
        found = self._encode(chunks, plain)
        good = [i for i, x in enumerate(found) if x is not None]
        counts = np.zeros((len(chunks), 4), np.int64)
        counts[:, 3] = 1
        groups = [b""] * len(chunks)
        length = np.zeros(len(chunks), np.int64)
        if good:
            a, b = (np.concatenate([np.asarray(found[i][k], np.int64) for i in good]) for k in (0, 1))
            n_a, n_b = (np.array([len(found[i][k]) for i in good]) for k in (0, 1))
            a_end, b_end = np.cumsum(self.a_table.length[a]), np.cumsum(self.b_table.length[b])
            ends = np.cumsum([len(chunks[i]) for i in good])
            every = np.union1d(a_end, b_end)
            pairs = a[np.searchsorted(a_end, every)] * self.wide + b[np.searchsorted(b_end, every)]
            length[good] = np.bincount(np.searchsorted(ends, every), minlength=len(good))
            both = np.intersect1d(a_end, b_end, assume_unique=True)
            n_groups = np.bincount(np.searchsorted(ends, both), minlength=len(good))
            counts[good] = np.column_stack([n_a, n_b, n_groups, np.zeros(len(good), np.int64)])
            a_cut, b_cut = (np.searchsorted(a_end, both) + 1).tolist(), (np.searchsorted(b_end, both) + 1).tolist()
            a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
            told, x, y = [], 0, 0
            for p, q in zip(a_cut, b_cut, strict=True):
                told.append(f"{a_text[x] if p == x + 1 else ','.join(a_text[x:p])}|{b_text[y] if q == y + 1 else ','.join(b_text[y:q])}")
                x, y = p, q
            at = 0
            for i, n in zip(good, n_groups.tolist(), strict=True):
                groups[i] = ";".join(told[at : at + n]).encode()
                at += n
        else:
            pairs = np.zeros(0, np.int64)
        self.start = np.concatenate([self.start, len(self.pairs) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.counts = np.concatenate([self.counts, counts])
        self.groups += groups
        self.size += sum(map(len, groups)) + 8 * len(pairs)

    def chunks(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts each led by a space; starts and ends of all chunks, and which of them may be joined with others."""
        data = np.insert(data, off[:-1], 32)
        off = off + np.arange(len(off))
        n = len(data)
        ahead = np.concatenate([_UNSAFE_NEXT[data[1:]], [True]])  # the byte behind
        last = (data <= 32) | (data == 127)  # no chunk ends with these
        wide = (data[:-1] == 0xC2) if n else np.zeros(0, bool)
        last[1:] |= wide
        three = ((data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81))) | ((data[:-2] == 0xE1) & (data[1:-1] == 0x9A)) | ((data[:-2] == 0xE3) & (data[1:-1] == 0x80)) if n > 2 else np.zeros(0, bool)
        last[2:] |= three if n > 2 else last[2:]
        first = np.zeros(n + 1, bool)
        first[1:n] = ((data[1:] == 32) | (data[1:] == 10)) & ~last[:-1] & ~ahead[1:]
        first[off] = True
        starts = np.flatnonzero(first[:n])
        ends = np.append(starts[1:], n)
        # ``ahead`` of a text's last byte looks at the next text, whose space makes it unsafe, as it should be
        plain = ~ahead[starts] & ~last[ends - 1] if len(starts) else np.zeros(0, bool)
        return data, starts, ends, plain

    def look_up(self, data: np.ndarray, s: np.ndarray, e: np.ndarray, plain: np.ndarray) -> np.ndarray:
        """The remembered row of every chunk."""
        with np.errstate(over="ignore"):
            unique, first, inverse = np.unique(span_hash(prefix_hash(data), s, e), return_index=True, return_inverse=True)
            other = span_hash(prefix_hash(data ^ np.uint8(0x5B)), s, e)
        if len(self.hash) > REMEMBERED or self.size > REMEMBERED_BYTES:
            self._forget()
        at = np.searchsorted(self.hash, unique)
        inside = at < len(self.hash)
        new = np.ones(len(unique), bool)
        new[inside] = self.hash[at[inside]] != unique[inside]
        if new.any():
            raw, take = data.tobytes(), first[new]
            texts = [raw[x:y] for x, y in zip(s[take].tolist(), e[take].tolist(), strict=True)]
            row = len(self.groups) + np.arange(len(texts))
            self._learn(texts, plain[take] & np.array([_SPACE not in t for t in texts]))
            at = np.searchsorted(self.hash, unique[new])
            self.hash, self.other, self.row = np.insert(self.hash, at, unique[new]), np.insert(self.other, at, other[take]), np.insert(self.row, at, row)
        at = np.searchsorted(self.hash, unique)[inverse]
        out = self.row[at]
        odd = np.flatnonzero(self.other[at] != other)  # other chunks with a hash that is taken: learned anew, not remembered by hash
        if len(odd):
            raw = data.tobytes()
            out[odd] = len(self.groups) + np.arange(len(odd))
            self._learn([raw[s[i] : e[i]] for i in odd.tolist()], np.zeros(len(odd), bool))
        return out

    def measure(self, column: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """For every text n_a, n_b, n_groups, n_links (zeros without tokens) and the digest of its groups; its different pairs, ascending, and the links of each, with the cuts between texts."""
        data, off = flat(column)
        n = len(off) - 1
        data, s, e, plain = self.chunks(data, off)
        row = self.look_up(data, s, e, plain)
        doc = np.searchsorted(off + np.arange(n + 1), s, side="right") - 1
        counts = np.zeros((n, 4), np.int64)
        for j in range(4):
            counts[:, j] = np.bincount(doc, self.counts[row, j], n)
        none = (counts[:, 3] > 0) | (np.diff(off) == 0)
        counts[none] = 0
        row, doc = row[~none[doc]], doc[~none[doc]]
        cut = np.searchsorted(doc, np.arange(n + 1)).tolist()
        rows = row.tolist()
        digest = [hashlib.sha256(b";".join([self.groups[i] for i in rows[cut[k] : cut[k + 1]]])).hexdigest() if cut[k] < cut[k + 1] else "" for k in range(n)]
        length = self.length[row]
        ahead = np.cumsum(length) - length
        pairs = self.pairs[np.arange(length.sum()) + np.repeat(self.start[row] - ahead, length)]
        counts[:, 3] = np.bincount(doc, length, n)
        whose = np.repeat(doc, length)
        order = np.argsort(whose * np.int64(1 << 40) + pairs, kind="stable") if len(pairs) else np.zeros(0, np.int64)
        pairs, whose = pairs[order], whose[order]
        first = np.flatnonzero((np.diff(pairs, prepend=-1) != 0) | (np.diff(whose, prepend=-1) != 0))
        links = np.diff(np.append(first, len(pairs)))
        return counts, digest, pairs[first], links, np.searchsorted(whose[first], np.arange(n + 1))


def _aligner(byte_bpe: str, piece_bpe: str) -> Aligner:
    """One aligner for all tasks of a worker process: loading the tokenizers costs time and memory."""
    import sys
    import types

    held = vars(sys.modules.setdefault("_tallgrass_worker", types.ModuleType("_tallgrass_worker"))).setdefault("aligners", {})
    return held.get((byte_bpe, piece_bpe)) or held.setdefault((byte_bpe, piece_bpe), Aligner(byte_bpe, piece_bpe))


def _align(byte_bpe: str, piece_bpe: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_bpe, piece_bpe)
        for batch in pieces(batches, "text", 1 << 19):
            counts, digest, pairs, links, cut = aligner.measure(batch["text"])
            cut = pa.array(cut, pa.int32())
            lists = pa.ListArray.from_arrays(cut, ints(pairs)), pa.ListArray.from_arrays(cut, pa.array(links, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch["key"], batch["copies"], *[ints(counts[:, j]) for j in range(4)], pa.array(digest, pa.string()), *lists], ["key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])

    return run


def _judged(slice_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = slice_of.value
        for batch in batches:
            asked, links = batch["pairs"].flatten().to_numpy(), batch["links"].flatten().to_numpy().astype(np.int64)
            n = batch.num_rows
            row = np.repeat(np.arange(n), batch["pairs"].value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(pair, asked), len(pair) - 1)
            links = np.where(pair[at] == asked, links, 0)
            # whole numbers to the end: sums of counts may pass what a double holds
            total, top = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(total, row, links * count[at])
            np.add.at(top, row, links * best[at])
            yield pa.RecordBatch.from_arrays([batch["key"], ints(top), ints(total)], ["key", "n_best", "count_sum"])

    return run


def align_texts(docs: DataFrame, byte_bpe: str, piece_bpe: str, *, doc_id: str = "doc_id", text: str = "text", slice_pairs: int = SLICE) -> DataFrame:
    """Align the tokens of two tokenizers in every document and measure how usual the alignments are in the corpus.

    Documents are grouped by their full text, with partial groups before the shuffle, so a hot text is one row with its
    copies; each text is tokenised and aligned once. A pair's count is the number of documents that link it, so a text
    adds its copies. Measures come back to the documents by the SHA-256 of the text, in a join whose hot keys Spark can split.

    Pair counts are looked up in slices of at most ``slice_pairs`` pairs, each broadcast by itself (48 MB); where the
    corpus has more, the stored pair lists of the texts are read once for each slice and the sums added up.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups_sha256, one row a document. Null
    and empty texts, and texts whose tokens do not give their bytes back, have no tokens: zeros and ''. Null ids and
    repeated rows are documents of their own; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts = rows.filter(F.length("text") > 0).groupBy("text").agg(F.count("*").alias("copies"))
    texts = texts.select("text", "copies", F.unhex(F.sha2("text", 256)).alias("key"))
    ddl = "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<int>"
    aligned = stored(texts.mapInArrow(_align(byte_bpe, piece_bpe), ddl), "aligned")
    counts = stored(aligned.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("n")), "pairs")
    from_a = F.expr(f"pair div {_wide(piece_bpe)}")
    highest = counts.groupBy(from_a.alias("a")).agg(F.max("n").alias("most"))
    judged = stored(counts.withColumn("a", from_a).join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best")), "judged-pairs")
    slices = max(1, -(-judged.count() // slice_pairs))
    parts = []
    for k in range(slices):
        got = judged.filter(F.pmod(F.xxhash64("pair"), F.lit(slices)) == k).toArrow()  # slice_pairs rows or so
        if got.num_rows:
            order = np.argsort(got["pair"].to_numpy())
            table = spark.sparkContext.broadcast(tuple(got[c].to_numpy().astype(np.int64)[order] for c in ("pair", "n", "best")))
            parts.append(aligned.select("key", "pairs", "links").mapInArrow(_judged(table), "key binary, n_best long, count_sum long"))
    measures = aligned.drop("copies", "pairs", "links")
    if parts:
        sums = parts[0]
        for p in parts[1:]:
            sums = sums.union(p)
        if len(parts) > 1:
            sums = sums.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        sums = stored(sums, "sums")
        measures = measures.join(sums.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key")).drop("_key")
    else:
        measures = measures.withColumn("n_best", F.lit(0).cast("long")).withColumn("count_sum", F.lit(0).cast("long"))
    measures = stored(measures, "measures")
    discard(counts, judged, aligned, *([sums] if parts else []))
    out = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("_k")).join(measures, F.col("_k") == F.col("key"), "left")
    longs = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return out.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in longs], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def _wide(piece_bpe: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe).get_piece_size()
