"""Language-model scoring by online logistic mixing of hashed-context bit predictors."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, same, stored, text_tag
from .textops import LOWER, flat, ints, mix, pieces, prefix_hash, span_hash, word_spans

#: Words with a code of their own; words whose counts every task holds; both are fixed, whatever the input.
CODED = 8192
LISTED = 1 << 18
#: Words without a code that are not listed, or no more frequent than this, teach the letters.
RARE = 2
#: Bits of the slot numbers of each letter predictor; those of the word predictors follow from the training tokens.
LETTER_BITS = (12, 18, 18, 18)
N_WORD, MOST_BITS = 5, 24
GATES, BUCKETS, DEPTHS = 16, 33, 24
#: The node of the bit that tells whether a word repeats the one before.
REPEAT = 1 << 20
BLOCK = 1 << 15
CHUNK = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93 * 0x9E3779B97F4A7C15 % (1 << 64))
# Letters by about their frequency in European languages; other bytes follow by number.
LETTERS = "enitarshdloucgmfpbvwkyzjqx.,;:!?-'|"


def word_bits(tokens: int) -> tuple[int, ...]:
    """Bits of the slots of each word predictor (order 0 to 2, skip, topic): a slot for 16 to 32 training tokens, up to 2^24."""
    top = min(MOST_BITS, max(18, int(tokens).bit_length() - 5))
    return 14, top, top, top - 1, top - 1


@dataclass
class Code:
    """A binary code of symbols: for each, the nodes passed and the bits taken, in flat arrays."""

    length: np.ndarray
    start: np.ndarray
    node: np.ndarray
    bit: np.ndarray

    @classmethod
    def of(cls, weights: list[int]) -> Code:
        """Huffman's code for the weights; ties by symbol, so equal weights always give the same code."""
        heap = [(w, i, None) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        serial = len(heap)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (a[0] + b[0], serial, (a, b)))
            serial += 1
        paths: list[list[tuple[int, int]]] = [[] for _ in weights]
        # three levels of nodes share a number but for the last three bits, and so a line of the cache in every table
        todo, blocks = [(heap[0], [], 1)], 1
        while todo:
            (_, i, pair), path, node = todo.pop()
            if pair is None:
                paths[i] = path
                continue
            for bit in (0, 1):
                below = node + (node & 7) + bit
                if node & 7 >= 4:
                    below, blocks = blocks * 8 + 1, blocks + 1
                todo.append((pair[bit], [*path, (node, bit)], below))
        length = np.array([len(p) for p in paths])
        flat_paths = np.array([x for p in paths for x in p], np.int64).reshape(-1, 2)
        return cls(length, np.cumsum(length) - length, flat_paths[:, 0], flat_paths[:, 1])

    def steps(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For all bits of the symbols: whose they are, node, bit, depth."""
        n = self.length[symbols]
        owner = np.repeat(np.arange(len(symbols)), n)
        depth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        at = self.start[symbols][owner] + depth
        return owner, self.node[at], self.bit[at], depth


def _places(stretched: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Cells of the refinement table: by depth in the code and by prediction."""
    return np.minimum(depth, DEPTHS - 1) * BUCKETS + np.rint((stretched + 12) * np.float32((BUCKETS - 1) / 24)).astype(np.int64)


class Mixer:
    """Bit predictors over hashed contexts, their gated mixing weights, and the table that refines the result.

    While it learns, tables hold counts of zeros and ones and ``learn`` predicts each batch before it counts it. Ready
    for scoring, tables hold the logarithm of the ratio of counts in tenths.
    """

    def __init__(self, bits: tuple[int, ...]):
        self.bits = bits
        self.counts = [np.zeros(2 << b, np.int32) for b in bits]
        self.ratio: list[np.ndarray] = []
        self.weights = np.full((GATES, len(bits)), 0.6 / math.sqrt(len(bits)), np.float64)
        self.refined = np.zeros((DEPTHS, BUCKETS, 2))
        self.seen = 0

    def slots(self, contexts: list[np.ndarray], owner: np.ndarray, node: np.ndarray) -> list[np.ndarray]:
        """Slot of each bit in each table; contexts come multiplied by _ODD, which then is done once a token and not once a bit."""
        node = node.view(np.uint64)
        spread, last = (node >> np.uint64(3)) * _SPREAD, node & np.uint64(7)
        out = []
        for c, b in zip(contexts, self.bits, strict=True):
            at = c[owner]
            at += spread
            at >>= np.uint64(64 - b)
            at ^= last
            out.append(at.view(np.int64))
        return out

    def inputs(self, slots: list[np.ndarray]) -> np.ndarray:
        out = np.empty((len(slots), len(slots[0])), np.float32)
        if self.ratio:
            for o, r, s in zip(out, self.ratio, slots, strict=True):
                np.multiply(r.take(s), np.float32(0.1), out=o)
            return out
        for o, c, s in zip(out, self.counts, slots, strict=True):
            both = c.view(np.int64).take(s).view(np.int32).astype(np.float32)  # a pair of counts is fetched as one number
            both += np.float32(0.4)
            np.divide(both[1::2], both[0::2], out=o)
        np.log(out, out=out)
        return np.clip(out, -8, 8, out=out)

    def mixed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stretched prediction and gate: how sure the two strongest contexts are."""
        sure = [np.minimum(np.abs(x[j]) * np.float32(0.7), 3).astype(np.int8) for j in (1, 2)]
        gate = (sure[0] * 4 + sure[1]).astype(np.int64)
        w = self.weights.astype(np.float32).T
        total = np.zeros(x.shape[1], np.float32)
        for j in range(len(x)):
            part = w[j].take(gate)
            part *= x[j]
            total += part
        return np.clip(total, -12, 12, out=total), gate

    def learn(self, contexts: list[np.ndarray], owner: np.ndarray, node: np.ndarray, bit: np.ndarray, depth: np.ndarray) -> None:
        for a in range(0, len(owner), 1 << 14):
            cut = slice(a, a + (1 << 14))
            b = bit[cut]
            slots = self.slots(contexts, owner[cut], node[cut])
            x = self.inputs(slots)
            s, gate = self.mixed(x)
            p = 1 / (1 + np.exp(-s))
            error, spread = b.astype(np.float32) - p, p * (1 - p)
            certainty = np.bincount(gate, spread, GATES)
            for j in range(len(x)):
                g = np.bincount(gate, error * x[j], GATES)
                self.weights[:, j] += 0.05 * g / (certainty * (float(x[j] @ x[j]) / len(b)) + 20)
            place = 2 * _places(s, depth[cut]) + b
            self.refined += np.bincount(place, minlength=2 * DEPTHS * BUCKETS).reshape(DEPTHS, BUCKETS, 2)
            ones = np.ones(len(b), np.int32)
            for c, t in zip(self.counts, slots, strict=True):
                np.add.at(c, 2 * t + b, ones)
            self.seen += len(b)

    def log_probability(self, contexts: list[np.ndarray], owner: np.ndarray, node: np.ndarray, bit: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each bit."""
        out = np.empty(len(owner), np.float32)
        at = np.linspace(-12, 12, BUCKETS)
        prior = 1 / (1 + np.exp(-at))
        table = ((self.refined[:, :, 1] + 20 * prior) / (self.refined.sum(2) + 20)).astype(np.float32).ravel()
        for a in range(0, len(owner), 1 << 14):
            cut = slice(a, a + (1 << 14))
            s, _ = self.mixed(self.inputs(self.slots(contexts, owner[cut], node[cut])))
            place = _places(s, depth[cut])
            p = np.clip((1 / (1 + np.exp(-s)) + table[place]) / 2, 1e-6, 1 - 1e-6)
            out[cut] = np.log(np.where(bit[cut] == 1, p, 1 - p))
        return out

    def state(self) -> list[np.ndarray]:
        return [*self.counts, np.concatenate([self.weights.ravel() * self.seen, self.refined.ravel(), [self.seen]])]

    @classmethod
    def ready(cls, bits: tuple[int, ...], tables: list[np.ndarray], rest: np.ndarray) -> Mixer:
        """From summed counts as ratios, and the sums of all tasks' weights times bits seen, refinements and bits seen."""
        m = cls(bits)
        m.counts, m.ratio = [], tables
        n = GATES * len(bits)
        if rest[-1]:
            m.weights = (rest[:n] / rest[-1]).reshape(GATES, -1)
            m.refined = rest[n:-1].reshape(DEPTHS, BUCKETS, 2)
        return m


def _ratios(counts: np.ndarray) -> np.ndarray:
    x = np.log((counts[1::2] + 0.4) / (counts[0::2] + 0.4)) * 10
    return np.clip(np.rint(x), -80, 80).astype(np.int8)


@dataclass
class Lexicon:
    """The listed words, their counts and symbols; symbol 0 is the end of a text, 1 any word without a code."""

    words: np.ndarray  # sorted hashes
    count: np.ndarray
    symbol: np.ndarray
    code: Code
    letters: Code
    tokens: int
    types: int
    ends: int
    outside: int  # training tokens of words without a code
    once: int  # words without a code that training has once

    @property
    def new(self) -> float:
        """The share of escaped words that training has not seen; below 1, as ``once`` never passes ``outside``."""
        return (self.once + 1) / (self.outside + 2)

    def plain(self) -> tuple:
        """The fields without classes of this package, for a broadcast."""
        c = self.code
        return self.words, self.count, self.symbol, (c.length, c.start, c.node, c.bit), self.tokens, self.types, self.ends, self.outside, self.once

    @classmethod
    def of(cls, plain: tuple) -> Lexicon:
        words, count, symbol, code, *rest = plain
        return cls(words, count, symbol, Code(*code), _letter_code(), *rest)

    def __post_init__(self):
        # a table by the top bits of the hash; words that find their place taken are looked up by search
        self.shift = np.uint64(64 - max(4, (4 * len(self.words)).bit_length()))
        self.place = np.zeros(1 << int(64 - self.shift), np.int32)
        self.place[(self.words[::-1] >> self.shift).astype(np.int64)] = np.arange(len(self.words), dtype=np.int32)[::-1]

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count (0 if not listed), symbol, and whether a word is listed."""
        if not len(self.words):
            return np.zeros(len(h), np.int64), np.ones(len(h), np.int64), np.zeros(len(h), bool)
        at = self.place[(h >> self.shift).astype(np.int64)].astype(np.int64)
        on = self.words[at] == h
        miss = np.flatnonzero(~on)
        at[miss] = np.minimum(np.searchsorted(self.words, h[miss]), len(self.words) - 1)
        on[miss] = self.words[at[miss]] == h[miss]
        return np.where(on, self.count[at], 0), np.where(on, self.symbol[at], 1), on


def _letter_code() -> Code:
    order = list(dict.fromkeys([*LETTERS.encode(), *range(256)]))
    weights = [0] * 257
    for rank, byte in enumerate(order):
        weights[byte] = 1_000_000 // (rank + 2)
    weights[256] = 150_000
    return Code.of(weights)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of many texts and their counts, and for each batch sent the number of its texts under the null word."""
    held_h, held_c, size = [], [], 0

    def send():
        h, inverse = np.unique(np.concatenate(held_h), return_inverse=True)
        c = np.bincount(inverse, np.concatenate(held_c), len(h)).astype(np.int64)
        return h, c

    with np.errstate(over="ignore"):
        for batch in pieces(batches, "_text", 1 << 20):
            data, off = flat(batch["_text"])
            low = LOWER[data]
            s, e, _ = word_spans(low, off)
            h, c = np.unique(span_hash(prefix_hash(low), s, e), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([batch.num_rows], pa.int64())], ["word", "c"])
            held_h.append(h)
            held_c.append(c)
            size += len(h)
            if size > 1 << 21:
                h, c = send()
                held_h, held_c, size = [h], [c], len(h)
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([ints(h), ints(c)], ["word", "c"])
                    held_h, held_c, size = [], [], 0
        if held_h:
            h, c = send()
            yield pa.RecordBatch.from_arrays([ints(h), ints(c)], ["word", "c"])


def _contexts(h: np.ndarray, before: np.ndarray, symbol: np.ndarray, data: np.ndarray, ends: np.ndarray):
    """Tokens of all texts with their ends: their text, whether a word repeats the one before, symbols, and contexts."""
    n_rows = len(before) - 1
    per = np.diff(before) + 1
    row = np.repeat(np.arange(n_rows), per)
    first = np.cumsum(per) - per
    is_end = np.zeros(len(row), bool)
    is_end[first + per - 1] = True
    sym = np.zeros(len(row), np.int64)
    sym[~is_end] = symbol
    hashes = np.ones(len(row), np.uint64)
    hashes[~is_end] = h
    tail = np.zeros(len(row), np.uint64)
    tail[~is_end] = data[ends - 1] if len(ends) else 0
    at = np.arange(len(row)) - first[row]

    def back(x: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros_like(x)
        out[k:] = x[:-k]
        out[at < k] = 0
        return out

    one, two = back(hashes, 1), back(hashes, 2)
    # the last common word before tells the language, the last bytes of two words the kind of text
    common = np.where((sym >= 2) & (sym < 66), np.arange(len(row)), -1)
    last = np.maximum.accumulate(common) if len(common) else common
    last = back(last, 1)
    ok = (at > 0) & (last >= first[row])
    topic = np.where(ok, sym[np.maximum(last, 0)], 0).astype(np.uint64)
    style = back(tail, 1) * np.uint64(256) + back(tail, 2)
    same = (one == hashes) & ~is_end & (at > 0)
    run = back(same.astype(np.uint64), 1) * np.uint64(2) + back(same.astype(np.uint64), 2)
    contexts = [run, mix(one + np.uint64(1)), mix(one * np.uint64(3) + mix(two + np.uint64(2))), mix(two + np.uint64(5)), mix(topic * np.uint64(65536) + style + np.uint64(7))]
    return row, same, sym, [c * _ODD for c in contexts]


def _steps(code: Code, symbols: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A bit for every token that tells a repeat of the word before, and the bits of the codes of all others."""
    fresh = np.flatnonzero(~same)
    owner, node, bit, depth = code.steps(symbols[fresh])
    n = len(same)
    return np.concatenate([np.arange(n), fresh[owner]]), np.concatenate([np.full(n, REPEAT), node]), np.concatenate([same.astype(bit.dtype), bit]), np.concatenate([np.full(n, DEPTHS - 1), np.minimum(depth, DEPTHS - 2)])


def _letters(data: np.ndarray, s: np.ndarray, e: np.ndarray):
    """Bytes of words with an end each: owner, symbol and contexts."""
    n = e - s + 1
    owner = np.repeat(np.arange(len(s)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    place = s[owner] + at
    is_end = at == n[owner] - 1
    sym = data[np.minimum(place, len(data) - 1)].astype(np.int64) if len(data) else np.zeros(len(owner), np.int64)
    sym[is_end] = 256

    def back(k: int) -> np.ndarray:
        out = np.zeros(len(owner), np.uint64)
        on = at >= k
        out[on] = data[place[on] - k].astype(np.uint64) + np.uint64(1)
        return out

    a, b, c = back(1), back(2), back(3)
    two, three = a * np.uint64(512) + b, (a * np.uint64(512) + b) * np.uint64(512) + c
    return owner, sym, [c * _ODD for c in (mix(a + np.uint64(11)), mix(two + np.uint64(13)), mix(three + np.uint64(17)), mix(three * np.uint64(512) + back(4) + np.uint64(19)))]


def _parts(mixers: list[Mixer]) -> Iterator[pa.RecordBatch]:
    tables = [t for m in mixers for t in m.state()]
    for i, t in enumerate(tables):
        for b in range(-(-len(t) // BLOCK)):
            part = t[b * BLOCK : (b + 1) * BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([b], pa.int32()), pa.array([pa.compress(part.tobytes(), "lz4", asbytes=True)], pa.binary()), pa.array([part.nbytes], pa.int64())], ["table", "block", "part", "size"])


def _is_counts(table: int) -> bool:
    return table not in (N_WORD, N_WORD + 1 + len(LETTER_BITS))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum parts by block; a block of counts leaves as ratios."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for t, b, part, size in zip(*(batch[c].to_pylist() for c in ("table", "block", "part", "size")), strict=True):
            x = np.frombuffer(pa.decompress(part, size, "lz4", asbytes=True), np.int32 if _is_counts(t) else np.float64)
            x = x.astype(np.int64) if _is_counts(t) else x  # a task's counts fit 32 bits, those of all need not
            total[t, b] = total[t, b] + x if (t, b) in total else x
    for (t, b), x in total.items():
        x = _ratios(x) if _is_counts(t) else x
        yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([b], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["table", "block", "part"])


def _learned(lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = Lexicon.of(lexicon.value)
        words, letters = Mixer(word_bits(lex.tokens)), Mixer(LETTER_BITS)
        with np.errstate(over="ignore"):
            for batch in pieces(batches, "_text", CHUNK):
                data, off = flat(batch["_text"])
                low = LOWER[data]
                s, e, before = word_spans(low, off)
                h = span_hash(prefix_hash(low), s, e)
                c, symbol, _ = lex.look_up(h)
                _, same, sym, contexts = _contexts(h, before, symbol, low, e)
                words.learn(contexts, *_steps(lex.code, sym, same))
                rare = np.flatnonzero((symbol == 1) & (c <= RARE))
                rare = rare[np.unique(h[rare], return_index=True)[1]]
                _, sym, contexts = _letters(low, s[rare], e[rare])
                letters.learn(contexts, *lex.letters.steps(sym))
        yield from _parts([words, letters])

    return run


def _scored(lexicon, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = Lexicon.of(lexicon.value)
        words, letters = (Mixer.ready(*x) for x in model.value)
        total = lex.tokens + 0.5 * (lex.types + 1)
        new = lex.new
        with np.errstate(over="ignore"):
            for batch in pieces(batches, "_text", CHUNK):
                data, off = flat(batch["_text"])
                low = LOWER[data]
                s, e, before = word_spans(low, off)
                h = span_hash(prefix_hash(low), s, e)
                c, symbol, listed = lex.look_up(h)
                row, same, sym, contexts = _contexts(h, before, symbol, low, e)
                owner, node, bit, depth = _steps(lex.code, sym, same)
                lp = words.log_probability(contexts, owner, node, bit, depth)
                n = batch.num_rows
                model_part = np.bincount(row[owner], lp, n) / math.log(10)
                owner_row = np.repeat(np.arange(n), np.diff(before))
                fresh = ~np.delete(same, np.cumsum(np.diff(before) + 1) - 1)  # of the words, without the ends
                known = listed & (symbol == 1) & fresh
                model_part += np.bincount(owner_row[known], np.log10((1 - new) * c[known] / max(lex.outside, 1)), n)
                base = np.bincount(owner_row[listed], np.log10((c[listed] + 0.5) / total), n) + math.log10((lex.ends + 0.5) / total)
                listed_tokens = np.bincount(owner_row[listed], minlength=n) + (lex.ends > 0)
                # words that are not listed: their counts come by a join, the spelling's probability goes along
                rare = np.flatnonzero(~listed)
                key, first, inverse = np.unique(h[rare], return_index=True, return_inverse=True)
                held_out = np.array(batch["_held"].to_pylist(), bool)
                asked = np.zeros(len(key), bool)
                asked[inverse[held_out[owner_row[rare]]]] = True
                spelled = np.full(len(key), -30.0)
                at = rare[first[asked]]
                o, ls, ctx = _letters(low, s[at], e[at])
                steps = lex.letters.steps(ls)
                bits_lp = letters.log_probability(ctx, *steps)
                spelled[asked] = np.bincount(o[steps[0]], bits_lp, len(at)) / math.log(10) + math.log10(new)
                cut = np.searchsorted(owner_row[rare], np.arange(n + 1))
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), ints(h[rare]))
                spell = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(spelled[inverse] if len(rare) else np.zeros(0)))
                firsts = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(fresh[rare].astype(np.int8)))
                yield pa.RecordBatch.from_arrays([batch["_id"], batch["_t"], batch["_held"], ints(np.diff(before) + 1), ints(listed_tokens), ints(np.diff(off)), pa.array(base), pa.array(model_part), lists, spell, firsts], ["_id", "_t", "_held", "n_tokens", "listed", "n_bytes", "base", "model", "rare", "spelled", "fresh"])

    return run


def _least_listed(counts: DataFrame) -> int:
    """The least count of a listed word: as many whole steps of counts as hold LISTED words or fewer, from a histogram."""
    step = F.floor(16 * F.log2("c"))
    total = 0
    told = counts.groupBy(step.alias("s")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()  # 16 steps for each doubling of a count
    least = max((r["least"] for r in told), default=1) + 1
    for r in sorted(told, key=lambda r: -r["s"]):
        total += r["n"]
        if total > LISTED:
            break
        least = r["least"]
    return least


def train(texts: DataFrame, text: str) -> tuple:
    """Word counts of all training texts, the lexicon, and the mixed model, whose tables grow with the training tokens up to 2^24 slots."""
    spark = texts.sparkSession
    texts = texts.select(F.coalesce(F.col(text), F.lit("")).alias("_text"))
    raw = stored(texts.mapInArrow(_word_counts, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")), "words")
    ends = raw.filter("word IS NULL").first()
    ends = ends["c"] if ends else 0
    counts = raw.filter("word IS NOT NULL")
    told = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if(F.col("c") == 1)).first()
    top = counts.filter(F.col("c") >= _least_listed(counts)).toArrow()  # LISTED rows at most
    word, c = top["word"].to_numpy().astype(np.int64), top["c"].to_numpy().astype(np.int64)
    by_count = np.lexsort((word, -c))
    word, c = word[by_count].view(np.uint64), c[by_count]
    coded = min(CODED, len(word))
    symbol = np.where(np.arange(len(word)) < coded, np.arange(len(word)) + 2, 1)
    outside = int(told[0] - c[:coded].sum())
    order = np.argsort(word)
    code = Code.of([max(ends, 1), max(outside, 1), *c[:coded].tolist()])
    lex = Lexicon(word[order], c[order], symbol[order], code, _letter_code(), told[0] + ends, told[1] + (ends > 0), ends, outside, told[2] - int((c[:coded] == 1).sum()))
    lexicon = spark.sparkContext.broadcast(lex.plain())
    # a learning task sends whole tables, so it must read at least as many bytes of text
    tasks = max(2 * spark.sparkContext.defaultParallelism, 6 * lex.tokens // sum(8 << b for b in word_bits(lex.tokens)))
    parts = texts.coalesce(tasks).mapInArrow(_learned(lexicon), "table int, block int, part binary, size long")
    summed = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "table", "block").mapInArrow(_summed, "table int, block int, part binary")
    bits = word_bits(lex.tokens)
    n_word, n_letter = len(bits), len(LETTER_BITS)
    tables = [np.zeros(1 << b, np.int8) for b in bits] + [np.zeros(GATES * n_word + DEPTHS * BUCKETS * 2 + 1)]
    tables += [np.zeros(1 << b, np.int8) for b in LETTER_BITS] + [np.zeros(GATES * n_letter + DEPTHS * BUCKETS * 2 + 1)]
    for r in summed.collect():  # as many blocks as the tables have
        t, wide = r["table"], BLOCK // 2 if _is_counts(r["table"]) else BLOCK
        got = np.frombuffer(bytes(r["part"]), tables[t].dtype)
        tables[t][r["block"] * wide : r["block"] * wide + len(got)] = got
    model = spark.sparkContext.broadcast([(bits, tables[:n_word], tables[n_word]), (LETTER_BITS, tables[n_word + 1 : -1], tables[-1])])
    return counts, lexicon, lex, model


def score_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on documents whose crc32(id) mod 5 is not 1 and score all.

    A-Z are lower-cased; tokens are the words and one end of text. A bit tells whether a word repeats the one before;
    the others are coded: the CODED most frequent words and the end have
    codes of bits; another word is one escape and then, if training saw it, its share of the escaped tokens, or else
    its letters as bits. Each bit is predicted by hashed contexts (order 0 to 2, the word before last, a topic of last
    common word and last bytes); predictions are mixed in the logistic domain with weights chosen by how sure the
    strong contexts are, and a table by depth and prediction refines the result. Tasks learn online, predicting every
    batch before counting it; counts are summed over all tasks, weights averaged by the bits they saw.

    Counts of all words are a table of their own. Tasks hold those of the LISTED most frequent words; other words
    of a document are joined to the table, which aggregates by key and splits hot keys as any skewed join.

    Returns doc_id, _t, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte (null for an empty
    text). Null texts are empty: one end token. A null id is training data. Repeated rows count and are scored each.
    Without training texts every word is new. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), text_tag(text).alias("_t"), held(doc_id, 1).alias("_held"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    counts, lexicon, lex, model = train(rows.filter(~F.col("_held")), "_text")
    ddl = "_id long, _t long, _held boolean, n_tokens long, listed long, n_bytes long, base double, model double, rare array<long>, spelled array<double>, fresh array<tinyint>"
    scored = stored(rows.mapInArrow(_scored(lexicon, model), ddl), "scored")
    total = lex.tokens + 0.5 * (lex.types + 1)
    rare = scored.filter(F.size("rare") > 0).select("_id", "_t", F.explode(F.arrays_zip("rare", "spelled", "fresh")).alias("r"))
    rare = rare.groupBy("_id", "_t", F.col("r.rare").alias("word")).agg(F.count("*").alias("n"), F.max("r.spelled").alias("spelled"), F.sum(F.col("r.fresh").cast("long")).alias("fresh"))
    copies = scored.groupBy("_id", "_t").agg(F.count("*").alias("copies"))
    new = lex.new
    joined = rare.join(counts, "word", "left")
    seen = F.coalesce(F.col("c"), F.lit(0))
    joined = joined.groupBy("_id", "_t").agg(
        F.sum(F.when(seen > 0, F.col("n")).otherwise(0)).alias("r_known"),
        F.sum(F.col("n") * F.log10((seen + 0.5) / F.lit(total))).alias("r_base"),
        F.sum(F.col("fresh") * F.when(seen > 0, F.log10(F.lit(1 - new) * seen / F.lit(float(max(lex.outside, 1))))).otherwise(F.col("spelled"))).alias("r_model"),
    )
    joined = joined.join(copies, same(joined, copies, "_id", "_t")).select(joined["_id"], joined["_t"], *[(F.col(c) / F.col("copies")).alias(c) for c in ("r_known", "r_base", "r_model")])
    narrow = scored.drop("rare", "spelled", "fresh")
    out = narrow.join(joined, same(narrow, joined, "_id", "_t"), "left").select(narrow["_id"].alias("doc_id"), narrow["_t"], *[c for c in narrow.columns if c not in ("_id", "_t")], "r_known", "r_base", "r_model")
    zero = F.lit(0.0)
    score = F.col("model") + F.coalesce("r_model", zero)
    return out.select(
        "doc_id", "_t", F.col("_held").alias("held_out"), "n_tokens", (F.col("listed") + F.coalesce("r_known", zero)).cast("long").alias("n_known"),
        F.lit(lex.tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("r_base", zero)).alias("base_score"), score.alias("score"),
        F.when(F.col("n_bytes") > 0, -score / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte"),
    )
