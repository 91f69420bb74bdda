"""Toxicity: a learned lexicon's trie met by Levenshtein automata, and scores of the words around a hit."""

from __future__ import annotations

import unicodedata
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, discard, held, stored, text_tag
from .textops import flat, pieces

#: Letters that a stem has at least and at most; letters from which a term may have one edit; words of a window on each side.
STEM, LONGEST, FUZZY, WINDOW = 4, 12, 5, 5
#: Terms of the lexicon and cues of the window that are kept, at most.
TERMS, CUES = 400, 4000
# Quotation marks.
QUOTES = "\"“”„‟«»‹›「」『』"
_FOLDED = 0x20000


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of every code point that has one of its own, and whether it belongs to a word when at its edge."""
    low = np.arange(0x110000, dtype=np.uint32)
    inner = np.ones(0x110000, bool)
    for i in range(_FOLDED):
        c = chr(i)
        inner[i] = c.isalnum() or unicodedata.category(c)[0] == "M"
        if len(x := c.lower()) == 1:
            low[i] = ord(x)
    return low, inner


@dataclass
class Automaton:
    """Deterministic union of the Levenshtein automata of a lexicon, run over its trie.

    State 0 is dead, 1 the start. ``step`` has a row of next states for each state, by letter class; class 0 is any
    letter that no term has. ``stem`` and ``word`` tell, for no edit and for one, the longest term that has been met at a
    state: as the beginning of a word, and as a whole one; -1 none.
    """

    letters: np.ndarray  # sorted code points of classes 1, 2, ...
    step: np.ndarray
    stem: np.ndarray  # states x 2
    word: np.ndarray

    @classmethod
    def of(cls, terms: list[tuple[str, bool]]) -> Automaton:
        """From (letters, whether any ending may follow). Terms of FUZZY letters or more may have one edit."""
        children: list[dict[str, int]] = [{}]
        ends: list[list[tuple[int, bool]]] = [[]]
        edits = [0]
        for t, (text, open_end) in enumerate(terms):
            node, most = 0, int(len(text) >= FUZZY)
            edits[0] = max(edits[0], most)
            for c in text:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ends.append([])
                    edits.append(0)
                node = children[node][c]
                edits[node] = max(edits[node], most)
            ends[node].append((t, open_end))

        def closed(at: dict[int, int]) -> frozenset[tuple[int, int]]:
            """With the nodes that are reached by leaving out one letter of a term."""
            out = dict(at)
            for node, e in at.items():
                if e == 0:
                    for child in children[node].values():
                        if edits[child] and out.get(child, 2) > 1:
                            out[child] = 1
            return frozenset(out.items())

        alphabet = sorted({c for t, _ in terms for c in t})
        number = {c: i + 1 for i, c in enumerate(alphabet)}
        start = closed({0: 0})
        states, todo = {frozenset(): 0, start: 1}, deque([start])
        rows: list[list[int]] = [[0] * (len(alphabet) + 1), []]

        def after(state: frozenset, c: str | None) -> int:
            out: dict[int, int] = {}
            for node, e in state:
                if c in children[node]:
                    child = children[node][c]
                    if edits[child] >= e and out.get(child, 2) > e:
                        out[child] = e
                if e == 0 and edits[node]:
                    for x in (node, *(n for k, n in children[node].items() if k != c)):
                        if edits[x] and out.get(x, 2) > 1:
                            out[x] = 1
            key = closed(out)
            if key not in states:
                states[key] = len(states)
                rows.append([])
                todo.append(key)
            return states[key]

        while todo:
            state = todo.popleft()
            other = after(state, None)
            row = [other] * (len(alphabet) + 1)
            for c in {c for node, _ in state for c in children[node]}:
                row[number[c]] = after(state, c)
            rows[states[state]] = row
        stem, word = np.full((len(states), 2), -1, np.int32), np.full((len(states), 2), -1, np.int32)
        length = [len(t) for t, _ in terms]
        for state, i in states.items():
            for node, e in state:
                for t, open_end in ends[node]:
                    if e > int(length[t] >= FUZZY):
                        continue
                    for table in (stem, word) if open_end else (word,):
                        if table[i, e] < 0 or length[table[i, e]] < length[t]:
                            table[i, e] = t
        return cls(np.array([ord(c) for c in alphabet], np.uint32), np.array(rows, np.int32).reshape(len(states), -1), stem, word)

    def classes(self) -> np.ndarray:
        out = np.zeros(0x110000, np.uint8 if len(self.letters) < 255 else np.uint16)
        out[self.letters] = np.arange(1, len(self.letters) + 1)
        return out

    def run(self, kinds: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the words kinds[start:end], all at once letter by letter: the term met without an edit, and with one (-1: none)."""
        exact, near = np.full(len(start), -1, np.int32), np.full(len(start), -1, np.int32)
        active = np.flatnonzero(end > start)
        at, stop, state = start[active], end[active], np.ones(len(active), np.int32)
        while len(active):
            state = self.step[state, kinds[at]]
            at = at + 1
            for found, table in ((exact, 0), (near, 1)):
                t = self.stem[state, table]
                hit = np.flatnonzero(t >= 0)
                found[active[hit]] = t[hit]
            done = np.flatnonzero(at == stop)
            for found, table in ((exact, 0), (near, 1)):
                t = self.word[state[done], table]
                found[active[done[t >= 0]]] = t[t >= 0]
            go = np.flatnonzero((at < stop) & (state != 0))
            active, at, stop, state = active[go], at[go], stop[go], state[go]
        return exact, near


@dataclass
class Hits:
    """Hits in a column of texts: the text, the term and its edits, and the cues of its window."""

    row: np.ndarray
    term: np.ndarray
    edits: np.ndarray
    cues: list[list[str]]
    words: np.ndarray  # for each text


class Matcher:
    def __init__(self, automaton: Automaton, use: np.ndarray | None = None):
        """``use`` tells for every term, without and with an edit, whether it counts."""
        self.automaton, self.use = automaton, use
        self.low, self.inner = _letters()
        self.kinds = automaton.classes()

    def hits(self, column: pa.Array) -> Hits:
        data, off = flat(column)
        text = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
        ahead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        cut = ahead[off] if ahead[-1] == len(text) else np.concatenate([[0], np.cumsum([len(t or "") for t in column.to_pylist()])])
        n, size = len(off) - 1, len(text)
        word = ~((text == 32) | ((text >= 9) & (text <= 13)))
        edge = np.zeros(size + 1, bool)
        edge[cut] = True
        begin, stop = word.copy(), word.copy()
        begin[1:] &= ~word[:-1] | edge[1:size]
        stop[:-1] &= ~word[1:] | edge[1:size]
        s, e = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        low = self.low[text]
        inner = self.inner[text]
        place = np.arange(size)
        following = np.minimum.accumulate(np.where(inner, place, size)[::-1])[::-1] if size else place
        before = np.maximum.accumulate(np.where(inner, place, -1)) if size else place
        a = np.minimum(following[s], e) if len(s) else s
        b = np.maximum(before[e - 1] + 1, a) if len(s) else e
        exact, near = self.automaton.run(self.kinds[low], a, b)
        if self.use is not None:
            exact = np.where((exact >= 0) & self.use[np.maximum(exact, 0), 0], exact, -1) if len(self.use) else exact
            near = np.where((near >= 0) & self.use[np.maximum(near, 0), 1], near, -1) if len(self.use) else near
        at = np.flatnonzero((exact >= 0) | (near >= 0))
        ahead_words = np.searchsorted(s, cut)
        row = np.searchsorted(cut, s[at], side="right") - 1
        # rows of empty texts share their cut; the last of them is the one that has the word
        term, edits = np.where(exact[at] >= 0, exact[at], near[at]), (exact[at] < 0).astype(np.int64)
        is_hit = np.zeros(len(s), bool)
        is_hit[at] = True
        cues = []
        for i, r in zip(at.tolist(), row.tolist(), strict=True):
            first, last = max(i - WINDOW, int(ahead_words[r])), min(i + WINDOW + 1, int(ahead_words[r + 1]))
            mine = {low[a[j] : b[j]].tobytes().decode("utf-32-le", "replace") for j in range(first, last) if j != i and not is_hit[j]}
            left, right = text[s[first] : a[i]].tobytes().decode("utf-32-le", "replace"), text[b[i] : e[last - 1]].tobytes().decode("utf-32-le", "replace")
            quoted = any(q in left for q in QUOTES) and any(q in right for q in QUOTES)
            mine.discard("")
            cues.append([*sorted(mine), " quoted" if quoted else " plain", " others" if is_hit[first:last].sum() > 1 else " alone"])
        return Hits(row, term, edits, cues, np.diff(ahead_words))


@dataclass
class ToxicityModel:
    """All that scoring needs: the automaton, weights of terms and cues, and the coefficients of the features."""

    terms: list[tuple[str, bool]]
    automaton: Automaton
    weight: np.ndarray  # terms x 2
    cue: dict[str, float]
    mean: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    spread: np.ndarray = field(default_factory=lambda: np.ones(len(FEATURES)))
    beta: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES) + 1))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.beta[0] + (x - self.mean) / self.spread @ self.beta[1:], -30, 30)))


FEATURES = ["exact", "near", "abuse", "worst", "terms", "words", "density", "share", "quoted", "hits"]


def features(model: ToxicityModel, h: Hits) -> np.ndarray:
    """One row of FEATURES for each text."""
    n = len(h.words)
    w = model.weight[h.term, h.edits] if len(h.term) else np.zeros(0)
    around = np.array([np.clip(sum(model.cue.get(c, 0.0) for c in cues), -4, 4) for cues in h.cues]) if len(h.term) else np.zeros(0)
    abuse = np.maximum(w + around, 0)
    quoted = np.array([" quoted" in c for c in h.cues], float) if len(h.term) else np.zeros(0)
    total = lambda v: np.bincount(h.row, v, n)
    worst = np.zeros(n)
    np.maximum.at(worst, h.row, abuse)
    pair = np.unique(h.row * np.int64(1 << 32) + h.term)
    terms = np.bincount(pair >> 32, minlength=n)
    hits, bad = total(np.ones(len(w))), total(abuse)
    return np.column_stack([
        np.log1p(total(w * (h.edits == 0))), np.log1p(total(w * (h.edits == 1))), np.log1p(bad), worst, np.log1p(terms), np.log1p(h.words),
        bad / np.sqrt(h.words + 10), np.log1p(100 * bad / (h.words + 10)), total(quoted) / np.maximum(hits, 1), np.log1p(hits),
    ])


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, spreads and coefficients (the constant first) by Newton's method."""
    mean, spread = (x.mean(0), x.std(0)) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    spread = np.where(spread > 1e-9, spread, 1)
    z = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    beta, ridge = np.zeros(z.shape[1]), np.full(z.shape[1], l2)
    ridge[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(ridge), z.T @ (y - p) - ridge * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return mean, spread, beta


def choose_terms(rows: list[tuple[str, bool, int, int]], toxic: int, clean: int, most: int = TERMS) -> list[tuple[str, bool]]:
    """The lexicon from (letters, open end, toxic texts, clean texts that have it).

    A term must be far more usual in toxic texts than in clean ones, beyond three standard errors. A stem gives way to one
    longer by a letter that is in nearly as many toxic texts; a longer term to a stem of it that tells nearly as much.
    """
    odds = {}
    for text, open_end, t, c in rows:
        gain = np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1))
        if t >= 3 and gain > 1 and gain > 3 * np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5) * (c > 0)):
            odds[text, open_end] = (gain, t)
    shortened = {}
    for (text, _), (_, t) in odds.items():
        shortened[text[:-1]] = max(shortened.get(text[:-1], 0), t)
    kept = {k: v for k, v in odds.items() if not (k[1] and shortened.get(k[0], 0) >= 0.9 * v[1])}
    out = []
    for (text, open_end), (gain, t) in kept.items():
        stems = [kept[text[:i], True][0] for i in range(STEM, len(text) + (not open_end)) if (text[:i], True) in kept]
        if not stems or gain > max(stems) + 0.3:
            out.append((-gain * np.sqrt(t), text, open_end))
    return [(text, open_end) for _, text, open_end in sorted(out)[:most]]


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_tag(text).alias("_t"), F.coalesce(F.col(text), F.lit("")).alias("_text"))


def _found(automaton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(automaton.value)
        for batch in pieces(batches, "_text", 1 << 20):
            h = matcher.hits(batch["_text"])
            y = batch["_y"].to_numpy()[h.row]
            yield pa.RecordBatch.from_arrays([pa.array(h.term, pa.int32()), pa.array(h.edits, pa.int32()), pa.array(y, pa.int32()), pa.array(h.cues, pa.list_(pa.string()))], ["term", "edits", "y", "cues"])

    return run


def _measured(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.value.automaton, model.value.weight > 0)
        for batch in pieces(batches, "_text", 1 << 20):
            x = features(model.value, matcher.hits(batch["_text"]))
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64())), batch["_y"].cast(pa.int32())], ["x", "y"])

    return run


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", most_rows: int = 8_000) -> ToxicityModel:
    """Lexicon, weights and coefficients from labelled documents whose crc32(id) mod 5 is not 0, at most ``most_rows`` of them by id hash.

    The bound holds the sample that is read three times, and so all that the driver collects: at most TERMS terms, CUES
    cues and a row of features for each labelled document. Labels that are null, other than 0 and 1, or given for a null
    id are ignored; of several labels for an id the largest counts, of several texts the one with the smallest tag.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held(doc_id, 0)).groupBy(F.col(doc_id).cast("long").alias("_k")).agg(F.max(label).cast("int").alias("_y"))
    known = known.orderBy(F.xxhash64("_k"), "_k").limit(most_rows)
    rows = _rows(docs, doc_id, text)
    sample = rows.join(F.broadcast(known), rows["doc_id"] == known["_k"]).groupBy("_k").agg(F.min_by("_text", "_t").alias("_text"), F.first("_y").alias("_y"))
    sample = stored(sample.select("_text", "_y"), "labelled")
    size = {r["_y"]: (r["n"], r["w"]) for r in sample.groupBy("_y").agg(F.count("*").alias("n"), F.sum(F.regexp_count("_text", F.lit(WORD))).alias("w")).collect()}  # two rows
    (toxic, toxic_words), (clean, clean_words) = size.get(1, (0, 0)), size.get(0, (0, 0))
    # different words of a text without what isn't a letter or digit at their edges, and the stems of each
    edges = r"^[^\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+$"
    words = F.array_distinct(F.transform(F.regexp_extract_all(F.lower("_text"), F.lit(f"({WORD})")), lambda w: F.regexp_replace(w, edges, "")))
    stems = F.array_distinct(F.flatten(F.transform("w", lambda w: F.transform(F.sequence(F.lit(STEM), F.least(F.length(w), F.lit(LONGEST))), lambda i: w.substr(F.lit(1), i)))))
    told = sample.select("_y", words.alias("w")).select("_y", F.filter("w", lambda w: F.length(w) >= STEM).alias("w"))
    both = F.concat(F.transform("w", lambda w: F.concat(w, F.lit(" "))), stems)
    counted = told.select("_y", F.explode(both).alias("term")).groupBy("term").agg(F.sum("_y").alias("t"), F.sum(1 - F.col("_y")).alias("c"))
    gain = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    # what choose_terms can take, in order of its own, a bounded number of rows
    usual = counted.filter((F.col("t") >= 3) & (gain > 1)).orderBy(-gain * F.sqrt("t"), "term").limit(50 * TERMS).collect()
    terms = choose_terms([(r["term"].rstrip(" "), not r["term"].endswith(" "), r["t"], r["c"]) for r in usual], toxic, clean)
    automaton = Automaton.of(terms)
    shared = spark.sparkContext.broadcast(automaton)
    hits = stored(sample.mapInArrow(_found(shared), "term int, edits int, y int, cues array<string>"), "hits")
    weight = np.zeros((len(terms), 2))
    for r in hits.groupBy("term", "edits").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")).collect():  # two rows a term
        w = np.log((r["t"] + 0.5) / (toxic_words + 1)) - np.log((r["c"] + 0.5) / (clean_words + 1))
        weight[r["term"], r["edits"]] = w if w > 0.7 and r["t"] >= 3 else 0
    # a hit whose term does not count has no window either
    counts = spark.createDataFrame([(i, e) for i in range(len(terms)) for e in (0, 1) if weight[i, e] > 0], "term int, edits int")
    some = hits.join(F.broadcast(counts), ["term", "edits"]).select("y", F.explode("cues").alias("cue")).groupBy("cue").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    some = some.filter(F.col("t") + F.col("c") >= 10).orderBy(-(F.col("t") + F.col("c")), "cue").limit(CUES).collect()
    everywhere = {r["cue"]: r for r in some if r["cue"].startswith(" ")}
    t_all, c_all = (sum(everywhere[k][j] for k in (" quoted", " plain") if k in everywhere) for j in ("t", "c"))
    share = (t_all + 1) / (t_all + c_all + 2)
    cue = {r["cue"]: float(np.clip(np.log((r["t"] + 20 * share) / (r["c"] + 20 * (1 - share)) * (1 - share) / share), -2, 2)) for r in some}
    model = ToxicityModel(terms, automaton, weight, cue)
    got = sample.mapInArrow(_measured(spark.sparkContext.broadcast(model)), "x array<double>, y int").toArrow()  # a row for each labelled id
    x = np.array(got["x"].to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    y = got["y"].to_numpy().astype(float) if len(x) else np.zeros(0)
    order = np.lexsort(np.column_stack([x, y]).T) if len(x) else np.zeros(0, int)
    model.mean, model.spread, model.beta = fit_logistic(x[order], y[order])
    discard(sample, hits)
    return model


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        matcher = Matcher(m.automaton, m.weight > 0)
        for batch in pieces(batches, "_text", 1 << 20):
            h = matcher.hits(batch["_text"])
            n_hits = np.bincount(h.row, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["_t"], pa.array(m.score(features(m, h))), pa.array(n_hits, pa.int64())], ["doc_id", "_t", "score", "n_hits"])

    return run


def classify(docs: DataFrame, model: ToxicityModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score the whole text of every document: doc_id, _t (tag of the text), score, 0 to 1, and n_hits, the terms met.

    Words are parted at white space, lower-cased and freed from what isn't a letter or digit at their edges. All are run
    through the automaton at once, letter by letter. A hit weighs as much as its term, without or with an edit, speaks
    for toxic texts; the words within WINDOW of it, quotation marks about it and other hits near it add to that or take
    from it, so that what is quoted counts less where training shows so. Null and empty texts are scored as texts without
    words; null ids and repeated rows like others; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return _rows(docs, doc_id, text).mapInArrow(_scores(shared), "doc_id long, _t long, score double, n_hits long")
