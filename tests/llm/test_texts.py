"""Operators on single texts: scores, rules, classifier."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallgrass.llm import divergence, mixing_lm, textops, trees
from tallgrass.llm.common import table
from .helpers import no_documents, odd_documents, words
from .helpers import words as words_of


def test_word_hashes_follow_words():
    texts = ["A b\tc", None, "", "b  C a", "é x é"]
    h, before = textops.word_hashes(*textops.flat(pa.array(texts)))
    flat = [w for t in texts for w in words(t)]
    assert len(h) == len(flat) and list(np.diff(before)) == [len(words(t)) for t in texts]
    assert len({int(x) for x in h}) == len(set(flat))
    assert all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))


def test_mixing_score_base_and_held_out(spark):
    docs, rows = odd_documents(spark)
    got = mixing_lm.score_documents(docs).toPandas()
    assert len(got) == len(rows)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    count = Counter(w for r in rows if not held(r[0]) for w in [*words(r[1]), None])
    n, v = sum(count.values()), len(count)
    base = lambda t: sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*words(t), None])
    want = sorted((len(words(r[1])) + 1, sum(count[w] > 0 for w in [*words(r[1]), None]), round(base(r[1]), 6), held(r[0])) for r in rows)
    assert sorted((a, b, round(c, 6), d) for a, b, c, d in zip(got.n_tokens, got.n_known, got.base_score, got.held_out)) == want
    assert set(got.train_tokens) == {n} and np.isfinite(got.score).all() and (got.score < 0).all()


def test_mixing_learns(spark):
    text = "the cat sat on the mat and the dog lay on the rug "
    docs = spark.createDataFrame([(i, text * 20) for i in range(60)], "doc_id long, text string")
    got = mixing_lm.score_documents(docs).toPandas()
    held = got[got.held_out]
    assert len(held) and (held.score > held.base_score / 3).all()


def test_mixing_without_training_or_rows(spark):
    assert mixing_lm.score_documents(no_documents(spark)).count() == 0
    one = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = mixing_lm.score_documents(spark.createDataFrame([(one, "a b")], "doc_id long, text string")).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0) and math.isfinite(row["score"])


def test_probabilities_of_a_code_sum_to_one():
    bits = (4, 8, 8)
    r = np.random.default_rng(1)
    m = mixing_lm.Mixer.ready(bits, [r.integers(-20, 20, 1 << b).astype(np.int8) for b in bits], np.zeros(1))
    code = mixing_lm.Code.of([5, 3, 2, 2, 1])
    owner, node, bit, depth = code.steps(np.arange(5))
    contexts = [np.full(5, k, np.uint64) for k in range(3)]
    with np.errstate(over="ignore"):
        lp = m.log_probability(contexts, owner, node, bit, depth)
    assert math.isclose(sum(math.exp(lp[owner == s].sum()) for s in range(5)), 1, rel_tol=1e-4)


def _base(text):
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    g = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if g[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w)


def test_divergence_base_rules(spark):
    docs, rows = odd_documents(spark)
    got = divergence.judge(docs).toPandas()
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(map(tuple, got[columns].itertuples(index=False))) == sorted(_base(r[1]) for r in rows)
    assert not got[got.base_failed].kept.any()
    assert divergence.judge(no_documents(spark)).count() == 0


def test_divergence_drops_what_is_far(spark):
    r = random.Random(1)
    common = divergence.COMMON_WORDS["en"]
    text = lambda i: ". ".join(" ".join(r.choice(common) if r.random() < 0.3 else f"word{'abcdefghij'[j % 10]}{r.choice('xyz')}" for j in range(12)) for _ in range(10))
    rows = [(i, text(i), "en") for i in range(30)]
    rows.append((99, " ".join(f"W{j * 7}### X{j}$$$ |{j}%%%" for j in range(90)), "en"))
    got = {r["doc_id"]: r["kept"] for r in divergence.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[99] and all(got[i] for i in range(30))


def test_js_distance(spark):
    row = spark.sql("SELECT array(0.5D, 0.5D, 0D) p, array(0D, 0D, 1D) q").select(divergence.js_distance(*map(__import__("pyspark.sql.functions", fromlist=["col"]).col, "pq")).alias("d")).first()
    assert math.isclose(row["d"], 1)


def test_trees_on_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = trees.classify(docs, trees.train(docs, labels)).join(labels, "doc_id").toPandas()
    got = got[[zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]]
    assert ((got.score >= 0.3) == (got.quality == 1)).mean() > 0.9


def test_trees_odd_rows(spark):
    docs, rows = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (777, 1)], "doc_id long, quality int")
    forest = trees.train(docs, labels)
    got = trees.classify(docs, forest).toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all()
    assert trees.classify(no_documents(spark), forest).count() == 0
    none = trees.train(docs, labels.limit(0))
    assert set(trees.classify(docs, none).toPandas().score) == {0.5}
    assert trees.keep_scored(docs, none).columns == docs.columns


def test_forest_traversal_matches_nodes():
    r = np.random.default_rng(0)
    x = r.normal(size=(300, 4))
    y = (x[:, 1] > 0.3).astype(float)
    f = trees.fit(x, y, trees=10, depth=3)
    for row, got in zip(x[:20], f.score(x[:20])):
        total = f.start
        for t in range(10):
            node = 0
            while node < 7:
                node = 2 * node + 1 + int(row[f.feature[t, node]] > f.threshold[t, node])
            total += f.leaf[t, node - 7]
        assert math.isclose(got, 1 / (1 + math.exp(-total)), rel_tol=1e-9)
    assert ((f.score(x) > 0.5) == y).mean() > 0.95


@pytest.mark.parametrize("column", [pa.array([], pa.string()), pa.array([None, ""], pa.string())])
def test_features_of_nothing(column):
    x = trees.features(column)
    assert x.shape == (len(column), len(trees.FEATURES)) and np.isfinite(x).all()


def test_model_score_by_a_scalar_version(spark):
    """Every bit of a text predicted one by one in plain Python, from the tables that training gave."""
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    texts = [" ".join(r.choice(vocab[: r.choice([5, 60])]) for _ in range(120)) for _ in range(40)]
    asked = ["w1 w2 w2 w2 never Seen w59, w3", "", "W1\tw1 w4 élan"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    _, lexicon, lex, model = mixing_lm.train(docs, "text")
    words, letters = (mixing_lm.Mixer.ready(*x) for x in model.value)
    mask = (1 << 64) - 1
    odd, spread = int(mixing_lm._ODD), 0xD6E8FEB86659FD93

    def mix(h):
        h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & mask
        h = (h ^ (h >> 27)) * 0x94D049BB133111EB & mask
        return h ^ (h >> 31)

    def bit_log(m, contexts, node, bit, depth):
        x = []
        for c, b, table in zip(contexts, m.bits, m.ratio):
            slot = ((c + (node >> 3) * spread) * odd & mask) >> (64 - b)
            x.append(0.1 * float(table[slot ^ (node & 7)]))
        sure = [min(int(min(abs(x[j]) * 0.7, 3)), 3) for j in (1, 2)]
        s = max(-12.0, min(12.0, sum(w * v for w, v in zip(m.weights[sure[0] * 4 + sure[1]], x))))
        place = round((s + 12) * 32 / 24)
        centre = 1 / (1 + math.exp(-(-12 + 24 * place / 32)))
        seen = m.refined[min(depth, mixing_lm.DEPTHS - 1), place]
        p = (1 / (1 + math.exp(-s)) + (seen[1] + 20 * centre) / (seen.sum() + 20)) / 2
        return math.log(p if bit else 1 - p)

    def path(code, symbol):
        a = int(code.start[symbol])
        return [(int(code.node[a + k]), int(code.bit[a + k]), k) for k in range(int(code.length[symbol]))]

    def hashed(word):
        a = np.frombuffer(word, np.uint8)
        with np.errstate(over="ignore"):
            return int(mixing_lm.span_hash(mixing_lm.prefix_hash(a), np.array([0]), np.array([len(a)]))[0])

    def score(text):
        tokens = [w.encode() for w in words_of(text)]
        symbol = []
        for w in tokens:
            at = int(np.searchsorted(lex.words, np.uint64(hashed(w))))
            known = at < len(lex.words) and int(lex.words[at]) == hashed(w)
            symbol.append((int(lex.symbol[at]), int(lex.count[at])) if known else (1, 0))
        total, runs, topic = 0.0, [], 0
        for i in range(len(tokens) + 1):
            end = i == len(tokens)
            back = lambda k: hashed(tokens[i - k]) if i >= k else 0
            tail = lambda k: tokens[i - k][-1] if i >= k else 0
            if i and 2 <= symbol[i - 1][0] < 66:
                topic = symbol[i - 1][0]
            run = (runs[-1] if runs else 0) * 2 + (runs[-2] if len(runs) > 1 else 0)
            style = tail(1) * 256 + tail(2)
            contexts = [run, mix((back(1) + 1) & mask), mix((back(1) * 3 + mix((back(2) + 2) & mask)) & mask), mix((back(2) + 5) & mask), mix((topic * 65536 + style + 7) & mask)]
            same = int(not end and i > 0 and tokens[i] == tokens[i - 1])
            runs.append(same)
            total += bit_log(words, contexts, mixing_lm.REPEAT, same, mixing_lm.DEPTHS - 1)
            if same:
                continue
            s, c = (0, 0) if end else symbol[i]
            for node, bit, depth in path(lex.code, s):
                total += bit_log(words, contexts, node, bit, min(depth, mixing_lm.DEPTHS - 2))
            if s != 1:
                continue
            new = lex.new
            if c:
                total += math.log((1 - new) * c / max(lex.outside, 1))
                continue
            total += math.log(new)
            w = tokens[i]
            for k in range(len(w) + 1):
                ch = [w[k - j] + 1 if k >= j else 0 for j in (1, 2, 3, 4)]
                three = (ch[0] * 512 + ch[1]) * 512 + ch[2]
                ctx = [mix(ch[0] + 11), mix(ch[0] * 512 + ch[1] + 13), mix(three + 17), mix(three * 512 + ch[3] + 19)]
                for node, bit, depth in path(lex.letters, w[k] if k < len(w) else 256):
                    total += bit_log(letters, ctx, node, bit, depth)
        return total / math.log(10)

    n = len(asked)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([0] * n), pa.array([True] * n), pa.array(asked)], ["_id", "_t", "_held", "_text"])
    out = next(mixing_lm._scored(lexicon, model)(iter([batch]))).to_pylist()
    for text, row in zip(asked, out, strict=True):
        got = row["model"] + sum(x for x, fresh in zip(row["spelled"], row["fresh"], strict=True) if fresh)
        assert abs(got - score(text)) < 1e-4 * max(1, abs(got)), (text, got, score(text))


def _corpus(types, tokens=20_000, seed=0):
    """Texts of words whose counts fall by rank, every word there once at least."""
    r = np.random.default_rng(seed)
    ids = np.concatenate([np.arange(types), np.minimum(r.zipf(1.3, tokens), types) - 1])
    r.shuffle(ids)
    return [" ".join(f"w{i}" for i in part) for part in np.array_split(ids, 60)]


@pytest.mark.parametrize("types", [300, 9_000, 30_000])
def test_mixing_scores_are_log_probabilities(spark, types):
    texts = [*_corpus(types), "", "never seen before", "w1 unseenword w2"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "doc_id long, text string")
    got = mixing_lm.score_documents(docs).toPandas()
    assert len(got) == 2 * len(texts) and np.isfinite(got.score).all() and (got.score < 0).all() and np.isfinite(got.base_score).all()


def test_mixing_scores_of_the_given_documents(spark):
    got = mixing_lm.score_documents(table(spark, "/root/testdata/sf0.001", "documents")).toPandas()
    assert np.isfinite(got.score).all() and (got.score < 0).all() and got.bits_per_byte.max() < 16


@pytest.mark.parametrize("types", [40, 9_000])
def test_mixing_shares_of_escaped_words_sum_to_one(spark, types):
    """A token is coded by bits, whose two values always sum to one; an escaped word then has its share, or that of all new ones."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(_corpus(types, 3_000))], "text_id long, text string")
    counts, lexicon, lex, model = mixing_lm.train(docs, "text")
    coded = {int(w) for w, s in zip(lex.words, lex.symbol) if s > 1}
    rest = [r["c"] for r in counts.collect() if (r["word"] % (1 << 64)) not in coded]
    assert sum(rest) == lex.outside and sum(c == 1 for c in rest) == lex.once and 0 < lex.new < 1
    assert sum((1 - lex.new) * c / max(lex.outside, 1) for c in rest) + lex.new <= 1 + 1e-9
    asked = ["w1", "w2", "zz"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3)), pa.array([0] * 3), pa.array([True] * 3), pa.array(asked)], ["_id", "_t", "_held", "_text"])
    assert all(r["model"] < 0 and all(x < 0 for x in r["spelled"]) for r in next(mixing_lm._scored(lexicon, model)(iter([batch]))).to_pylist())


def test_mixing_counts_pass_31_bits():
    tables = [np.array([1_500_000_000, 7] * (mixing_lm.BLOCK // 2), np.int32)]
    part = pa.compress(tables[0].tobytes(), "lz4", asbytes=True)
    batch = pa.RecordBatch.from_arrays([pa.array([0, 0], pa.int32()), pa.array([0, 0], pa.int32()), pa.array([part, part], pa.binary()), pa.array([tables[0].nbytes] * 2, pa.int64())], ["table", "block", "part", "size"])
    out = next(mixing_lm._summed(iter([batch]))).to_pylist()[0]
    assert set(np.frombuffer(out["part"], np.int8)) == {-80}
