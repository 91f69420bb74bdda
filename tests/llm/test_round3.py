"""Whitening, toxicity and tokenizer alignment against brute force."""

import base64
import bisect
import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa

from tallgrass.llm import alignment, queries, toxicity, whitening
from tallgrass.llm.common import table
from tallgrass.llm.queries import tokenizer_file
from .helpers import no_documents, odd_documents

SF = "/root/testdata/sf0.001"


def brute_alignment(texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum and digest of every text, by whole-text encoding and pairwise overlap."""
    import sentencepiece
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    tk.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    letters = alignment.byte_level_letters()
    found = []
    for t in texts:
        a = tk.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t, num_threads=1) if t else []
        x = [bytes(letters[c] for c in tk.id_to_token(i)) for i in a]
        y = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(x) != (" " + t).encode() or b"".join(y) != (" " + t).encode():
            found.append(None)
            continue
        spans = []
        for tokens in (x, y):
            at, mine = 0, []
            for k in tokens:
                mine.append((at, at + len(k)))
                at += len(k)
            spans.append(mine)
        # two pointers over the overlaps
        links, j = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = [([], []) for _ in both]
        for side, ids in enumerate((a, b)):
            for (_, e), i in zip(spans[side], ids, strict=True):
                groups[bisect.bisect_left(both, e)][side].append(str(i))
        told = ";".join(f"{','.join(p)}|{','.join(q)}" for p, q in groups)
        found.append((len(a), len(b), len(both), links, hashlib.sha256(told.encode()).hexdigest()))
    count = Counter(p for f in found if f for p in set(f[3]))
    best = {}
    for (a, _), c in count.items():
        best[a] = max(best.get(a, 0), c)
    return [(*f[:3], len(f[3]), sum(count[p] == best[p[0]] for p in f[3]), sum(count[p] for p in f[3]), f[4]) if f else (0, 0, 0, 0, 0, 0, "") for f in found]


ODD = [
    " ", "  two  spaces  ", "\nline\n\nlines \n end\n", "tab\tand\r\nreturn", "a\u0085b \u0085 c d 　e", "don't we'll 'S it's", "x▁y and more", "<|endoftext|> </s> <s> <0x0A>", "日本語 の テキスト 、です", "é é ​﻿", "\U0001f600 \U0001f468‍\U0001f469 ok", "\x00\x01 z \x7f q",
    "12345 6,789.00 ½ ²", "a   b c   d", "“quoted” — dash …", "((((()))))  ;;\n;;", "AbC" * 500, " lead", "trail ", "\n", "\t x",
]


def test_alignment_by_brute_force(spark):
    docs, rows = odd_documents(spark)
    r = random.Random(5)
    odd = [*ODD, *("".join(r.choice("ab \n\té ▁'’1. ") for _ in range(r.randrange(1, 60))) for _ in range(300)), *(" ".join(r.choice(ODD) for _ in range(6)) for _ in range(60))]
    more = [(i + 1000, t, "en", "s", 1, 1, "k", 0.5, 1, "t") for i, t in enumerate(odd)]
    docs, rows = docs.union(spark.createDataFrame(more, docs.schema)), rows + more
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    key = lambda x: tuple((v is None, v) for v in x)
    want = sorted(((r[0], *m) for r, m in zip(rows, brute_alignment([r[1] or "" for r in rows]), strict=True)), key=key)
    for most in (alignment.SLICE, 200):  # one slice, and several
        got = sorted((tuple(r) for r in alignment.align_texts(docs, *files, slice_pairs=most).select("doc_id", *names).collect()), key=key)
        assert got == want
    assert alignment.align_texts(no_documents(spark), *files).count() == 0
    assert {r["groups_sha256"] for r in alignment.align_texts(docs.filter("text = ''"), *files).collect()} == {""}


def test_alignment_of_the_given_documents(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_token_alignment(spark, SF).collect()}
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert got == {r["doc_id"]: m for r, m in zip(rows, brute_alignment([r["text"] or "" for r in rows]), strict=True)}


def test_alignment_forgets_and_parts_chunks_with_one_hash(monkeypatch):
    aligner = alignment.Aligner(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    column = pa.array(["one two three\nfour", None, "", "two three two", "x▁y"])
    want = aligner.measure(column)
    assert want[0][3].tolist()[:2] == [3, 3] and want[0][[1, 2, 4]].sum() == 0 and want[1][4] == ""
    monkeypatch.setattr(alignment, "REMEMBERED", 0)
    for a, b in zip(aligner.measure(column), want, strict=True):
        assert list(np.ravel(a)) == list(np.ravel(b))
    monkeypatch.setattr(alignment, "REMEMBERED", 10)
    aligner.other = aligner.other ^ np.uint64(1)  # what is remembered seems to be of other chunks
    for a, b in zip(aligner.measure(column), want, strict=True):
        assert list(np.ravel(a)) == list(np.ravel(b))


def test_byte_level_letters_match_the_ranks():
    import public_tokenizers

    letters = alignment.byte_level_letters()
    assert sorted(letters.values()) == list(range(256))
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = dict(map(bytes.split, f))
    aligner = alignment.Aligner(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    assert {base64.b64decode(k): int(v) for k, v in ranks.items()} == {b: i for i, b in enumerate(aligner.a_table.bytes)}


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, w int")


def brute_whitening(rows):
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    fit = sorted({tuple(int(a) for a in x) for _, x in good})
    n, d = len(fit), len(fit[0])
    total = [sum(x[j] for x in fit) for j in range(d)]
    y = [[n * x[j] - total[j] for j in range(d)] for x in fit]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)])
    values, parts = np.linalg.eigh(v)
    return n, total, [(i, x, sum((n * int(a) - s) ** 2 for a, s in zip(x, total))) for i, x in good], values[::-1], parts[:, ::-1], v


def test_whitening_by_brute_force(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(150, 6)) @ r.normal(size=(6, 6)) + 0.3
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base.astype(np.float32))]
    rows += [(200 + i, rows[7][1]) for i in range(40)] + [(None, rows[8][1]), (7, rows[9][1])]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5), (904, []), (905, [1.0, 2.0])]
    got = whitening.whiten(_vectors(spark, [(*x, "q", 1) for x in rows + bad])).toPandas()
    n, total, mine, values, parts, v = brute_whitening(rows)
    assert len(got) == 4 * len(mine) and set(got.n) == {n} == {150} and got.identity_error.max() < 1e-9
    assert Counter(zip(got.vec_id.fillna(-1), got.deviation)) == Counter({k: 4 * c for k, c in Counter((-1 if i is None else i, far) for i, _, far in mine).items()})
    for c in range(4):
        part = got[got.component == c + 1]
        assert np.allclose(part.explained, values[c] / np.trace(v), rtol=1e-12)
        want = sorted((np.array(x) - np.array(total) / n) @ parts[:, c] / np.sqrt(values[c]) for _, x, _ in mine)
        have = sorted(part.whitened)
        assert np.allclose(have, want, atol=1e-9) or np.allclose(have, sorted(-np.array(want)), atol=1e-9)


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(_vectors(spark, [])).count() == 0
    assert whitening.whiten(_vectors(spark, [(1, None, "q", 1), (2, [float("nan")], "q", 1)])).count() == 0
    same = whitening.whiten(_vectors(spark, [(i, [1.0, 2.0], "q", 1) for i in range(5)])).collect()
    assert len(same) == 10 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same} == {(1, 0, None, 0.0, None)}
    line = whitening.whiten(_vectors(spark, [(i, [float(i), 2.0], "q", 1) for i in range(5)])).toPandas()
    assert line[line.component == 2].whitened.isna().all() and np.allclose(sorted(line[line.component == 1].whitened), np.array([-2, -1, 0, 1, 2]) / np.sqrt(2))
    huge = whitening.whiten(_vectors(spark, [(i, [1e12 * i, 1.0 + i % 2], "q", 1) for i in range(4)])).toPandas()
    assert huge.deviation.isna().all() and huge.identity_error.max() < 1e-4


def test_squares_are_exact_beyond_64_bits():
    r = np.random.default_rng(1)
    for size in (1 << 20, 1 << 49, 1 << 61):
        y = r.integers(-size, size, (1200, 3))
        want = [sum(int(v) ** 2 for v in y[:, i]) for i in range(3)] + [sum((int(a) + int(b)) ** 2 for a, b in zip(y[:, i], y[:, j])) for i, j in ((0, 1), (0, 2), (1, 2))]
        assert whitening.exact_squares(y) == want
    x = np.array([[1 << 40, -(1 << 40)]])
    assert whitening.centred(x, 1 << 30, [5, -5]).tolist() == [[(1 << 70) - 5, -(1 << 70) + 5]]


def _distance(a, b, prefix):
    """Fewest edits from ``a`` to ``b``, or to any beginning of ``b``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return min(row) if prefix else row[-1]


def _next(row, i, x, b):
    new = [i]
    for j, y in enumerate(b, 1):
        new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
    return new


def test_automaton_meets_what_edit_distance_meets():
    r = random.Random(2)
    terms = [("abcab", True), ("abca", True), ("bbaab", False), ("cab", False), ("accbab", True), ("abcabcc", False), ("aaaaaa", False)]
    automaton = toxicity.Automaton.of(terms)
    words = ["".join(r.choice("abcd") for _ in range(r.randrange(1, 10))) for _ in range(4000)] + [t for t, _ in terms] + [""]
    kinds = automaton.classes()[np.array([ord(c) for c in "".join(words)])]
    ends = np.cumsum([len(w) for w in words])
    exact, near = automaton.run(kinds, ends - [len(w) for w in words], ends)
    for w, x, n in zip(words, exact, near, strict=True):
        d = [_distance(t, w, open_end) if w else 99 for t, open_end in terms]
        zero = [i for i, v in enumerate(d) if v == 0]
        one = [i for i, v in enumerate(d) if v <= 1 and len(terms[i][0]) >= toxicity.FUZZY]
        assert (x >= 0) == bool(zero) and (x < 0 or x in zero and len(terms[x][0]) == max(len(terms[i][0]) for i in zero)), w
        assert (n >= 0) <= bool(one) and (n < 0 or n in one), w
        assert n >= 0 or x >= 0 or not one, w


def test_hits_and_cues():
    matcher = toxicity.Matcher(toxicity.Automaton.of([("idiot", True), ("scum", False)]))
    texts = [None, "", 'He said "you IDIOT!" to me', "", "idi0ts ## scum## and\tscums", "--- ... é"]
    h = matcher.hits(pa.array(texts))
    assert h.row.tolist() == [2, 4, 4] and h.term.tolist() == [0, 0, 1] and h.edits.tolist() == [0, 1, 0] and h.words.tolist() == [0, 0, 6, 0, 5, 2 + 1]
    assert {"said", "you", "to", "me", "he", " quoted", " alone"} == set(h.cues[0]) and " others" in h.cues[1] and " plain" in h.cues[1]


def test_choice_of_terms():
    rows = [("idio", True, 50, 0), ("idiot", True, 50, 0), ("idiot", False, 50, 0), ("idiots", False, 10, 0), ("them", True, 50, 400), ("rare", False, 1, 0), ("lich", True, 60, 40), ("lichxx", False, 30, 0)]
    chosen = toxicity.choose_terms(rows, 60, 500)
    assert ("idiot", True) in chosen and ("idio", True) not in chosen and ("them", True) not in chosen and ("rare", False) not in chosen and ("lichxx", False) in chosen


def test_toxicity_held_out(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = {r["doc_id"]: r for r in queries.op12_toxicity_automata(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    known = [(got[r["doc_id"]], r["toxic"]) for r in labels.collect() if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert sum(p["predicted"] == y for p, y in known) >= 0.93 * len(known)


def test_toxicity_misspelled_and_quoted(spark):
    r = random.Random(4)
    plain = [f"w{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(400):
        w = [r.choice(plain) for _ in range(40)]
        if i % 4 == 0:
            w[r.randrange(5, 35)] = r.choice(["moronic", "moronic", "filthbag"])
        if i % 8 == 1:
            at = r.randrange(5, 35)
            w[at : at + 3] = ["says", '"moronic"', "reported"]
        rows.append((i, " ".join(w)))
        labels.append((i, 0, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    around = [r.choice(plain) for _ in range(20)], [r.choice(plain) for _ in range(20)]
    texts = [" ".join([*around[0], *mid, *around[1]]) for mid in (["moronic"], ["mornic!"], ["says", '"moronic"', "reported"], ["w1"])]
    score = {x["doc_id"]: x["score"] for x in toxicity.classify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert score[0] > 0.5 > score[2] and score[3] < 0.1 and score[0] > score[1] >= score[3]


def test_toxicity_odd_rows(spark):
    docs, rows = odd_documents(spark)
    labels = spark.createDataFrame([(i, i % 2, [0, 1, None, 7][i % 4]) for i in range(len(rows))] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs, toxicity.train(docs, labels))
    assert got.count() == len(rows) and got.filter("score between 0 and 1").count() == len(rows)
    for none in (no_documents(spark), docs.limit(0)):
        assert toxicity.classify(none, toxicity.train(none, labels)).count() == 0
    assert toxicity.classify(docs, toxicity.train(docs, labels.limit(0))).count() == len(rows)
