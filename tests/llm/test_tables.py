"""Packing, archives, mixing, and the pipeline."""

import hashlib
import io
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallgrass.llm import archives, mixing, packing, trees
from tallgrass.llm.common import with_copies
from tallgrass.llm.queries import tokenizer_file
from tallgrass.llm.textops import flat
from .helpers import brute_units, components, no_documents, odd_documents, words


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    docs, rows = odd_documents(spark)
    got = packing.pack_documents(docs, tokenizer_file(), window=64).toPandas()
    tk = Tokenizer.from_file(tokenizer_file())
    ids = [[*tk.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows]
    pieces = sorted((len(x), a, min(64, len(x) - a), zlib.crc32(np.array(x[a : a + 64], "<u4").tobytes())) for x in ids for a in range(0, len(x), 64))
    assert sorted(zip(got.doc_tokens, got.start, got.length, got.ids_crc32)) == pieces
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 64
    assert got.length.sum() / (64 * got.sequence_id.nunique()) > 0.97
    assert packing.pack_documents(no_documents(spark), tokenizer_file()).count() == 0


def test_words_give_the_tokenizers_ids():
    from tokenizers import Tokenizer

    tk, mine = Tokenizer.from_file(tokenizer_file()), packing.WordTokenizer(tokenizer_file())
    odd = ["Don't", "it's.", "é", "éa", "ÀÉ!!", "x1y2", "'s", "a'b've", " q", "a b", "ẞß", "İi", "ǆ", "²3", "日本語", "", "--", "ab́c", "ͅ", "<|endoftext|>", "a<|endoftext|>b"]
    column = pa.array([*odd, None, " ".join(odd), "\u0085a\u00a0b\u2003c d"])
    for _ in range(2):
        ids, cut = mine.encode(*flat(column))
        for i, w in enumerate(column.to_pylist()):
            assert ids[cut[i] : cut[i + 1]].tolist() == tk.encode(w or "", add_special_tokens=False).ids, w


def test_best_fill_is_best():
    r = np.random.default_rng(0)
    for _ in range(200):
        lengths = r.integers(1, 30, int(r.integers(1, 8)))
        counts = {int(n): int((lengths == n).sum()) for n in sorted(set(lengths.tolist()), reverse=True)}
        sums = {0}
        for n in lengths.tolist():
            sums |= {s + n for s in sums if s + n <= 40}
        fill = packing.best_fill(counts, 40)
        assert sum(n * k for n, k in fill) == max(sums) and all(k <= counts[n] for n, k in fill)


def _pages(spark):
    rows = [(i, f"http://h{i}/a b", t) for i, t in enumerate([None, "", "x" * 99, "x" * 99, "y" * 100, "y" * 100, "é" * 60 + "\r\n\r\nrest\nWARC/1.1\r\n", "é" * 60 + "\r\n\r\nrest\nWARC/1.1\r\n", "z" * 50_000])]
    rows += [(20, "u", "y" * 100), (20, "u", "y" * 100), (None, None, "y" * 100), (None, "n", "only null" * 20), (3, "u3", "y" * 100)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string"), rows


@pytest.mark.parametrize("files", [1, 3])
def test_archives(spark, files):
    pages, rows = _pages(spark)
    got = archives.archive_pages(pages.repartition(files)).toPandas().astype(object)
    assert len(got) == len(rows)
    for digest, group in got.groupby("payload_digest"):
        mine = [r for r in rows if hashlib.sha256((r[2] or "").encode()).hexdigest() == digest]
        n = len((mine[0][2] or "").encode())
        assert len(mine) == len(group) and set(group.payload_bytes) == {n}
        if n < 100:
            assert set(group.record_type) == {"response"}
            continue
        first = group[group.record_type == "response"]
        ids = [r[0] for r in mine if r[0] is not None]
        assert len(first) == 1 and (not ids or first.page_id.iloc[0] == min(ids))
        if ids:
            assert set(group[group.record_type == "revisit"].refers_to) <= {min(ids)}
    assert archives.archive_pages(pages.limit(0)).count() == 0


def test_both_arc_versions_are_read(spark):
    pages, rows = _pages(spark)
    for version in (1, 2):
        path = archives.new_path(spark, "arc-test")
        archives.write_arc(pages, path, version=version)
        got = archives.read_arc(spark, path)
        assert sorted((r["payload_bytes"], r["payload_digest"]) for r in got.collect()) == sorted((len((r[2] or "").encode()), hashlib.sha256((r[2] or "").encode()).hexdigest()) for r in rows)


def test_foreign_arc_file():
    text = b"filedesc://x.arc 0.0.0.0 20010101000000 text/plain 70\n1 0 Someone\nURL IP-address Archive-date Content-type Archive-length\n\n\n\n\n\n\n"
    head, rest = text.split(b"\n", 1)
    block = b"1 0 Someone\nURL IP-address Archive-date Content-type Archive-length\n"
    stream = io.BufferedReader(io.BytesIO(b"filedesc://x.arc 0.0.0.0 20010101000000 text/plain %d\n" % len(block) + block + b"\nhttp://a/b c 1.2.3.4 20010203040506 text/html 5\nhello\n\nhttp://d 1.2.3.4 20010203040506 text/html 0\n\n"))
    got = [(f["URL"], b) for f, b, _, problem in archives.arc_records(stream) if problem is None]
    assert got == [("http://a/b c", b"hello"), ("http://d", b"")]


def test_bytes_and_broken_records(spark, tmp_path):
    """Latin-1, an image, a block without HTTP, lines that are no headers, and a record that is cut."""
    image = bytes(range(256)) * 2
    http = b"HTTP/1.1 200 OK\r\nX-Page-Id: %d\r\n\r\n"
    blocks = [http % 1 + "déjà vu ".encode("latin-1") * 20, http % 2 + image, http % 3 + image, b"20010101000000\n1.2.3.4"]
    body = b"1 0 Someone\nURL IP-address Archive-date Content-type Archive-length\n"
    raw = b"filedesc://x.arc 0.0.0.0 20010101000000 text/plain %d\n" % len(body) + body
    for i, b in enumerate(blocks):
        raw += b"\nhttp://h/%d 1.2.3.4 20010203040506 text/html %d\n" % (i, len(b)) + b + b"\n"
        if i == 1:
            raw += b"\nhttp://lost 1.2.3.4 20010203040506 text/html -\nsome lines\nof nothing 7\n"
    raw += b"\nhttp://cut 1.2.3.4 20010203040506 text/html 5000\nshort"
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.arc").write_bytes(raw)
    records = archives.read_arc(spark, str(tmp_path / "a"))
    told = {r["url"]: (bytes(r["payload"]), r["problem"]) for r in records.collect()}
    assert told["http://h/0"] == ("déjà vu ".encode("latin-1") * 20, None) and told["http://h/1"] == told["http://h/2"] == (image, None)
    assert told["http://h/3"] == (blocks[3], None) and told["http://cut"] == (b"short", "cut")
    assert [u for u, (_, problem) in told.items() if problem == "no header"] == ["http://lost 1.2.3.4 20010203040506 text/html -"]
    path = archives.new_path(spark, "warc-test")
    archives.write_warc(archives.plan_revisits(records), path)
    back = sorted((r["url"], r["record_type"], r["payload_bytes"], r["payload_digest"]) for r in archives.read_warc(spark, path).collect())
    digest = lambda b: hashlib.sha256(b).hexdigest()
    assert back == [
        ("http://h/0", "response", 160, digest("déjà vu ".encode("latin-1") * 20)), ("http://h/1", "response", 512, digest(image)),
        ("http://h/2", "revisit", 512, digest(image)), ("http://h/3", "resource", 22, digest(blocks[3])),
    ]
    files = [f for f in spark.read.format("binaryFile").load(path).collect() if f["length"]]
    raw_back = b"".join(archives._stream(bytes(f["content"])).read() for f in files)
    assert image in raw_back and "déjà vu ".encode("latin-1") * 20 in raw_back


def test_mixing(spark):
    docs, rows = odd_documents(spark)
    got = mixing.mix_sources(docs).toPandas()
    assert len(got) == len(rows) and sorted(got["size"]) == sorted(len(words(r[1])) for r in rows)
    assert (got.taken <= 3 * got["size"]).all() and (got.taken == got.copies * got["size"]).all()
    assert abs(got.target.groupby(got.source_size).first().sum()) > 0
    total = got["size"].sum()
    assert got.taken.sum() <= total
    again = mixing.mix_sources(docs.repartition(3)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(str, again[key].itertuples(index=False))) == sorted(map(str, got[key].itertuples(index=False)))
    assert mixing.mix_sources(no_documents(spark)).count() == 0


def test_mixing_targets(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "abc"[i % 3] if i < 300 else "z") for i in range(310)] + [(999, None, None)], "doc_id long, text string, source string")
    got = mixing.mix_sources(docs).toPandas()
    # a 5, b 2, c 1, z 5 (capped at 300), null of size 0
    t = dict(zip(got.source_size, got.target))
    by = got.merge(docs.toPandas()[["doc_id", "source"]], on="doc_id").groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert by.target["z"] == 300 and abs(by.target["a"] / by.target["b"] - 2.5) < 1e-9 and abs(by.target.sum() - 3100) < 1e-6
    assert (abs(by.taken - by.target) <= 20).all() and t[0] == 0


def test_with_copies(spark):
    docs = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, None, 3), (None, "b", 4), (3, "c", 5)], "doc_id long, text string, n long")
    from pyspark.sql import functions as F

    from tallgrass.llm.common import text_tag

    counts = docs.select(F.col("doc_id").alias("_id"), text_tag("text").alias("_t")).distinct().withColumn("n", F.when(F.col("_id") == 1, 3).when(F.col("_id") == 3, 0).otherwise(1))
    got = sorted((str(r["doc_id"]), r["text"] or "") for r in with_copies(docs, counts).collect())
    assert got == [("1", "a")] * 3 + [("2", ""), ("None", "b")]


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = {r[0] for r in docs.select("doc_id").collect()}
    d = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, sf)
        assert d.columns == docs.columns
        ids = {r[0] for r in d.select("doc_id").collect()} & ids
    out = corpus_pipeline.run(spark, sf).toPandas()
    assert set(out.doc_id) == ids and out.groupby("sequence_id").length.sum().max() <= 4096


def test_pipeline_by_brute_force(spark):
    """Every stage on what the one before kept, in plain Python; the mixture's copies by its own operator, which has SQL."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    forest = trees.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    score = dict(zip(texts, forest.score(trees.features(pa.array(list(texts.values())))), strict=True))
    good = stages[0](spark, docs, sf)
    assert {r["doc_id"] for r in good.select("doc_id").collect()} == {i for i, x in score.items() if x >= 0.3}

    ids = sorted(i for i, x in score.items() if x >= 0.3)
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for w in (words(texts[i]) for i in ids)]
    links = [(a, b) for b in range(len(ids)) for a in range(b) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = components(len(ids), links)
    kept = [i for k, i in enumerate(ids) if root[k] == k]
    single = stages[1](spark, good, sf)
    assert sorted(r["doc_id"] for r in single.select("doc_id").collect()) == kept

    left = brute_units([(i, texts[i]) for i in kept], "clause", 3, 25, 50)
    lines = stages[2](spark, single, sf)
    rows = lines.collect()
    assert {r["doc_id"]: words(r["text"]) for r in rows} == {i: w for i, w in left.items() if w or not words(texts[i])}
    assert all(r["n_chars"] == len(r["text"]) for r in rows)

    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(lines).collect() if r["copies"]}
    mixed = [r["doc_id"] for r in stages[3](spark, lines, sf).collect()]
    assert Counter(mixed) == copies

    from tokenizers import Tokenizer

    tk, text = Tokenizer.from_file(tokenizer_file()), {r["doc_id"]: r["text"] for r in rows}
    want = Counter((i, a, min(4096, n - a)) for i in mixed for n in [len(tk.encode(text[i], add_special_tokens=False).ids) + 1] for a in range(0, n, 4096))
    packed = corpus_pipeline.run(spark, sf).toPandas()
    assert Counter(zip(packed.doc_id, packed.start, packed.length)) == want
    for _, x in packed.sort_values("offset").groupby("sequence_id"):
        assert x.offset.tolist() == [0, *x.length.cumsum().tolist()[:-1]] and x.length.sum() <= 4096


def test_pipeline_on_odd_rows(spark, tmp_path):
    import corpus_pipeline

    docs, _ = odd_documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(9, 1), (11, 1), (6, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    d = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, str(tmp_path))
        assert d.columns == docs.columns
        d.count()
    assert corpus_pipeline.STAGES[-1][1](spark, d, str(tmp_path)).count() >= 0
    none = no_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        none = stage(spark, none, str(tmp_path))
        assert none.columns == docs.columns and none.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, none, str(tmp_path)).count() == 0


def test_mixing_agrees_whatever_the_order_of_the_input(spark):
    rows = [(None if i % 3 else i % 30, f"{'a b c ' if i % 2 else 'd e '}{i}" if i % 5 else f"same {i % 4}", f"s{i % 2}") for i in range(400)]
    got = []
    for k in (1, 7, 399):
        turned = sorted(rows, key=lambda r: hash((r, k))) if k > 1 else rows
        docs = spark.createDataFrame(turned, "doc_id long, text string, source string").repartition(k % 5 + 1)
        got.append(sorted((str(r["doc_id"]), r["_t"], r["taken"], r["target"]) for r in mixing.mix_sources(docs).collect()))
    assert got[0] == got[1] == got[2]
