"""Tables in buckets by key, counts kept by changes, texts as ordered rows, late rows of streams."""

import glob
import json
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallgrass.operators import assemble, merge, stats
from tallgrass.sources import keyed
from tallgrass.streaming import pipelines

RULES = {"title": "overwrite", "author": "keep_if_empty", "cover": "keep_if_null", "since": "insert_only"}
WRITES = "k long, seq long, title string, author string, cover string, since string"


def writes(n, seed):
    r = random.Random(seed)
    pick = lambda *v: r.choice(v)
    return [(r.randrange(40), i, pick("a", "b", None), pick("", None, f"w{i}"), pick(None, f"c{i}"), pick(None, f"s{i}")) for i in range(n)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("cuts", [(0, 300), (1, 200), (150, 151), (300, 300)])
def test_keyed_merge_equals_fold(spark, tmp_path, cuts):
    rows = writes(300, 5)
    part = lambda a, b: spark.createDataFrame(rows[a:b], WRITES)
    name = keyed.write_keyed(merge.fold_merge(part(0, cuts[0]), ["k"], "seq", RULES), "w", "k", buckets=4, path=str(tmp_path))
    first = spark.table(name)
    before = sorted(map(str, first.collect()))
    name = keyed.merge_into(spark, name, part(*cuts), "k", "seq", RULES, name="w", buckets=4, path=str(tmp_path))
    name = keyed.merge_into(spark, name, part(cuts[1], 300), "k", "seq", RULES, name="w", buckets=4, path=str(tmp_path))
    want = merge.fold_merge(part(0, 300), ["k"], "seq", RULES)
    assert sorted(map(str, spark.table(name).select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, first.collect())) == before  # a reader stays with its version


def test_keyed_tables_are_not_shuffled_and_look_ups_prune_files(spark, tmp_path):
    rows = spark.createDataFrame(writes(300, 6), WRITES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        name = keyed.write_keyed(merge.fold_merge(rows, ["k"], "seq", RULES), "w", "k", buckets=8, path=str(tmp_path))
        plan = plan_of(keyed.merged(spark, name, rows, "k", "seq", RULES))
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
        join = max(i for i, line in enumerate(lines[:scan]) if "SortMergeJoin" in line)
        assert not any("Exchange" in line for line in lines[join:scan]), plan  # the stored side, which comes first
        keys = spark.createDataFrame([(3,), (77,), (None,)], "k long")
        plan = plan_of(keyed.look_up(spark, name, keys, "k"))
        assert plan.count("Exchange") == 1, plan  # the keys
        assert {r["k"] for r in keyed.look_up(spark, name, keys, "k").collect()} == {3}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    version = keyed.merge_into(spark, name, rows, "k", "seq", RULES, name="w", buckets=8, path=str(tmp_path))
    assert len(glob.glob(f"{tmp_path}/{version}/*.parquet")) <= 8  # a file a bucket, without a shuffle before the write
    found = keyed.look_up(spark, version, [3], "k")
    mine = [r[0] for r in found.select(F.regexp_extract(F.input_file_name(), "[^/]+$", 0)).collect()]
    for f in glob.glob(f"{tmp_path}/{version}/*.parquet"):
        if not f.endswith(mine[0]):
            open(f, "wb").close()  # a scan of any other bucket would fail
    assert [r["k"] for r in keyed.look_up(spark, version, [3], "k").collect()] == [3]
    with pytest.raises(Exception):  # noqa: B017, PT011
        spark.table(version).collect()


def test_counts_by_changes_equal_counts_of_all(spark):
    r = random.Random(9)
    state, counts = {}, spark.createDataFrame([], "of string, status string, n long")
    for _ in range(4):
        touched = {r.randrange(30): r.choice(["pending", "completed", "failed", None]) for _ in range(12)}
        frame = lambda d: spark.createDataFrame([(k, v) for k, v in d.items()], "k long, status string")
        before = frame({k: state[k] for k in touched if k in state})
        counts = stats.add_counts(counts, stats.count_changes("items", before, frame(touched)), stats.count_changes("sections", before, frame(touched), None))
        counts = spark.createDataFrame(counts.collect(), counts.schema)
        state.update(touched)
        got = {(x["of"], x["status"]): x["n"] for x in counts.collect() if x["n"]}
        want = {("items", s): n for s in set(state.values()) if (n := list(state.values()).count(s))} | {("sections", ""): len(state)}
        assert got == want
    row = stats.stats_of_counts(counts).first()
    assert (row["sections"], row["completed_items"], row["works"]) == (len(state), list(state.values()).count("completed"), 0)
    assert set(stats.stats_of_counts(counts.limit(0)).first()) == {0}


def test_site_counts_equal_a_full_count_after_every_batch(spark, tmp_path):
    from tallgrass.plans import streams
    from tallgrass.streaming import site

    pages = streams.site_pages(spark, "/root/testdata/sf0.001").orderBy("page_id").collect()
    t, third = site.tables(spark, str(tmp_path), 4), -(-len(pages) // 3)
    for i in range(3):
        site.ingest_batch(t, spark.createDataFrame(pages[i * third : (i + 1) * third], "page_id long, url string, html string"), i, streams.BASE)
        full = stats.corpus_stats(t.read("works"), t.read("sections"), t.read("items"), t.read("assets"), t.read("ledger")).first().asDict()
        assert site.corpus_stats(t).first().asDict() == full and full["works"] > 0
    assert site.corpus_stats(t, at=0).first()["works"] <= full["works"]


WORKS = "work_id {0}, title string, alternative_titles string, author string, artist string, genres array<string>, status string, url string, summary string"


def _text_of(folder):
    return "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{folder}/part-*")))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_ordered_rows_equal_whole_texts(spark, tmp_path, kind):
    key = (lambda i: i) if kind == "long" else (lambda i: f"w{i}")
    works = spark.createDataFrame([(key(i), f"t{i}", "", None, "a", ["g"], "s", "u", "sum" if i % 2 else None) for i in range(5)] + [(None, "n", "", "", "", [], "", "", "")], WORKS.format(kind))
    # a long work, a work without items, an item without a work, equal places, null texts
    items = [(key(0), i, f"i{i}", None, f"x{i}\ny") for i in range(3000)] + [(key(i), j // 2, f"i{j}", "d", f"text {j}") for i in (1, 3, 4) for j in range(7)] + [(key(9), 1, "lost", "", "x"), (None, 1, "n", "", "x"), (key(4), 9, "null", "", None)]
    items = spark.createDataFrame(items, f"work_id {kind}, item_index long, title string, date string, text string").repartition(5)
    whole = {r["work_id"]: r["content"] for r in assemble.document_text(works, items).collect()}
    rows = assemble.document_rows(works, items)
    got = {}
    for r in rows.orderBy("work_id", "is_item", "item_index", "block").collect():
        got.setdefault(r["work_id"], []).append(r["block"])
    assert {k: "\n".join(v) for k, v in got.items()} == whole and set(whole) == {key(i) for i in (0, 1, 3, 4)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assemble.export_rows(rows, f"{tmp_path}/out")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for k, text in whole.items():
        assert _text_of(f"{tmp_path}/out/work={k}") == text + "\n"
    assert len(glob.glob(f"{tmp_path}/out/work={key(0)}/part-*")) > 1  # a long work is no single task's
    assemble.export_rows(rows.limit(0), f"{tmp_path}/none")


def test_many_short_works_share_files(spark, tmp_path):
    works = spark.range(3000).selectExpr("id AS work_id", "'t' AS title", "'' AS alternative_titles", "'' AS author", "'' AS artist", "array('g') AS genres", "'s' AS status", "'u' AS url", "'' AS summary")
    items = spark.range(9000).selectExpr("id % 3000 AS work_id", "id div 3000 AS item_index", "concat('i', id) AS title", "'' AS date", "concat('\\r x\\n\"ư\t', id) AS text")
    assemble.export_rows(assemble.document_rows(works, items), f"{tmp_path}/out", each=False)
    files = sorted(glob.glob(f"{tmp_path}/out/part-*"))
    assert 1 <= len(files) <= 200
    got = {}
    for line in (x for f in files for x in open(f, encoding="utf-8")):
        row = json.loads(line)
        got.setdefault(row["work_id"], []).append(row["block"])
    assert {k: "\n".join(v) for k, v in got.items()} == {r["work_id"]: r["content"] for r in assemble.document_text(works, items).collect()}


def test_first_seen_drops_rows_behind_the_watermark_and_forgets_old_keys(spark, tmp_path):
    noon = datetime(2024, 1, 1, 12)
    at = lambda m: noon + timedelta(minutes=m)
    batches = [
        [("a", at(0)), ("a", at(0)), ("b", at(3)), ("early", at(30))],  # the watermark is 20 from here
        [("a", at(7)), ("early", at(31)), ("c", at(21)), ("d", at(60)), ("soon", at(5))],  # then 50; none was known before, so no row is late
        [("late", at(19)), ("soon", at(25)), ("d", at(69)), ("between", at(49))],  # behind 20 is late; a, b, c and early are forgotten after it
        [("early", at(55)), ("a", at(58)), ("d", at(69)), ("late", at(49)), ("e", at(51))],  # behind 50 is late
    ]
    for b in batches:
        spark.createDataFrame(b, "k string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = pipelines.run_to_end(pipelines.first_seen(stream, ["k"], event_time="ts", watermark="10 minutes"), f"{tmp_path}/run")
    got = {}
    for r in out.orderBy("ts").collect():
        got.setdefault(r["k"], []).append(int((r["ts"] - noon).total_seconds() // 60))
    got.pop("soon")
    assert got == {"a": [0, 58], "b": [3], "early": [30, 55], "c": [21], "d": [60], "between": [49], "e": [51]}


def test_repair_of_every_field_and_its_strict_form(spark):
    from tallgrass.functions import vietnamese as V

    cases = {"cươ ~ ": ("cưỡ", "cưỡng"), "CƯƠ\u0303": ("CƯỠ", "CƯỠNG"), "Ươ ˜": ("Ưỡ", "Ưỡng"), "lươ ´ i": ("lưới", "lưới"), "a ~": ("ã", "ã"), None: ("", "")}
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string").orderBy("i")
    assert [tuple(r) for r in df.select(V.repair(F.col("x")), V.repair(F.col("x"), strict=True)).collect()] == list(cases.values())
    t = lambda s: F.lit(s)
    one = spark.range(1)
    page = one.select(assemble.introduction(t("a ~ b"), t("e ´"), t(None), t("i `"), F.array(t("a ~")), t("s"), t("u"), t("o ~\nx"), repair=V.repair)).first()[0]
    assert all(x in page for x in ("<h1>ã b</h1>", "é</p>", "Chưa rõ", "ì</p>", "a ~</p>", "<p>õ</p>")) and "´" not in page
    item = one.select(assemble.fragment(t("a ~"), t("e ´\n\no ~"), F.lit(3), repair=V.repair)).first()[0]
    assert item.startswith("<h2>ã</h2>") and item.endswith("<p>é</p>\n<p>õ</p>")


def test_repair_takes_time_in_proportion_to_a_word(spark):
    from tallgrass.functions import vietnamese as V

    cases = {"b" * 60_000: "b" * 60_000, "a ´ ` nghê\tn hô i. Ộ NG": "á ` nghên hôi. ỘNG", "ươ  ˙ e ´ t~ x ´": "ượ ét~ x ´"}
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string").orderBy("i")
    began = time.perf_counter()
    assert [r[0] for r in df.select(V.repair(F.col("x"))).collect()] == list(cases.values())
    assert time.perf_counter() - began < 20


def test_runs_and_covers(spark):
    opened = spark.createDataFrame([(1, "daily"), (2, "full")], "run_id long, run_type string")
    closed = spark.createDataFrame([(1, 5, "partial", 3, "x"), (1, 9, "success", None, None), (7, 1, "success", 1, "y")], "run_id long, seq long, status string, items long, details string")
    got = {r["run_id"]: tuple(r)[1:] for r in merge.close_runs(opened, closed).collect()}
    assert got == {1: ("daily", "success", 0, None), 2: ("full", "running", 0, None)}
    works = spark.createDataFrame([(1, "a", "old", "p"), (2, "a", None, None)], "k long, status string, error_message string, cover string")
    changes = spark.createDataFrame([(1, "b", None, None), (2, "b", "e", "q"), (3, "b", "e", "q")], works.schema)
    assert sorted(map(tuple, merge.update_status(works, changes, "k", filled=["cover"]).collect())) == [(1, "b", "old", "p"), (2, "b", "e", "q")]
    assert merge.update_status(works, changes, "k").columns == works.columns
