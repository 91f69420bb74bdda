"""Operators on small rows: the quirks, random histories against folds, streams against batches."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tallgrass.functions import html as H
from tallgrass.functions import text as T
from tallgrass.functions import urls as U
from tallgrass.functions import vietnamese as V
from tallgrass.operators import assemble, frontier, joins, merge, quality, retry
from tallgrass.sources import tables
from tallgrass.streaming import pipelines


def values(spark, expression, cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize(
    ("expression", "cases"),
    [
        (V.repair, {"đê ´ n": "đến", "dâ n": "dân", "khuâ ´ t": "khuất", "hô n": "hôn", "ngươ ` i": "người", "và i": "vài", "a ~ b": "ã b", None: "", "a b​c": "a bc"}),
        (U.slug, {"https://h/truyen/12345-title": "12345-title", "https://h/a/b": "a_b", "https://h/": "novel", "https://h": "novel", "/convert/x/": "x"}),
        (U.item_id, {"https://h/x/c112903-chuong-1": 112903, "https://h/x": None, "https://h/abc12": None}),
        (U.work_id, {"https://h/truyen/12345-title": 12345, "https://h/truyen/a1": None}),
        (lambda c: U.normalize(c, "https://h/d/e"), {"": "", None: "", "//x/y": "https://x/y", "/x": "https://h/x", "x": "https://h/d/x", "../x": "https://h/x", "?q=1": "https://h/d/e?q=1", "#f": "https://h/d/e#f", " http://A/ ": "http://A/", "./a/./b/..": "https://h/d/a/"}),
        (T.file_name, {"a/b:c*": "abc", "***": "untitled", "  a \n b ": "a b", "x" * 200: "x" * 120}),
        (T.digits_to_int, {"1,234 từ": 1234, "abc": 0}),
        (T.clean, {"a\r\nb\rc\n\n\n\nd ": "a\nb\nc\n\nd"}),
        (T.reassemble, {'["0002Yg==","0001YQ=="]': "ab", '["0001"]': "", '["0001!!!","0002Yg=="]': "b", "not json": "", None: "", '["x","0001YQ=="]': "a"}),
        (T.escape_html, {"<a href=\"x\">'&": "&lt;a href=&quot;x&quot;&gt;&#x27;&amp;"}),
        (lambda c: T.format_bytes(c.cast("long")), {"1023": "1023.0 B", "1024": "1.0 KB", "1600": "1.6 KB", "1099511627776": "1.0 TB"}),
        (lambda c: T.format_duration(c.cast("double")), {"3661": "1h 01m 01s", "59.9": "59s", "61": "1m 01s"}),
        (lambda c: F.array_join(frontier.page_selection(c).cast("array<string>"), ","), {"3, 1,x,3,-2": "1,3", "": ""}),
    ],
)
def test_expressions(spark, expression, cases):
    assert dict(zip(cases, values(spark, expression, list(cases)))) == cases


def test_belongs(spark):
    rows = [("https://h/truyen/5-a/c1-x", "https://h/truyen/5-a", True), ("https://h/truyen/6-b/c1-x", "https://h/truyen/5-a", False), ("https://h/truyen/5-a/x", "https://h/truyen/5-a", False), ("https://h/x/aa/c1", "https://h/truyen/aa", True), (None, "https://h/truyen/aa", False)]
    df = spark.createDataFrame(rows, "i string, w string, e boolean")
    assert all(r[0] == r[1] for r in df.select("e", U.belongs_to_work(F.col("i"), F.col("w"))).collect())


def test_merge_equals_sequential_writes(spark):
    r = random.Random(3)
    history = [(k, s, r.choice(["a", "b", None]), r.choice(["", "x", "y", None]), r.choice([None, 1, 2])) for k in range(60) for s in range(r.randrange(1, 6))]
    want = {}
    for k, _, o, e, n in history:
        row = want.setdefault(k, [None, "", None, o])
        row[0] = o
        row[1] = e or row[1]
        row[2] = n if n is not None else row[2]
    df = spark.createDataFrame(history, "k int, seq int, o string, e string, n int").withColumn("i", F.col("o"))
    got = merge.fold_merge(df, ["k"], "seq", {"o": "overwrite", "e": "keep_if_empty", "n": "keep_if_null", "i": "insert_only"})
    assert {x["k"]: [x["o"], x["e"], x["n"], x["i"]] for x in got.collect()} == want


def test_failed_item_overwrites_its_body_unless_preserved(spark):
    df = spark.createDataFrame([(1, 0, "completed", "d", 1, "text"), (1, 1, "failed", "", None, "")], "k int, seq int, status string, publish_date string, section_id int, body string")
    for keep, body in ((False, ""), (True, "text")):
        row = merge.merge_items(df, ["k"], body="body", preserve_body_on_failure=keep).first()
        assert (row["status"], row["publish_date"], row["section_id"], row["body"]) == ("failed", "d", 1, body)


def fold(actions, most=3):
    attempts, status = 0, None
    for a in actions:
        if status is None:
            status = "pending" if a in ("add", "sync") else None
        elif a in ("add", "fail"):
            attempts += 1
            status = "dead" if attempts >= most else "pending"
        elif a == "resolve":
            status = "resolved"
        elif a == "sync" and status != "dead":
            status = "pending"
    return (attempts, status) if status else None


def histories(n=300):
    r = random.Random(9)
    return {f"k{i}": [r.choice(["add", "fail", "sync", "resolve"]) for _ in range(r.randrange(1, 9))] for i in range(n)}


def test_ledger_equals_fold(spark):
    h = histories()
    df = spark.createDataFrame([(k, s, a) for k, v in h.items() for s, a in enumerate(v)], "target_url string, seq int, action string")
    got = {r["target_url"]: (r["attempts"], r["status"]) for r in retry.ledger(df).collect()}
    assert got == {k: fold(v) for k, v in h.items() if fold(v)}


def test_streamed_ledger_equals_batch(spark, tmp_path):
    h = histories(60)
    rows = [(k, s, a) for k, v in h.items() for s, a in enumerate(v)]
    for part in range(3):
        spark.createDataFrame([x for x in rows if x[1] // 3 == part], "target_url string, seq int, action string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("target_url string, seq int, action string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = pipelines.run_to_end(pipelines.retry_ledger(stream), f"{tmp_path}/run", mode="update")
    got = {r[0]: (r[1], r[2]) for r in out.groupBy("target_url").agg(F.max_by("attempts", "batch"), F.max_by("status", "batch")).collect()}
    assert got == {k: fold(v) for k, v in h.items() if fold(v)}


def test_ledger_table_equals_fold_without_python(spark, tmp_path, monkeypatch):
    h = histories(200) | {None: ["fail", "add", "fail", "sync", "fail", "fail", "resolve"]}
    rows = [(k, s, a) for k, v in h.items() for s, a in enumerate(v)]
    schema = "target_url string, seq int, action string"
    for part in range(3):
        spark.createDataFrame([x for x in rows if x[1] // 3 == part], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    pipelines.ledger_table(stream, f"{tmp_path}/run", buckets=4).awaitTermination()
    out = pipelines.current(spark, f"{tmp_path}/run/ledger")
    assert {r["target_url"]: (r["attempts"], r["status"]) for r in out.collect()} == {k: fold(v) for k, v in h.items() if fold(v)}

    # the query calls no Python function for each key of a batch
    from tallgrass.plans import streams

    monkeypatch.setattr(pipelines, "retry_ledger", None)
    assert streams.stream_retry_ledger(spark, "/root/testdata/sf0.001").count() > 0


def test_first_embedding_takes_more_tasks_for_more_rows(spark):
    uses = spark.range(4000).selectExpr("id % 50 AS w", "id % 7 AS a", "id AS place")
    out = assemble.first_embedding(uses, "w", "a", ["place"], task_rows=100)
    assert out.groupBy(F.spark_partition_id()).count().count() > 30
    assert sorted(r["place"] for r in out.filter("embedded").collect()) == list(range(350))


@pytest.mark.parametrize("name", ["info_pairs", "stat_pairs", "ordered_tags", "type_summary", "asset_urls", "max_page", "work_title"])
def test_pages_made_of_small_rows_are_parsed_in_several_tasks(spark, name):
    from tallgrass.plans import registry

    df = registry.queries()[name](spark, "/root/testdata/sf0.001")
    assert df.groupBy(F.spark_partition_id()).count().count() > 1  # a small file is one split


def test_toc_islands(spark):
    def groups(sections):
        df = spark.createDataFrame([(1, i, s) for i, s in enumerate(sections)], "work_id int, item_index int, section string")
        return [(r["title"], r["items"]) for r in assemble.toc_islands(df).orderBy("grp").collect()]

    assert groups([None, None, "A", "A", "B", "A"]) == [("A", 4), ("B", 1), ("A", 1)]
    assert groups([None, None]) == [("", 2)]
    assert groups(["A", None]) == [("A", 1), ("Tập 2", 1)]


def test_stop_at_empty_page(spark):
    df = spark.createDataFrame([(1, 1, 3), (1, 2, 2), (1, 3, 0), (1, 4, 5), (2, 1, 1)], "k int, page int, n int")
    assert sorted((r["k"], r["page"]) for r in frontier.take_until_empty(df, ["k"], "page", "n").collect()) == [(1, 1), (1, 2), (2, 1)]


def test_seed_pages(spark):
    df = spark.createDataFrame([(1, 0, 5), (5, 200, 6), (1, 3, 9), (4, 2, 9)], "start long, stop long, most long")
    got = sorted((r["start"], r["page"]) for r in frontier.seed_pages(df, "p{page}").collect())
    assert got == [(1, p) for p in (1, 1, 2, 2, 3, 3, 4, 5)] + [(5, 5), (5, 6)]


def test_snapshot_and_lists(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("a",)], "url string")
    version = tables.write_snapshot(df, str(tmp_path / "t"))
    assert spark.read.parquet(version).count() == 2 and tables.write_snapshot(df, str(tmp_path / "t")) != version
    assert tables.as_json_list(df.union(df)).first()[0] == '["a","b"]'
    tables.as_json_list(df).write.text(str(tmp_path / "j"))
    assert sorted(r[0] for r in tables.read_url_list(spark, str(tmp_path / "j"), "json").collect()) == ["a", "b"]
    spark.createDataFrame([("Tên", "một\nhai")], "file_name string, content string").transform(lambda d: tables.export_text(d, str(tmp_path / "x"), each=True) or tables.export_text(d, str(tmp_path / "y")) or d)
    assert spark.read.text(str(tmp_path / "x"), wholetext=True).first()[0] == "một\nhai\n"
    assert tables.read_export(spark, str(tmp_path / "y")).collect() == [("Tên", "một\nhai")]


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "zz")], "k int, s string")
    assert quality.duplicate_keys(df.filter("k IS NOT NULL"), ["k"]).collect()[0]["n"] == 2
    assert quality.orphans(df, df.limit(0), "k", "k").count() == 2
    assert quality.invalid_status(df, "s", ["a"]).count() == 2 and quality.missing_required(df, ["k", "s"]).count() == 2


def test_ill_formed_pages(spark):
    pages = spark.createDataFrame([("p", '<script>var t="</p>";</script><article><p><b>One<br><p>two &amp; three</p><p>\n</p></article>'), ("q", None), ("r", "")], "page string, html string")
    nodes = H.html_nodes(pages, "page", "html", ["p"]).orderBy("pos").collect()
    assert [n["text"] for n in nodes] == ["One", "two & three", ""]
    assert [r[0] for r in pages.orderBy("page").select(H.body_text(F.col("html"), F.lit("x"))).collect()] == ["One\n\ntwo & three", None, ""]


def test_links_in_any_quoting(spark):
    cases = {"<a href=\"/x\">1</a>": [("/x", "1")], "<A HREF='/x' id=1> <b>2</b></A>": [("/x", "2")], "<a id=1 href=/y>3</a><a href=''>no</a><a data-href='/z'>no</a><a\nhref = \"a b\">4</a>": [("/y", "3"), ("a b", "4")], "<abbr href='/q'>no</abbr>": []}
    got = values(spark, H.links, list(cases))
    assert [[tuple(p) for p in g] for g in got] == list(cases.values())


class _Reference(HTMLParser):
    """Texts of all elements, in order, by the standard parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.done = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "p" and (at := [i for i, n in enumerate(self.open) if n[0] == "p"]):
            del self.open[at[-1] :]
        node = [tag, dict(attrs).get("class") or "", dict(attrs).get("href"), []]
        self.done.append(node)
        if tag not in ("br", "img"):
            self.open.append(node)

    def handle_endtag(self, tag):
        if at := [i for i, n in enumerate(self.open) if n[0] == tag]:
            del self.open[at[-1] :]

    def handle_data(self, data):
        for n in self.open:
            n[3].append(data)


def test_parse_agrees_with_the_standard_parser():
    r = random.Random(6)
    parts = ["<p>", "</p>", "<div class='x y'>", "</div>", "<a href=\"/q?a=1&amp;b\">", "</a>", "<br/>", "<img src=/i.png>", " text ", "&lt;b&gt;", "\n", "<!-- <p>no</p> -->", "<script>var a = '<p>';</script>", "<span CLASS=z>", "</span>", "1 < 2 ", "<ul><li>", "</ul>", "é"]
    for _ in range(400):
        html = "".join(r.choice(parts) for _ in range(r.randrange(1, 25)))
        ref = _Reference()
        ref.feed(html)
        ref.close()
        got = H.parse(html, H._Chosen({"": ["p", "div", "a", "br", "img", "script", "span", "ul", "li"]}), H._Chosen({"box": [".x"]}), False)
        assert [(n[2], " ".join(n[3]), dict(n[5]).get("href"), n[6]) for n in got] == [(t, c, h, "".join(x).strip()) for t, c, h, x in ref.done], html
        around = lambda n: [m[0] for m in got if "x" in m[3] and m[0] < n[0] <= m[1]]
        assert all(dict(n[7]).get("box") == (max(around(n)) if around(n) else None) for n in got), html


def test_extraction_plans_one_parse_and_no_shuffle(spark):
    pages = spark.createDataFrame([("https://h/truyen/5-a", "<a href='/truyen/5-a/c1-x'>1</a>")], "page string, html string").coalesce(1)
    for out in (H.table_of_contents(H.html_pages(pages, "page", "html", **H.CONTENTS), "https://h"), H.feed_entries(H.html_pages(pages, "page", "html", **H.FEED), "https://h"), H.item_pages(H.html_pages(pages, "page", "html", text_only=True, **H.ITEM_NODES)), H.catalog_urls(H.html_pages(pages, "page", "html", **H.CATALOG), "https://h"), H.largest_pages(H.html_pages(pages, "page", "html", **H.PAGINATION))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "Exchange" not in plan


def test_contents_of_a_long_and_an_odd_page(spark):
    many = "".join(f'<li><a href="/truyen/5-a/c{i}-x">t{i}</a><div class="chapter-time">d{i}</div></li>' for i in range(5000))
    long = f'<section class="volume-list"><p class="sect-title">one</p><ul class="list-chapters">{many}</ul></section><section class="volume-list"><ul class="list-chapters"><li><a href="/truyen/5-a/c3-x">again</a></li></ul></section><a href="/truyen/5-a/c9999-z">late</a>'
    pages = spark.createDataFrame([("https://h/truyen/5-a", long), ("https://h/truyen/6-b", '<nav><a href="/truyen/6-b/c1-x">no</a></nav><a href="/truyen/6-b/c2-x"></a>'), ("https://h/truyen/7-c", None)], "page string, html string")
    got = H.table_of_contents(H.html_pages(pages, "page", "html", **H.CONTENTS), "https://h").orderBy("page", "item_index").collect()
    assert [(r["item_index"], r["section"], r["title"], r["date"]) for r in got[:5000]] == [(i + 1, "one", f"t{i}", f"d{i}") for i in range(5000)]
    assert [tuple(r)[1:] for r in got[5000:]] == [("one", 1, 5001, "https://h/truyen/5-a/c9999-z", "late", ""), ("Quyển 1", 1, 1, "https://h/truyen/6-b/c2-x", "Chương 1", "")]


def test_feed_of_pages_with_and_without_cards(spark):
    card = '<div class="series-item"><div class="series-title"><a href="/w">W</a></div><span class="time-ago">now</span></div><div class="series-item"><a href="/no">no title</a></div>'
    pages = spark.createDataFrame([("a", card), ("b", '<div class="series-title"><a href="x">X</a><a>none</a></div>'), ("c", "")], "page string, html string")
    got = H.feed_entries(H.html_pages(pages, "page", "html", **H.FEED), "https://h").orderBy("page").collect()
    assert [tuple(r)[:1] + tuple(r)[2:] for r in got] == [("a", "https://h/w", "W", "", "", "now"), ("b", "https://h/x", "X", "", "", "")]


def test_feed_labels(spark):
    feed = spark.createDataFrame([("w", ""), ("w", None), ("w", "a"), ("w", "b"), ("v", "a")], "work string, item string")
    works, done = spark.createDataFrame([("w",)], "work string"), spark.createDataFrame([("a",)], "item string")
    label = lambda force: [(r["work"], r["item"], r["reason"]) for r in joins.classify_feed(feed, works, done, work="work", item="item", force=force).collect()]
    key = str
    assert sorted(label(False), key=key) == sorted([("w", "", "recheck"), ("w", None, "recheck"), ("w", "a", "recheck"), ("w", "b", "new_item"), ("v", "a", "new_work")], key=key)
    assert {x[2] for x in label(True) if x[0] == "w"} == {"new_item"}


def test_entry_without_the_optional_part(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parents[1]
    shutil.copy(repo / "__spark_entry__.py", tmp_path)
    shutil.copytree(repo / "tallgrass", tmp_path / "tallgrass", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 70 and set(e.oracle_sql()) <= set(q); assert not any(k.startswith('op') and k[2].isdigit() for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def fold_rows(actions):
    """A key's whole row by applying its actions one by one: (action, target_id, max_attempts, error, extra)."""
    row = None
    for a, target, most, error, extra in actions:
        if row is None:
            if a in ("add", "sync"):
                row = [target, 0, 3 if most is None else most, "pending", error, extra]
        elif a in ("add", "fail"):
            row[1] += 1
            row[3] = "dead" if row[1] >= row[2] else "pending"
            row[4] = error
            row[5] = extra if a == "add" else row[5]
        elif a == "resolve":
            row[3] = "resolved"
        else:
            row[3] = "dead" if row[3] == "dead" else "pending"
            row[4] = row[4] if error is None else error
    return row


ACTIONS = "item_type string, target_url string, seq long, action string, target_id long, max_attempts long, error string, extra string"


def row_histories(n=300, seed=4):
    r = random.Random(seed)
    return {("t", f"k{i}"): [(r.choice(["add", "fail", "sync", "resolve"]), r.choice([None, 1, 2]), r.choice([None, 1, 2, 4]), r.choice([None, "e", "f"]), r.choice([None, "x", "y"])) for _ in range(r.randrange(1, 10))] for i in range(n)}


def test_ledger_rows_equal_sequential_actions_at_once_and_by_batches(spark):
    h = row_histories()
    rows = [(*k, s, *x) for k, v in h.items() for s, x in enumerate(v)]
    want = {k: fold_rows(v) for k, v in h.items() if fold_rows(v)}
    at_once = retry.ledger_rows(spark.createDataFrame(rows, ACTIONS))
    assert {(r["item_type"], r["target_url"]): [r[c] for c in retry.ROW] for r in at_once.collect()} == want
    state = None
    for part in range(4):
        some = spark.createDataFrame([x for x in rows if x[2] // 3 == part], ACTIONS)
        new = retry.ledger_rows(some, state)
        state = spark.createDataFrame(new.collect(), new.schema)
    assert {(r["item_type"], r["target_url"]): [r[c] for c in retry.ROW] for r in state.collect()} == want


def test_payloads_by_type(spark):
    rows = [("item", "u1", 7, 0, 3, "pending", None, '{"novel_id": 5, "title": null}'), ("image", "u2", 8, 0, 3, "pending", None, "broken"), ("work", "u3", None, 1, 3, "pending", None, None), ("item", "u4", None, 3, 3, "pending", None, "{}"), ("item", "u5", None, 0, 3, "dead", None, "{}")]
    df = spark.createDataFrame(rows, "item_type string, target_url string, target_id long, attempts long, max_attempts long, status string, last_error string, extra_data string")
    got = {r["target_url"]: r.asDict(True) for r in retry.payloads(df).collect()}
    assert set(got) == {"u1", "u2", "u3"} and got["u1"]["item"] == {"work_id": 5, "section_id": None, "item_index": 0, "title": "Chương"} and got["u1"]["image"] is None
    assert got["u2"]["image"] == {"image_id": 8, "image_type": "chapter_illustration"} and got["u3"]["work"] == {"url": "u3"}


def test_table_set_commits_all_or_nothing(spark, tmp_path):
    from tallgrass.sources.versions import TableSet

    t = TableSet(spark, str(tmp_path / "set"), {"a": "k string, n long", "b": "k string, m long"}, "k", buckets=4)
    rows = lambda name, *r: spark.createDataFrame(list(r), t.schemas[name])
    assert t.head() is None and t.read("a").count() == 0
    assert t.commit(0, {"a": rows("a", ("x", 1), ("y", 1)), "b": rows("b", ("x", 5))}, {"why": "first"})
    pinned, at = t.read("a"), t.head()
    broken = rows("b", ("x", 6)).withColumn("m", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        t.commit(1, {"a": rows("a", ("x", 2)), "b": broken})
    assert t.head() == 0 and sorted(map(tuple, t.read("a").collect())) == [("x", 1), ("y", 1)]
    touched = t.touched(rows("a", ("x", 2)), "k")
    keep = [r for r in t.read("a", only=touched).collect() if r["k"] != "x"]
    assert t.commit(1, {"a": rows("a", ("x", 2), *map(tuple, keep)), "b": rows("b", ("x", 6))}) and not t.commit(1, {"a": rows("a", ("z", 9))})
    assert sorted(map(tuple, t.read("a").collect())) == [("x", 2), ("y", 1)] and sorted(map(tuple, t.read("a", at=at).collect())) == [("x", 1), ("y", 1)] == sorted(map(tuple, pinned.collect()))
    assert t.record(0)["note"] == {"why": "first"}
    assert t.clean(keep=2) == 1  # what the broken write left
    assert sorted(map(tuple, t.read("a", at=0).collect())) == [("x", 1), ("y", 1)]
    t.clean(keep=1)
    assert t.commits() == [1] and sorted(map(tuple, t.read("a").collect())) == [("x", 2), ("y", 1)]


def test_a_key_with_very_many_actions(spark):
    many = spark.range(300_000).select(F.lit("t").alias("item_type"), F.lit("hot").alias("target_url"), F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, "add").otherwise("fail").alias("action"), F.lit(None).cast("long").alias("target_id"), F.lit(10**6).cast("long").alias("max_attempts"), F.col("id").cast("string").alias("error"), F.lit("x").alias("extra"))
    row = retry.ledger_rows(many).first()
    assert (row["attempts"], row["status"], row["last_error"]) == (299_999, "pending", "299999")


def _site_rows(t, at=None):
    return {name: sorted(map(str, t.read(name, at=at).collect())) for name in t.schemas if name != "runs"}


def test_streamed_site_equals_one_batch_also_after_a_kill(spark, tmp_path, monkeypatch):
    from tallgrass.plans import streams
    from tallgrass.sources.versions import TableSet
    from tallgrass.streaming import site

    pages = streams.site_pages(spark, "/root/testdata/sf0.001").orderBy("page_id").collect()
    schema = "page_id long, url string, html string"
    third = -(-len(pages) // 3)
    for i in range(3):
        spark.createDataFrame(pages[i * third : (i + 1) * third], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    once = site.tables(spark, f"{tmp_path}/once", 4)
    assert site.ingest_batch(once, spark.createDataFrame(pages, schema), 0, streams.BASE)
    want = _site_rows(once)
    assert not site.ingest_batch(once, spark.createDataFrame(pages, schema), 0, streams.BASE) and _site_rows(once) == want  # a replay

    real, killed = TableSet.commit, []

    def commit(self, number, tables, note=None, **more):
        if number == 1 and not killed:
            killed.append(number)
            tables = {**tables, "items": tables["items"].withColumn("title", F.raise_error(F.lit("killed")).cast("string"))}  # works and sections are written by then
        return real(self, number, tables, note, **more)

    monkeypatch.setattr(TableSet, "commit", commit)
    path = f"{tmp_path}/out"
    with pytest.raises(Exception):  # noqa: B017, PT011
        site.ingest(stream(), path, streams.BASE, buckets=4).awaitTermination()
    t = site.tables(spark, path, 4)
    first = site.tables(spark, f"{tmp_path}/first", 4)
    site.ingest_batch(first, spark.createDataFrame(pages[:third], schema), 0, streams.BASE)
    assert t.commits() == [0] and _site_rows(t) == _site_rows(first)  # readers see nothing of the batch that was cut short
    site.ingest(stream(), path, streams.BASE, buckets=4).awaitTermination()
    assert _site_rows(t) == want and t.read("runs").count() == 3
    whole, parts = once.read("runs").first(), t.read("runs").agg(F.sum("checked").alias("checked"), F.sum("updated").alias("updated"), F.sum("new_items").alias("new_items"), F.sum("errors").alias("errors"), F.sum(F.col("details")["pages"]).alias("pages")).first()
    assert (parts["checked"], parts["updated"], parts["errors"], parts["pages"]) == (whole["checked"], whole["updated"], whole["errors"], whole["details"]["pages"])
    assert {tuple(r) for r in site.missing_items(t).select("item_url", "status").collect()} == {(r["item_url"], r["status"]) for r in t.read("items").collect() if r["status"] != "completed"}
    assert t.clean(1) >= 0 and _site_rows(t) == want


def test_streamed_ledger_rows_equal_batch(spark, tmp_path):
    from tallgrass.streaming import site

    h = row_histories(80, 8)
    rows = [(*k, s, *x) for k, v in h.items() for s, x in enumerate(v)]
    for part in range(3):
        spark.createDataFrame([x for x in rows if x[2] // 4 == part], ACTIONS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(ACTIONS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    site.ledger_stream(stream, f"{tmp_path}/out", buckets=4).awaitTermination()
    got = site.TableSet(spark, f"{tmp_path}/out", {"ledger": site.SCHEMAS["ledger"]}, "target_url", 4).read("ledger").collect()
    assert {(r["item_type"], r["target_url"]): [r[c] for c in retry.ROW] for r in got} == {k: fold_rows(v) for k, v in h.items() if fold_rows(v)}


def test_sql_functions_equal_column_forms(spark):
    from tallgrass.functions.register import FUNCTIONS, register

    register(spark)
    texts = ["", None, "https://h/truyen/12345-a/c9-x", "https://h/convert/x", "http://h/a/b.PNG", "//x", "slug", "a\r\nb\rc\n\n\n\nd ", "a/b:c* \n <d>", "x" * 200, "1,234 từ", "Mã FREE ship", "<a href=\"x\">'&", '["a","b"]', "not json", "  two  words "]
    spark.createDataFrame([(i, t, i * 700_000 + i) for i, t in enumerate(texts)], "i long, s string, n long").createOrReplaceTempView("told")
    forms = {
        "url_slug(s)": U.slug(F.col("s")), "url_work_id(s)": U.work_id(F.col("s")), "url_item_id(s)": U.item_id(F.col("s")), "is_http(s)": U.is_http(F.col("s")), "slug_to_url(s, 'https://b')": U.from_slug(F.col("s"), "https://b"),
        "asset_ext(s)": U.asset_extension(F.col("s")), "asset_path('f', s)": U.asset_path(F.lit("f"), F.col("s")), "cover_path('f', s)": U.cover_path(F.lit("f"), F.col("s")), "clean_text(s)": T.clean(F.col("s")), "sanitize_filename(s)": T.file_name(F.col("s")),
        "content_hash(s)": F.sha2("s", 256), "format_bytes(n * n)": T.format_bytes(F.col("n") * F.col("n")), "format_duration(n / 100)": T.format_duration(F.col("n") / 100), "first_nonempty(s, 'z')": T.first_nonempty(F.col("s"), F.lit("z")), "digits_to_int(s)": T.digits_to_int(F.col("s")),
        "word_count(s)": T.word_count(F.col("s")), "is_notice(s)": T.is_notice(F.col("s")), "fetch_outcome(CAST(200 + i * 38 AS INT))": T.fetch_outcome(F.lit(200) + F.col("i") * 38), "json_strings(s)": T.json_array(F.col("s")), "escape_html(s)": T.escape_html(F.col("s")),
    }
    assert {k.split("(")[0] for k in forms} == set(FUNCTIONS)
    told = spark.table("told")
    for text, column in forms.items():
        assert [r[0] for r in spark.sql(f"SELECT {text} FROM told ORDER BY i").collect()] == [r[0] for r in told.orderBy("i").select(column).collect()], text
    found = spark.sql("SELECT t.tag, t.text, t.href FROM (SELECT '<p>1<a href=x>2</a></p>' AS h), LATERAL html_nodes(h, array('a', 'p')) AS t ORDER BY pos").collect()
    assert [tuple(r) for r in found] == [("p", "12", None), ("a", "2", "x")]
