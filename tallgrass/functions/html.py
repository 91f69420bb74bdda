"""Extraction from HTML: one parse of a page in a task, and everything after it as expressions; flat markup by expressions only."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from html import unescape as plain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from . import urls as U

# Elements of an item page that are no text of it: by tag, by style, by class, and shop links by address.
SILENT_TAGS = frozenset(("script", "style", "noscript"))
HIDDEN_STYLES = ("display: none", "display:none")
BOX_CLASSES = frozenset(("notice-item", "alert", "reading-notice"))
SHOPS = ("shopee", "lazada")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset(("script", "style"))
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'<]++|"[^"<]*+"|'[^'<]*+')*+)>""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_KEPT = ("href", "src", "data-src", "style")
NODES = "array<struct<pos:int,last:int,tag:string,classes:array<string>,id:string,attrs:map<string,string>,text:string,within:map<string,int>>>"


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in _ATTR.findall(raw):
        out.setdefault(name.lower(), plain("".join(values)))
    return out


def _silent(tag: str, classes: list[str], attrs: dict[str, str]) -> bool:
    if tag in SILENT_TAGS or BOX_CLASSES.intersection(classes):
        return True
    return any(x in attrs.get("style", "") for x in HIDDEN_STYLES) or tag == "a" and any(x in attrs.get("href", "") for x in SHOPS)


class _Chosen:
    """Selectors (a tag, .class or #id), each with the names that it stands for."""

    def __init__(self, named: Mapping[str, Iterable[str]]):
        self.tags: dict[str, list[str]] = {}
        self.classes: dict[str, list[str]] = {}
        self.ids: dict[str, list[str]] = {}
        for name, selectors in named.items():
            for s in selectors:
                kind, key = (self.classes, s[1:]) if s[0] == "." else (self.ids, s[1:]) if s[0] == "#" else (self.tags, s)
                kind.setdefault(key, []).append(name)

    def of(self, tag: str, classes: list[str], id_: str) -> list[str]:
        out = list(self.tags.get(tag, ()))
        for c in classes:
            out += self.classes.get(c, ())
        if id_:
            out += self.ids.get(id_, ())
        return out


def parse(html: str, wanted: _Chosen, scopes: _Chosen, text_only: bool) -> list[tuple]:
    """(pos, last, tag, classes, id, attrs, text, within) of the chosen elements of a page, in document order.

    Positions count all elements; ``last`` is the position of the last element inside. ``within`` gives, for each
    scope, the position of the innermost element of it around. An unclosed element ends with its parent, a paragraph
    also where the next begins; an end without a start is passed over; what looks like a tag and is none is text, and so
    is one with ``<`` inside of it, so that the time is in proportion to the length of any page.
    """
    nodes: list[list] = []
    texts: list[str] = []
    around: dict[str, list[int]] = {}
    # open elements: tag, position, scopes, whether silent, and the node with the place of its text if it was chosen
    opened: list[tuple] = []
    count, at, end = 0, 0, len(html)

    def close(depth: int) -> None:
        while len(opened) > depth:
            _, _, names, _, node, first = opened.pop()
            for name in names:
                around[name].pop()
            if node is not None:
                node[1], node[6] = count - 1, "".join(texts[first:]).strip()

    def say(data: str) -> None:
        if data and opened and not opened[-1][3]:
            texts.append(plain(data))

    while at < end:
        m = _TAG.search(html, at)
        if m is None:
            say(html[at:])
            break
        say(html[at : m.start()])
        at = m.end()
        closing, tag, raw = m.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            for depth in range(len(opened) - 1, -1, -1):
                if opened[depth][0] == tag:
                    close(depth)
                    break
            continue
        if tag == "p":
            for depth in range(len(opened) - 1, -1, -1):
                if opened[depth][0] == "p":
                    close(depth)
                    break
        attrs = _attributes(raw) if raw.strip(" /") else {}
        classes, id_ = attrs.get("class", "").split(), attrs.get("id", "")
        silent = text_only and (bool(opened) and opened[-1][3] or _silent(tag, classes, attrs))
        node = None
        if not silent and wanted.of(tag, classes, id_):
            node = [count, count, tag, classes, id_, [(k, attrs[k]) for k in _KEPT if k in attrs], "", [(k, v[-1]) for k, v in around.items() if v]]
            nodes.append(node)
        if tag not in _VOID:
            names = scopes.of(tag, classes, id_)
            for name in names:
                around.setdefault(name, []).append(count)
            opened.append((tag, count, names, silent, node, len(texts)))
            if tag in _RAW and not raw.endswith("/"):
                stop = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                inner = html[at : stop.start() if stop else end]
                if inner and not silent:
                    texts.append(inner)
                at = stop.start() if stop else end
        count += 1
    close(0)
    return nodes


def _lists(cut: list[int], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), values)


def _maps(rows: list[list[tuple]], kind: pa.DataType) -> pa.MapArray:
    cut = [0]
    for r in rows:
        cut.append(cut[-1] + len(r))
    pairs = [x for r in rows for x in r]
    return pa.MapArray.from_arrays(pa.array(cut, pa.int32()), pa.array([k for k, _ in pairs], pa.string()), pa.array([v for _, v in pairs], kind))


def _parsed(wanted: Iterable[str], scopes: Mapping[str, tuple[str, ...]], text_only: bool, keep: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, s = _Chosen({"": wanted}), _Chosen(scopes)
        for batch in batches:
            for begin in range(0, batch.num_rows, 100):
                part = batch.slice(begin, 100)
                cut, nodes = [0], []
                for html in part["html"].to_pylist():
                    nodes += parse(html or "", w, s, text_only)
                    cut.append(len(nodes))
                pos, last, tag, classes, id_, attrs, text, within = zip(*nodes, strict=True) if nodes else ([],) * 8
                inner = [0]
                for c in classes:
                    inner.append(inner[-1] + len(c))
                struct = pa.StructArray.from_arrays(
                    [pa.array(pos, pa.int32()), pa.array(last, pa.int32()), pa.array(tag, pa.string()), _lists(inner, pa.array([x for c in classes for x in c], pa.string())), pa.array(id_, pa.string()), _maps(list(attrs), pa.string()), pa.array(text, pa.string()), _maps(list(within), pa.int32())],
                    ["pos", "last", "tag", "classes", "id", "attrs", "text", "within"],
                )
                yield pa.RecordBatch.from_arrays([part["page"], _lists(cut, struct), *[part[k] for k in keep]], ["page", "nodes", *keep])

    return run


def html_pages(pages: DataFrame, page: str, html: str, wanted: Iterable[str], *, scopes: Mapping[str, Iterable[str]] | None = None, text_only: bool = False, keep: Iterable[str] = ()) -> DataFrame:
    """(page, nodes, what is to be kept): one row a page with the elements that ``wanted`` chooses, parsed once and in document order.

    Selectors are a tag, ``.class`` or ``#id``. ``scopes`` names sets of them; each node tells the innermost element of a
    scope around it. With ``text_only``, scripts, hidden elements, notice boxes and shop links are left out, also of the
    texts around them. Every page keeps its row, also a null one, so what follows needs no join back. Attributes kept
    are those that extraction reads: href, src, data-src and style.
    """
    keep = tuple(keep)
    rows = pages.select(F.col(page).cast("string").alias("page"), F.col(html).alias("html"), *keep)
    kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return rows.mapInArrow(_parsed(tuple(wanted), {k: tuple(v) for k, v in (scopes or {}).items()}, text_only, keep), f"page string, nodes {NODES}{kept}")


def html_nodes(pages: DataFrame, page: str, html: str, wanted: Iterable[str], *, scopes: Mapping[str, Iterable[str]] | None = None, text_only: bool = False) -> DataFrame:
    """The nodes of ``html_pages``, a row each."""
    return html_pages(pages, page, html, wanted, scopes=scopes, text_only=text_only).select("page", F.inline_outer("nodes")).filter("pos IS NOT NULL")


def has_class(node: Column, *names: str) -> Column:
    return F.arrays_overlap(node["classes"], F.array(*[F.lit(n) for n in names]))


def first_node(nodes: Column, condition: Callable[[Column], Column]) -> Column:
    """The first node for which the condition holds, or null."""
    return F.get(F.filter(nodes, condition), F.lit(0))


def _last(items: Column) -> Column:
    return F.get(items, F.size(items) - 1)


def first_of_each(df: DataFrame, items: str, key: str) -> DataFrame:
    """Of the structs in column ``items``, the first with each value of their field ``key``, in order.

    By sorting and comparing neighbours, so a page with very many items costs little more than its sort.
    """
    keyed = F.array_sort(F.transform(items, lambda x, i: F.struct(x[key].alias("k"), i.alias("i"), x.alias("x"))))
    df = df.withColumn("_keyed", F.transform(keyed, lambda y: F.struct(y["k"], y["i"])))
    df = df.withColumn("_firsts", F.array_sort(F.transform(F.filter("_keyed", lambda y, i: (i == 0) | ~F.get(F.col("_keyed"), i - 1)["k"].eqNullSafe(y["k"])), lambda y: y["i"])))
    return df.withColumn(items, F.transform("_firsts", lambda i: F.get(F.col(items), i))).drop("_keyed", "_firsts")


def info_pairs(pages: DataFrame, labels: dict[str, tuple[str, ...]], name: str, value: str) -> DataFrame:
    """Label and value of every item; the first column whose words the label holds takes it, the last pair wins.

    Nodes need the classes ``name`` and ``value`` and the scope ``item``. Returns a row a page, null where nothing is told.
    """

    def told(cls: str) -> Column:
        hit = F.filter("nodes", lambda n: has_class(n, cls) & n["within"]["item"].isNotNull())
        return F.transform(hit, lambda n: F.struct(n["within"]["item"].alias("item"), n["text"].alias("text")))

    both = first_of_each(first_of_each(pages.withColumn("_names", told(name)).withColumn("_values", told(value)), "_names", "item"), "_values", "item")

    def column(label: Column) -> Column:
        to = F.lit(None).cast("string")
        for c, words in reversed(labels.items()):
            hit = F.lit(False)
            for w in words:
                hit = hit | label.contains(w)
            to = F.when(hit, c).otherwise(to)
        return to

    value_of = lambda values, n: F.get(F.filter(values, lambda x: x["item"] == n["item"]), F.lit(0))["text"]
    pairs = U.let(F.struct("_names", "_values"), lambda v: F.transform(v["_names"], lambda n: F.struct(column(F.lower(n["text"])).alias("to"), value_of(v["_values"], n).alias("value"), n["item"].alias("item"))))
    both = both.withColumn("_pairs", F.array_sort(F.filter(pairs, lambda p: p["value"].isNotNull()), lambda a, b: a["item"] - b["item"]))
    last = lambda c: _last(F.filter("_pairs", lambda p: p["to"] == c))["value"]
    return both.select("page", *[last(c).alias(c) for c in labels])


# Label words, in the order in which they are tried.
INFO_LABELS = {"author": ("tác giả",), "artist": ("họa sĩ", "minh họa"), "status": ("tình trạng",), "other_names": ("tên khác", "khác")}
STAT_LABELS = {"words": ("số từ", "từ"), "views": ("lượt xem", "xem"), "bookmarks": ("theo dõi", "bookmark"), "rating_text": ("đánh giá",), "updated": ("lần cuối", "cập nhật")}
_RATING = r"([\d.,]+)\s*/\s*(\d+)"


def typed_stats(pairs: DataFrame) -> DataFrame:
    number = F.replace(F.regexp_extract("rating_text", _RATING, 1), F.lit(","), F.lit("."))
    return pairs.select(
        "page",
        *[T.digits_to_int(F.coalesce(c, F.lit(""))).alias(c) for c in ("words", "views", "bookmarks")],
        F.coalesce(number.try_cast("double"), F.lit(0.0)).alias("rating"),
        F.coalesce(F.regexp_extract("rating_text", _RATING, 2).try_cast("long"), F.lit(0)).cast("long").alias("rating_count"),
        F.trim(F.translate(F.coalesce("updated", F.lit("")), "\r\n", "  ")).alias("updated"),
    )


def ordered_tags(pages: DataFrame, classes: tuple[str, ...] = ("series-gerne-item", "badge-genre", "genre-item"), href: str = "/the-loai/") -> DataFrame:
    """Distinct non-empty tag texts of a page in order; nodes need the tag a and the classes."""
    hit = F.filter("nodes", lambda n: (n["attrs"]["href"].contains(href) & (n["tag"] == "a")) | has_class(n, *classes))
    return pages.select("page", F.array_distinct(F.filter(F.transform(hit, lambda n: n["text"]), lambda x: x != "")).alias("tags"))


def cover_url(style: Column, src: Column, data_src: Column, base: str) -> Column:
    styled = F.nullif(F.regexp_extract(F.coalesce(style, F.lit("")), r"url\(['\"]?(.*?)['\"]?\)", 1), F.lit(""))
    return U.normalize(F.coalesce(styled, F.nullif(src, F.lit("")), F.nullif(data_src, F.lit(""))), base)


def type_and_summary(pages: DataFrame) -> DataFrame:
    first = lambda c: first_node(F.col("nodes"), lambda n: has_class(n, c))["text"]
    return pages.select("page", F.coalesce(first("series-type"), F.lit("Truyện dịch")).alias("work_type"), F.coalesce(T.clean(first("summary-content")), F.lit("")).alias("summary"))


# Containers whose links are no items.
NOISE_CLASSES = ("ln-comment", "comment-wrapper", "fbcmt_root", "sidebar", "series-users", "same-author", "feature-section", "series-action")
NOISE_IDS = ("series-comments", "ln-comment", "comment-section", "navbar")
# Heads of sections.
SECTION_TITLES = ("sect-title", "sect-header", "title-item", "sear-head", "volume-title")
#: What ``html_pages`` must give for ``table_of_contents``.
CONTENTS = {
    "wanted": ("a", ".volume-list", ".chapter-time", *(f".{c}" for c in SECTION_TITLES)),
    "scopes": {"section": (".volume-list",), "list": (".list-chapters",), "noise": ("footer", "nav", *(f".{c}" for c in NOISE_CLASSES), *(f"#{i}" for i in NOISE_IDS))},
}


def contents_lists(pages: DataFrame, base: str, keep: Iterable[str] = ()) -> DataFrame:
    """(page, items, what is to be kept): the table of contents of a work page as an array; page is the work's URL.

    Anchors in noise are dropped; a URL counts once on a page, where it stands in a list before where it does not; links
    to items of other works are dropped. Links outside of lists go to the last kept section. Dates go by position in
    the section. Sections take their links and dates by one pass each, and no row leaves its task.
    """
    d = pages.withColumn("_n", F.filter("nodes", lambda n: n["within"]["noise"].isNull()))
    section = lambda n: n["within"]["section"]
    listed = lambda n: section(n).isNotNull() & n["within"]["list"].isNotNull()
    links = F.filter("_n", lambda n: (n["tag"] == "a") & (F.coalesce(n["attrs"]["href"], F.lit("")) != ""))
    d = d.withColumn("_links", F.transform(links, lambda n: F.struct(listed(n).alias("in"), section(n).alias("sec"), n["pos"].alias("pos"), n["attrs"]["href"].alias("href"), n["text"].alias("text"))))
    d = d.withColumn("_links", F.filter("_links", lambda x: x["in"] | x["href"].rlike(r"/c\d+-[^/]+")))
    d = d.withColumn("_urls", U.normalize_each(F.transform("_links", lambda x: x["href"]), base))
    d = d.withColumn("_links", F.zip_with("_links", "_urls", lambda x, u: x.withField("href", u).withField("slug", U.slug(u))))
    d = d.withColumn("_dates", F.transform(F.filter("_n", lambda n: has_class(n, "chapter-time") & n["within"]["list"].isNotNull()), lambda n: F.struct(section(n).alias("sec"), n["text"].alias("date"))))
    d = d.withColumn("_heads", F.transform(F.filter("_n", lambda n: has_class(n, *SECTION_TITLES)), lambda n: F.struct(section(n).alias("sec"), n["text"].alias("title"))))
    d = d.withColumn("_secs", F.transform(F.filter("_n", lambda n: has_class(n, "volume-list")), lambda n: n["pos"]))
    # what an inner expression reads for every section is bound first: the optimiser may put a column's own expression there
    own = lambda items, s: F.filter(items, lambda x: x["sec"] == s)
    parts = U.let(F.struct("_secs", "_links", "_heads", "_dates"), lambda v: F.transform(v["_secs"], lambda s, i: F.struct(
        (i + 1).alias("index"), F.get(own(v["_heads"], s), F.lit(0))["title"].alias("title"), F.filter(v["_links"], lambda x: x["in"] & (x["sec"] == s)).alias("links"), own(v["_dates"], s).alias("dates"),
    )))
    d = d.withColumn("_parts", parts)

    def item(x: Column, index: Column, title: Column, date: Column) -> Column:
        return F.struct(x["href"].alias("url"), x["slug"].alias("slug"), x["in"].alias("in"), x["pos"].alias("pos"), x["text"].alias("text"), index.cast("int").alias("index"), title.alias("title"), date.alias("date"))

    dated = lambda p: F.filter(F.zip_with(p["links"], p["dates"], lambda x, y: F.struct(x.alias("x"), y["date"].alias("date"))), lambda z: z["x"].isNotNull())
    inner = F.flatten(F.transform("_parts", lambda p: F.transform(dated(p), lambda z: item(z["x"], p["index"], p["title"], z["date"]))))
    loose = F.transform(F.filter("_links", lambda x: ~x["in"]), lambda x: item(x, F.lit(None), F.lit(None).cast("string"), F.lit(None).cast("string")))
    d = d.withColumn("_all", F.concat(F.array_sort(inner, lambda a, b: a["pos"] - b["pos"]), loose))
    d = d.select("page", *keep, U.slug(F.col("page")).alias("_work"), "_all").withColumn("_all", U.let(F.struct("_all", "_work"), lambda v: F.filter(v["_all"], lambda x: U.belongs_to_slug(x["url"], x["slug"], v["_work"]))))
    d = first_of_each(d, "_all", "url")
    d = d.withColumn("_sec", F.array_max(F.transform(F.filter("_all", lambda x: x["in"]), lambda x: F.struct(x["index"].alias("index"), x["title"].alias("title")))))
    index = lambda x: F.coalesce(x["index"], F.col("_sec")["index"], F.lit(1))
    return d.select("page", *keep, F.transform("_all", lambda x, i: F.struct(
        F.coalesce(F.when(x["in"], x["title"]).otherwise(F.col("_sec")["title"]), F.concat(F.lit("Quyển "), index(x).cast("string"))).alias("section"), index(x).cast("long").alias("section_index"), (i + 1).cast("long").alias("item_index"), x["url"].alias("item_url"),
        F.coalesce(F.nullif(x["text"], F.lit("")), F.concat(F.lit("Chương "), (i + 1).cast("string"))).alias("title"), F.coalesce(x["date"], F.lit("")).alias("date"),
    )).alias("items"))


def table_of_contents(pages: DataFrame, base: str) -> DataFrame:
    """Items of a work page with section, date, title and running index: ``contents_lists``, a row an item."""
    # an outer generator: from an inner one, Spark infers a filter that works the whole array out a second time below
    return contents_lists(pages, base).select("page", F.inline_outer("items")).filter("item_url IS NOT NULL")


# Classes of feed cards, in the order in which they are tried.
CARDS = ("thumb-item-flow", "series-item")
#: What ``html_pages`` must give for ``feed_entries``.
FEED = {"wanted": ("a", "time", ".time-ago", *(f".{c}" for c in CARDS)), "scopes": {"title": (".series-title",), "item": (".chapter-title",), **{c: (f".{c}",) for c in CARDS}}}


def _of(name: str) -> Callable[[Column], Column]:
    return lambda n: has_class(n, name)


def feed_entries(pages: DataFrame, base: str, card: tuple[str, ...] = CARDS) -> DataFrame:
    """One row per card with a title link; pages without cards fall back to bare title links.

    The first class of cards that a page has is taken; narrower selectors of the first class choose no other cards.
    """
    kind = F.lit(None).cast("string")
    for c in reversed(card):
        kind = F.when(first_node(F.col("nodes"), _of(c)).isNotNull(), c).otherwise(kind)
    d = pages.withColumn("_kind", kind)
    in_title, in_item = (lambda n: n["within"]["title"].isNotNull() & (n["tag"] == "a")), (lambda n: n["within"]["item"].isNotNull() & (n["tag"] == "a"))
    time = lambda n: (n["tag"] == "time") | has_class(n, "time-ago")
    mine = F.filter("nodes", lambda n: n["within"][F.col("_kind")].isNotNull())
    d = d.withColumn("_own", F.transform(mine, lambda n: F.struct(n["within"][F.col("_kind")].alias("card"), n.alias("n"))))
    cards = F.transform(F.filter("nodes", lambda n: F.array_contains(n["classes"], F.col("_kind"))), lambda n: n["pos"])
    d = d.withColumn("_cards", U.let(F.struct(cards.alias("cards"), "_own"), lambda v: F.transform(v["cards"], lambda p: F.struct(p.alias("pos"), F.transform(F.filter(v["_own"], lambda x: x["card"] == p), lambda x: x["n"]).alias("own")))))
    none = F.lit("")

    def entry(pos: Column, link: Column, latest: Column, when: Column) -> Column:
        return F.struct(pos.alias("pos"), link.alias("link"), latest.alias("latest"), when.alias("when"))

    told = F.filter(F.transform("_cards", lambda c: entry(c["pos"], first_node(c["own"], in_title), first_node(c["own"], in_item), first_node(c["own"], time))), lambda e: e["link"].isNotNull())
    nothing = F.get(F.filter("nodes", lambda n: F.lit(False)), F.lit(0))
    bare = F.transform(F.filter("nodes", lambda n: in_title(n) & (F.coalesce(n["attrs"]["href"], none) != "")), lambda n: entry(n["pos"], n, nothing, nothing))
    d = d.withColumn("_told", told).select("page", F.inline_outer(F.when(F.size("_told") > 0, F.col("_told")).otherwise(bare))).filter("pos IS NOT NULL")
    text = lambda c: F.coalesce(F.col(c)["text"], none)
    href = lambda c: U.normalize(F.coalesce(F.col(c)["attrs"]["href"], none), base)
    return d.select("page", "pos", href("link").alias("work_url"), text("link").alias("title"), text("latest").alias("latest_title"), href("latest").alias("latest_url"), text("when").alias("updated"))


def asset_urls(pages: DataFrame, base: str) -> DataFrame:
    """Distinct image addresses of a page in order: src, else data-src; nodes need the tag img."""
    src = lambda n: F.coalesce(F.nullif(n["attrs"]["src"], F.lit("")), F.nullif(n["attrs"]["data-src"], F.lit("")))
    found = F.filter(F.transform(F.filter("nodes", lambda n: n["tag"] == "img"), src), lambda x: x.isNotNull())
    return pages.select("page", F.array_distinct(U.normalize_each(found, base)).alias("assets"))


def work_titles(pages: DataFrame) -> DataFrame:
    """(page, title): the first element of class series-name, or else the slug of the page's address."""
    named = first_node(F.col("nodes"), lambda n: has_class(n, "series-name"))["text"]  # fixed value: the class of a work's name
    return pages.select("page", F.coalesce(named, U.slug(F.col("page"))).alias("title"))


# Where links of a catalogue stand.
CATALOG = {"wanted": ("a",), "scopes": {"title": (".series-title",), "card": (".thumb-item-flow",)}}


def catalog_urls(pages: DataFrame, base: str, prefixes: tuple[str, ...] = U.WORK_PREFIXES) -> DataFrame:
    """(page, item_index, url): addresses of works on a catalogue page, distinct, in order of their first link.

    Links count inside of series-title, and covers (class series-cover) inside of thumb-item-flow. Nodes as CATALOG says.
    """
    linked = lambda n: (n["tag"] == "a") & (n["within"]["title"].isNotNull() | (has_class(n, "series-cover") & n["within"]["card"].isNotNull()))
    urls = F.transform(F.filter("nodes", linked), lambda n: n["attrs"]["href"])
    of_works = F.filter(U.normalize_each(urls, base), lambda u: u.rlike("/(" + "|".join(re.escape(p) for p in prefixes) + ")/"))
    return pages.select("page", F.posexplode_outer(F.array_distinct(of_works)).alias("_i", "url")).filter("url IS NOT NULL").select("page", (F.col("_i") + 1).cast("long").alias("item_index"), "url")


# Where links of a pagination stand.
PAGINATION = {"wanted": ("a",), "scopes": {"wrap": (".paging_item", ".pagination_wrap"), "list": (".pagination",), "entry": ("li",)}}


def largest_pages(pages: DataFrame) -> DataFrame:
    """(page, max_page): largest number among the pagination links of each page, 1 at least. Nodes as PAGINATION says.

    A link whose text is a number counts with that, another with ``page=`` in its address.
    """
    listed = lambda n: (n["tag"] == "a") & (n["within"]["wrap"].isNotNull() | F.coalesce(n["within"]["entry"] > n["within"]["list"], F.lit(False)))
    number = lambda n: F.when(n["text"].rlike(r"^\d+$"), n["text"]).otherwise(F.regexp_extract(n["attrs"]["href"], r"page=(\d+)", 1)).try_cast("long")
    most = F.array_max(F.transform(F.filter("nodes", listed), number))
    return pages.select("page", F.greatest(F.lit(1), F.coalesce(most, F.lit(1))).cast("long").alias("max_page"))


# Classes of an item's heads and content.
#: What ``html_pages`` must give for ``item_pages``, besides ``text_only``.
ITEM_NODES = {"wanted": ("h4", "h6", "p", ".chapter-title", ".chapter-content", ".reading-content", "#chapter-content"), "scopes": {"top": (".title-top",)}}


def item_pages(pages: DataFrame, repair: Callable[[Column], Column] = lambda c: c, keep: Iterable[str] = ()) -> DataFrame:
    """(page, what is to be kept, title, section, words, date, text) of every item page.

    The first heading is the title, or else a constant; the first subheading is the section's title and may tell words
    and date. The text is the paragraphs of the content, or where it has none its lines: trimmed, not empty, no notice, not
    equal to a title, joined by blank lines. Without a number of words in the heading the text's are counted. Title,
    section and text are repaired after that.
    """
    top = lambda n: n["within"]["top"].isNotNull() | has_class(n, "title-item")
    is_content = lambda n: has_class(n, "chapter-content", "reading-content") | (n["id"] == "chapter-content")
    nodes = F.col("nodes")
    d = pages.select(
        "page", *keep, F.filter(nodes, lambda n: n["tag"] == "p").alias("_p"), first_node(nodes, is_content).alias("_content"),
        F.coalesce(first_node(nodes, lambda n: (n["tag"] == "h4") & top(n) | has_class(n, "chapter-title"))["text"], F.lit("Chương")).alias("title"),
        F.coalesce(first_node(nodes, lambda n: (n["tag"] == "h6") & top(n))["text"], F.lit("")).alias("section"),
    )
    inner = F.transform(F.filter("_p", lambda n: (n["pos"] > F.col("_content")["pos"]) & (n["pos"] <= F.col("_content")["last"])), lambda n: n["text"])
    lines = F.transform(F.split(T.clean(F.col("_content")["text"]), "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    d = d.withColumn("_inner", inner).withColumn("_lines", F.when(F.size("_inner") > 0, F.col("_inner")).otherwise(lines))
    kept = F.filter("_lines", lambda x: (x != "") & ~T.is_notice(x) & (x != F.col("title")) & (x != F.col("section")))
    out = d.withColumn("text", repair(F.coalesce(F.array_join(kept, "\n\n"), F.lit(""))))
    told = T.digits_to_int(F.regexp_extract("section", r"(?iu)Độ dài:\s*([\d.,]+)\s*từ", 1))
    date = F.trim(F.regexp_extract("section", r"(?iu)Cập nhật:\s*([^\n\r]+)", 1))
    return out.select("page", *keep, repair(F.col("title")).alias("title"), repair(F.col("section")).alias("section"), F.when(told > 0, told).otherwise(T.word_count(F.col("text"))).cast("long").alias("words"), date.alias("date"), "text")


# Flat markup: expressions only.


_ANCHOR = r"""<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def links(html: Column) -> Column:
    """(href, text) of the anchors in order, in any case and quoting; empty addresses dropped."""
    found = F.regexp_extract_all(html, F.lit(rf"(?is){_ANCHOR}[^>]*>.*?</a>"), F.lit(0))
    href = lambda x: F.trim(F.regexp_replace(F.regexp_extract(x, rf"(?is)^{_ANCHOR}", 1), r"""^["']|["']$""", ""))
    pairs = F.transform(found, lambda x: F.struct(href(x).alias("href"), F.trim(F.regexp_replace(F.regexp_replace(x, "(?s)<[^>]*>", ""), r"^\s+|\s+$", "")).alias("text")))
    return F.filter(pairs, lambda p: p["href"] != "")


def page_title(html: Column, fallback: Column) -> Column:
    """Text of the first h1, also an empty one; without any, the fallback."""
    return F.when(html.rlike(r"(?s)<h1[^>]*>.*?</h1>"), F.trim(F.regexp_replace(F.regexp_extract(html, r"(?s)<h1[^>]*>(.*?)</h1>", 1), "<[^>]*>", ""))).otherwise(fallback)


def body_text(html: Column, title: Column) -> Column:
    """Paragraphs of the article, without scripts, styles, notices, and lines equal to the title, joined by blank lines."""
    h = F.regexp_replace(html, r"(?is)<(script|style|noscript)[^>]*>.*?</\1>", "")
    h = F.regexp_replace(h, '(?is)<!--.*?-->|<div class="ad">.*?</div>', "")
    article = F.regexp_extract(h, r"(?is)<article[^>]*>(.*?)(</article>|$)", 1)
    parts = F.slice(F.split(article, "(?i)<p[^>]*>"), F.lit(2), F.lit(1 << 30))
    plain = F.transform(parts, lambda x: unescape(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "(?is)</p>.*", ""), "(?s)<[^>]*>", ""), r"^\s+|\s+$", "")))
    kept = F.filter(plain, lambda x: (x != "") & ~T.is_notice(x) & (x != F.coalesce(title, F.lit(""))))
    return F.array_join(kept, "\n\n")


def unescape(s: Column) -> Column:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s
