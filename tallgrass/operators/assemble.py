"""Tables of contents, item fragments and whole documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import escape_html
from ..functions.urls import asset_extension


def toc_islands(items: DataFrame, work: str = "work_id", index: str = "item_index", section: str = "section", tie: tuple[str, ...] = ()) -> DataFrame:
    """Runs of items with the same section, in order: (work, group, section, first and last index, items).

    Items before the first section join its group; without any section all are one untitled group. A null section
    after a titled one is a group of its own, titled by its number.
    """
    w = Window.partitionBy(work).orderBy(index, *tie)
    before = F.lag(section).over(w)
    n = F.row_number().over(w)
    changed = F.when(n == 1, F.col(section).isNotNull()).otherwise(~before.eqNullSafe(F.col(section)))
    grouped = items.withColumn("_n", changed.cast("int")).withColumn("_g", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    any_section = F.max(F.col(section).isNotNull()).over(Window.partitionBy(work))
    grouped = grouped.withColumn("_g", F.when(any_section & (F.col("_g") == 0), 1).otherwise(F.col("_g")))
    out = grouped.groupBy(work, F.col("_g").cast("long").alias("grp")).agg(F.max(section).alias("section"), F.min(index).alias("first_index"), F.max(index).alias("last_index"), F.count("*").alias("items"))
    title = F.when(F.col("grp") == 0, F.lit("")).otherwise(F.coalesce("section", F.concat(F.lit("Tập "), F.col("grp").cast("string"))))
    return out.select(work, "grp", title.alias("title"), "first_index", "last_index", "items")


def export_assets(uses: DataFrame, stored: DataFrame, work: str, url: str, path: str, order: list[str]) -> DataFrame:
    """Uses of assets with ``src``, the name in the archive where a file is stored, else the address, and ``embedded``.

    ``stored`` has the paths of files. An archive takes a stored file in once, at its first use within the work.
    """
    have = stored.select(F.col(path).alias("_p")).distinct()
    name = F.concat(F.lit("images/img_"), F.substring(F.md5(url), 1, 12), asset_extension(F.col(url)))
    j = uses.join(have, uses[path] == have["_p"], "left").withColumn("src", F.when(F.col("_p").isNotNull(), name).otherwise(F.col(url)))
    first = F.row_number().over(Window.partitionBy(work, "src").orderBy(*order)) == 1
    return j.withColumn("embedded", F.col("_p").isNotNull() & first).drop("_p")


def introduction(title: Column, alternative_titles: Column, author: Column, artist: Column, genres: Column, status: Column, url: Column, summary: Column, *, repair: Callable[[Column], Column] = lambda c: c) -> Column:
    """Markup of a work's first page: title, facts that are there, and the summary's lines; escaped. ``repair`` mends all but genres, status and address."""
    title, alternative_titles, artist, summary = (repair(c) for c in (title, alternative_titles, artist, summary))
    author = repair(F.coalesce(F.nullif(author, F.lit("")), F.lit("Chưa rõ")))
    fact = lambda label, value: F.concat(F.lit(f"<p><strong>{label}:</strong> "), value, F.lit("</p>"))
    given = lambda label, value: F.when(F.coalesce(value, F.lit("")) != "", fact(label, escape_html(value)))
    link = F.concat(F.lit('<a href="'), escape_html(url), F.lit('">'), escape_html(url), F.lit("</a>"))
    facts = [
        F.concat(F.lit("<h1>"), escape_html(title), F.lit("</h1>")), F.lit('<div class="meta">'), given("Tên khác", alternative_titles),
        fact("Tác giả", escape_html(author)), given("Họa sĩ", artist), given("Thể loại", F.array_join(genres, ", ")),
        fact("Tình trạng", escape_html(status)), F.when(F.coalesce(url, F.lit("")) != "", fact("Nguồn", link)), F.lit("</div>"),
    ]
    lines = F.filter(F.transform(F.split(F.coalesce(summary, F.lit("")), "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    told = F.transform(lines, lambda x: F.concat(F.lit("<p>"), escape_html(x), F.lit("</p>")))
    box = F.when(F.size(lines) > 0, F.concat(F.array(F.lit('<div class="summary">'), F.lit("<h3>Tóm tắt nội dung</h3>")), told, F.array(F.lit("</div>")))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(F.array_compact(F.array(*facts)), box), "\n")


def exportable_works(works: DataFrame, work: str = "work_id", status: str = "status") -> DataFrame:
    """Completed works in order of their ids."""
    return works.filter(F.col(status) == "completed").orderBy(work)


def fragment(title: Column, text: Column, words: Column, date: Column | None = None, assets: Column | None = None, *, repair: Callable[[Column], Column] = lambda c: c) -> Column:
    """Markup of one item: heading, a line of date and words if there are any, images, paragraphs with line breaks, escaped. ``repair`` mends title and text first."""
    title, text = repair(title), repair(text)
    facts = [F.when(words > 0, F.concat(F.format_number(words, 0), F.lit(" từ")))]
    if date is not None:
        facts.insert(0, F.when(F.coalesce(date, F.lit("")) != "", F.concat(F.lit("Cập nhật: "), escape_html(date))))
    line = F.array_join(F.array_compact(F.array(*facts)), " — ")
    meta = F.when(line != "", F.concat(F.lit('<p class="date">'), line, F.lit("</p>")))
    strip = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    paragraphs = F.filter(F.transform(F.split(text, "\n\n"), strip), lambda x: x != "")

    def paragraph(p: Column) -> Column:
        lines = F.filter(F.transform(F.split(p, "\n"), strip), lambda x: x != "")
        return F.concat(F.lit("<p>"), F.array_join(F.transform(lines, escape_html), "<br />"), F.lit("</p>"))

    images = F.array().cast("array<string>") if assets is None else F.coalesce(assets, F.array().cast("array<string>"))
    shown = F.transform(images, lambda x: F.concat(F.lit('<p class="center"><img src="'), escape_html(x), F.lit('" alt="Minh họa" /></p>')))
    parts = F.concat(F.array_compact(F.array(F.concat(F.lit("<h2>"), escape_html(title), F.lit("</h2>")), meta)), shown, F.transform(paragraphs, paragraph))
    return F.array_join(parts, "\n")


def first_embedding(assets: DataFrame, work: str, asset: str, order: list[str], *, task_rows: int = 500_000) -> DataFrame:
    """Flag the first use of an asset within a work; a window holds the uses of one asset in one work.

    The rows are counted and dealt out to so many tasks that each sorts about ``task_rows``, whatever the size of the table.
    """
    assets = assets.repartition(max(int(assets.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-assets.count() // task_rows)), work, asset)
    return assets.withColumn("embedded", F.row_number().over(Window.partitionBy(work, asset).orderBy(*order)) == 1)


def _some(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def _header(repair: Callable[[Column], Column]) -> Column:
    """The lines before a work's items, as an array."""
    rule, thin = F.lit("=" * 60), F.lit("-" * 60)
    head = F.array_compact(F.array(
        rule, F.upper(repair(F.col("title"))),
        F.when(_some("alternative_titles"), F.concat(F.lit("Tên khác: "), repair(F.col("alternative_titles")))),
        F.concat(F.lit("Tác giả: "), repair(F.coalesce(F.nullif(F.col("author"), F.lit("")), F.lit("Chưa rõ")))),
        F.when(_some("artist"), F.concat(F.lit("Họa sĩ: "), repair(F.col("artist")))),
        F.concat(F.lit("Thể loại: "), F.array_join("genres", ", ")), F.concat(F.lit("Tình trạng: "), F.col("status")), F.concat(F.lit("Nguồn: "), F.col("url")), rule, F.lit(""),
    ))
    summary = F.when(_some("summary"), F.array(F.lit("TÓM TẮT NỘI DUNG:"), repair(F.col("summary")), F.lit(""), thin, F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(head, summary), "\n")


def _block(repair: Callable[[Column], Column]) -> Column:
    """The lines of an item."""
    lines = F.array(F.concat(F.lit("--- "), F.upper(repair(F.col("title"))), F.lit(" ---")), F.when(_some("date"), F.concat(F.lit("["), F.col("date"), F.lit("]"))), F.lit(""), repair(F.col("text")), F.lit(""), F.lit("-" * 60), F.lit(""))
    return F.array_join(F.array_compact(lines), "\n")


def document_text(works: DataFrame, items: DataFrame, work: str = "work_id", order: tuple[str, ...] = ("item_index",), repair: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """One text per work that has items: a header, the summary if any, and every item in order.

    Works: title, alternative_titles, author, artist, genres (array), status, url, summary. Items: title, date, text.
    A work's text must fit a row; ``document_rows`` has no such limit.
    """
    body = items.select(work, F.struct(*order, _block(repair).alias("b")).alias("_b")).groupBy(work).agg(F.array_join(F.transform(F.sort_array(F.collect_list("_b")), lambda x: x["b"]), "\n").alias("_body"))
    top = works.select(work, "title", _header(repair).alias("_head"))
    return top.join(body, work).select(work, "title", F.concat_ws("\n", "_head", "_body").alias("content"))


def document_rows(works: DataFrame, items: DataFrame, work: str = "work_id", order: tuple[str, ...] = ("item_index",), repair: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """The parts of the same texts as rows: the header (``is_item`` false, order null), then a row for every item.

    Sorted by work, is_item, order and block, and joined by line ends, a work's blocks are its ``document_text``. No
    work's items come together in a row or a task, so a work may have any number of them. Null keys have no text.
    """
    none = [F.lit(None).cast(items.schema[c].dataType).alias(c) for c in order]
    used = items.select(work).distinct()
    head = works.join(used, work, "left_semi").select(work, F.lit(False).alias("is_item"), *none, _header(repair).alias("block"))
    body = items.join(works.select(work), work, "left_semi").select(work, F.lit(True).alias("is_item"), *order, _block(repair).alias("block"))
    return head.union(body)


def export_rows(rows: DataFrame, path: str, work: str = "work_id", order: tuple[str, ...] = ("item_index",), *, each: bool = True) -> None:
    """Write ``document_rows`` as text: a folder for each work, whose files, in the order of their names, make up its text.

    A folder and a file for each work take far longer to make than a short text to write, so that is for some thousand works.
    Without ``each``, works share files: lines of JSON with the work and a block, in the same order, all blocks of all works.

    Rows are dealt out by ranges of work and place and sorted in their tasks, so a long work takes as many tasks, and
    files, as its size asks for. Null and empty names go to the folder ``_``.
    """
    if not each:
        keys = [work, "is_item", *order, "block"]
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(work, "block").write.json(path)
        return
    keys = ["_folder", "is_item", *order, "block"]
    named = rows.withColumn("_folder", F.coalesce(F.nullif(F.col(work).cast("string"), F.lit("")), F.lit("_")))
    named.repartitionByRange(*keys).sortWithinPartitions(*keys).select(F.col("_folder").alias("work"), F.col("block").alias("value")).write.partitionBy("work").text(path)
