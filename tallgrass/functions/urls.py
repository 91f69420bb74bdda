"""URL expressions: columns in, columns out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First path segments that stand before a work's slug.
WORK_PREFIXES = ("truyen", "sang-tac", "convert")
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def _trimmed_path(url: Column) -> Column:
    return F.regexp_replace(path(url), "^/+|/+$", "")


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def slug(url: Column, prefixes: Sequence[str] = WORK_PREFIXES) -> Column:
    """Second path part after a known prefix, else the whole path with ``_`` for ``/``; an empty path is ``novel``."""

    def of(p: Column) -> Column:
        parts = F.split(p, "/")
        return F.when((F.size(parts) >= 2) & F.get(parts, F.lit(0)).isin(*prefixes), F.get(parts, F.lit(1))).when(p == "", "novel").otherwise(F.replace(p, F.lit("/"), F.lit("_")))

    return let(_trimmed_path(url), of)


def work_id(url: Column, prefixes: Sequence[str] = WORK_PREFIXES) -> Column:
    """Leading digits of the slug as a number, or null."""
    return F.regexp_extract(slug(url, prefixes), r"^(\d+)", 1).try_cast("long")


def item_id(url: Column) -> Column:
    """Digits of the first path part that starts with ``c`` and a digit, or null."""
    return F.regexp_extract(path(url), r"(?:^|/)c(\d+)", 1).try_cast("long")


def normalize(url: Column, base: str) -> Column:
    """Trim, complete ``//`` to https, keep http(s), and join the rest to ``base`` as RFC 3986 has it.

    Dot segments of joined paths are resolved; ``base`` is an origin with or without a path.
    """
    return _normalized(url, F.trim(F.regexp_replace(url, r"^\s+|\s+$", "")), base)


def normalize_each(urls: Column, base: str) -> Column:
    """``normalize`` of every URL of an array. There nothing is shared between parts of an expression, so each step is one of its own."""
    trimmed = F.transform(urls, lambda u: F.trim(F.regexp_replace(F.coalesce(u, F.lit("")), r"^\s+|\s+$", "")))
    plain = lambda t: t.startswith("http://") | t.startswith("https://") | (t == "")
    return F.transform(trimmed, lambda t: F.when(plain(t), t).otherwise(_normalized(t, t, base)))


def _normalized(url: Column, t: Column, base: str) -> Column:
    import re

    origin, base_path = re.match(r"^([a-z]+://[^/?#]*)([^?#]*)", base).groups()
    folder = base_path.rpartition("/")[0]
    query = F.regexp_extract(t, r"([?#].*)$", 1)
    own = F.regexp_extract(t, r"^([^?#]*)", 1)
    raw = F.when(own == "", F.lit(base_path)).when(own.startswith("/"), own).otherwise(F.concat(F.lit(folder + "/"), own))
    joined = F.concat(F.lit(origin), F.when(own == "", raw).otherwise(_no_dots(raw)), query)
    return F.when(url.isNull() | (t == ""), F.lit("")).when(t.startswith("//"), F.concat(F.lit("https:"), t)).when(t.rlike("^https?://"), t).otherwise(joined)


def _no_dots(p: Column) -> Column:
    """Remove ``.`` and resolve ``..`` by one fold over the segments."""
    parts = F.split(F.regexp_replace(p, "^/", ""), "/")
    none = F.array().cast("array<string>")
    folded = F.aggregate(parts, none, lambda a, x: F.when(x == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).when(x == ".", a).otherwise(F.concat(a, F.array(x))))
    tail = F.when(p.rlike(r"(^|/)\.\.?$") & (F.size(folded) > 0), "/").otherwise("")
    return F.when(p.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(folded, "/"), tail)).otherwise(p)


def is_http(url: Column) -> Column:
    return url.rlike("^https?://")


def from_slug(x: Column, base: str) -> Column:
    return F.when(x.startswith("http"), x).otherwise(F.concat(F.lit(f"{base}/truyen/"), x))


def belongs_to_work(item_url: Column, work_url: Column, prefixes: Sequence[str] = WORK_PREFIXES) -> Column:
    """Whether an item's URL has an item part and agrees with the work by id, or else by slug."""
    return belongs_to_slug(item_url, slug(item_url, prefixes), slug(work_url, prefixes))


def belongs_to_slug(item_url: Column, item: Column, work: Column) -> Column:
    """As ``belongs_to_work``, from the slugs of both URLs."""
    number = lambda s: F.coalesce(F.regexp_extract(s, r"^(\d+)", 1).try_cast("long"), F.lit(0))  # noqa: E731  an id of 0 counts as unknown

    def by(x: Column) -> Column:
        s, own, a, b = x["work"], x["item"], x["a"], x["b"]
        by_slug = F.when((s != "") & (own != "") & (s != "novel"), (own == s) | item_url.contains(s)).otherwise(True)
        return F.when((a != 0) & (b != 0), a == b).otherwise(by_slug)

    both = F.struct(work.alias("work"), item.alias("item"), number(item).alias("a"), number(work).alias("b"))
    return F.coalesce(F.when(item_url.rlike(r"/c\d+"), let(both, by)).otherwise(False), F.lit(False))


def asset_extension(url: Column) -> Column:
    low = F.lower(url)
    return F.when(low.contains(".png"), ".png").when(low.contains(".webp"), ".webp").otherwise(".jpg")


def cover_path(file_name: Column, url: Column) -> Column:
    """Covers are named after their work."""
    return F.concat(file_name, asset_extension(url))


def recovered_path(url: Column) -> Column:
    """Where assets go that a retry fetched, whatever their kind."""
    return F.concat(F.lit("retry/"), F.substring(F.md5(url), 1, 12), F.lit(".jpg"))


def asset_path(file_name: Column, url: Column) -> Column:
    """Folder of the work, first 12 digits of the URL's md5, extension."""
    return F.concat(file_name, F.lit("/"), F.substring(F.md5(url), 1, 12), asset_extension(url))
