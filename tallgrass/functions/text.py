"""Text, number and format expressions: columns in, columns out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases that mark a notice instead of a paragraph.
NOTICE_PHRASES = (
    "click vào link khi mua bất kỳ",
    "shopee để ủng hộ",
    "mã free ship",
    "ủng hộ hako",
    "mua bất cứ sản phẩm",
)


def clean(s: Column) -> Column:
    """Line ends to LF, at most one blank line in a row, trimmed."""
    s = F.regexp_replace(F.regexp_replace(s, "\r\n|\r", "\n"), "\n{3,}", "\n\n")
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def file_name(s: Column, most: int = 120) -> Column:
    s = F.regexp_replace(F.regexp_replace(s, r'[\\/*?:"<>|]', ""), r"\s+", " ")
    s = F.rtrim(F.substring(F.trim(s), 1, most))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("untitled"))


def format_bytes(n: Column) -> Column:
    """Divide a whole number by 1024 up to PB; one decimal, ties to even."""
    shown = lambda i, unit: F.format_string(f"%.1f {unit}", F.rint(n / float(1024**i) * 10) / 10)
    out = shown(5, "PB")
    for i, unit in reversed(list(enumerate(("B", "KB", "MB", "GB", "TB")))):
        out = F.when(n < float(1024 ** (i + 1)), shown(i, unit)).otherwise(out)
    return out


def format_duration(seconds: Column) -> Column:
    s = seconds.cast("long")
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return F.when(h > 0, F.format_string("%dh %02dm %02ds", h, m, s % 60)).when(m > 0, F.format_string("%dm %02ds", m, s % 60)).otherwise(F.format_string("%ds", s))


def first_nonempty(a: Column, b: Column) -> Column:
    return F.coalesce(F.nullif(a, F.lit("")), b)


def digits_to_int(s: Column) -> Column:
    return F.coalesce(F.regexp_replace(s, "[^0-9]", "").try_cast("long"), F.lit(0).cast("long"))


def word_count(s: Column) -> Column:
    return F.size(F.filter(F.split(s, r"\s+"), lambda x: x != ""))


def is_notice(s: Column, phrases: Sequence[str] = NOTICE_PHRASES) -> Column:
    """Whether the lower-cased text holds any of the phrases."""
    low = F.lower(s)
    out = F.lit(False)
    for p in phrases:
        out = out | low.contains(p)
    return out


def escape_html(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def fetch_outcome(status: Column) -> Column:
    return F.when(status == 200, "ok").when(status.isin(403, 404), "permanent").when(status.isin(429, 502, 503, 504), "throttled").otherwise("retryable")


def json_array(s: Column) -> Column:
    """A JSON array of strings; null, empty and malformed text is an empty array."""
    return F.coalesce(F.from_json(F.coalesce(F.nullif(s, F.lit("")), F.lit("[]")), "array<string>"), F.array().cast("array<string>"))


def reassemble(segments: Column) -> Column:
    """Order numbered base64 segments, a JSON array of texts, and join what they decode to.

    The first four characters of a segment are its number; shorter ones and those that don't decode are left out. If
    any number can't be read, the given order stays. Malformed JSON gives ''.
    """
    parts = F.from_json(segments, "array<string>")
    good = F.forall(parts, lambda x: F.substring(x, 1, 4).try_cast("int").isNotNull())
    keyed = F.transform(parts, lambda x, i: F.struct(F.substring(x, 1, 4).try_cast("int").alias("k"), i.alias("i"), x.alias("x")))
    ordered = F.when(good, F.transform(F.sort_array(keyed), lambda x: x["x"])).otherwise(parts)
    kept = F.filter(ordered, lambda x: F.length(x) > 4)
    decoded = F.transform(kept, lambda x: F.decode(F.try_to_binary(F.regexp_replace(F.substring(x, 5, 1 << 30), "[^A-Za-z0-9+/=]", ""), F.lit("base64")), "UTF-8"))
    return F.coalesce(F.array_join(decoded, ""), F.lit(""))
