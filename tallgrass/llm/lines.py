"""Substring deduplication by hashing units of text: clauses, lines or paragraphs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, same, stored, text_tag
from .filters import has_key, key_filter
from .passages import repeated_passages
from .textops import LOWER, digests, flat, ints, pieces, prefix_hash, span_hash, word_spans

_WORD = re.compile(WORD)
#: Bytes that end a clause when white space follows.
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?,;:")] = True


def unit_spans(data: np.ndarray, off: np.ndarray, unit: str) -> tuple[np.ndarray, ...]:
    """(word starts, word ends, words before each row, first word of each unit, word after its last, row of each unit)."""
    s, e, before = word_spans(data, off)
    new = np.zeros(len(s), bool)
    new[before[:-1][before[:-1] < before[1:]]] = True
    if len(s):
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        new[1:] |= breaks[s[1:]] - breaks[e[:-1]] >= (2 if unit == "paragraph" else 1)
        if unit == "clause":
            new[1:] |= _STOPS[data[e[:-1] - 1]]
    first = np.flatnonzero(new)
    return s, e, before, first, np.append(first[1:], len(s))[: len(first)], np.searchsorted(before, first, side="right") - 1


def _compared(unit: str, min_words: int):
    """A row for every unit of at least ``min_words`` words: its number among these, its words and 128 bits of hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in pieces(batches, "_text"):
                data, off = flat(batch["_text"])
                low = LOWER[data]
                s, e, before, a, b, row = unit_spans(low, off, unit)
                h, other = (span_hash(prefix_hash(x), s, e) for x in (low, low ^ np.uint8(0x5B)))
                h1, h2 = digests(h, other, a, b)
                on = np.flatnonzero(b - a >= min_words)
                a, b, row, h1, h2 = a[on], b[on], row[on], h1[on], h2[on]
                n = np.bincount(row, minlength=batch.num_rows)
                i = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([batch["_id"].take(at), batch["_t"].take(at), pa.array(i, pa.int32()), pa.array(a - before[row], pa.int32()), pa.array(b - a, pa.int32()), ints(h1), ints(h2)], ["_id", "_t", "_i", "_a", "_n", "_h1", "_h2"])

    return run


def _passing(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                yield batch.filter(pa.array(has_key(bits.value, batch["_h1"].to_numpy().astype(np.int64).view(np.uint64))))

    return run


def _runs(seen: list[dict], min_run: int) -> list[tuple[int, int]]:
    """Word spans of runs of neighbouring seen units that have ``min_run`` words together."""
    out, last, start, end, n = [], -2, 0, 0, 0
    for i, a, words in [*sorted((u["i"], u["a"], u["n"]) for u in seen), (-9, 0, 0)]:
        if i != last + 1:
            if n >= min_run:
                out.append((start, end))
            start, n = a, 0
        last, end, n = i, a + words, n + words
    return out


def cuts(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points that go with spans of words: one that begins a line takes the white space after it, another that before."""
    word = [m.span() for m in _WORD.finditer(text)]
    joined: list[list[int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    out = []
    for i, j in joined:
        a, b, last = word[i][0], word[j - 1][1], word[i - 1][1] if i else 0
        if not i or "\n" in text[last:a]:
            out.append((a, word[j][0] if j < len(word) else len(text)))
        else:
            out.append((last, b))
    return out


def _rebuilt(min_run: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            out: list[list] = [[], [], [], []]
            for text, seen, spans in zip(*(batch[c].to_pylist() for c in ("_text", "_seen", "_spans")), strict=True):
                runs = _runs(seen, min_run) if seen else []
                gone = cuts(text, runs + [(s["start"], s["end"]) for s in spans or ()])
                at, kept = 0, []
                for a, b in gone:
                    kept.append(text[at:a])
                    at = b
                for o, v in zip(out, (len(seen or ()), len(gone), "".join([*kept, text[at:]]), [{"start": a, "end": b} for a, b in gone]), strict=True):
                    o.append(v)
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch["_id"], batch["_t"], pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], span), batch["_rest"]], ["doc_id", "_t", "n_seen", "n_removed", "kept_text", "removed", "rest"])

    return run


def seen_units(rows: DataFrame, unit: str, min_words: int) -> DataFrame:
    """(_id, _t, _seen): for texts with units that stand earlier in the corpus, which ones: number, first word, words."""
    units = stored(rows.mapInArrow(_compared(unit, min_words), "_id long, _t long, _i int, _a int, _n int, _h1 long, _h2 long"), "units")
    rank = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("d"), F.col("_t").alias("t"), F.col("_i").alias("i"))
    repeated = units.groupBy("_h1", "_h2").agg(F.min(rank).alias("_first"), F.max(rank).alias("_last")).filter("_first != _last").drop("_last")
    repeated = stored(repeated, "repeated-units")  # joined as a table, so that the rows of a common unit can be split
    bits = rows.sparkSession.sparkContext.broadcast(key_filter(repeated.select("_h1")))
    later = units.mapInArrow(_passing(bits), units.schema).join(repeated, ["_h1", "_h2"]).filter(rank != F.col("_first"))
    return later.groupBy("_id", "_t").agg(F.collect_set(F.struct(F.col("_i").alias("i"), F.col("_a").alias("a"), F.col("_n").alias("n"))).alias("_seen"))


def dedup_units(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", unit: str = "clause", min_words: int = 3, min_run: int = 25, window: int = 0) -> DataFrame:
    """Remove clauses (or lines, or paragraphs) that also stand earlier in the corpus.

    A line ends a unit; so does, for ``unit='clause'``, a word with one of ``.!?,;:`` at its end, so that units end in
    the same places wherever in a line a passage begins. For ``'paragraph'`` only an empty line does. A unit is
    normalised by lower-casing A-Z and joining its words by single spaces; units of fewer than ``min_words`` words are
    not compared. Of equal units the one with the smallest (id, text tag, position) stays; ids are ranked as integers,
    null last. The others are seen units, and they go where neighbours of them have ``min_run`` words together, with
    what is too short to compare between them; this leaves short common phrases in clean documents alone. Digests are
    128 bits, counted with partial sums, so a unit that stands in every document costs a task no more than its rows.

    With a ``window``, every run of that many words that starts earlier in the corpus goes too, wherever in a unit it
    begins and ends: the same grouping by digests over content-chosen pieces (see ``repeated_passages``).

    Returns doc_id, _t (tag of the text), n_seen (units), n_removed (spans), kept_text, removed: the spans, in code
    points of the original text, and rest: the other columns, as they were. A span that begins a line goes with the
    white space after it, another with that before it. Null and empty texts keep the text ''. Equal rows are one
    document: each gets the same result. An empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), text_tag(text).alias("_t"), F.coalesce(F.col(text), F.lit("")).alias("_text"), F.struct(*[F.col(c) for c in docs.columns if c != text]).alias("_rest"))
    texts = rows.select("_id", "_t", "_text")
    found = seen_units(texts, unit, min_words).withColumn("_spans", F.lit(None).cast("array<struct<start:long,end:long>>"))
    if window:
        spans = repeated_passages(texts, window).withColumn("_seen", F.lit(None).cast(found.schema["_seen"].dataType))
        found = found.unionByName(spans).groupBy("_id", "_t").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("_seen", "_spans")])
    joined = rows.join(found, same(rows, found, "_id", "_t"), "left").select(rows["_id"], rows["_t"], "_text", "_seen", "_spans", "_rest")
    kind = T.StructType().add("doc_id", "long").add("_t", "long").add("n_seen", "long").add("n_removed", "long").add("kept_text", "string")
    span = T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())
    return joined.mapInArrow(_rebuilt(min_run), kind.add("removed", T.ArrayType(span)).add("rest", rows.schema["_rest"].dataType))


def deduplicated(docs: DataFrame, *, text: str = "text", length: str | None = "n_chars", **options) -> DataFrame:
    """The documents with repeated units removed; those that lose all their words go. A length column is kept true."""
    out = dedup_units(docs, text=text, **options)
    out = out.filter((F.col("n_removed") == 0) | F.col("kept_text").rlike(WORD))
    new = {text: F.col("kept_text")}
    if length and length in docs.columns:
        new[length] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(docs.schema[length].dataType)).otherwise(F.col(f"rest.{length}"))
    return out.select(*[new[c].alias(c) if c in new else F.col(f"rest.{c}").alias(c) for c in docs.columns])


#: What the query returns, by window functions; the character U+E000, which no text holds, marks the ends of units.
SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, length(regexp_extract(coalesce(text, ''), '^[\x20\x09-\x0D]*')) AS lead FROM documents),
pieces AS (
  SELECT doc_id, lead, generate_subscripts(l, 1) AS k, unnest(l) AS piece
  FROM (SELECT doc_id, lead, string_split(regexp_replace(substr(text, lead + 1), '([\x20\x09\x0B-\x0D]*\n[\x20\x09-\x0D]*|[.!?,;:][\x20\x09-\x0D]+)', '\1' || chr(57344), 'g'), chr(57344)) AS l FROM cut)),
sized AS (
  SELECT *, lead + coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a,
         length(regexp_replace(piece, '[\x20\x09-\x0D]+$', '')) AS core, regexp_extract_all(piece, '[^\x20\x09-\x0D]+') AS w FROM pieces WHERE piece <> ''),
placed AS (
  SELECT doc_id, k, a, a + core AS b, len(w) AS n, lead(a) OVER d AS next_a,
         coalesce(lag(a + core) OVER d, 0) AS last_b, coalesce(contains(substr(lag(piece) OVER d, lag(core) OVER d + 1), chr(10)), true) AS begins,
         md5(array_to_string(list_transform(w, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')), ' ')) AS digest
  FROM sized WINDOW d AS (PARTITION BY doc_id ORDER BY k)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY digest ORDER BY doc_id NULLS LAST, k) > 1 AS seen, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i FROM placed WHERE n >= 3),
runs AS (
  SELECT doc_id, min(i) AS i, min(a) AS a, max(b) AS b, arg_min(begins, i) AS begins, arg_min(last_b, i) AS last_b, arg_max(next_a, i) AS next_a, arg_max(next_a IS NULL, i) AS is_end
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS island FROM ranked WHERE seen)
  GROUP BY doc_id, island HAVING sum(n) >= 25),
spans AS (
  SELECT r.doc_id, r.i, CASE WHEN begins THEN a ELSE last_b END AS a, CASE WHEN NOT begins THEN b WHEN is_end THEN length(text) ELSE next_a END AS b
  FROM runs AS r JOIN cut ON r.doc_id IS NOT DISTINCT FROM cut.doc_id),
gaps AS (
  SELECT s.doc_id, s.i, substr(text, CAST(coalesce(lag(s.b) OVER o, 0) + 1 AS BIGINT), CAST(s.a - coalesce(lag(s.b) OVER o, 0) AS BIGINT)) AS part
  FROM spans AS s JOIN cut ON s.doc_id IS NOT DISTINCT FROM cut.doc_id WINDOW o AS (PARTITION BY s.doc_id ORDER BY s.i)),
left_over AS (SELECT doc_id, string_agg(part, '' ORDER BY i) AS head FROM gaps GROUP BY doc_id),
totals AS (SELECT doc_id, count(*) AS n_removed, sum(b - a) AS removed_chars, max(b) AS last_b FROM spans GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) FILTER (WHERE seen) AS n_seen FROM ranked GROUP BY doc_id)
SELECT cut.doc_id, CAST(coalesce(n_seen, 0) AS BIGINT) AS n_seen, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars,
       sha256(coalesce(head, '') || substr(text, CAST(coalesce(last_b, 0) + 1 AS BIGINT))) AS kept_sha256
FROM cut LEFT JOIN left_over ON cut.doc_id IS NOT DISTINCT FROM left_over.doc_id LEFT JOIN totals ON cut.doc_id IS NOT DISTINCT FROM totals.doc_id LEFT JOIN counted ON cut.doc_id IS NOT DISTINCT FROM counted.doc_id
"""
