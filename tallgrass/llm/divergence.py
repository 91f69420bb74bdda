"""Quality rules by distribution divergence, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CLASS, stored

# Common words of each language, and a list for texts of other or unknown language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for"],
    "fr": ["de", "la", "le", "les", "des", "et", "que", "un", "en", "une"],
    "de": ["der", "die", "und", "zu", "den", "von", "das", "mit", "ist", "des"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "un", "por", "se"],
    "": ["the", "of", "and", "de", "la", "der", "die", "que", "el", "en"],
}
# Symbols that are counted, and classes of characters by a regular expression for what is outside.
SYMBOLS = "#*$%&|<>"
CLASSES = {"upper": r"[^\p{Lu}]+", "digit": r"[^0-9]+", "stop": r"[^.,;:]+", "bang": r"[^!?]+", "symbol": r"[^#*$%&|<>@=+~^/_{}\[\]\\-]+"}

BASE_MIN_WORDS = 10
BASE_MAX_REPEATED = 20
WINDOW = 5
#: Texts below these sizes are not judged by the histogram.
MIN_CHARS = 150
MIN_WORDS = 40
#: Languages with fewer documents that pass the base rules have no reference.
MIN_REFERENCE = 20
#: Largest Jensen-Shannon distances (square root of the divergence in bits) to the reference of the language.
MAX_CLASS_DISTANCE = 0.2
MAX_WORD_DISTANCE = 0.245


def _repeated_words(docs: DataFrame, words: str, out: str) -> DataFrame:
    """Add ``out``: words in 5-word windows found twice or more. Each step names its input twice, so none is inlined."""
    w, n = F.col(words), F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]))
    docs = docs.withColumn("_h", F.when(n >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    docs = docs.withColumn("_s", F.when(repeats, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_s")
    twice = F.filter(s, lambda x, j: F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)) | F.when(j > 0, F.get(s, F.greatest(j - 1, F.lit(0)))["h"] == x["h"]).otherwise(False))
    docs = docs.withColumn("_p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    p = F.col("_p")
    each = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
    return docs.withColumn(out, F.coalesce(F.aggregate(each, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long")).drop("_h", "_s", "_p")


def document_counts(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    """Counts of every text: the base rules' and the two histograms ``classes`` and ``common``."""
    t = F.col("_text")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"), F.when(F.col(lang).isin(*[x for x in COMMON_WORDS if x]), F.col(lang)).otherwise("").alias("_lang"))
    rows = rows.withColumn("_w", F.filter(F.split("_text", f"[{WS_CLASS}]+"), lambda x: x != ""))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.trim(F.lit(" \t\n\u000b\f\r"), x)) > 0)
    rows = rows.withColumn("_l", lines)
    bare = t
    for c in SYMBOLS:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    rows = rows.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(bare)).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
    })
    rows = _repeated_words(rows.drop("_l"), "_w", "n_repeat_words")
    counted = [F.length(F.regexp_replace(t, outside, F.lit(""))).cast("long").alias(k) for k, outside in CLASSES.items()]
    # only words that are on a list anywhere are compared with the list of the language
    every = sorted({w for x in COMMON_WORDS.values() for w in x})
    rows = rows.select("doc_id", "_lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.length(t).cast("long").alias("chars"), *counted, F.filter("_w", lambda x: x.isin(*every)).alias("_m"))
    m = F.col("_m")
    lists = F.lit(None).cast("array<string>")
    for k, words in COMMON_WORDS.items():
        lists = F.when(F.col("_lang") == k, F.array(*[F.lit(w) for w in words])).otherwise(lists)
    rows = rows.withColumn("_list", lists)

    def hits(k: int) -> Column:
        return F.size(F.filter(m, lambda x: x == F.get("_list", F.lit(k)))).cast("long").alias(f"word_{k}")

    return rows.select("doc_id", "_lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", *CLASSES, F.size(m).alias("_size"), *[hits(k) for k in range(len(COMMON_WORDS[""]))])


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance in bits of two arrays of shares of equal length."""

    def part(a: Column, b: Column) -> Column:
        m = (a + b) / 2
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0) + F.when(b > 0, b * F.log2(b / m)).otherwise(0.0)

    return F.sqrt(F.greatest(F.aggregate(F.zip_with(p, q, part), F.lit(0.0), lambda x, y: x + y) / 2, F.lit(0.0)))


def _shares(counts: list[Column], total: Column) -> Column:
    rest = total
    for c in counts:
        rest = rest - c
    return F.array(*[F.when(total > 0, c / total).otherwise(0.0) for c in [*counts, F.greatest(rest, F.lit(0))]])


def judge(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """Keep documents whose histograms lie near those of their language.

    The reference of a language sums the histograms of all its documents that pass the base rules: shares of character
    classes (white space, upper case, digits, stops, exclamation marks, symbols, the rest) and of common words among
    all words. A document is dropped if it fails a base rule (fewer than 10 words; over 20 % of its words in 5-word
    windows that repeat), or if a Jensen-Shannon distance to the reference passes its limit. Texts under MIN_CHARS or
    MIN_WORDS are too short for the class or the word histogram and are not judged by it; neither is a document whose
    language has no reference, for which MIN_REFERENCE documents must pass the base rules. The reference is the corpus
    itself, so the rule finds what is unlike most texts of its language: where most are junk, junk is what it keeps.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance,
    word_distance (null where not judged) and kept. Null and empty texts have no words and fail the base rule. Unknown
    and null languages share one reference. Null ids and repeated rows are judged like others; an empty table gives no
    rows; other columns are not read.
    """
    counts = stored(document_counts(docs, doc_id, text, lang).drop("_size"), "counts")
    failed = (F.col("n_words") < BASE_MIN_WORDS) | (100 * F.col("n_repeat_words") > BASE_MAX_REPEATED * F.col("n_words"))
    classes, words = list(CLASSES), [f"word_{k}" for k in range(len(COMMON_WORDS[""]))]
    counts = counts.withColumn("base_failed", failed).withColumn("white", F.col("chars") - F.col("word_chars"))
    sums = counts.filter(~failed).groupBy(F.col("_lang").alias("_k")).agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"r_{c}") for c in ("chars", "n_words", "white", *classes, *words)]).filter(F.col("_n") >= MIN_REFERENCE)
    shares = lambda names, total, pre: _shares([F.col(pre + c) for c in names], F.col(pre + total))
    reference = stored(sums.select("_k", shares(["white", *classes], "chars", "r_").alias("r_classes"), shares(words, "n_words", "r_").alias("r_words")), "reference")
    told = counts.join(reference, counts["_lang"] == reference["_k"], "left").withColumns({"p_classes": shares(["white", *classes], "chars", ""), "p_words": shares(words, "n_words", "")})
    told = told.withColumns({
        "class_distance": F.when(F.col("chars") >= MIN_CHARS, js_distance(F.col("p_classes"), F.col("r_classes"))),
        "word_distance": F.when(F.col("n_words") >= MIN_WORDS, js_distance(F.col("p_words"), F.col("r_words"))),
    })
    near = F.coalesce(F.col("class_distance") <= max_class_distance, F.lit(True)) & F.coalesce(F.col("word_distance") <= max_word_distance, F.lit(True))
    return told.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", (~F.col("base_failed") & near).alias("kept"))


def sql() -> str:
    """The query's rows in SQL."""
    words = [f"word_{k}" for k in range(len(COMMON_WORDS[""]))]
    names = ["white", *CLASSES]
    lists = " ".join(f"WHEN '{k}' THEN [{', '.join(repr(w) for w in ws)}]" for k, ws in COMMON_WORDS.items() if k)
    other = ", ".join(repr(w) for w in COMMON_WORDS[""])
    share = lambda cols, total, pre: "[" + ", ".join(f"CASE WHEN {pre}{total} > 0 THEN {c} / CAST({pre}{total} AS DOUBLE) ELSE 0.0 END" for c in [*(pre + c for c in cols), f"greatest({pre}{total} - " + " - ".join(pre + c for c in cols) + ", 0)"]) + "]"
    distance = lambda p, q: f"sqrt(greatest(list_sum(list_transform(range(1, len({p}) + 1), lambda i: CASE WHEN {p}[i] > 0 THEN {p}[i] * log2({p}[i] / (({p}[i] + {q}[i]) / 2)) ELSE 0 END + CASE WHEN {q}[i] > 0 THEN {q}[i] * log2({q}[i] / (({p}[i] + {q}[i]) / 2)) ELSE 0 END)) / 2, 0))"
    outside = {k: v.replace("\\\\", "\\\\").replace("'", "''") for k, v in CLASSES.items()}
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ('en', 'fr', 'de', 'es') THEN lang ELSE '' END AS lang FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
             CASE lang {lists} ELSE [{other}] END AS c FROM d),
g AS (SELECT r, i, list_slice(w, i, i + {WINDOW - 1}) AS g FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w WHERE len(w) >= {WINDOW})),
p AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
q AS (SELECT r, CAST(sum(least({WINDOW}, coalesce(j - i, {WINDOW}))) AS BIGINT) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS j FROM p) GROUP BY r),
n AS (SELECT w.r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             coalesce(q.n, 0) AS n_repeat_words, length(t) AS chars, length(t) - length(array_to_string(w, '')) AS white,
             {", ".join(f"length(regexp_replace(t, '{v}', '', 'g')) AS {k}" for k, v in outside.items())},
             {", ".join(f"len(list_filter(w, lambda x: x = c[{k + 1}])) AS word_{k}" for k in range(len(words)))}
      FROM w LEFT JOIN q ON q.r = w.r),
b AS (SELECT *, n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_MAX_REPEATED} * n_words AS base_failed FROM n),
s AS (SELECT lang AS k, {", ".join(f"CAST(sum({c}) AS BIGINT) AS r_{c}" for c in ("chars", "n_words", *names, *words))} FROM b WHERE NOT base_failed GROUP BY lang HAVING count(*) >= {MIN_REFERENCE}),
h AS (SELECT b.*, {share(names, "chars", "")} AS pc, {share(words, "n_words", "")} AS pw, {share(names, "chars", "r_")} AS rc, {share(words, "n_words", "r_")} AS rw, k FROM b LEFT JOIN s ON b.lang = s.k),
j AS (SELECT *, CASE WHEN k IS NOT NULL AND chars >= {MIN_CHARS} THEN {distance("pc", "rc")} END AS cd, CASE WHEN k IS NOT NULL AND n_words >= {MIN_WORDS} THEN {distance("pw", "rw")} END AS wd FROM h)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(cd <= {MAX_CLASS_DISTANCE}, true) AND coalesce(wd <= {MAX_WORD_DISTANCE}, true) AS kept FROM j
"""
