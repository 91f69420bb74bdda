"""Jaccard self-join of documents on word n-grams with adaptive multi-match prefixes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored, text_tag, with_copies
from .components import connected_components
from .filters import blocks_of, gathered, has_key, has_twice, key_filter, twice_filter
from .textops import flat, ints, mix, pieces, word_hashes

#: Counters of the frequency sketches of words and of shingles; both are fixed, whatever the input.
SKETCH = 1 << 20
#: Words of 64 bits in a set's bitmap.
MAP = 8
_MAPS = [f"x{i}" for i in range(MAP)]
#: Longest extension of a prefix, and how many other sets a token meets at least by chance, whatever the estimate.
MOST_MATCHES = 7
BY_CHANCE = 0.02
#: Matches of a pair that are asked for when all classes of a token meet, and how many tokens before a match tell which they are.
FIRST, BEFORE = 4, 8
#: Steps of estimated frequencies for each doubling, and the step of frequency one.
STEPS, ONE = 3, 120
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, by the hashes of the words."""
    n = len(h)
    out = np.zeros(max(n - k + 1, 0), np.uint64)
    for j in range(k):
        out = out * _ODD[0] + mix(h[j : n - k + 1 + j] + _ODD[j % 5]) if len(out) else out
    return mix(out)


def short_text(h: np.ndarray) -> np.uint64:
    """One shingle of all words of a text that has fewer than it takes."""
    x = np.uint64(len(h))
    for v in h:
        x = mix(x * _ODD[1] + v)
    return x


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes: of ``k`` words, or of all words if there are fewer."""
    h, before = word_hashes(*flat(column))
    whole = shingles(h, k)
    for a, b in zip(before[:-1], before[1:], strict=True):
        if b - a >= k:
            yield np.unique(whole[a : b - k + 1])
        else:
            yield np.array([short_text(h[a:b])], np.uint64) if b > a else np.zeros(0, np.uint64)


def set_keys(s: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits for a set; sets are taken as equal if these and the size agree."""
    n = np.uint64(len(s))
    return mix(np.add.reduce(mix(s ^ _ODD[3])) + n * _ODD[2]), mix(np.add.reduce(mix(s * _ODD[4] + _ODD[1])) ^ n)


def bitmap(s: np.ndarray) -> np.ndarray:
    """64 * MAP bits, each flipped by the shingles that hash to it: as many bits differ as shingles of two sets at most."""
    h = mix(s * _ODD[1])
    ones = np.bincount((h >> np.uint64(58 - (MAP.bit_length() - 1))).astype(np.int64), minlength=64 * MAP) & 1
    return np.packbits(ones.astype(np.uint8)).view(">i8").astype(np.int64)


def prefix_length(n: int, percent: int, matches: int) -> int:
    """Smallest tokens of a set of ``n`` among which a similar set shares at least ``matches``."""
    return min(n, n - -(-percent * n // 100) + matches)


def choose_matches(frequency: np.ndarray, n: int, percent: int) -> int:
    """How far to lengthen a prefix: the number of matches with the least estimated cost.

    ``frequency`` has estimates for the tokens in order. Lengthening adds the rows that the further tokens meet;
    asking for m matches leaves at most 1/m of the rows met as candidates, each to be verified against n tokens.
    """
    most = max(1, min(MOST_MATCHES, (percent * percent * n) // 10_000))
    met = np.cumsum(np.maximum(frequency - 1, 0) + BY_CHANCE)
    costs = [met[prefix_length(n, percent, m) - 1] * (1 + n / 16 / m) for m in range(1, most + 1)]
    return int(np.argmin(costs)) + 1


_NONE = {"_id": pa.int64(), "_t": pa.int64(), "c": pa.int64(), "c2": pa.int64(), "n": pa.int64(), **dict.fromkeys(_MAPS, pa.int64()), "block": pa.int32(), "part": pa.binary()}


def _rows(**columns: pa.Array) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns.get(k, pa.nulls(size, kind)) for k, kind in _NONE.items()], list(_NONE))


def _classes(k: int):
    """A row for every text with the keys, size and bitmap of its set; at the end of a task the blocks of both sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * SKETCH, np.int32)
        late: list[np.ndarray] = [np.zeros(0, np.int64)]

        def count(least: int) -> None:
            if sum(map(len, late)) > least:
                np.add(counts, np.bincount(np.concatenate(late), minlength=2 * SKETCH), out=counts, casting="unsafe")
                late[1:] = []

        with np.errstate(over="ignore"):
            for batch in pieces(batches, "_text"):
                h, _ = word_hashes(*flat(batch["_text"]))
                sets = list(shingle_sets(batch["_text"], k))
                late.append((h >> np.uint64(44)).astype(np.int64))
                late.append((np.concatenate([*sets, h[:0]]) >> np.uint64(44)).astype(np.int64) + SKETCH)
                count(SKETCH)
                keys = np.array([set_keys(s) for s in sets], np.uint64).reshape(-1, 2)
                maps = np.array([bitmap(s) for s in sets], np.int64).reshape(-1, MAP)
                yield _rows(_id=batch["_id"], _t=batch["_t"], c=ints(keys[:, 0]), c2=ints(keys[:, 1]), n=ints(np.array([len(s) for s in sets])), **{x: ints(maps[:, i]) for i, x in enumerate(_MAPS)})
        count(0)
        blocks = blocks_of(counts)
        yield _rows(block=blocks["block"], part=blocks["part"])

    return run


def estimates(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the sketches tell of frequencies, as logarithms to base 2 of words' shares, of shingles against the mean, and of shingles that stand out."""
    words, sets = counts[:SKETCH].astype(np.float64), counts[SKETCH:].astype(np.float64)
    total, mean = max(words.sum(), 1), max(sets.mean(), 1e-9)
    above = sets - mean - 5 * math.sqrt(mean) - 4
    out = np.log2(np.maximum(words, 1) / total), np.log2(np.maximum(sets, 1) / max(mean, 1)), np.where(above > 1, np.log2(np.maximum(above, 1)), -40)
    return tuple(x.astype(np.float32) for x in out) + (np.float32(math.log2(total)),)


def ordered_tokens(h: np.ndarray, k: int, told: tuple) -> np.ndarray:
    """For every run of ``k`` words a token of 64 bits: its estimated frequency in steps, then 56 bits of its hash.

    The estimate is that of independent words, corrected by the shingle's counter as far as that tells more than noise,
    and never below what stands out of the counter's mean. So rare shingles come first however large the corpus.
    """
    word, near, high, total = told
    n = len(h) - k + 1
    s = shingles(h, k)
    at = (s >> np.uint64(44)).astype(np.int64)
    share = word[(h >> np.uint64(44)).astype(np.int64)]
    est = 4 * near[at] + total
    for j in range(k):
        est += share[j : n + j]
    step = np.clip(np.rint(np.maximum(est, high[at]) * STEPS) + ONE, 0, 255).astype(np.uint64)
    return (step << np.uint64(56)) | (s >> np.uint64(8))


def frequency_of(tokens: np.ndarray) -> np.ndarray:
    return np.exp2(((tokens >> np.uint64(56)).astype(np.float64) - ONE) / STEPS)


def _key(s: np.ndarray, twins: set[int]) -> np.uint64:
    """The first key of a set, or where different sets share that, both."""
    a, b = set_keys(s)
    return mix(a + b * _ODD[2]) if int(a) in twins else a


def _prefixes(k: int, percent: int, told, twins: set[int]):
    """(c, p, tokens) for the prefix of every set; p packs its size and matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in pieces(batches, "_text"):
                h, before = word_hashes(*flat(batch["_text"]))
                whole, order = shingles(h, k), ordered_tokens(h, k, told.value) if len(h) >= k else None
                c, p, tokens, size = [], [], [], [0]
                for a, b in zip(before[:-1], before[1:], strict=True):
                    if b == a:
                        continue
                    s = np.unique(whole[a : b - k + 1]) if b - a >= k else np.array([short_text(h[a:b])], np.uint64)
                    t = np.unique(order[a : b - k + 1]) if b - a >= k else s >> np.uint64(8)
                    m = choose_matches(frequency_of(t[: prefix_length(len(s), percent, MOST_MATCHES)]), min(len(s), len(t)), percent)
                    first = t[: prefix_length(len(s), percent, m)]
                    c.append(_key(s, twins))
                    p.append(len(s) << 3 | m)
                    tokens.append(first)
                    size.append(len(first))
                if c:
                    lists = pa.ListArray.from_arrays(pa.array(np.cumsum(size), pa.int32()), ints(np.concatenate(tokens)))
                    yield pa.RecordBatch.from_arrays([ints(np.array(c, np.uint64)), ints(np.array(p)), lists], ["c", "p", "tokens"])

    return run


def _shared_tokens(twice):
    """Prefixes without the tokens that stand in one of them only; places tell where in the prefix the others stood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = twice.value
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                batch = whole.slice(a, 2000)
                tokens = batch["tokens"].flatten().to_numpy().astype(np.int64)
                size = batch["tokens"].value_lengths().to_numpy()
                row = np.repeat(np.arange(len(size)), size)
                at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                with np.errstate(over="ignore"):
                    on = has_twice(bits, tokens.view(np.uint64))
                left = np.bincount(row[on], minlength=len(size))
                cut = pa.array(np.concatenate([[0], np.cumsum(left)]), pa.int32())
                lists = [pa.ListArray.from_arrays(cut, pa.array(x[on], pa.int64())) for x in (tokens, at)]
                yield pa.RecordBatch.from_arrays([batch["c"], batch["p"], *lists], ["c", "p", "tokens", "places"]).filter(pa.array(left > 0))

    return run


def _sets(k: int, wanted, twins: set[int]):
    """The sets of wanted texts; a task sends each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in pieces(batches, "_text"):
            keys = batch["_k"].to_numpy().astype(np.int64)
            on = has_key(wanted.value, keys.view(np.uint64))
            on[on] = [not (x in sent or sent.add(x)) for x in keys[on].tolist()]
            batch = batch.filter(pa.array(on))
            if batch.num_rows:
                with np.errstate(over="ignore"):
                    sets = list(shingle_sets(batch["_text"], k))
                    yield pa.RecordBatch.from_arrays([ints(np.array([_key(s, twins) for s in sets], np.uint64)), pa.array([s.tobytes() for s in sets], pa.binary())], ["c", "s"])

    return run


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    shared = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _split_twins(twins: set[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                c, c2 = (batch[x].to_numpy().astype(np.int64).view(np.uint64) for x in ("c", "c2"))
                new = np.where(np.isin(c, np.array(list(twins), np.uint64)), mix(c + c2 * _ODD[2]), c)
                yield pa.RecordBatch.from_arrays([ints(new) if name == "c" else batch[name] for name in batch.schema.names], batch.schema.names)

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, left, ok = None, None, []
            for a, b in zip(batch["s_a"].to_pylist(), batch["s_b"].to_pylist(), strict=True):
                if a is not last:
                    last, left = a, np.frombuffer(a, np.uint64)
                ok.append(similar(left, np.frombuffer(b, np.uint64), percent))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    b = sets.select(F.col("c").alias("b"), F.col("s").alias("s_b"))
    a = sets.select(F.col("c").alias("a"), F.col("s").alias("s_a"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "s_a", "s_b").mapInArrow(_verified(percent), "a long, b long")


def with_before(met: DataFrame) -> DataFrame:
    """Rows (c, token, pos, ...) with the ``BEFORE`` tokens that the class has before this one, in its order."""
    return met.withColumn("before", F.collect_list("token").over(Window.partitionBy("c").orderBy("pos").rowsBetween(-BEFORE, -1)))


def early(asked: str) -> F.Column:
    """Whether a match can be among the first ``asked`` of its pair: fewer shared tokens stand right before it on both sides.

    The first ones always pass, as fewer shared tokens stand before them at all. Of the others few do, so a pair makes
    about as many rows as it is asked for, not as many as there are tokens in both prefixes.
    """
    return F.size(F.array_intersect("before_a", "before_b")) < F.expr(asked)


def jaccard_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, all_links: bool = False) -> DataFrame:
    """Group documents whose sets of ``words``-word shingles are linked by a Jaccard similarity of ``percent``/100 or more.

    Words are lower-cased in A-Z; a text of fewer words is one shingle; a text without words, or null, links with
    nothing. Documents of equal sets form classes, and only classes are compared.

    Every set is ordered by the estimated frequency of its shingles (from that of their words and from counters of
    shingles, two sketches of fixed size filled from all documents) and then by hash. A class sends its prefix, the shingles
    among which any similar set must share at least m; m and with it the length is chosen for each class by estimated
    cost. First, each shingle compares its classes with the one that
    has it earliest in its order, which links most members of a group without any pairs inside it. Then classes of
    different components that meet in a shingle, of sizes and positions that allow the similarity, are counted, and
    pairs with as many matches as the shorter of both asks for, or ``FIRST``, are compared; only about the first of a
    pair's matches are made into rows (``early``). Both steps compare whole sets. With
    ``all_links`` the first step is left out and all similar classes are found, also inside of components; pairs then
    grow with the links there are.

    Returns doc_id, _t (tag of the text), n_shingles, component_id (smallest id of the component; null ids count only
    where all are null) and kept, true for one document: the smallest (doc_id, _t) of the component; with ``all_links``
    also n_links, the number of other documents that a document is linked with. A document without words is a component
    of its own. Equal rows get equal results. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), text_tag(text).alias("_t"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    first = stored(rows.mapInArrow(_classes(words), "_id long, _t long, c long, c2 long, n long, " + ", ".join(f"{x} long" for x in _MAPS) + ", block int, part binary"), "classes")
    keyed = first.filter("block IS NULL").drop("block", "part")
    told = spark.sparkContext.broadcast(estimates(gathered(first.filter("block IS NOT NULL").select("block", "part"), 2 * SKETCH, np.add, np.int32)))
    # different sets with one key: by chance n^2 / 2^65 for n classes
    twins = {r["c"] & (1 << 64) - 1 for r in keyed.groupBy("c").agg(F.min("c2").alias("lo"), F.max("c2").alias("hi")).filter("lo != hi").select("c").collect()}
    if twins:
        keyed = keyed.mapInArrow(_split_twins(twins), keyed.schema)
    prefixes = stored(rows.select("_text").mapInArrow(_prefixes(words, percent, told, twins), "c long, p long, tokens array<long>"), "prefixes")
    told.destroy()  # the prefixes are a table now
    twice = spark.sparkContext.broadcast(twice_filter(prefixes, "tokens", prefixes.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()[0]))
    found = prefixes.mapInArrow(_shared_tokens(twice), "c long, p long, tokens array<long>, places array<long>")
    found = stored(found.groupBy("c").agg(F.first("p").alias("p"), F.first("tokens").alias("tokens"), F.first("places").alias("places")), "shared")
    twice.destroy()
    discard(prefixes)
    classes = stored(keyed.filter("n > 0").groupBy("c").agg(F.min(F.struct(F.col("_id").isNull().alias("null"), "_id", "_t")).alias("r"), *[F.first(x).alias(x) for x in _MAPS]).select("c", F.xxhash64("r._id", "r._t").alias("k"), *_MAPS), "representatives")

    met = found.select("c", "p", F.explode(F.arrays_zip("tokens", "places")).alias("at")).select("c", F.col("at.tokens").alias("token"), F.shiftright("p", 3).alias("n"), F.col("p").bitwiseAND(F.lit(7)).alias("m"), F.col("at.places").alias("pos"))
    def allowed(n_a: str, n_b: str, pos_a: str, pos_b: str, m: str) -> F.Column:
        """Sizes near enough, and not too many shingles passed before a match."""
        passed = F.col(pos_a) + F.col(pos_b) - 2 * (F.expr(m) - 1)
        return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & ((100 + percent) * passed <= (100 - percent) * (F.col(n_a) + F.col(n_b)))

    def mapped(side: str) -> DataFrame:
        return classes.select(F.col("c").alias(f"c_{side}"), *[F.col(x).alias(f"{x}_{side}") for x in _MAPS])

    def alike(n_a: str, n_b: str) -> F.Column:
        """Bitmaps that don't show too many differences."""
        differ = sum((F.bit_count(F.col(f"{x}_a").bitwiseXOR(F.col(f"{x}_b"))) for x in _MAPS), F.lit(0))
        return (100 + percent) * differ <= (100 - percent) * (F.col(n_a) + F.col(n_b))

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs that are similar by the sets of all classes that they name, from one text of each."""
        some = classes.join(pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct(), "c", "left_semi").select("c", "k")
        some = stored(some, "wanted")
        wanted = spark.sparkContext.broadcast(key_filter(some.select("k")))
        sets = rows.select(F.xxhash64("_id", "_t").alias("_k"), "_text").mapInArrow(_sets(words, wanted, twins), "c long, s binary")
        out = stored(_verify(pairs, sets.groupBy("c").agg(F.first("s").alias("s")), percent), "links")
        wanted.destroy()
        discard(some)
        return out

    placed = found.withColumn("part", F.col("c"))
    if not all_links:
        least = F.shiftleft(F.col("pos"), 40) + F.shiftright(F.xxhash64("c").bitwiseAND(F.lit((1 << 62) - 1)), 24)
        leaders = met.groupBy("token").agg(F.min_by("c", least).alias("lead"), F.min_by("n", least).alias("lead_n"), F.min(least).alias("at"), F.count("*").alias("count")).filter("count > 1")
        leaders = stored(leaders.select("token", "lead", "lead_n", F.shiftright("at", 40).alias("lead_pos")), "leaders")
        stars = met.join(leaders, "token").filter("c != lead").filter(allowed("n", "lead_n", "pos", "lead_pos", "1"))
        stars = stars.groupBy(F.col("lead").alias("c_a"), F.col("c").alias("c_b"), F.col("lead_n").alias("n_a"), F.col("n").alias("n_b")).agg(F.count("*").alias("met"), F.min("m").alias("m"))
        # one match will do where bitmaps tell chance pairs apart, whose bits differ in near half; longer sets need all
        # matches or are met most by the class, so that groups hold together. Other pairs are left to the second step.
        tells = (100 - percent) * (F.col("n_a") + F.col("n_b")) < (100 + percent) * 25 * MAP
        best = F.row_number().over(Window.partitionBy("c_b").orderBy(F.desc("met"), "c_a"))  # a row for each leader in a prefix
        stars = stars.withColumn("best", best).filter(tells | (F.col("met") >= F.col("m")) | (F.col("best") == 1))
        stars = stars.join(mapped("a"), "c_a").join(mapped("b"), "c_b").filter(alike("n_a", "n_b"))
        stars = stored(stars.select(F.col("c_a").alias("a"), F.col("c_b").alias("b")), "stars")
        links = verified(stars)
        grouped = connected_components(links, "a", "b")
        discard(leaders, stars)
        placed = found.join(grouped, found["c"] == grouped["node"], "left").select("c", "p", "tokens", "places", F.coalesce("component", "c").alias("part"))
    placed = stored(placed.select("c", "p", "part", F.explode(F.arrays_zip("tokens", "places")).alias("at")).select("c", F.col("at.tokens").alias("token"), F.shiftright("p", 3).alias("n"), F.col("p").bitwiseAND(F.lit(7)).alias("m"), F.col("at.places").alias("pos"), "part"), "placed")
    apart = placed.groupBy("token").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo != hi").select("token")
    apart = stored(apart, "apart")
    open_ = with_before(placed.join(apart, "token", "left_semi")).join(classes.select("c", *_MAPS), "c").withColumn("size", F.floor(F.log(F.col("n")) / math.log(100 / percent + 1e-9)))
    asked = f"least(m_a, m_b, {FIRST})"
    left = open_.withColumn("at", F.explode(F.array(F.col("size"), F.col("size") + 1))).toDF(*[f"{c}_a" for c in open_.columns], "at").withColumn("key", F.xxhash64("token_a", "at")).drop("at")
    right = open_.toDF(*[f"{c}_b" for c in open_.columns]).withColumn("key", F.xxhash64("token_b", "size_b"))
    pairs = left.join(right, "key").filter("token_a = token_b AND part_a != part_b AND (size_a != size_b OR c_a < c_b)").filter(allowed("n_a", "n_b", "pos_a", "pos_b", asked)).filter(alike("n_a", "n_b")).filter(early(asked))
    pairs = pairs.groupBy(F.least("c_a", "c_b").alias("a"), F.greatest("c_a", "c_b").alias("b")).agg(F.count("*").alias("met"), F.min(F.expr(asked)).alias("m"))
    pairs = stored(pairs.filter("met >= m").select("a", "b"), "pairs")
    more = verified(pairs)
    discard(found, classes, placed, apart, pairs, *([] if all_links else [grouped]))
    parts = connected_components(more if all_links else links.union(more), "a", "b")
    counted = []
    if all_links:
        copies = stored(keyed.filter("n > 0").groupBy(F.col("c").alias("b")).agg(F.count("*").alias("copies")), "copies")
        both = more.union(more.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        linked = stored(both.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("others")), "linked")
        discard(more)
        keyed = keyed.join(copies, keyed["c"] == copies["b"], "left").join(linked, F.col("c") == F.col("a"), "left").withColumn("n_links", F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)))
        counted = ["n_links"]
    else:
        discard(links, more)

    docs_in = keyed.join(parts, F.col("c") == parts["node"], "left").select("_id", "_t", "n", F.coalesce("component", "c").alias("g"), *counted)
    smallest = docs_in.filter("n > 0").groupBy("g").agg(F.min(F.struct(F.col("_id").isNull().alias("x"), "_id", "_t")).alias("r"))
    smallest = stored(smallest, "smallest").withColumnRenamed("g", "_g")
    out = docs_in.join(smallest, (F.col("g") == F.col("_g")) & (F.col("n") > 0), "left")
    first = F.col("r._id").eqNullSafe(F.col("_id")) & F.col("r._t").eqNullSafe(F.col("_t"))
    return out.select(F.col("_id").alias("doc_id"), "_t", F.col("n").alias("n_shingles"), F.when(F.col("r").isNull(), F.col("_id")).otherwise(F.col("r._id")).alias("component_id"), (F.col("r").isNull() | first).alias("kept"), *counted)


def one_of_each_group(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The documents with all their columns, one of each group of near copies; of equal rows one stays too."""
    found = jaccard_components(docs, doc_id=doc_id, text=text, words=words, percent=percent)
    kept = found.filter("kept").select(F.col("doc_id").alias("_id"), "_t").distinct()
    return with_copies(docs, kept.withColumn("n", F.lit(1)), doc_id=doc_id, text=text)
