"""Filters, suffix families and links at size."""

import numpy as np
import pyarrow as pa

from tallgrass.llm import common, filters, substrings, vectors


def test_filter_of_repeated_numbers_takes_no_room_for_single_ones(spark, monkeypatch):
    monkeypatch.setattr(filters, "MOST_BITS", 1 << 16)
    r = np.random.default_rng(3)
    once, twice = (x.view(np.uint64) for x in np.split(r.integers(-(1 << 63), 1 << 63, 61_000, dtype=np.int64), [60_000]))
    numbers = r.permutation(np.concatenate([once, twice, twice, twice[:50], twice[:1].repeat(5000)]).view(np.int64))
    lists = spark.createDataFrame([(x.tolist(),) for x in np.array_split(numbers, 40)], "n array<long>").repartition(3)
    with np.errstate(over="ignore"):
        bits = filters.twice_filter(lists, "n", len(numbers))
        assert len(bits) == 1 << 13 and filters.has_twice(bits, twice).all()
        assert filters.has_twice(bits, once).mean() < 0.01  # as many as the filter has bits


def test_windows_are_compared_by_whole_grams(monkeypatch):
    monkeypatch.setattr(substrings, "SHARE", 40)
    monkeypatch.setattr(substrings, "BATCH", 25)
    r = np.random.default_rng(8)
    rows = []
    for gram in range(30):
        middle = r.integers(97, 100, 110).astype(np.uint8).tobytes()
        for _ in range(int(r.integers(1, 5))):
            rows.append((gram, middle[: int(r.integers(100, 110))] + r.integers(97, 99, 3).astype(np.uint8).tobytes()))
    rows = [(rows[i][0], k, rows[i][1]) for k, i in enumerate(r.permutation(len(rows)))]
    batch = pa.RecordBatch.from_arrays([pa.array([g for g, _, _ in rows]), *[pa.array([k for _, k, _ in rows])] * 2, pa.array([0] * len(rows)), pa.array([b for _, _, b in rows], pa.binary())], ["gram", "_id", "_t", "low", "bytes"])
    covered: dict[int, set[int]] = {}
    for b in substrings._scan(100)(iter([batch])):
        for x in b.to_pylist():
            covered.setdefault(x["_id"], set()).update(range(x["start"], x["end"]))
    seen, want = set(), {}
    for gram, k, text in rows:
        for p in range(len(text) - 99):
            if (w := (gram, text[p : p + 100])) in seen:
                want.setdefault(k, set()).update(range(p, p + 100))
            seen.add(w)
    assert want and covered == want


def _plans(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {found.apply(i).executionId(): found.apply(i).physicalPlanDescription() for i in range(found.size())}


def test_links_of_many_vectors_are_joined_without_broadcasts(spark, monkeypatch):
    r = np.random.default_rng(6)
    x = r.normal(size=(150, 8))
    x = np.concatenate([x, x + r.normal(size=x.shape) * 0.02])
    df = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int").coalesce(2)
    want = sorted(vectors.link_vectors(df).collect())
    monkeypatch.setattr(common, "BROADCAST_ROWS", 20)
    before = _plans(spark)
    assert sorted(vectors.link_vectors(df).collect()) == want and sum(x["n_links"] for x in want) > 50
    joins = [p for i, p in _plans(spark).items() if i not in before and "Join" in p]
    assert len(joins) > 5 and not [p for p in joins if "BroadcastExchange" in p.split("Initial Plan")[0]]
