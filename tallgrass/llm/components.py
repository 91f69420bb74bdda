"""Connected components by alternating star contraction; no edge list ever meets in one task or the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored, unbroadcast


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of each batch by edges from every node to the smallest that the batch connects it with."""
    for batch in batches:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while (up := root.setdefault(top, top)) != top:
                top = up
            while root[x] != top:
                root[x], x = top, root[x]
            return top

        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        pairs = [(x, find(x)) for x in list(root)]
        pairs = [(x, t) for x, t in pairs if x != t]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """A stored table (node, component) for every node that a link names; component is the smallest node reachable.

    Large-star and small-star steps alternate until nothing changes, about log2 of the longest path rounds. The
    minimum of a node's neighbours is a partial aggregate, written and joined back, so a node with very many
    neighbours is split like any other skewed join. Links with a null end and links to itself are ignored.
    """
    edges = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
    edges = edges.mapInArrow(_forest, "a long, b long")  # a > b from here on
    edges = stored(edges.distinct(), "edges")
    last, n = None, edges.count()
    while True:
        before, stars = edges, []
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        stars.append(least := stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "large"))
        large = both.join(unbroadcast(least, 2 * n), "a").filter("b > a AND b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        stars.append(large := stored(large, "star"))
        stars.append(least := stored(large.groupBy("a").agg(F.min("b").alias("m")), "small"))
        small = large.join(unbroadcast(least, 2 * n), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        edges = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        discard(before, *stars)
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == last:
            break
        last, n = state, state[0]
    parts = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    parts = stored(parts, "parts")
    discard(edges)
    return parts
