"""Near-duplicate vectors by collision-counting projections."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored, unbroadcast
from .components import connected_components


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key of label and components, and the unit vector in double precision; both null where a row links with nothing."""
    for batch in batches:
        keys, units = [], []
        for x, label in zip(batch["_v"].to_pylist(), batch["_label"].to_pylist(), strict=True):
            v = np.array([np.nan if c is None else c for c in x], float) if x is not None and label is not None else np.zeros(0)
            top = np.abs(v).max() if len(v) else 0
            if len(v) and np.isfinite(v).all() and top > 0:
                u = v / top
                u /= math.sqrt(float(u @ u))
                keys.append(hashlib.blake2b(f"{label}:".encode() + v.tobytes(), digest_size=16).digest())
                units.append(u.tobytes())
            else:
                keys.append(None)
                units.append(None)
        yield pa.RecordBatch.from_arrays([batch["_id"], batch["_label"], pa.array(keys, pa.binary()), pa.array(units, pa.binary())], ["_id", "_label", "_key", "_unit"])


def hit_probability(min_cosine: float, bits: int) -> float:
    """Chance that two vectors at the least cosine collide in one round: same side of ``bits`` planes and in the window."""
    return 0.95 * (1 - math.acos(min_cosine) / math.pi) ** bits


def rounds_for(p: float, least: int, recall: float) -> int:
    """Smallest number of rounds in which a pair collides at least ``least`` times with chance ``recall``."""
    n = least
    while sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(least)) > 1 - recall:
        n += 1
    return n


def _project(rounds: int, bits: int, width: float, seed: int):
    """For every round: the cell of a vector by signs, its place on the round's line, and the window-wide bin there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                units = [np.frombuffer(u) for u in batch["_unit"].to_pylist()]
                dims = np.array([len(u) for u in units])
                node = np.array(batch["node"].to_pylist(), np.int64)
                label = np.array(batch["_label"].to_pylist(), np.int64)
                for d in np.unique(dims):
                    if d not in planes:
                        planes[d] = np.random.default_rng([seed, int(d)]).standard_normal((int(d), rounds * (bits + 1)))
                        lines = planes[d].reshape(int(d), rounds, bits + 1)[:, :, bits]
                        lines /= np.linalg.norm(lines, axis=0)
                    on = np.flatnonzero(dims == d)
                    x = (np.stack([units[i] for i in on]) @ planes[d]).reshape(len(on), rounds, bits + 1)
                    cell = ((x[:, :, :bits] > 0) << np.arange(bits, dtype=np.int64)).sum(2)
                    place = x[:, :, bits] * math.sqrt(d)
                    cols = [np.repeat(node[on], rounds), np.repeat(label[on], rounds), np.full(len(on) * rounds, d), np.tile(np.arange(rounds), len(on)), cell.ravel(), np.floor(place / width).astype(np.int64).ravel()]
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array(place.ravel())], ["node", "_label", "dims", "round", "cell", "bin", "place"])

    return run


def _cosines(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                a, b = ([np.frombuffer(x) for x in batch[c].to_pylist()] for c in ("u_a", "u_b"))
                dims = np.array([len(x) for x in a])
                on = np.zeros(len(a), bool)
                for d in np.unique(dims):
                    some = np.flatnonzero(dims == d)
                    products = np.stack([a[i] for i in some]) * np.stack([b[i] for i in some])
                    cosine = products.sum(1)
                    for i in np.flatnonzero(np.abs(cosine - least) < 1e-9):  # so near that the order of summing could decide
                        cosine[i] = math.fsum(products[i])
                    on[some] = cosine >= least
                yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(on))

    return run


def link_vectors(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    min_cosine: float = 0.93,
    cell_size: int = 24,
    least_collisions: int = 2,
    recall: float = 0.995,
    seed: int = 7,
) -> DataFrame:
    """Link vectors of equal label whose cosine is ``min_cosine`` or more, and give their components.

    Equal vectors are one class. Every round throws random planes, whose number grows with the logarithm of the
    largest label so that cells keep about ``cell_size`` classes, and one line. Within a cell, classes are sorted on
    the line, and two collide if they lie within a window that holds 95 % of the pairs at ``min_cosine``. The number of
    rounds follows from ``recall``: a pair at the least cosine collides ``least_collisions`` times with that chance,
    nearer pairs more often. Pairs with as many collisions are checked in double precision. Bins of the window's
    width are join keys, so a cell that grows is split, and pairs beyond the window are never made.

    Returns vec_id, n_links (other rows linked directly, equal vectors included), component_id (smallest vec_id
    reachable) and kept. Null, empty or zero vectors, null or non-finite components and null labels link with nothing.
    Vectors of different lengths do not link. Repeated rows count as vectors of their own. A null vec_id is never the
    smallest unless all are null. An empty table gives no rows; other columns are not read.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("_id"), F.col(label).cast("long").alias("_label"), F.col(embedding).cast("array<double>").alias("_v"))
    rows = stored(rows.mapInArrow(_units, "_id long, _label long, _key binary, _unit binary"), "units")
    keyed = rows.filter("_key IS NOT NULL")
    classes = keyed.groupBy("_key").agg(F.min("_id").alias("rep"), F.count("*").alias("copies"), F.first("_label").alias("_label"), F.first("_unit").alias("_unit"))
    classes = stored(classes.withColumn("node", F.xxhash64("_key")), "classes")
    # keys have 128 bits; different ones with one node, by chance n^2 / 2^65 of n, get their nodes from the key's end
    twins = [r["node"] for r in classes.groupBy("node").count().filter("count > 1").select("node").collect()]
    if twins:
        other = F.xxhash64(F.substring("_key", 9, 8), F.substring("_key", 1, 8))
        before = classes
        classes = stored(classes.withColumn("node", F.when(F.col("node").isin(twins), other).otherwise(F.col("node"))), "classes")
        discard(before)
    largest, n = (x or 0 for x in classes.groupBy("_label").count().agg(F.max("count"), F.sum("count")).first())
    bits = max(0, math.ceil(math.log2(max(1, largest / cell_size))))
    rounds = rounds_for(hit_probability(min_cosine, bits), least_collisions, recall)
    width = 2 * math.sqrt(2 - 2 * min_cosine)
    points = classes.select("node", "_label", "_unit").mapInArrow(_project(rounds, bits, width, seed), "node long, _label long, dims long, round long, cell long, bin long, place double")
    points = points.select("node", "place", "bin", F.xxhash64("_label", "dims", "round", "cell").alias("cell"))
    left = points.select(F.col("node").alias("a"), F.col("place").alias("place_a"), F.col("bin").alias("bin_a"), F.explode(F.array(F.col("bin"), F.col("bin") + 1)).alias("at"), "cell").withColumn("key", F.xxhash64("cell", "at"))
    right = points.select(F.col("node").alias("b"), F.col("place").alias("place_b"), F.col("bin").alias("bin_b"), F.xxhash64("cell", "bin").alias("key"))
    near = (F.abs(F.col("place_a") - F.col("place_b")) <= width) & ((F.col("bin_a") < F.col("bin_b")) | (F.col("a") < F.col("b")))
    hits = left.join(unbroadcast(right, n * rounds), "key").filter(near)
    pairs = hits.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("n")).filter(F.col("n") >= least_collisions)
    a = classes.select(F.col("node").alias("a"), F.col("_unit").alias("u_a"), F.col("_label").alias("l_a"))
    b = classes.select(F.col("node").alias("b"), F.col("_unit").alias("u_b"), F.col("_label").alias("l_b"))
    links = pairs.select("a", "b").join(unbroadcast(a, n), "a").join(unbroadcast(b, n), "b").filter("l_a = l_b AND length(u_a) = length(u_b)")
    links = stored(links.select("a", "b", "u_a", "u_b").mapInArrow(_cosines(min_cosine), "a long, b long"), "links")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = classes.select(F.col("node").alias("b"), "copies")
    degree = stored(both.join(unbroadcast(copies, 2 * links.count()), "b").groupBy("a").agg(F.sum("copies").alias("others")), "degrees")
    parts = connected_components(links, "a", "b")
    told = classes.select("_key", "node", "rep", "copies").join(unbroadcast(degree, n), F.col("node") == F.col("a"), "left").join(unbroadcast(parts.withColumnRenamed("node", "_n"), n), F.col("node") == F.col("_n"), "left")
    linked = stored(told.select("_key", "rep", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("part")), "told")
    smallest = stored(linked.groupBy("part").agg(F.min("rep").alias("component_id")), "smallest")
    told = stored(linked.join(unbroadcast(smallest, n), "part").select(F.col("_key").alias("_k"), "n_links", "component_id"), "told")
    discard(classes, links, degree, parts, linked, smallest)
    out = rows.select("_id", "_key").join(unbroadcast(told, n), F.col("_key") == F.col("_k"), "left")
    component = F.when(F.col("_k").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return out.select(F.col("_id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("_id")).alias("kept"))
