"""Near-duplicate embeddings by a forest of random-projection trees with spill overlap."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .common import discard, integral, stored, table, tidy
from .components import components

#: Vectors that the splits are fitted on, at most; a leaf's aim; rows of a side of a comparison, at most.
SAMPLE, LEAF, BLOCK = 16_384, 400, 512


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as a matrix of doubles; its lists are of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sampled(vectors: DataFrame, key: str, n: int, most: int) -> np.ndarray:
    """About `most` of the n vectors (column vector), at most so many: those whose key hashes below a threshold, in the
    order of the hashes. What reaches the driver is bounded, however many partitions there are."""
    h = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 40))
    took = vectors.filter(h < math.ceil(min(1.0, 1.1 * most / max(1, n)) * (1 << 40))).select(h.alias("h"), F.col("vector").cast("array<double>").alias("vector")).toArrow().combine_chunks()
    if not len(took):
        return np.zeros((0, 1))
    x = matrix(took.column("vector").combine_chunks())
    return x[np.lexsort((x[:, 0], took.column("h").to_numpy()))[:most]]


class Tree:
    """Recursive splits by random directions (one a level) at the median of the sample's vectors in the node, or, where
    a node has few of them, of the level. Vectors within `spill` of the median go to both sides."""

    def __init__(self, sample: np.ndarray, depth: int, spill: float, rng: np.random.Generator):
        self.direction = unit(rng.standard_normal((max(1, depth), sample.shape[1])))[:depth]
        self.spill, self.cut, self.default = spill, [], []
        node = np.zeros(len(sample), np.int64)
        for level in range(depth):
            p = sample @ self.direction[level]
            self.default.append(float(np.median(p)))
            order = np.argsort(node, kind="stable")
            ids, begin, n = np.unique(node[order], return_index=True, return_counts=True)
            self.cut.append({int(i): float(np.median(p[order[b : b + k]])) for i, b, k in zip(ids, begin, n, strict=True) if k >= 32})
            at = np.array([self.cut[level].get(int(i), self.default[level]) for i in ids])
            node = node * 2 + (p > at[np.searchsorted(ids, node)])

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every place of every vector; a vector has one or more leaves."""
        row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for level, direction in enumerate(self.direction):
            p = (x @ direction)[row]
            ids, where = np.unique(node, return_inverse=True)
            at = np.array([self.cut[level].get(int(i), self.default[level]) for i in ids])[where]
            left, right = p <= at + self.spill, p > at - self.spill
            row, node = np.concatenate([row[left], row[right]]), np.concatenate([node[left] * 2, node[right] * 2 + 1])
        return row, node


def _shared(a: list[np.ndarray], b: list[np.ndarray], leaf: int) -> np.ndarray:
    """Which pairs of rows have a common leaf with a smaller number than `leaf`; that one counts them."""
    a, b = [x[x < leaf] for x in a], [x[x < leaf] for x in b]
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    common = np.intersect1d(flat_a, flat_b)
    if not len(common):
        return np.zeros((len(a), len(b)), bool)

    def table_of(rows: list[np.ndarray], flat: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), len(common)), np.float32)
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        ok = common[at] == flat
        out[np.repeat(np.arange(len(rows)), [len(r) for r in rows])[ok], at[ok]] = 1
        return out

    return table_of(a, flat_a) @ table_of(b, flat_b).T > 0.5


def compared(leaf: int, same: bool, a: pa.RecordBatch | pa.Table, b: pa.RecordBatch | pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links between two blocks of a leaf (or within one): ids, links counted here, and edges that span them."""
    ids_a, ids_b = (t.column("id").to_numpy() for t in (a, b))
    none = np.zeros(0, np.int64)
    ok = unit(matrix(a.column("vector").combine_chunks())) @ unit(matrix(b.column("vector").combine_chunks())).T >= least
    if same:
        np.fill_diagonal(ok, False)
    ra, rb = np.flatnonzero(ok.any(axis=1)), np.flatnonzero(ok.any(axis=0))
    if not len(ra):
        return none, none, none, none
    ok = ok[np.ix_(ra, rb)]
    leaves = lambda t, rows: [np.asarray(x, np.int64) for x in t.column("leaves").take(pa.array(rows)).to_pylist()]
    first = ok & ~_shared(leaves(a, ra), leaves(b, rb), leaf)
    weight_a, weight_b = (t.column("weight").to_numpy()[r] for t, r in ((a, ra), (b, rb)))
    who, links = ids_a[ra], (first * weight_b).sum(axis=1)
    if not same:
        who, links = np.concatenate([who, ids_b[rb]]), np.concatenate([links, (first * weight_a[:, None]).sum(axis=0)])
    # local components by spreading the smallest id
    la, lb = ids_a[ra].copy(), ids_b[rb].copy()
    top = np.iinfo(np.int64).max
    while True:
        na = np.minimum(la, np.where(ok, lb, top).min(axis=1))
        nb = np.minimum(lb, np.where(ok, na[:, None], top).min(axis=0))
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    return who, links, np.concatenate([ids_a[ra], ids_b[rb]]), np.concatenate([la, lb])


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95, trees: int = 8, seed: int = 6, sample: int = SAMPLE, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """One row per vector: key, n_links, component_id (the smallest key that links reach), kept (it is that one).

    Pairs are sought within the leaves of `trees` trees and link at a cosine of `least` or more, in double precision.
    The spill is a sixteenth of the distance of vectors at that cosine (half the deviation of its projection at 64
    dimensions): a tree parts a pair at the threshold with a chance of about 0.02 a level, a forest with that to the
    power of `trees`. Splits are fitted on a bounded sample; every vector goes through every tree.

    Equal vectors are one, with a weight, so copies need no comparison and n_links counts them all. A pair that meets in
    several leaves is counted in the one with the smallest number; only counts and the edges of local spanning trees
    leave a task. A leaf with more than `block` vectors is compared block by block, every block with every other, so no
    task holds a large leaf and none is cut short. Exact counts of links need as many comparisons as a dense group of
    different vectors has pairs; only equal vectors are spared them.

    Vectors that are null, zero, or hold null or non-finite components link with nothing: n_links 0, a component of
    their own. Vectors of different lengths don't link. Keys are distinct integers; rows with one key and vector count as copies
    of each other. An empty table gives no rows; other columns are ignored."""
    spark = rows.sparkSession
    integral(rows, key)
    rows = rows.select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    good = rows.filter(usable(F.col("vector"))).select("id", F.transform("vector", lambda x: F.when(x == 0, F.lit(0).cast(rows.schema["vector"].dataType.elementType)).otherwise(x)).alias("vector"))
    classes = stored(good.groupBy("vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight")), "classes")
    found = []
    for (size,) in classes.groupBy(F.size("vector")).agg(F.count(F.lit(1)).alias("n")).select(F.col("size(vector)")).collect():
        found.append(_linked(classes.filter(F.size("vector") == size), size, least, trees, seed, sample, leaf, block))
    out = StructType([StructField(key, rows.schema["id"].dataType), StructField("n_links", LongType()), StructField("component_id", rows.schema["id"].dataType)])
    if not found:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links, edges = found[0]
    for more, e in found[1:]:
        links, edges = links.union(more), edges.union(e)
    links = links.groupBy("id").agg(F.sum("n").alias("n")).withColumnRenamed("id", "rep")
    parts = components(edges).select(F.col("node").alias("rep"), F.col("component").alias("component"))
    told = classes.join(links, "rep", "left").join(parts, "rep", "left")
    told = told.select(F.xxhash64("vector").alias("h"), F.col("vector").alias("v"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    good = good.withColumn("h", F.xxhash64("vector"))
    linked = good.join(told, (good.h == told.h) & (good.vector == told.v)).select("id", "n_links", "component_id")
    alone = rows.filter(~usable(F.col("vector"))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _linked(classes: DataFrame, size: int, least: float, trees: int, seed: int, sample: int, leaf: int, block: int) -> tuple[DataFrame, DataFrame]:
    n = classes.count()
    fit = unit(sampled(classes, "rep", n, sample))
    depth = max(0, math.ceil(math.log2(max(1, n / leaf))))
    spill = math.sqrt(max(0.0, 2 - 2 * least)) / math.sqrt(size) / 2
    forest = [Tree(fit, depth, spill, np.random.default_rng([seed, t])) for t in range(trees)]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(matrix(batch.column("vector")))
            row, place = [], []
            for t, tree in enumerate(forest):
                r, node = tree.leaves(x)
                row.append(r)
                place.append(node + (t << 40))
            row, place = np.concatenate(row), np.concatenate(place)
            by = np.lexsort((place, row))
            off = np.searchsorted(row[by], np.arange(len(x) + 1))
            lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(place[by]))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("weight"), batch.column("vector"), lists], ["id", "weight", "vector", "leaves"])

    schema = StructType([StructField("id", LongType()), StructField("weight", LongType()), StructField("vector", classes.schema["vector"].dataType), StructField("leaves", ArrayType(LongType()))])
    places = stored(classes.select(F.col("rep").cast("long"), "weight", "vector").mapInArrow(tidy(placed), schema), "places")
    each = places.withColumn("leaf", F.explode("leaves"))
    # leaves beyond a block are cut to blocks; a row goes to every pair of blocks that has its own
    large = each.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    large = large.select("leaf", F.ceil(F.col("n") / block).cast("long").alias("blocks"))
    each = each.join(large, "leaf", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    each = each.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    each = each.select("id", "weight", "vector", "leaves", "leaf", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(group: pa.Table) -> pa.Table:
        i, j, where = group.column("i")[0].as_py(), group.column("j")[0].as_py(), group.column("leaf")[0].as_py()
        a = group.filter(pc.equal(group.column("own"), i)) if i != j else group
        b = group.filter(pc.equal(group.column("own"), j)) if i != j else group
        who, links, u, v = compared(where, i == j, a, b, least) if len(a) and len(b) else [np.zeros(0, np.int64)] * 4
        own = links > 0
        apart = u != v
        return pa.table({"a": pa.array(np.concatenate([who[own], u[apart]]), pa.int64()), "b": pa.array(np.concatenate([np.zeros(own.sum(), np.int64), v[apart]]), pa.int64(), mask=np.concatenate([np.ones(own.sum(), bool), np.zeros(apart.sum(), bool)])), "n": pa.array(np.concatenate([links[own], np.zeros(apart.sum(), np.int64)]).astype(np.int64))})

    told = stored(each.groupBy("leaf", "i", "j").applyInArrow(compare, "a long, b long, n long"), "leaf-links")
    discard(places)
    return told.filter("b IS NULL").select(F.col("a").alias("id"), "n"), told.filter("b IS NOT NULL").select("a", "b")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
