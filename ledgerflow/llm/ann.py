"""Nearest neighbours: an inverted file of coarse centroids with product-quantised residuals, and an exact check of its lists."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import discard, integral, mix64, stored, table, tidy
from .forest import matrix, sampled, usable

#: Vectors that the index is fitted on, at most; lists at most (they grow with the root of the vectors until there); rows of
#: a task's share of the index and queries that meet it at once, at most; rows of the sample that codebooks are fitted on.
SAMPLE, LISTS, SHARE, ASKED, CODED = 65_536, 4096, 4096, 2048, 16_384
#: How many vectors may be ranked exactly for a query.
DEEP = (128, 256, 512, 1024)
#: The exact check: components of a share of its vectors, at most; products at once; shares of a small table, about.
HELD, PRODUCTS, CHECKS = 1 << 22, 1 << 21, 24


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from distinct random rows; an empty centroid takes a random row."""
    x = np.unique(x, axis=0)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], x[rng.integers(len(x), size=len(c))])
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(axis=1) / 2
    return np.concatenate([(x[i : i + 4096] @ c.T - half).argmax(axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


@dataclass
class Index:
    """Coarse centroids, codebooks (part, code, components) of the residuals, how many lists a query looks in at least and
    how many vectors are ranked exactly for it."""

    coarse: np.ndarray
    books: np.ndarray
    probes: int
    deep: int

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, parts: int = 64, codes: int = 256, recall: float = 0.985, k: int = 20, seed: int = 10) -> Index:
        """The fewest lists that hold `recall` of the exact k nearest of 512 of the sample's distinct vectors within the
        sample; of DEEP the first number of vectors by whose exact ranking 0.03 less of them are found (tight groups, which
        codes hardly tell apart, need many). A sample is sparser than the table, so its neighbours are farther and need more
        lists than the table's. Parts have two components or more."""
        rng = np.random.default_rng(seed)
        coarse = kmeans(sample, lists, rng)
        size = sample.shape[1]
        parts = max(p for p in range(1, min(parts, max(1, size // 2)) + 1) if size % p == 0)
        some = sample[:CODED]
        rest = (some - coarse[nearest(some, coarse)]).reshape(len(some), parts, -1)
        books = [kmeans(rest[:, p], codes, rng, 6) for p in range(parts)]
        books = np.stack([np.concatenate([b, np.repeat(b[:1], codes - len(b), axis=0)]) for b in books])
        queries, at = sample[rng.choice(len(sample), min(512, len(sample)), replace=False)], nearest(sample, coarse)
        best = np.concatenate([np.argpartition(-(q @ sample.T), min(k, len(sample) - 1), axis=1)[:, : k + 1] for q in np.array_split(queries, 8) if len(q)])
        order = np.argsort(np.argsort(-(queries @ coarse.T), axis=1), axis=1)
        rank = np.sort(np.take_along_axis(order, at[best], 1).ravel())
        out = cls(coarse, books, int(rank[min(len(rank) - 1, math.ceil(recall * len(rank)))]) + 1, max(DEEP[0], 2 * (k + 1)))
        tried = [np.zeros(0)] * len(DEEP)
        codes = out.encode(sample)[1]
        for q, b in zip(np.array_split(queries, 8), np.array_split(best, 8), strict=True):
            if len(q):
                i, j, near = scanned(out, q, out.probed(q, np.bincount(at, minlength=len(coarse)), 0), at, codes, len(sample))
                order = np.lexsort((-near, i))
                i, j = i[order], j[order]
                nth = np.arange(len(i)) - np.searchsorted(i, i)
                found = np.zeros((len(q), len(sample)), np.int32) + len(sample)
                found[i, j] = nth
                tried = [np.append(t, (np.take_along_axis(found, b, 1) < d).mean(axis=1)) for t, d in zip(tried, DEEP, strict=True)]
        out.deep = max(out.deep, next((d for d, t in zip(DEEP, tried, strict=True) if t.mean() >= recall - 0.03), DEEP[-1]))
        return out

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = nearest(x, self.coarse)
        rest = (x - self.coarse[at]).reshape(len(x), len(self.books), -1)
        return at, np.stack([nearest(rest[:, p], b) for p, b in enumerate(self.books)], axis=1).astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Inner products of the queries' parts with every code; for inner products they don't depend on the list."""
        return np.einsum("qpd,pcd->qpc", q.reshape(len(q), len(self.books), -1), self.books).astype(np.float32)

    def probed(self, q: np.ndarray, sizes: np.ndarray, least: int) -> list[np.ndarray]:
        """The lists of each query: `probes` of them, and more, nearest first, until they hold `least` vectors (all lists
        where there aren't so many)."""
        order = np.argsort(-(q @ self.coarse.T), axis=1, kind="stable")
        n = np.maximum(self.probes, (np.cumsum(sizes[order], axis=1) < least).sum(axis=1) + 1)
        return [o[:m] for o, m in zip(order, n, strict=True)]


def scanned(index: Index, q: np.ndarray, lists: list[np.ndarray], at: np.ndarray, codes: np.ndarray, deep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) by the asymmetric distance tables: of the rows in each query's lists the `deep` best."""
    out: tuple[list, list, list] = ([], [], [])
    for lo in range(0, len(q), 256):
        part, own = q[lo : lo + 256], lists[lo : lo + 256]
        probed = np.zeros((len(part), len(index.coarse)), bool)
        probed[np.repeat(np.arange(len(part)), [len(x) for x in own]), np.concatenate(own)] = True
        score = (part @ index.coarse.T).astype(np.float32)[:, at]
        lut = index.tables(part)
        for p in range(codes.shape[1]):
            score += lut[:, p][:, codes[:, p]]
        score[~probed[:, at]] = -np.inf
        pick = np.argpartition(-score, deep - 1, axis=1)[:, :deep] if deep < score.shape[1] else np.broadcast_to(np.arange(score.shape[1]), score.shape)
        best = np.take_along_axis(score, pick, 1)
        i, j = np.nonzero(best > -np.inf)
        out[0].append(i + lo)
        out[1].append(pick[i, j])
        out[2].append(best[i, j])
    none = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)]
    return tuple(np.concatenate(o) if o else z for o, z in zip(out, none, strict=True))


def unfound(q: np.ndarray, least: np.ndarray, x: np.ndarray, reps: np.ndarray, known: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score): exactly, for each query the k + 1 best of the rows that have its `least` or more, ties to the
    smaller rep, without those it knows. Products of matrices find them, their scores are summed as everywhere."""
    out: tuple[list, list, list] = ([], [], [])
    off, flat = known.value_lengths().to_numpy().cumsum(), known.flatten().to_numpy()
    place = np.minimum(np.searchsorted(reps, flat), len(reps) - 1)
    owner, held = np.repeat(np.arange(len(q)), np.diff(off, prepend=0)), reps[place] == flat
    owner, place = owner[held], place[held]
    # how much a product of matrices may differ from the sum
    slack = 4 * x.shape[1] * np.finfo(float).eps * np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1)).max()
    step = max(1, PRODUCTS // len(x))
    for lo in range(0, len(q), step):
        part, near = q[lo : lo + step], slack[lo : lo + step, None]
        score = part @ x.T
        hit = ~(score < least[lo : lo + step, None] - near)
        mine = slice(*np.searchsorted(owner, (lo, lo + len(part))))
        hit[owner[mine] - lo, place[mine]] = False
        many = np.flatnonzero(hit.sum(axis=1) > k + 1)
        if len(many):
            nth = np.partition(np.where(hit[many], score[many], -np.inf), len(x) - k - 1, axis=1)[:, len(x) - k - 1, None]
            hit[many] &= ~(score[many] < nth - 2 * near[many])
        i, j = np.nonzero(hit)
        cut = max(1, PRODUCTS // x.shape[1])
        score = np.concatenate([np.zeros(0), *((part[i[at : at + cut]] * x[j[at : at + cut]]).sum(axis=1) for at in range(0, len(i), cut))])
        order = np.lexsort((j, -score, i))  # rows are in the order of rep
        i, j, score = i[order], j[order], score[order]
        took = (np.arange(len(i)) - np.searchsorted(i, i) <= k) & ~(score < least[lo + i])
        for o, v in zip(out, (i + lo, j, score), strict=True):
            o.append(v[took])
    none = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return tuple(np.concatenate([z, *o]) for o, z in zip(out, none, strict=True))


def binaries(x: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    x = np.ascontiguousarray(x)
    return pa.Array.from_buffers(pa.binary(x.shape[1] * x.itemsize), len(x), [None, pa.py_buffer(x)]).cast(pa.binary())


def _packed(index: Index, sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A list's first share and how many it has. Lists that are near each other share shares, so a query meets few."""
    groups = kmeans(index.coarse, math.isqrt(len(index.coarse)), np.random.default_rng(0))
    first, over, at, free = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), 0, most
    for i in np.argsort(nearest(index.coarse, groups), kind="stable"):
        n = sizes[i]
        if n > most:
            first[i], over[i] = at + 1, -(-n // most)
            at, free = at + over[i], 0
        else:
            if n > free:
                at, free = at + 1, most
            first[i], free = at, free - n
    return first, over


def search(rows: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, sample: int = SAMPLE, seed: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest of `rows` by inner product in double precision, nearest
    first, ties to the smaller id; a row with the query's id is not its neighbour.

    Equal vectors are one in the index, with their k + 1 smallest ids (no other can be among the k best), and equal
    queries are asked once. The index is fitted on a bounded sample (16,384 vectors, or 16 a list up to `sample`, by a hash
    of their ids); every vector is in it. There are as many lists as the root of the number of vectors, LISTS at most. A
    query looks in as many lists as the sample needs for its recall, and in more until they hold 4 (k + 1) vectors, so it
    gets k neighbours wherever the table has them. Lists go to shares of at most SHARE rows, a longer list to several; a
    share's codes meet the queries that look in it, ASKED at a time. Only codes move there, and of each share and query
    the index's `deep` best; of all shares the `deep` best get their vectors, and exact products rank them.

    An exact check follows, for which what was found is the bound: whatever a list holds is at most as near as its centroid
    and its radius, or its longest vector, allow. Queries meet the vectors of all lists that can reach their (k + 1)th
    score, and what reaches it and wasn't found joins the rest. So the answers are those of a comparison of all with all,
    whatever the vectors; where they have no structure, that is the check's work too. Its shares lie by lists, of HELD
    components at most, and each vector moves once.

    Keys are integers. Vectors that are null, zero, hold null or non-finite components or have another length than most take
    no part. Rows that agree in key and vector are one; empty tables give no rows; other columns are ignored. A query with
    fewer candidates in the whole table than k gets those (rows with its own key and other vectors may take their places)."""
    spark = rows.sparkSession
    clean = lambda df: F.transform(F.col("vector"), lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    name = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2")]

    def told(df: DataFrame) -> DataFrame:
        df = df.select(integral(df, key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        return df.filter(usable(F.col("vector")) & F.col("id").isNotNull()).withColumn("vector", clean(df)).select("id", "vector", *name)

    good, ask = told(rows), told(queries)
    sizes = good.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "size").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    good, ask = good.filter(F.size("vector") == sizes["size"]), ask.filter(F.size("vector") == sizes["size"])
    by_id = W.partitionBy("h1", "h2").orderBy("id")
    few = good.dropDuplicates(["id", "h1", "h2"]).withColumn("nth", F.row_number().over(by_id)).filter(F.col("nth") <= k + 1)
    single = all(df.schema[vector].dataType.elementType.typeName() == "float" for df in (rows, queries))
    kind = np.float32 if single else np.float64  # in which vectors move, without loss
    vectors = stored(few.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector")), "vectors")
    n = vectors.count()
    lists = max(1, min(LISTS, math.isqrt(n), sample // 16))
    fit = sampled(vectors, "rep", n, min(sample, max(16_384, 16 * lists)))
    index = Index.fit(fit, lists, seed=seed, k=k)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"))
            at, codes = index.encode(x)
            far, norm = (np.sqrt((y * y).sum(axis=1)) for y in (x - index.coarse[at], x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32)), binaries(codes), pa.array(far), pa.array(norm)], [*batch.schema.names, "list", "code", "far", "norm"])

    told_of = "rep long, ids array<long>, vector array<double>, list int, code binary, far double, norm double"
    inverted = stored(vectors.select("rep", "ids", "vector").mapInArrow(tidy(coded), told_of), "inverted-file")
    discard(vectors)
    size, radius, longest = np.zeros(len(index.coarse), np.int64), np.zeros(len(index.coarse)), np.zeros(len(index.coarse))
    for r in inverted.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far"), F.max("norm").alias("norm")).collect():  # LISTS rows at most
        size[r["list"]], radius[r["list"]], longest[r["list"]] = r["n"], r["far"], r["norm"]
    first, over = _packed(index, size, min(SHARE, max(256, n // 64)))
    least = 4 * (k + 1)

    def sharing(first: np.ndarray, over: np.ndarray):
        def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                where = batch.column("list").to_numpy()
                own = first[where] + (mix64(batch.column("rep").to_numpy()) % over[where].astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], [*batch.schema.names, "share"])

        return tidy(shares)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, share, own = [], [], []
            for i, found in enumerate(index.probed(matrix(batch.column("vector")), size, least)):
                to = np.repeat(first[found] - (np.cumsum(over[found]) - over[found]), over[found]) + np.arange(over[found].sum())
                of = np.repeat(found, over[found])
                by = np.argsort(to, kind="stable")
                names, begin = np.unique(to[by], return_index=True)
                row += [i] * len(names)
                share += names.tolist()
                own += np.split(of[by].astype(np.int32), begin[1:])
            whole = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*whole.columns, pa.array(share, pa.int64()), pa.array(own, pa.list_(pa.int32()))], [*whole.schema.names, "share", "lists"])

    once = stored(ask.groupBy("h1", "h2").agg(F.min("id").alias("q"), F.first("vector").alias("vector")), "queries")
    want = stored(once.select("q", "vector").mapInArrow(tidy(asked), "q long, vector array<double>, share long, lists array<int>"), "asked")
    deals = want.groupBy("share").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("deals"))
    own = inverted.select("rep", "list", "code").mapInArrow(sharing(first, over), "rep long, list int, code binary, share long").join(deals, "share").withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    want = want.join(deals, "share").withColumn("deal", F.pmod(F.xxhash64("q"), F.col("deals")).cast("int"))

    def compare(q: pa.Table, r: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)]
        if len(q) and len(r):
            codes = np.frombuffer(b"".join(r.column("code").to_pylist()), np.uint8).reshape(len(r), -1)
            found = scanned(index, matrix(q.column("vector").combine_chunks()), [np.array(x) for x in q.column("lists").to_pylist()], r.column("list").to_numpy(), codes, index.deep)
            found = q.column("q").to_numpy()[found[0]], r.column("rep").to_numpy()[found[1]], found[2]
        return pa.table(dict(zip(("q", "rep", "near"), map(pa.array, found), strict=True)))

    near = want.select("q", "vector", "lists", "share", "deal").groupBy("share", "deal").cogroup(own.select("rep", "list", "code", "share", "deal").groupBy("share", "deal")).applyInArrow(compare, "q long, rep long, near float")
    best = near.withColumn("nth", F.row_number().over(W.partitionBy("q").orderBy(F.col("near").desc(), "rep"))).filter(F.col("nth") <= index.deep).select("q", "rep")
    pairs = best.join(once.select("q", F.col("vector").alias("asks")), "q").join(inverted.select("rep", "ids", "vector"), "rep")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = (matrix(batch.column("asks")) * matrix(batch.column("vector"))).sum(axis=1) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("rep"), batch.column("ids"), pa.array(score)], ["q", "rep", "ids", "score"])

    def best_of(scores: DataFrame) -> DataFrame:
        order = W.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
        return scores.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1).drop("nth")

    scores = pairs.select("q", "rep", "ids", "asks", "vector").mapInArrow(tidy(exact), "q long, rep long, ids array<long>, score double")
    ranked = stored(best_of(scores.select("q", "rep", F.explode("ids").alias("vec_id"), "score")), "ranked")
    to, parts = _packed(index, size, max(1, min(max(256, n // CHECKS), HELD // sizes["size"])))
    total = int((to + parts).max())

    def reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 512):
                some = batch.slice(lo, 512)
                x = matrix(some.column("vector"))
                norm = np.sqrt((x * x).sum(axis=1))[:, None]
                bound = np.minimum(x @ index.coarse.T + norm * radius, norm * longest) + 1e-9 * norm * (radius + longest)
                i, at = np.nonzero(~(bound < some.column("least").to_numpy()[:, None]) & (size > 0))
                n = parts[at]
                share = np.repeat(to[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                i, share = np.divmod(np.unique(np.repeat(i, n) * total + share), total)
                raw = binaries(x.astype(kind))
                for begin in range(0, len(i), 16_384):
                    who = pa.array(i[begin : begin + 16_384])
                    columns = [some.column("q"), raw, some.column("least"), some.column("known")]
                    yield pa.RecordBatch.from_arrays([c.take(who) for c in columns] + [pa.array(share[begin : begin + 16_384])], ["id", "raw", "least", "known", "share"])

    def raws(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("list"), binaries(matrix(batch.column("vector")).astype(kind))], ["rep", "list", "raw"])

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, lines, x, reps = None, [], [], None, None
        rows_of = lambda raw: np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
        for batch in batches:
            share, asks = batch.column("share").to_numpy(), batch.column("asks").to_numpy()
            ends = np.append(np.flatnonzero(np.diff(share * 2 + asks)) + 1, len(share))
            for lo, hi in zip(np.append(0, ends), ends):  # noqa: B905
                some = batch.slice(lo, hi - lo)
                if not len(some):
                    continue
                if share[lo] != now:
                    now, ids, lines, x = share[lo], [], [], None
                if not asks[lo]:  # a share's vectors come before its queries
                    ids.append(some.column("id").to_numpy())
                    lines += some.column("raw").to_pylist()
                    continue
                if x is None and lines:
                    reps, x = np.concatenate(ids), rows_of(lines)
                    order = np.argsort(reps)
                    reps, x, ids, lines = reps[order], x[order], [], []
                if x is not None:
                    i, j, score = unfound(rows_of(some.column("raw").to_pylist()), some.column("least").to_numpy(), x, reps, some.column("known"), k)
                    yield pa.RecordBatch.from_arrays([some.column("id").take(pa.array(i)), pa.array(reps[j]), pa.array(score)], ["q", "rep", "score"])

    found = ranked.groupBy("q").agg(F.when(F.count(F.lit(1)) > k, F.min("score")).alias("least"), F.collect_set("rep").alias("known"))
    asks = once.select("q", "vector").join(found, "q", "left").select("q", "vector", F.coalesce("least", F.lit(float("-inf"))).alias("least"), F.coalesce("known", F.array().cast("array<long>")).alias("known"))
    asks = asks.mapInArrow(tidy(reaching), "id long, raw binary, least double, known array<long>, share long")
    held = inverted.select("rep", "list", "vector").mapInArrow(tidy(raws), "rep long, list int, raw binary").mapInArrow(sharing(to, parts), "rep long, list int, raw binary, share long")
    held = held.select(F.col("rep").alias("id"), "raw", F.lit(0.0).alias("least"), F.array().cast("array<long>").alias("known"), "share", F.lit(0).alias("asks"))
    meet = held.unionByName(asks.withColumn("asks", F.lit(1))).repartition(min(total, 4096), "share").sortWithinPartitions("share", "asks")
    more = meet.mapInArrow(tidy(checked), "q long, rep long, score double").join(inverted.select("rep", "ids"), "rep")
    ranked = best_of(ranked.unionByName(more.select("q", "rep", F.explode("ids").alias("vec_id"), "score")))
    # every query of the same vector gets these, but itself
    each = ask.select(F.col("id").alias("query_id"), "h1", "h2").distinct().join(once.select("q", "h1", "h2"), ["h1", "h2"]).select("query_id", "q")
    found = each.join(ranked.drop("rep"), "q").filter("vec_id != query_id")
    order = W.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.filter(F.col("vec_id") % 20 == 0))
