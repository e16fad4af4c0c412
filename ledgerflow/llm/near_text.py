"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF word shingles."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import discard, integral, mix64, sliced, stored, table, tidy, utf8_bytes, word_hashes, words
from .components import components

#: Words of a shingle; least weighted Jaccard similarity; bands and rows of a band.
WORDS, LEAST, BANDS, ROWS = 5, 0.8, 16, 4
#: Counters of a row of the sketch of the words' document frequencies, which has two rows.
BUCKETS = 1 << 18
#: Pieces in which tasks hand over their sketches.
PIECES = 64
#: Members of a block, where a bucket's members are compared with each other.
BLOCK = 512
_N = 4096
_rng = np.random.default_rng(0x1C35)
#: Quantiles of the Gamma(2, 1) and uniform variables that the sampling draws, looked up by bits of a hash.
_R = _rng.permutation(np.sort(_rng.gamma(2, 1, _N * 64)).reshape(_N, 64).mean(axis=1)).astype(np.float32)
_LN_C = _rng.permutation(np.log(np.sort(_rng.gamma(2, 1, _N * 64)).reshape(_N, 64).mean(axis=1))).astype(np.float32)
_BETA = _rng.permutation((np.arange(_N) + 0.5) / _N).astype(np.float32)
_ODD = _rng.integers(0, 1 << 63, BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_INV_R = (1 / _R).astype(np.float32)


def _word_table(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash and the row of each word of the texts, in order."""
    off, data = utf8_bytes(texts)
    start, end, row = words(off, data)
    return word_hashes(data, start, end), row


def _counters(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A word's counter in each row of the sketch, from different bits of its hash."""
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64), (h >> np.uint64(40) & np.uint64(BUCKETS - 1)).astype(np.int64)


def word_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """A count-min sketch, 2 by BUCKETS: in how many texts the words of each counter occur (a text counts once a counter).
    The lesser of a word's two counters is its document frequency, or more where words collide in both."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(2 * BUCKETS, np.int64)
        some = 0
        for batch in batches:
            for part in sliced(batch, text, 2 << 20):
                h, row = _word_table(part.column(text))
                some += len(h)
                for i, at in enumerate(_counters(h)):
                    once = np.unique(row * BUCKETS + at) % BUCKETS
                    n[i * BUCKETS : (i + 1) * BUCKETS] += np.bincount(once, minlength=BUCKETS)
        if some:  # a piece is a row, so that rows don't follow the words
            turn = int(n.view(np.uint64).sum() % np.uint64(64))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(PIECES)), pa.array(np.full(PIECES, turn)), pa.array([x.tobytes() for x in n.reshape(PIECES, -1)], pa.binary())], ["piece", "turn", "counts"])

    def added(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in group.column("counts").to_pylist())
        return pa.table({"piece": group.column("piece")[:1], "turn": group.column("turn")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    kind = "piece long, turn long, counts binary"
    # in two steps, so that no task adds up the pieces of all tasks
    parts = docs.select(text).mapInArrow(tidy(task), kind).groupBy("piece", "turn").applyInArrow(added, kind).groupBy("piece").applyInArrow(added, kind)
    out = np.zeros(2 * BUCKETS, np.int64).reshape(PIECES, -1)
    for r in parts.collect():  # 2 * BUCKETS numbers in all
        out[r["piece"]] = np.frombuffer(r["counts"], np.int64)
    return out.reshape(2, BUCKETS)


def idf_of(frequencies: np.ndarray, n: int) -> np.ndarray:
    """1 + ln((1 + n) / (1 + df)) / ln(1 + n): between 1 and 2, so that a shingle of rare words counts up to twice one of
    words that every text has, and a large group of copies doesn't make its own words worthless."""
    return (1 + np.log((1 + n) / (1 + np.minimum(frequencies, n))) / max(1e-9, math.log(1 + n))).astype(np.float32)


def shingles(texts: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count, idf) of the distinct shingles of each text. A shingle is WORDS words in a row, or all words
    of a text that has fewer; its idf is the mean of its words'. idf: of the sketch's counters."""
    h, row = _word_table(texts)
    z = np.zeros(0, np.int64)
    if not len(h):
        return z, z.astype(np.uint64), z, np.zeros(0, np.float32)
    weight = np.maximum(*(own[at] for own, at in zip(idf, _counters(h), strict=True)))
    first = np.searchsorted(row, np.arange(len(texts)))
    count = np.bincount(row, minlength=len(texts))
    n = len(h)
    with np.errstate(over="ignore"):
        code, total, length = h.copy(), weight.astype(np.float64), np.ones(n)
        for j in range(1, min(WORDS, n)):
            inside = np.zeros(n, bool)
            inside[: n - j] = row[j:] == row[: n - j]
            nxt, w = np.zeros(n, np.uint64), np.zeros(n)
            nxt[: n - j], w[: n - j] = h[j:], weight[j:]
            code = np.where(inside, code * np.uint64(0x9E3779B97F4A7C15) + nxt, code)
            total, length = total + np.where(inside, w, 0), length + inside
    whole = length == WORDS
    whole[first[(count > 0) & (count < WORDS)]] = True  # short texts: one shingle
    code, row, value = mix64(code[whole]), row[whole], (total[whole] / length[whole]).astype(np.float32)
    by = np.argsort(code, kind="stable")
    by = by[np.argsort(row[by], kind="stable")]
    code, row, value = code[by], row[by], value[by]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], code[at], np.diff(np.append(at, len(code))), value[at]


def signatures(n: int, row: np.ndarray, code: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The consistent weighted samples of each text (n x BANDS * ROWS): for each hash the shingle and level of least
    ln a = ln c - r (t - beta + 1), t = floor(ln weight / r + beta); 32 bits of both. Rows without shingles have 0."""
    out = np.zeros((n, len(_ODD)), np.uint32)
    if not len(row):
        return out
    own, begin = np.unique(row, return_index=True)
    ln_w = np.log(count.astype(np.float32) * idf)
    low = (code & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    mask = np.uint64(_N - 1)
    for k, odd in enumerate(_ODD):
        with np.errstate(over="ignore"):
            z = code * odd
            r_at = (z >> np.uint64(52)).astype(np.int32)
            beta = _BETA[(z >> np.uint64(40) & mask).astype(np.int32)]
            t = np.floor(ln_w * _INV_R[r_at] + beta)
            ln_a = _LN_C[(z >> np.uint64(28) & mask).astype(np.int32)] - _R[r_at] * (t - beta + 1)
            # as one number: the order of ln a above, what was sampled below
            bits = np.ascontiguousarray(np.float32(512) + ln_a, np.float32).view(np.uint32).astype(np.uint64)
            name = low ^ (t.astype(np.int32).astype(np.uint32) * np.uint32(0x85EBCA6B)) ^ (z >> np.uint64(32)).astype(np.uint32)
            out[own, k] = (np.minimum.reduceat(bits << np.uint64(32) | name, begin) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out


def banded(sign: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band."""
    with np.errstate(over="ignore"):
        key = np.zeros((len(sign), BANDS), np.uint64)
        for j in range(ROWS):
            key = key * np.uint64(0x9E3779B97F4A7C15) + sign[:, j::ROWS][:, :BANDS].astype(np.uint64) + np.uint64(1)
    return mix64(key.ravel()).reshape(key.shape).astype(np.int64)


def similarities(a: pa.Array, b: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Exact weighted Jaccard similarity of the pairs a[i], b[i]: sum of least weights over sum of largest."""
    n = len(a)
    ra, ca, na, wa = shingles(a, idf)
    rb, cb, nb, wb = shingles(b, idf)
    with np.errstate(over="ignore"):
        key = lambda r, c: c + mix64(r.astype(np.uint64), 5)
        keys = np.concatenate([key(ra, ca), key(rb, cb)])
    count, weight, row = np.concatenate([na, nb]), np.concatenate([wa, wb]).astype(np.float64), np.concatenate([ra, rb])
    by = np.argsort(keys, kind="stable")
    same = keys[by][1:] == keys[by][:-1]
    x, y = by[:-1][same], by[1:][same]
    both = np.bincount(row[x], np.minimum(count[x], count[y]) * weight[x], n)
    total = np.bincount(row, count * weight, n)
    return np.divide(both, total - both, out=np.zeros(n), where=total > both)


def _samples(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text", 1 << 20):
                row, code, count, weight = shingles(part.column("text"), idf)
                sign = signatures(len(part), row, code, count, weight)
                has = np.zeros(len(part), bool)
                has[row] = True
                at = pa.array(np.flatnonzero(has))
                off = pa.array(np.arange(len(at) + 1) * BANDS, pa.int32())
                raw = np.ascontiguousarray(sign[has])
                kept = pa.Array.from_buffers(pa.binary(raw.shape[1] * 4), len(at), [None, pa.py_buffer(raw)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("id").take(at), pa.ListArray.from_arrays(off, pa.array(banded(raw).ravel())), kept], ["id", "bands", "sign"])

    return docs.mapInArrow(tidy(task), "id long, bands array<long>, sign binary")


def _agreeing(pairs: DataFrame, samples: DataFrame, least: float) -> DataFrame:
    """Pairs whose samples agree in at least `least` of their places."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(len(batch), -1) for c in ("sign_a", "sign_b"))
            yield batch.select(["a", "b"]).filter(pa.array((a == b).mean(axis=1) >= least)) if len(batch) else batch.select(["a", "b"])

    s = samples.select("id", "sign")
    both = pairs.join(s.select(F.col("id").alias("a"), F.col("sign").alias("sign_a")), "a").join(s.select(F.col("id").alias("b"), F.col("sign").alias("sign_b")), "b")
    return both.mapInArrow(tidy(task), "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text_a", 1 << 20):
                for own in sliced(part, "text_b", 1 << 20):
                    ok = similarities(own.column("text_a"), own.column("text_b"), idf) >= least
                    yield own.select(["a", "b"]).filter(pa.array(ok))

    both = pairs.join(docs.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(docs.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.mapInArrow(tidy(task), "a long, b long")


def _stars(places: DataFrame) -> DataFrame:
    """Pairs of each bucket's members with its most central one: places (bucket, id, centre)."""
    top = places.groupBy("bucket").agg(F.max(F.struct("centre", F.col("id").alias("star"))).alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return places.join(top.select("bucket", F.col("top.star").alias("star")), "bucket").filter("id != star").select(F.least("id", "star").alias("a"), F.greatest("id", "star").alias("b"))


def similar(a: pa.Array, b: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Exact weighted Jaccard similarity of every a[i] with every b[j]: a shingle that a text has n times is n features of
    0 or 1, so that sums of least weights are products of matrices."""
    sides = []
    for texts in (a, b):
        row, code, count, weight = shingles(texts, idf)
        total = np.bincount(row, count * weight.astype(np.float64), len(texts))
        level = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        with np.errstate(over="ignore"):
            key = np.repeat(code, count) + np.where(level > 0, mix64(level.astype(np.uint64), 5), np.uint64(0))
        sides.append((np.repeat(row, count), key, np.repeat(weight, count).astype(np.float64), total))
    (ra, ka, wa, ta), (rb, kb, _, tb) = sides
    both = np.zeros((len(a), len(b)))
    common = np.intersect1d(ka, kb)
    for at in range(0, len(common), 2048):
        part = common[at : at + 2048]
        x, y = np.zeros((len(a), len(part))), np.zeros((len(b), len(part)))
        for out, row, key, weight in ((x, ra, ka, wa), (y, rb, kb, 1.0)):
            place = np.minimum(np.searchsorted(part, key), len(part) - 1)
            ok = part[place] == key
            out[row[ok], place[ok]] = weight if np.isscalar(weight) else weight[ok]
        both += x @ y.T
    total = ta[:, None] + tb[None] - both
    return np.divide(both, total, out=np.zeros(both.shape), where=total > 0)


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the links a[i], b[i] connect."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    top = np.arange(len(nodes))
    while True:
        least = top.copy()
        low = np.minimum(top[x], top[y])
        np.minimum.at(least, x, low)
        np.minimum.at(least, y, low)
        least = least[least]
        if (least == top).all():
            break
        top = least
    apart = top != np.arange(len(nodes))
    return nodes[apart], nodes[top[apart]]


def _rest(places: DataFrame, parts: DataFrame, samples: DataFrame, docs: DataFrame, idf: np.ndarray, least: float, n: int) -> DataFrame:
    """Links (a, b) that connect all texts of a similarity of `least` or more that share a bucket of places (band, bucket,
    id), but no component of parts (node, component).

    In a bucket the members outside its largest component are dealt to blocks, and all members are; a block of the one
    meets every block of the other in a group of its own. A pair is compared in the first band that it shares, by its
    samples first (those that agree in too few places, six deviations below `least`, a chance of about 1e-9, can't be
    similar). Where two blocks have no more such pairs than members, the pairs go on, to be verified one by one; else the
    blocks do, whose texts are compared exactly by products of matrices, and only edges that span their links leave the
    task. So neither a task's rows nor those between tasks follow the pairs."""
    at = places.join(parts.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("part", F.coalesce("component", "id")).select("band", "bucket", "id", "part")
    sizes = at.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("bucket").agg(F.max(F.struct("n", "part")).alias("top"), F.sum("n").alias("n")).filter("n > top.n")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    mixed = mixed.select("bucket", F.col("top.part").alias("main"), blocks(F.col("n") - F.col("top.n")).alias("few"), blocks(F.col("n")).alias("all"))
    own = at.join(mixed, "bucket").join(samples.select("id", "sign"), "id")
    deal = lambda n: F.pmod(F.xxhash64("id", F.lit("block")), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    columns = ["band", "bucket", "id", "part", (F.col("part") == F.col("main")).alias("big"), "sign"]
    right = own.select(*columns, F.lit(False).alias("left"), deal(F.col("all")).alias("j"), each(F.col("few")).alias("i"))
    left = own.filter("part != main").select(*columns, F.lit(True).alias("left"), deal(F.col("few")).alias("i"), each(F.col("all")).alias("j"))
    members = stored(right.unionByName(left), "members")
    enough = least - 6 * math.sqrt(least * (1 - least) / (BANDS * ROWS))

    def sharing(x: pa.Table, y: pa.Table, band: int) -> np.ndarray:
        """Which pairs are to be compared here."""
        sx, sy = (np.frombuffer(b"".join(t["sign"].to_pylist()), np.uint32).reshape(len(t), -1) for t in (x, y))
        ix, px, iy, py, big = (c.to_numpy() for c in (x["id"], x["part"], y["id"], y["part"], y["big"]))
        out = np.zeros((len(x), len(y)), bool)
        for k in range(0, len(x), 64):
            own = slice(k, k + 64)
            agree, before = np.zeros((len(ix[own]), len(y)), np.uint8), np.zeros((len(ix[own]), len(y)), bool)
            for b in range(BANDS):
                all_ = np.ones(agree.shape, bool)
                for r in range(b * ROWS, (b + 1) * ROWS):
                    same = sx[own, r, None] == sy[None, :, r]
                    agree += same
                    all_ &= same
                if b < band:
                    before |= all_
            out[own] = (agree >= enough * BANDS * ROWS) & ~before & (px[own, None] != py[None]) & (big[None] | (ix[own, None] < iy[None]))
        return out

    def sides(group: pa.Table) -> tuple[pa.Table, pa.Table, np.ndarray]:
        group = group.combine_chunks()
        x, y = group.filter(group["left"]), group.filter(pc.invert(group["left"]))
        return x, y, sharing(x, y, group["band"][0].as_py()) if len(x) and len(y) else np.zeros((len(x), len(y)), bool)

    def picked(group: pa.Table) -> pa.Table:
        """Pairs (bucket null), or a row of bucket, a block and a block."""
        x, y, open_ = sides(group)
        i, j = np.nonzero(open_)
        if len(i) > len(x) + len(y):
            return pa.table({"bucket": group["bucket"][:1], "a": group["i"][:1].cast(pa.int64()), "b": group["j"][:1].cast(pa.int64())})
        a, b = x["id"].to_numpy()[i], y["id"].to_numpy()[j]
        return pa.table({"bucket": pa.nulls(len(a), pa.int64()), "a": np.minimum(a, b), "b": np.maximum(a, b)})

    def dense(group: pa.Table) -> pa.Table:
        x, y, open_ = sides(group)
        x, y, open_ = x.filter(pa.array(open_.any(axis=1))), y.filter(pa.array(open_.any(axis=0))), open_[np.ix_(open_.any(axis=1), open_.any(axis=0))]
        links = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for m, own in _parts(x):
            for n, other in _parts(y):
                few = open_[m : m + len(own), n : n + len(other)]
                if few.any():
                    i, j = np.nonzero(few & (similar(own.column("text"), other.column("text"), idf) >= least))
                    links.append((own.column("id").to_numpy()[i], other.column("id").to_numpy()[j]))
        a, b = _spanning(*(np.concatenate(z) for z in zip(*links, strict=True)))
        return pa.table({"a": a, "b": b})

    found = stored(members.groupBy("bucket", "i", "j").applyInArrow(picked, "bucket long, a long, b long"), "picked", n)
    pairs = _verified(found.filter("bucket IS NULL").select("a", "b").distinct(), docs, idf, least)
    crowded = found.filter("bucket IS NOT NULL").select("bucket", F.col("a").cast("int").alias("i"), F.col("b").cast("int").alias("j"))
    crowded = members.join(crowded, ["bucket", "i", "j"], "left_semi").join(docs, "id")
    return pairs.union(crowded.groupBy("bucket", "i", "j").applyInArrow(dense, "a long, b long"))


def _parts(rows: pa.Table) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of about a megabyte of text, with their first row."""
    at = 0
    for batch in rows.combine_chunks().to_batches():
        for part in sliced(batch, "text", 1 << 20):
            yield at, part
            at += len(part)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """(id, class_id) for every document; class_id is the smallest key of those that exact copies and links of a weighted
    Jaccard similarity of `least` or more reach.

    1. Equal texts are one, under their smallest key. 2. Weights: a shingle's count times the mean idf of its words, over
    all texts (a sketch of the words' document frequencies). 3. Each text's samples go to BANDS buckets of ROWS samples
    each; at a similarity of 0.8 a pair has none in common with a chance of about 0.0002. 4. First, a bucket's members are
    compared with its most central one (that shares the most buckets with others), which copies of one original have in
    common. 5. Then, for links that don't go through it: stars in the buckets of two neighbouring bands (closer texts) and
    stars around a random member of each bucket; of these pairs those that the first round hasn't connected, and whose
    samples agree enough (0.62 of 64: three deviations below 0.8), are compared too; they only spare work to the next step.
    6. Then every bucket is finished: all pairs of its members that are in different components by now are compared, block
    against block. 7. Every link is verified on whole texts.

    Nulls: a null text is an empty one; texts without words link only with equal texts; rows without a key are compared with
    none and return a null class each. Keys are integers. Rows with one key are one document: it returns one row, and the
    classes of its texts are one. An empty table gives no rows. Other columns are ignored."""
    plain = docs.select(integral(docs, key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    same = stored(plain.filter("id IS NOT NULL").select("id", F.md5(F.col("text").cast("binary")).alias("digest")).distinct(), "digests")
    n = max(1, same.count())
    # the groups alone are written first, so that a large group is no task of its own in the join
    groups = stored(same.groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "rep"), "groups", n)
    copies = stored(same.join(groups, "digest", "left").select("id", F.coalesce("rep", "id").alias("rep"), "digest"), "copies", n)
    discard(same, groups)
    firsts = copies.filter("id = rep").select("id", "digest")
    digest = F.md5(F.col("text").cast("binary"))
    # rows that agree in key and text are one; a key's several first texts are sampled one by one
    own = plain.withColumn("digest", digest).join(firsts, ["id", "digest"], "left_semi").select("id", "text")
    idf = idf_of(word_frequencies(plain), n)
    samples = stored(_samples(own, idf), "samples")

    each = samples.select("id", F.posexplode("bands").alias("band", "value"))
    bucket = F.xxhash64("band", "value")
    places = each.select("band", bucket.alias("bucket"), "id")
    full = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = stored(places.join(full, "bucket"), "buckets", BANDS * n)
    centre = stored(buckets.groupBy("id").agg(F.sum("n").alias("centre")), "centres", n)
    places = stored(buckets.select("band", "bucket", "id").join(centre, "id"), "places", BANDS * n)
    discard(buckets)
    texts = stored(own.join(centre.select("id"), "id", "left_semi"), "texts")  # of all that may be in a pair; the others aren't moved again
    several = copies.groupBy("id").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    several = copies.join(several, "id").filter("rep != least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    first = stored(_verified(_stars(places.select("bucket", "id", "centre")).distinct(), texts, idf, least).union(several), "links", n)
    parts = stored(components(first), "parts", n)

    near = samples.join(centre, "id").select("id", "centre", "bands")
    pairs_of = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(F.lit("two"), i, F.get("bands", i), F.get("bands", (i + 1) % BANDS)))
    closer = _stars(near.select(F.explode(pairs_of).alias("bucket"), "id", "centre"))
    any_ = _stars(places.select("bucket", "id", F.xxhash64("bucket", "id").alias("centre")))
    more = closer.union(any_).distinct()
    at = parts.select("node", "component")
    more = more.join(at.select(F.col("node").alias("a"), F.col("component").alias("part_a")), "a", "left").join(at.select(F.col("node").alias("b"), F.col("component").alias("part_b")), "b", "left")
    more = more.filter(~F.coalesce(F.col("part_a") == F.col("part_b"), F.lit(False))).select("a", "b")
    more = stored(_agreeing(more, samples, least - 3 * math.sqrt(least * (1 - least) / (BANDS * ROWS)) - 0.03), "more-pairs", n)
    second = _verified(more, texts, idf, least)
    hung = lambda p: p.filter("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    earlier, parts = parts, stored(components(hung(parts).union(second)), "parts", n)
    discard(first, more, earlier, centre)

    third = stored(_rest(places, parts, samples, texts, idf, least, n), "links", n)
    discard(places, samples, texts)
    whole = parts if third.isEmpty() else components(hung(parts).union(third))
    out = copies.select("id", "rep").join(whole.select(F.col("node").alias("rep"), "component"), "rep", "left").groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("class_id"))
    return out.union(plain.filter("id IS NULL").select("id", F.lit(None).cast("long").alias("class_id")))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", F.coalesce(F.col("id") == F.col("class_id"), F.lit(True)).alias("kept"))
