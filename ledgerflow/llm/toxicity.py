"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyarrow import compute as pc, fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from .ann import kmeans, nearest as closest
from .common import fresh_path, give_back, laid, quoted, sliced, spread, table, tidy

#: Labelled rows that a model is fitted on, at most; examples of a block; neighbours that vote.
EXAMPLES, BLOCK, NEIGHBOURS = 8192, 32, 50
#: Texts that are searched for together, and postings of rare terms that they may have in all, at most.
TEXTS, POSTINGS = 256, 2_500_000
#: Texts of these whose scores are ranked at once.
ROWS = 32
#: Examples that the calibration scores, each without itself, at most.
CALIBRATED = 2048
#: How many examples, shared out by the labels' shares, a term is taken to have been in besides those it is in.
SMOOTH = 60.0
#: Terms of more than one example of so many are frequent: their postings are opened block by block.
FREQUENT = 16
_LETTERS = regex.compile(r"\p{L}+")
_hash = xxhash.xxh3_64_intdigest


def terms_of(token: str) -> list[int]:
    """Hashes of a token's terms: its runs of letters, lower-cased."""
    low = token.lower()
    return [_hash(low)] if low.isalpha() else [_hash(w) for w in _LETTERS.findall(low)]


def counted(texts: pa.Array, numbers: dict[str, list[int]], number_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of the texts; numbers remembers the terms of the tokens met before. number_of: the terms' numbers
    of several tokens at once, from their hashes."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    token = lists.flatten().dictionary_encode()
    names = token.dictionary.to_pylist()
    if len(numbers) > 150_000:
        numbers.clear()
    new = [w for w in names if w not in numbers]
    numbers.update(zip(new, number_of([terms_of(w) for w in new]), strict=True))
    own = [numbers[w] for w in names]
    n = np.fromiter(map(len, own), np.int64, len(own))
    flat = np.fromiter((t for x in own for t in x), np.int64, int(n.sum()))
    begin, code = np.cumsum(n) - n, token.indices.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    some = n[code] > 0
    code, row = code[some], row[some]
    k = n[code]
    term = laid(flat, begin[code], k)
    key, count = np.unique(np.repeat(row, k) << 32 | term, return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, count


@dataclass
class Index:
    """Examples as TF-IDF vectors in blocks.

    A rare term's postings (slots and weights) are opened whenever a text has it. A frequent term's lie in a matrix, terms
    by slots, of which a block is opened only for texts for which it may matter: peak has the largest weight of each
    frequent term in each block, so what a block's examples have from rare terms and sum(query weight * peak) bound every
    cosine in it."""

    names: np.ndarray  # hashes of the terms, sorted
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    at: np.ndarray  # where a term's postings begin; a frequent one has none
    slots: np.ndarray
    weights: np.ndarray
    place: np.ndarray  # a frequent term's row of the matrix, else -1
    often: np.ndarray
    peak: np.ndarray
    prior: float
    line: tuple[float, float] = (1.0, 0.0)

    @classmethod
    def build(cls, names: np.ndarray, ids: np.ndarray, labels: np.ndarray, row: np.ndarray, term: np.ndarray, count: np.ndarray) -> Index:
        """The index over all terms of the examples. A term's idf is the difference of its two idfs, over the P toxic
        examples and over the Q others, p and q of which have it. With SMOOTH more of all N that have it, in proportion to
        the labels, that is |ln(1 + p N / (SMOOTH P)) - ln(1 + q N / (SMOOTH Q))|; 0 for terms that no example has."""
        n, toxic = len(ids), labels.sum()
        df, p = np.bincount(term, minlength=len(names)).astype(float), np.bincount(term, labels[row], len(names)).astype(float)
        share = toxic / n
        log = lambda x, share: np.log(1 + x / (SMOOTH * share)) if share else np.zeros(len(x))
        idf = np.abs(log(p, share) - log(df - p, 1 - share))
        weight = (1 + np.log(count)) * idf[term]
        weight /= np.maximum(np.sqrt(np.bincount(row, weight * weight, n))[row], 1e-300)
        common = np.flatnonzero(df > n / FREQUENT)
        place = np.full(len(names), -1)
        place[common] = np.arange(len(common))
        slots, blocks = -(-n // BLOCK) * BLOCK, -(-n // BLOCK)
        often = np.zeros((len(common), slots))
        frequent = place[term] >= 0
        often[place[term[frequent]], row[frequent]] = weight[frequent]
        # examples that are alike share blocks: by groups of their frequent terms, and by their heaviest term
        heavy = np.full(n, len(names))
        order = np.lexsort((term, -weight, row))
        first = np.unique(row[order], return_index=True)
        heavy[first[0]] = term[order][first[1]]
        like = often[:, :n].T
        group = closest(like, kmeans(like, max(1, n // 128), np.random.default_rng(7), 5)) if len(common) else np.zeros(n)
        order = np.lexsort((ids, heavy, group))
        slot = np.empty(n, np.int64)
        slot[order] = np.arange(n)
        often[:, :n] = often[:, order]
        rare = np.flatnonzero(~frequent)
        rare = rare[np.lexsort((slot[row[rare]], term[rare]))]
        at = np.searchsorted(term[rare], np.arange(len(names) + 1))
        peak = often.reshape(len(common), blocks, BLOCK).max(axis=2)
        return cls(names, idf, ids[order], labels[order], at, slot[row[rare]].astype(np.int32), weight[rare], place, often, peak, float(labels.mean()))

    def save(self, where: str) -> str:
        """One file, in parts of whole eights of bytes: the length of its head, the head (JSON), then the arrays."""
        there, path = fs.FileSystem.from_uri(where)
        there.create_dir(path.rpartition("/")[0], recursive=True)
        arrays = {n: np.ascontiguousarray(v) for n, v in vars(self).items() if isinstance(v, np.ndarray)}
        head = json.dumps({"arrays": [(n, v.dtype.str, v.shape) for n, v in arrays.items()], "prior": self.prior, "line": self.line}).encode()
        with there.open_output_stream(path) as f:
            for part in (np.array([len(head)], "<i8"), np.frombuffer(head, np.uint8), *arrays.values()):
                f.write(memoryview(part.reshape(-1).view(np.uint8)))
                f.write(bytes(-part.nbytes % 8))
        return where

    @classmethod
    def load(cls, where: str) -> Index:
        """A saved index; on a local disk its arrays are the mapped file, which all workers of a machine share."""
        there, path = fs.FileSystem.from_uri(where)
        if isinstance(there, fs.LocalFileSystem):
            data = np.asarray(np.memmap(path, np.uint8, "r"))
        else:
            with there.open_input_file(path) as f:
                data = np.frombuffer(f.read(), np.uint8)
        size = int(data[:8].view("<i8")[0])
        head, at, arrays = json.loads(data[8 : 8 + size].tobytes()), 8 + size + -size % 8, {}
        for name, kind, shape in head["arrays"]:
            n = math.prod(shape) * np.dtype(kind).itemsize
            arrays[name] = data[at : at + n].view(kind).reshape(shape)
            at += n + -n % 8
        return cls(**arrays, prior=head["prior"], line=tuple(head["line"]))

    def numbers(self, tokens: list[list[int]]) -> list[list[int]]:
        """Numbers of each token's terms, from their hashes, without those that no example has. Found in the sorted names: a
        table of them would take each worker many times their size."""
        hashes = np.fromiter((h for t in tokens for h in t), np.uint64)
        at = np.minimum(np.searchsorted(self.names, hashes), max(0, len(self.names) - 1))
        found = np.where(self.names[at] == hashes, at, -1).tolist() if len(self.names) else [-1] * len(hashes)
        out, upto = [], 0
        for t in tokens:
            out.append([i for i in found[upto : upto + len(t)] if i >= 0])
            upto += len(t)
        return out

    def nearest(self, row: np.ndarray, term: np.ndarray, count: np.ndarray, n: int, k: int = NEIGHBOURS, but: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Slots and cosines (n by k, nearest first; cosine 0 where there are no more) of the nearest examples of n texts.
        but: a slot of each text that is left out.

        A text's blocks with the largest bounds are opened first; then those whose bound beats its k-th best."""
        slots = self.often.shape[1]
        weight = (1 + np.log(count)) * self.idf[term]
        weight /= np.maximum(np.sqrt(np.bincount(row, weight * weight, n))[row], 1e-300)
        often = self.place[term] >= 0
        query = np.zeros((n, len(self.peak)))
        query[row[often], self.place[term[often]]] = weight[often]
        rare = np.flatnonzero(~often)
        begin, many = self.at[term[rare]], self.at[term[rare] + 1] - self.at[term[rare]]
        upto = np.cumsum(many)
        at = np.repeat((begin - (upto - many)).astype(np.int32), many)
        at += np.arange(len(at), dtype=np.int32)
        cell = np.repeat((row[rare] * slots).astype(np.int32), many)
        cell += self.slots[at]
        part = np.repeat(weight[rare], many)
        part *= self.weights[at]
        score = np.bincount(cell, part, n * slots).astype(float, copy=False).reshape(n, slots)
        if but is not None:
            score[np.arange(n), but] = -slots
        blocks = slots // BLOCK
        bound = score.reshape(n, blocks, BLOCK).max(axis=2) + query @ self.peak
        opened = np.zeros((n, blocks), bool)

        def open_(which: np.ndarray) -> None:
            for b in np.flatnonzero(which.any(axis=0)):
                own, part = np.flatnonzero(which[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
                score[own, part] += query[own] @ self.often[:, part]
            opened[which] = True

        k = min(k, slots)
        some = min(blocks, -(-k // BLOCK) + 1)
        which = np.zeros((n, blocks), bool)
        np.put_along_axis(which, np.argpartition(-bound, some - 1, axis=1)[:, :some], True, 1)
        open_(which)
        best = np.empty(n)
        for a in range(0, n, ROWS):  # some rows at a time: these copies are as large as score
            some = slice(a, a + ROWS)
            best[some] = -np.partition(np.where(np.repeat(opened[some], BLOCK, axis=1), -score[some], 1.0), k - 1, axis=1)[:, k - 1]
        open_((bound > np.maximum(best, 0)[:, None] * (1 - 1e-12)) & ~opened)
        np.negative(score, out=score)
        score.reshape(n, blocks, BLOCK)[~opened] = 1
        top = np.concatenate([np.argpartition(score[a : a + ROWS], k - 1, axis=1)[:, :k] for a in range(0, n, ROWS)])
        near = np.maximum(-np.take_along_axis(score, top, 1), 0)
        order = np.lexsort((top, -np.round(near, 12)), axis=1)
        return np.take_along_axis(top, order, 1), np.take_along_axis(near, order, 1)

    def searched(self, row: np.ndarray, term: np.ndarray, count: np.ndarray, n: int, but: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """nearest for any number of texts, some at a time."""
        cost = np.cumsum(np.bincount(row, self.at[term + 1] - self.at[term], n)) if n else np.zeros(0)
        out, a = [], 0
        while a < n:
            z = min(a + TEXTS, max(a + 1, int(np.searchsorted(cost, (cost[a - 1] if a else 0) + POSTINGS, side="right"))))
            lo, hi = np.searchsorted(row, (a, z))
            out.append(self.nearest(row[lo:hi] - a, term[lo:hi], count[lo:hi], z - a, but=None if but is None else but[a:z]))
            a = z
        none = np.zeros((0, NEIGHBOURS))
        return (np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])) if out else (none.astype(np.int64), none)

    def vote(self, slots: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Votes weigh the squared cosine, half a vote goes to the prior."""
        w = scores * scores
        return ((w * self.labels[np.minimum(slots, len(self.labels) - 1)]).sum(axis=1) + 0.5 * self.prior) / (w.sum(axis=1) + 0.5)

    def calibrate(self, row: np.ndarray, term: np.ndarray, count: np.ndarray, slot: np.ndarray) -> None:
        """A logistic line through examples' own votes, each without itself; slot: of each of their rows."""
        raw, y = self.vote(*self.searched(row, term, count, len(slot), slot)), self.labels[slot]
        x = np.log(np.clip(raw, 1e-3, 1 - 1e-3) / (1 - np.clip(raw, 1e-3, 1 - 1e-3)))
        w = np.array([1.0, 0.0])
        for _ in range(200):  # Newton steps of bounded length; a small pull to the unchanged vote keeps the line finite
            p = 1 / (1 + np.exp(-np.clip(w[0] * x + w[1], -30, 30)))
            g = np.array([((p - y) * x).sum() + (w[0] - 1), (p - y).sum() + w[1]])
            d = p * (1 - p)
            h = np.array([[(d * x * x).sum() + 1, (d * x).sum()], [(d * x).sum(), d.sum() + 1]])
            step = np.clip(np.linalg.solve(h, g), -0.5, 0.5)
            w = w - step
            if np.abs(step).max() < 1e-9:
                break
        if w[0] > 0:
            self.line = (float(w[0]), float(w[1]))

    def score(self, raw: np.ndarray) -> np.ndarray:
        raw = np.clip(raw, 1e-3, 1 - 1e-3)
        return 1 / (1 + np.exp(-np.clip(self.line[0] * np.log(raw / (1 - raw)) + self.line[1], -30, 30)))


def held_out(doc_id: Column) -> Column:
    return (F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2) & doc_id.isNotNull()


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Index | None:
    """A model from labelled rows that aren't held out: about the first `examples` of them by a hash of doc_id (a bounded,
    documented sample), with all their terms. Only the examples' term counts reach the driver. None without labels.

    A doc_id with several labels is toxic if any of them says so; null labels and ids don't count."""
    learn = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    learn = learn.groupBy(F.col("doc_id").alias("l_id")).agg(F.max("toxic").alias("l_toxic"))
    n = learn.count()
    h = F.pmod(F.xxhash64(F.lit("example"), "l_id"), F.lit(1 << 40))
    learn = learn.filter(h < math.ceil(min(1.0, 1.1 * examples / max(1, n)) * (1 << 40))).orderBy(h, "l_id").limit(examples)
    d = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sample = d.join(F.broadcast(learn), F.col("id") == F.col("l_id")).select("id", "l_toxic", "text")  # `examples` rows at most on the broadcast side

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text", 4 << 20):
                number: dict[int, int] = {}
                row, term, count = counted(part.column("text"), {}, lambda own: [[number.setdefault(h, len(number)) for h in t] for t in own])
                off = pa.array(np.searchsorted(row, np.arange(len(part) + 1)), pa.int32())
                names = np.fromiter(number, np.uint64, len(number)).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id").cast(pa.int64()), part.column("l_toxic").cast(pa.int64()), pa.ListArray.from_arrays(off, pa.array(names[term])), pa.ListArray.from_arrays(off, pa.array(count.astype(np.int32)))], ["id", "toxic", "terms", "counts"])

    got = sample.mapInArrow(tidy(vectors), "id long, toxic long, terms array<long>, counts array<int>").toArrow().combine_chunks()
    if not len(got):
        return None
    ids, labels_ = got.column("id").to_numpy(), (got.column("toxic").to_numpy() > 0).astype(float)
    lists = got.column("terms").combine_chunks()
    row = np.repeat(np.arange(len(ids)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    hashes, count = lists.flatten().to_numpy().view(np.uint64), got.column("counts").combine_chunks().flatten().to_numpy()
    del got, lists
    # in an order that doesn't depend on the tasks'
    digest = np.bincount(row, count * (hashes % np.uint64(1 << 20)).astype(float), len(ids))
    turn = np.empty(len(ids), np.int64)
    order = np.lexsort((digest, ids))
    turn[order] = np.arange(len(ids))
    ids, labels_, row = ids[order], labels_[order], turn[row]
    names, term = np.unique(hashes, return_inverse=True)
    by = np.lexsort((term, row))
    row, term, count = row[by], term[by], count[by]
    index = Index.build(names, ids, labels_, row, term, count)
    slot = np.empty(len(ids), np.int64)  # repeated ids have equal order in both
    slot[np.lexsort((np.arange(len(ids)), ids))] = np.lexsort((np.arange(len(ids)), index.ids))
    some = np.arange(len(ids)) if len(ids) <= CALIBRATED else np.sort(np.random.default_rng(7).choice(len(ids), CALIBRATED, replace=False))
    own = np.full(len(ids), -1)
    own[some] = np.arange(len(some))
    in_ = own[row] >= 0
    index.calibrate(own[row[in_]], term[in_], count[in_], slot[some])
    del hashes, row, term, count, by, in_, digest
    give_back()  # what this took besides the model would stay with the driver
    return index


_models: dict[str, Index] = {}


def model_at(where: str) -> Index:
    """This worker's model, kept from task to task; the last one only."""
    if where not in _models:
        _models.clear()
        _models[where] = Index.load(where)
    return _models[where]


EVIDENCE = ArrayType(StructType([StructField("doc_id", LongType()), StructField("toxic", IntegerType()), StructField("cosine", DoubleType())]))


def scored(docs: DataFrame, model: Index | None, threshold: float = 0.3, evidence: int = 3) -> DataFrame:
    """docs with tox_score (0 to 1), tox_predicted (1 from the threshold on) and tox_evidence (the nearest examples).

    A text without a term that examples have, empty and null ones too, gets the calibrated prior and no evidence; without
    a model scores are 0. Repeated rows get equal scores; only text goes into a score. No rows give no rows. Texts are
    read whole, in slices of some MB. Columns of these names are replaced, others pass through."""
    own = ["tox_score", "tox_predicted", "tox_evidence"]
    kept = [c for c in docs.columns if c not in own]
    rest = [c for c in kept if c != "text"]  # these travel in one column, so that their names can't clash
    rows = docs.select(F.struct(*map(quoted, rest)).alias("rest") if rest else F.lit(0).alias("rest"), "text")
    schema = StructType([*rows.schema.fields, StructField("tox_score", DoubleType()), StructField("tox_predicted", IntegerType()), StructField("tox_evidence", EVIDENCE)])
    item = pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())])
    where = model.save(fresh_path(docs.sparkSession, "toxicity")) if model else None  # in the task it would be twice in each worker

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = model_at(where) if where else None, {}
        for batch in batches:
            for part in sliced(batch, "text", 4 << 20):
                n = len(part)
                score, why = np.zeros(n), pa.ListArray.from_arrays(pa.array(np.zeros(n + 1), pa.int32()), pa.array([], item))
                if model:
                    slots, near = model.searched(*counted(part.column("text"), known, model.numbers), n)
                    score = model.score(model.vote(slots, near))
                    told = near[:, :evidence] > 0
                    at, cosine = slots[:, :evidence][told], near[:, :evidence][told]
                    items = pa.StructArray.from_arrays([pa.array(model.ids[at]), pa.array(model.labels[at].astype(np.int32)), pa.array(cosine)], fields=list(item))
                    why = pa.ListArray.from_arrays(pa.array(np.append(0, told.sum(axis=1).cumsum()), pa.int32()), items)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32)), why], schema.names)

    out = rows.mapInArrow(tidy(task), schema)
    return out.select(*(F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in kept), *own)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = scored(spread(docs), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("tox_score").alias("score"), F.col("tox_predicted").alias("predicted"), F.col("tox_evidence").alias("evidence"))
