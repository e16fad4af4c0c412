"""Substring deduplication by content-defined chunks with a gear rolling hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import integral, mix64, quoted, sliced, table, tidy, utf8_bytes

#: A chunk ends after white space where GEAR_BITS bits of the rolling hash are 0; where there is none for LONG bytes,
#: after any character where LONG_BITS bits are (8 characters, as fine as 4 words); and where it may end next after MOST bytes.
GEAR_BITS, LONG, LONG_BITS, MOST = 2, 64, 3, 256
#: A run of duplicate chunks is removed if it has this many words, or bytes where it has no white space.
LEAST_WORDS, LEAST_BYTES = 15, 120
#: And if its chunks have this many words beyond their first two, for chunks of one or two words are equal by chance, or
#: if it is so long that chance is out of the question.
LEAST_TELLING, SURE_WORDS = 5, 40
#: A chunk is backed by one so many chunks on at most, if both stand as far from each other in one earlier document; this
#: share of a run's words must be backed.
NEAR, BACKED = 3, 0.5
#: Bytes of text that are chunked at a time; the arrays take some 40 bytes for each.
SLICE = 1 << 20
_rng = np.random.default_rng(0x6EA2)
_GEAR = _rng.integers(0, 1 << 16, 256, dtype=np.uint16)
_VALUE = _rng.integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_powers = np.ones(1, np.uint64)
_back = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    global _powers, _back
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            size = max(n + 1, 1 << 20)
            _powers, _back = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
            _powers[0] = _back[0] = 1
            _powers, _back = np.cumprod(_powers), np.cumprod(_back)
    return _powers, _back


def _gear(data: np.ndarray) -> np.ndarray:
    """The gear hash (h * 2 + G[byte], 16 bits, so over 16 bytes) at every byte, by doubling."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        h[step:] += h[:-step] << np.uint16(step)
    return h


def chunks(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, digest) of the chunks of texts laid end to end. Every text is covered by its chunks; where they
    end depends on the last 64 bytes at most (or, MOST bytes after the last such end, on that), so chunks find step again
    after an insertion. Where a text repeats one word or the like and hashes end no chunk, they are MOST bytes and a few."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    h = _gear(data)
    length = np.diff(off)
    own = np.flatnonzero(length)  # a text's first 15 bytes must not see the text before
    head = np.zeros((len(own), 31), np.uint16)
    k = np.minimum(length[own], 15)
    row = np.repeat(np.arange(len(own)), k)
    col = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
    head[row, 16 + col] = _GEAR[data[off[own][row] + col]]
    for step in (1, 2, 4, 8):
        head[:, step:] += head[:, :-step].copy() << np.uint16(step)
    h[off[own][row] + col] = head[row, 16 + col]
    white = _WHITE[data]
    cut = white & (h >> np.uint16(16 - GEAR_BITS) == 0)
    cut[:-1] &= ~white[1:]  # the whole of a stretch of white space belongs to the chunk before
    space, may = np.flatnonzero(white), white.copy()
    may[:-1] &= ~white[1:]
    if n >= LONG and np.diff(np.concatenate([[-1], space, [n]])).max() > LONG:
        last = np.full(n, -1, np.int32)
        last[space] = space
        last[off[:-1][own]] = off[:-1][own]
        since = np.arange(n, dtype=np.int32) - np.maximum.accumulate(last)
        inside = np.ones(n, bool)
        inside[:-1] = (data[1:] & 0xC0) != 0x80  # the next byte begins a character
        unspaced = (since >= LONG) & inside
        cut |= unspaced & (h >> np.uint16(16 - LONG_BITS) == 0)
        may |= unspaced
    cut[off[1:][own] - 1] = True
    end = np.flatnonzero(cut) + 1
    start = np.concatenate([[0], end[:-1]])
    at = np.flatnonzero(end - start > MOST)
    if len(at):
        steps = (end[at] - start[at] - 1) // MOST
        k = np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps) + 1
        ends, want = np.repeat(end[at], steps), np.repeat(start[at], steps) + k * MOST - 1
        places = np.flatnonzero(may)
        nxt = np.append(places, n)[np.searchsorted(places, want)]
        cut[nxt[nxt < ends]] = True
    end = np.flatnonzero(cut) + 1
    start = np.concatenate([[0], end[:-1]])
    power, back = _tables(n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[data] * power[:n], out=total[1:])
        digest = mix64((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return start, end, np.searchsorted(off, start, side="right") - 1, digest.astype(np.int64)


def _emitted(docs: DataFrame, first: bool) -> DataFrame:
    """Chunks of each batch that are the batch's first of their digest, or all others. The others are duplicates whatever
    other batches hold (of, nth_of: of the batch's first), so only one row for each digest and batch needs to meet those of
    other batches."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, mark = batch.column("id"), batch.column("mark").to_numpy()
            ids = pc.fill_null(key, np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            parts, base = [], 0
            for part in sliced(batch, "text", SLICE):
                start, _, row, digest = chunks(*utf8_bytes(part.column("text")))
                nth = np.arange(len(row)) - np.searchsorted(row, row, side="left")
                parts.append((digest, row + base, nth.astype(np.int32)))
                base += len(part)
            if not parts:
                continue
            digest, row, nth = (np.concatenate(x) for x in zip(*parts, strict=True))
            by = np.lexsort((nth, mark[row], ids[row], digest))
            head = np.ones(len(by), bool)
            head[1:] = digest[by][1:] != digest[by][:-1]
            first_of = by[np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))]
            same = (ids[row[by]] == ids[row[first_of]]) & (mark[row[by]] == mark[row[first_of]]) & (nth[by] == nth[first_of])  # the first itself, or a repeated row
            which = head if first else ~same
            pick, of = by[which], first_of[which]
            order = np.argsort(pick, kind="stable")
            pick, of = pick[order], of[order]
            columns = [pa.array(digest[pick]), key.take(pa.array(row[pick])), pa.array(mark[row[pick]]), pa.array(nth[pick])]
            names = ["digest", "id", "mark", "nth"]
            if not first:
                columns += [pa.array(_named(ids, mark)[row[of]]), pa.array(nth[of])]
                names += ["of", "nth_of"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = StructType([StructField("digest", LongType()), StructField("id", LongType()), StructField("mark", LongType()), *StructType.fromDDL("nth int").fields])
    if not first:
        schema = StructType([*schema.fields, StructField("of", LongType()), *StructType.fromDDL("nth_of int").fields])
    return docs.mapInArrow(tidy(task), schema)


def _named(ids: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """One number for a document: its key, or its mark where it has none."""
    return np.where(ids == np.iinfo(np.int64).min, mark, ids)


def duplicates(docs: DataFrame) -> DataFrame:
    """(id, mark, marks): for every document with duplicate chunks (not the first of their digest by id, mark and place) an
    array of (nth, digest, of, nth_of): of which document's which chunk. docs: id long, mark long (tells documents without
    an id apart), text string.

    A digest's rows are one per batch of documents, which a window ranks as they come (repeated rows of one document rank
    alike); no task gathers a frequent chunk's copies."""
    order = W.partitionBy("digest").orderBy("id", "mark", "nth")
    later = _emitted(docs, True).withColumn("rank", F.dense_rank().over(order)).withColumn("from", F.first(F.struct(F.coalesce("id", "mark").alias("id"), "nth")).over(order))
    later = later.filter("rank > 1").select("id", "mark", "nth", "digest", F.col("from.id").alias("of"), F.col("from.nth").alias("nth_of"))
    both = later.unionByName(_emitted(docs, False))
    return both.groupBy("id", "mark").agg(F.collect_list(F.struct("nth", "digest", "of", "nth_of")).alias("marks"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """docs with the text's repeated passages removed and n_removed, the characters taken out.

    Texts are cut to chunks; of equal chunks the first by key and place stays. A run is neighbouring duplicates, from the
    first to the last that is backed: of which another chunk, NEAR chunks on at most, is a duplicate of the same earlier
    document's chunk just as far on. What goes is every run of `least_words` words or more, BACKED of them in backed
    chunks, and LEAST_TELLING of them not among their chunk's first two or SURE_WORDS in all (of LEAST_BYTES bytes where
    there is no white space), so phrases that a text shares by chance with several others stay. What is left of a text is
    joined as it is, white space and all.

    Nulls: a null text stays null (0 removed); rows without a key sort first, by a hash of their text, and are documents of
    their own. Empty texts stay empty. Keys are integers. Rows with one key (or none and one text) are one document here:
    equal chunks at the same place of two of them both stay. Repeated passages within one text count too. An empty table gives no rows. Other columns pass through, but
    n_removed, which is replaced. Texts are handled whole."""
    whole, id_ = F.coalesce(F.col(text), F.lit("")), integral(docs, key)
    mark = F.when(id_.isNull(), F.xxhash64(whole)).otherwise(F.lit(0).cast("long"))
    marks = duplicates(docs.select(id_.alias("id"), mark.alias("mark"), whole.alias("text"))).withColumnsRenamed({"id": "m_id", "mark": "m_mark"})
    # the other columns travel in one, so that their names can't clash
    rest = [c for c in docs.columns if c not in (text, "n_removed")]
    rows = docs.select(F.struct(*map(quoted, rest)).alias("rest") if rest else F.lit(0).alias("rest"), F.col(text).alias("text"), id_.alias("id"), mark.alias("mark"))
    joined = rows.join(marks, rows.id.eqNullSafe(F.col("m_id")) & (rows.mark == F.col("m_mark")), "left").select("rest", "text", "marks")
    schema = StructType([joined.schema["rest"], joined.schema["text"], StructField("n_removed", LongType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text", SLICE):
                texts, removed = part.column("text"), np.zeros(len(part), np.int64)
                marked = np.flatnonzero(part.column("marks").is_valid().to_numpy(zero_copy_only=False))
                if len(marked):
                    own = texts.take(pa.array(marked))
                    off, data = utf8_bytes(own)
                    start, end, row, digest = chunks(off, data)
                    lists = part.column("marks").take(pa.array(marked))
                    flat = lists.flatten()
                    m_row = np.repeat(np.arange(len(marked)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                    begin = np.searchsorted(row, np.arange(len(marked)))
                    m_at = begin[m_row] + flat.field("nth").to_numpy(zero_copy_only=False)
                    ok = m_at < np.searchsorted(row, m_row, side="right")
                    m_at, m_own = m_at[ok], np.flatnonzero(ok)
                    ok = digest[m_at] == flat.field("digest").to_numpy(zero_copy_only=False)[m_own]
                    m_at, m_own = m_at[ok], m_own[ok]
                    dup, of, shift = np.zeros(len(row), bool), np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
                    dup[m_at] = True
                    of[m_at], shift[m_at] = flat.field("of").to_numpy(zero_copy_only=False)[m_own], flat.field("nth_of").to_numpy(zero_copy_only=False)[m_own] - m_at
                    gone = _runs(dup, of, shift, start, end, row, data, least_words)
                    keep = np.ones(len(data), bool)
                    keep[_spread(start[gone], end[gone])] = False
                    if gone.any():
                        left = np.concatenate([[0], np.cumsum(keep)])[off]
                        new = pa.Array.from_buffers(pa.large_string(), len(marked), [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[keep]))]).cast(pa.string())
                        removed[marked] = (pc.utf8_length(own).to_numpy(zero_copy_only=False) - pc.utf8_length(new).to_numpy(zero_copy_only=False))
                        new = pc.if_else(own.is_valid(), new, pa.scalar(None, pa.string()))
                        mask = np.zeros(len(part), bool)
                        mask[marked] = True
                        texts = pc.replace_with_mask(texts.cast(pa.string()), pa.array(mask), new)
                yield pa.RecordBatch.from_arrays([part.column("rest"), texts, pa.array(removed)], schema.names)

    out = joined.mapInArrow(tidy(task), schema)
    return out.select(*(F.col("text").alias(text) if c == text else F.col("rest")[c].alias(c) for c in docs.columns if c != "n_removed"), "n_removed")


def _spread(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = end - start
    upto = np.cumsum(n)
    return np.repeat(start - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)


def _runs(dup: np.ndarray, of: np.ndarray, shift: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, data: np.ndarray, least_words: int) -> np.ndarray:
    """The chunks of runs of duplicates within a text that are backed and long enough. of, shift: each chunk's earlier
    document and how far its place is from the one there."""
    word = ~_WHITE[data]
    word[1:] &= _WHITE[data[:-1]]
    word[start[np.searchsorted(row, np.unique(row))]] |= ~_WHITE[data[start[np.searchsorted(row, np.unique(row))]]]
    upto = np.concatenate([[0], np.cumsum(word)])
    words = upto[end] - upto[start]

    def numbered(in_run: np.ndarray) -> np.ndarray:
        new = np.ones(len(in_run), bool)
        new[1:] = (in_run[1:] != in_run[:-1]) | (row[1:] != row[:-1])
        return np.cumsum(new) - 1

    run, backed = numbered(dup), np.zeros(len(dup), bool)
    for j in range(1, min(NEAR, len(dup) - 1) + 1):
        both = dup[j:] & (run[j:] == run[:-j]) & (of[j:] == of[:-j]) & (shift[j:] == shift[:-j])
        backed[j:] |= both
        backed[:-j] |= both
    # from a run's first backed chunk to its last
    at, n = np.flatnonzero(backed), run[-1] + 1 if len(run) else 0
    first, last = np.full(n, len(dup)), np.full(n, -1)
    np.minimum.at(first, run[at], at)
    np.maximum.at(last, run[at], at)
    place = np.arange(len(dup))
    inside = dup & (place >= first[run]) & (place <= last[run])
    size = end - start
    n, b, telling = np.bincount(run, words * inside), np.bincount(run, size * inside), np.bincount(run, np.maximum(words - 2, 0) * inside)
    told = np.bincount(run, size * backed) >= BACKED * b
    enough = told & ((n >= least_words) & ((telling >= LEAST_TELLING) | (n >= SURE_WORDS)) | ((b >= LEAST_BYTES) & (n * 40 < b)))
    return inside & enough[run]


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs).select("doc_id", "text", "n_removed")
