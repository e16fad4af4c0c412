"""Token-id files: flat unsigned integers and 64-bit document offsets, read memory-mapped.

A data set is a folder of shards. A shard has `<name>.ids` (token ids end to end, little-endian uint16, or uint32 where
the vocabulary needs it), `<name>.off` (uint64, n_docs + 1: where each document begins within the shard, and the end)
and `<name>.doc` (int64 document ids; the first n_null of them stand for null). `write` returns the manifest: one line
per shard in document order, with its base, the prefix sum of the tokens of all shards before it."""

from __future__ import annotations

import itertools
import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc, fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import fresh_path, integral, laid, sliced, table, tidy

#: Words whose ids a worker remembers at most.
CACHE_WORDS = 400_000
#: Latin letters whose normal form is themselves and whose lower case is one letter.
LATIN = frozenset(c for c in map(chr, range(0x250)) if c.isalpha() and c != "\u0130")
#: The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = dict.fromkeys(range(256)) | {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(sorted({*range(256)} - {*_PRINTABLE}))}
_ENCODERS: dict[str, WordEncoder | TextEncoder] = {}
# What a tokenizer's file says of one that lower-cases and never looks across white space.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLITTER = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def by_words(path: str) -> bool:
    """Whether a tokenizer encodes a text as its words between white space, one by one."""
    with open(path) as f:
        spec = json.load(f)
    steps = (spec["normalizer"] or {}).get("normalizers") == _NORMALIZERS and (spec["pre_tokenizer"] or {}).get("pretokenizers") == [_SPLITTER, _BYTE_LEVEL]
    model = spec["model"]
    plain = spec["post_processor"] is None and model["type"] == "BPE" and not model.get("dropout") and not model.get("byte_fallback")
    return steps and plain and not any(t["lstrip"] or t["rstrip"] or t["normalized"] or len(t["content"].split()) != 1 for t in spec["added_tokens"])


class TextEncoder:
    """Ids of whole texts by the tokenizers library, text by text: for any tokenizer."""

    def __init__(self, path: str):
        self.tokenizer = _library(path)

    def __call__(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (n + 1) and ids of the texts, each with end_id after it."""
        more = [] if end_id is None else [end_id]
        ids = [e.ids + more for e in self.tokenizer.encode_batch_fast(pc.fill_null(texts, "").to_pylist(), add_special_tokens=False)]
        return np.concatenate([[0], np.cumsum(list(map(len, ids)), dtype=np.int64)]).astype(np.int64), np.fromiter(itertools.chain.from_iterable(ids), np.uint32)


def _library(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encoder_of(path: str) -> WordEncoder | TextEncoder:
    """This worker's encoder; its words stay known from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = (WordEncoder if by_words(path) else TextEncoder)(path)
    return _ENCODERS[path]


class WordEncoder:
    """Ids of whole texts by the tokenizers library, which sees each distinct word of a slice once.

    For tokenizers that lower case, drop white space and never look across it (`by_words`: every normaliser and
    splitter step is bounded by ASCII white space), encoding a text is encoding its words. Words of Latin letters are one
    unit after lower-casing, which their composed form doesn't change, so they go straight to the library's model, and so
    does what stands before a last comma or full stop, which is a unit of its own; all others go through the library's
    whole chain."""

    def __init__(self, path: str):
        self.tokenizer = _library(path)
        self.model = self.tokenizer.model
        self.last = {c: self.tokenizer.encode(c, add_special_tokens=False).ids for c in ",."}
        self._forget()

    def _forget(self) -> None:
        self.known, self.flat, self.off = {}, np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, names: list[str]) -> None:
        ids, rest, tokenize = [None] * len(names), [], self.model.tokenize
        for i, w in enumerate(names):
            core, last = (w[:-1], self.last[w[-1]]) if w[-1:] in self.last else (w, [])
            if core.isalpha() and (core.isascii() or LATIN.issuperset(core)):
                core = core.lower()
                ids[i] = [t.id for t in tokenize(core if core.isascii() else core.encode().decode("latin-1").translate(BYTES))] + last
            else:
                rest.append(i)
        for at in range(0, len(rest), 8192):
            part = rest[at : at + 8192]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([names[i] for i in part], add_special_tokens=False), strict=True):
                ids[i] = e.ids
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        self.known.update(zip(names, range(len(self.off) - 1, len(self.off) - 1 + len(names)), strict=True))
        self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(n.sum()))])
        self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(n)])

    def __call__(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (n + 1) and ids of the texts, each with end_id after it."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        word = lists.flatten().dictionary_encode()
        code = word.indices.to_numpy(zero_copy_only=False)
        names = word.dictionary.to_pylist()
        if len(self.known) > CACHE_WORDS:
            self._forget()
        at = list(map(self.known.get, names))
        if None in at:
            self._learn([w for w, i in zip(names, at, strict=True) if i is None])
            at = list(map(self.known.__getitem__, names))
        begin, size = self.off[at], self.off[1:][at] - self.off[at]
        flat, counts = self.flat, np.diff(lists.offsets.to_numpy())
        if len(self.known) > CACHE_WORDS:  # the next slice knows only what this one has more than twice
            often = np.flatnonzero(np.bincount(code, minlength=len(names)) > 2)
            kept = [names[i] for i in often]
            n = size[often]
            self._forget()
            self.known = dict(zip(kept, range(len(kept)), strict=True))
            self.flat, self.off = laid(flat, begin[often], n), np.concatenate([[0], np.cumsum(n)])
        if end_id is not None:  # one more word, after every text
            code = np.insert(code, np.cumsum(counts), len(names))
            counts, begin, size = counts + 1, np.append(begin, len(flat)), np.append(size, 1)
            flat = np.append(flat, np.uint32(end_id))
        n = size[code]
        off = np.zeros(len(counts) + 1, np.int64)
        off[1:] = np.concatenate([[0], np.cumsum(n)])[np.cumsum(counts)]
        return off, laid(flat, begin[code], n)


def opened(where: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(where)


def write(docs: DataFrame, tokenizer: str, where: str, vocabulary: int | None = None, end_id: int | None = 2, key: str = "doc_id", text: str = "text") -> list[dict]:
    """Encodes every text and writes the shards to the folder `where`, in ascending order of key (nulls first; documents
    with one key by a hash of their texts). Returns the manifest. Ids have 16 bits if all of the tokenizer's, end_id and
    `vocabulary` (a larger one to come) fit, else 32.

    A null or empty text has no ids but the end id; repeated rows are documents of their own; an empty table gives an
    empty manifest. Each task writes files of its own names, and only those of tasks that succeeded are in the manifest,
    so lost executors and repeated tasks leave no wrong shard. The driver gets one line per shard."""
    most = max([*_library(tokenizer).get_vocab(with_added_tokens=True).values(), end_id or 0, (vocabulary or 0) - 1])
    kind = np.uint16 if most < 1 << 16 else np.uint32
    rows = docs.select(integral(docs, key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        name = f"{place:06d}-{uuid.uuid4().hex}"
        there, folder = opened(where)
        there.create_dir(folder, recursive=True)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encode, n, tokens, nulls = encoder_of(tokenizer), 0, 0, 0
        with there.open_output_stream(f"{folder}/{name}.ids") as ids, there.open_output_stream(f"{folder}/{name}.off") as off, there.open_output_stream(f"{folder}/{name}.doc") as doc:
            for batch in batches:
                for part in sliced(batch, "text", 10 << 20):
                    at, found = encode(part.column("text"), end_id)
                    ids.write(found.astype(kind).tobytes())
                    off.write((at[:-1] + tokens).astype("<u8").tobytes())
                    doc.write(pc.fill_null(part.column("key"), 0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                    n, tokens, nulls = n + len(part), tokens + int(at[-1]), nulls + part.column("key").null_count
            off.write(np.array([tokens], "<u8").tobytes())
        if n:
            yield pa.RecordBatch.from_pylist([{"place": place, "name": name, "n_docs": n, "n_tokens": tokens, "n_null": nulls}])

    found = rows.mapInArrow(tidy(task), "place long, name string, n_docs long, n_tokens long, n_null long").collect()
    base, out = 0, []
    for r in sorted(found, key=lambda r: r["place"]):
        out.append({"name": r["name"], "n_docs": r["n_docs"], "n_null": r["n_null"], "n_tokens": r["n_tokens"], "base": base, "width": kind().itemsize})
        base += r["n_tokens"]
    return out


def mapped(where: str, name: str, kind: str, dtype: str, at: int = 0, n: int | None = None) -> np.ndarray:
    """A file of the shard as an array: memory-mapped where the folder is local, else read."""
    there, folder = opened(where)
    path = f"{folder}/{name}.{kind}"
    if not there.get_file_info(path).size:
        return np.zeros(0, dtype)
    if isinstance(there, fs.LocalFileSystem):
        whole = np.memmap(path, dtype, "r")
        return whole[at : None if n is None else at + n]
    size = np.dtype(dtype).itemsize
    with there.open_input_file(path) as f:
        return np.frombuffer(f.read_at((f.size() - at * size) if n is None else n * size, at * size), dtype)


def documents(where: str, shard: dict, most: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A shard's documents in parts: document ids, offsets (n + 1, within the part) and ids; about `most` ids in a part."""
    off, doc = mapped(where, shard["name"], "off", "<u8").astype(np.int64), mapped(where, shard["name"], "doc", "<i8")
    at = 0
    while at < len(doc):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
        yield np.asarray(doc[at:to]), off[at : to + 1] - off[at], mapped(where, shard["name"], "ids", f"<u{shard['width']}", int(off[at]), int(off[to] - off[at]))
        at = to


def read(spark: SparkSession, where: str, manifest: list[dict]) -> DataFrame:
    """One row per document from the files: key, start, n_tokens, ids_crc32 (of the ids as 32-bit integers)."""
    out = "key long, start long, n_tokens long, ids_crc32 long"
    shards = spark.createDataFrame([(i, s["name"], s["n_null"], s["base"], s["width"]) for i, s in enumerate(manifest)], "place long, name string, n_null long, base long, width long")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                done = start = 0
                for doc, off, ids in documents(where, shard):
                    wide = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                    sums = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                    null = np.arange(done, done + len(doc)) < shard["n_null"]
                    yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64(), mask=null), pa.array(off[:-1] + start + shard["base"]), pa.array(np.diff(off)), pa.array(sums, pa.int64())], ["key", "start", "n_tokens", "ids_crc32"])
                    done, start = done + len(doc), start + int(off[-1])

    return shards.repartition(max(1, len(manifest)), "place").mapInArrow(tidy(task), out)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    where = fresh_path(spark, "token-files")
    manifest = write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), where)
    return read(spark, where, manifest).withColumnRenamed("key", "doc_id")
