"""What the operators share: tables, the shared folder, lineage cuts and hashing."""

from __future__ import annotations

import ctypes
import functools
import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Texts are handled in slices of about this many bytes, so that memory doesn't follow the Arrow batch.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan for a costly task: dealt over all cores where its files make fewer parts than there are (a small table in one
    row group). Large tables stay as they lie."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def quoted(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def integral(df: DataFrame, name: str) -> Column:
    """An integer key as long. A key of another type is an error: a cast would make nulls of its values."""
    if df.schema[name].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"the key {name} is {df.schema[name].dataType.simpleString()}; integers are needed")
    return quoted(name).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where the session has none and runs on one
    machine (tests) a temporary folder is set."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or getattr(sc, "_ledgerflow_shared", None)
    if not where:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir isn't set: driver and executors share no folder")
        where = sc._ledgerflow_shared = "file://" + tempfile.mkdtemp(prefix="ledgerflow-")
        sc.setCheckpointDir(where)
    return where.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/ledgerflow/{name}-{uuid.uuid4().hex}"


#: Rows of a file of a table that is known to be narrow.
NARROW = 100_000


def stored(df: DataFrame, name: str, rows: int | None = None, codec: str | None = None) -> DataFrame:
    """Cuts the lineage: writes df to the shared folder and reads it back. `rows`, a bound of the rows of a narrow table,
    keeps it to few files (every file is some calls to the file system, whatever it holds). codec: where whole texts are
    stored, gzip makes them smaller than the default does."""
    spark = df.sparkSession
    out = df if rows is None else df.repartition(rows // NARROW + 1)
    writer = out.write.option("compression", codec) if codec else out.write
    writer.parquet(path := fresh_path(spark, name))
    table_ = spark.read.schema(df.schema).parquet(path)
    table_._stored_at = path
    return table_


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing needs any more."""
    for df in tables:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def clean_up(spark: SparkSession) -> None:
    """Deletes all that the operators have left in the shared folder, of all sessions that share it; no result that still
    reads from there can be used afterwards."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/ledgerflow")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def give_back() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task that gives freed memory back when it ends: workers wait for their next task, several to an executor."""

    @functools.wraps(task)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def laid(flat: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Stretches of flat (begin, length) end to end. Positions take 32 bits where that is enough."""
    upto = np.cumsum(n)
    kind = np.int32 if max(len(flat), upto[-1] if len(upto) else 0) < 1 << 31 else np.int64
    at = np.repeat((begin - (upto - n)).astype(kind), n)
    at += np.arange(len(at), dtype=kind)
    return flat[at]


def sliced(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Cuts a batch to slices whose texts have about limit bytes; a longer text is a slice of its own."""
    col = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < len(sizes):
        total = np.cumsum(sizes[at : at + (1 << 16)])
        n = max(1, int(np.searchsorted(total, limit, side="right")))
        yield batch.slice(at, n)
        at += n


def utf8_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1, from 0) and bytes of a string column without copying them; null counts as empty."""
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and len(col) else np.zeros(0, np.uint8)
    return off - off[0], data[off[0] : off[-1]]


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix) over an array."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and the row of each word (a run of anything but space and \\t..\\r), for texts laid end to end."""
    if not len(data):
        return (z := np.zeros(0, np.int64)), z, z
    ink = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[off[:-1]] = True
    begin = ink.copy()
    begin[1:] &= ~ink[:-1] | cut[1:-1]
    end = ink.copy()
    end[:-1] &= ~ink[1:] | cut[1:-1]
    start = np.flatnonzero(begin)
    return start, np.flatnonzero(end) + 1, np.searchsorted(off, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial over them, from differences of one running sum modulo 2^64."""
    if not len(start):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        n = end - start
        h = np.zeros(len(start), np.uint64)
        todo, at = np.arange(len(start)), 0
        while len(todo):  # a step for each byte of the longest word, over the words that are as long
            h[todo] = h[todo] * np.uint64(0x100000001B3) + data[start[todo] + at].astype(np.uint64) + np.uint64(1)
            at += 1
            todo = todo[n[todo] > at]
            if at > 64 and len(todo):  # very long words, one by one
                for i in todo:
                    h[i] ^= np.uint64(int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little"))
                break
    return mix64(h)
