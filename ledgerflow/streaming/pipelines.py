"""The two streaming jobs: events to history, history to current state."""

from __future__ import annotations

import json
import logging
import sys

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import load
from ..functions.parsing import parse_events, parse_metadata, unified
from ..functions.specs import current_type, history_type
from ..operators.versioned import bootstrapped, combined, upserted
from ..session import get_session
from ..sources.feeds import feeds
from ..sources.store import Files, Table
from .buffer import LETTERS, assembled, buffered, unreadable

log = logging.getLogger(__name__)
METADATA = "METADATA"
#: Parts of the current state, by a hash of the order.
BUCKETS = 16


def _run(writer, checkpoint: str, once: bool, interval: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def _writer(spark: SparkSession, checkpoint: str) -> str:
    """The id of a checkpoint's query, under which a table remembers its batches."""
    files = Files(spark, checkpoint)
    where = f"{checkpoint.rstrip('/')}/metadata"
    return json.loads(files.read(where))["id"] if files.exists(where) else checkpoint


def history_pipeline(spark: SparkSession, sources: dict[str, DataFrame], table: Table, checkpoint: str, once: bool = False, interval: str | None = None, processed: Column | None = None, dedup: bool = False, expire_ms: int | None = None, count_deletes: bool = True, letters: Table | None = None) -> StreamingQuery:
    """Streams of text (one per feed, METADATA among them) to the history table. A micro-batch is one commit, which a
    repeated batch doesn't make twice.

    letters: a table for what doesn't get into the history: transactions that expired (with their events), and lines that
    no transaction can be told from (kind, xid, csn, events)."""
    events = unified([parse_events(df, name) for name, df in sources.items() if name != METADATA], parse_metadata(sources[METADATA]))
    table.create(history_type())
    out = buffered(events, dedup=dedup, expire_ms=expire_ms, count_deletes=count_deletes)
    if letters is not None:
        letters.create(LETTERS)
        out = out.unionByName(unreadable(sources))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            writer = _writer(spark, checkpoint)
            version = table.append(assembled(batch, processed=processed), batch_id, writer)
            log.info("history: batch %s is version %s", batch_id, version)
            if letters is not None:
                lost = batch.filter("status <> 'COMPLETE'").select(F.col("status").alias("kind"), "xid", "csn", "events")
                if not lost.isEmpty():
                    letters.append(lost, batch_id, writer)
        finally:
            batch.unpersist()

    return _run(out.writeStream.outputMode("append").foreachBatch(write), checkpoint, once, interval)


def merge_batch(table: Table, batch: DataFrame, batch_id: int | None = None, guard: bool = True, buckets: int | None = BUCKETS, writer: str = "") -> int | None:
    """Merges a batch of history rows into the current state; an empty one changes nothing. Only the parts of the table
    (buckets by a hash of the order) that the batch's orders lie in are read and rewritten; with buckets=None the whole
    table is."""
    if batch.isEmpty():
        return None
    there = bool(table.exists() and table.folders())
    merged = lambda target, rows: upserted(target, rows, guard=guard) if there else bootstrapped(rows, guard)
    rows = combined(batch)
    if buckets:
        rows = rows.persist()  # for the buckets that it touches, and for the merge
        version = table.merge_by(rows, "orderId", merged, buckets, batch_id, writer)
        rows.unpersist()
    else:
        version = table.merge(merged(table.read() if there else None, rows), batch_id, writer)
    log.info("current: batch %s is version %s", batch_id, version)
    return version


def current_pipeline(spark: SparkSession, history: Table, table: Table, checkpoint: str, once: bool = False, interval: str | None = None, guard: bool = True, commits_per_batch: int | None = None, buckets: int | None = BUCKETS) -> StreamingQuery:
    """New rows of the history to the current state, by version. guard=False parks orders whose children come first."""
    table.create(current_type())

    def merge(commits: DataFrame, batch_id: int) -> None:
        batch = history.rows_of(commits).persist()  # isEmpty and the merge read it
        try:
            merge_batch(table, batch, batch_id, guard, buckets, _writer(spark, checkpoint))
        finally:
            batch.unpersist()

    return _run(history.stream(commits_per_batch).writeStream.outputMode("update").foreachBatch(merge), checkpoint, once, interval)


def main(arguments: list[str]) -> None:
    """history|current [job.json] [key=value ...]"""
    job = next((a for a in arguments[1:] if a.endswith(".json")), None)
    config = load(job, arguments=[a for a in arguments[1:] if "=" in a])
    spark = get_session(config)
    history = Table(spark, config["history_path"])
    if arguments[0] == "history":
        query = history_pipeline(spark, feeds(spark, config), history, config["checkpoint"], letters=Table(spark, config["letters_path"]) if config["letters_path"] else None)
    else:
        query = current_pipeline(spark, history, Table(spark, config["current_path"]), config["checkpoint"], buckets=int(config["buckets"]) if config["buckets"] else BUCKETS)
    query.awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
