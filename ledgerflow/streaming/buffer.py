"""A stateful operator that holds the events of a transaction until all that its metadata announces are there."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..functions.parsing import expected, normalised, with_transaction
from ..functions.specs import ENTITIES, Entity
from ..operators.transactions import denormalised

S = StringType()
# State schemas are plain objects: parsing DDL needs the driver's session, which workers don't have.
_EVENT = StructType([StructField("entity", S), StructField("event", S)])
_HAVE = StructType([StructField("counts", ArrayType(IntegerType()))])
_WANT = StructType([StructField("tx_ts", S), StructField("counts", ArrayType(IntegerType()))])
_OUT = StructType([StructField("xid", S), StructField("csn", S), StructField("tx_ts", S), StructField("status", S), StructField("events", ArrayType(S))])


class TransactionBuffer(StatefulProcessor):
    """Buffers a transaction's events and emits them once, when every table has at least the announced number.

    Events are one JSON text each, so state is appended to and never decoded here; decoding and assembly are column
    expressions after the operator. What a transaction has is counted in a state of its own, so the events it holds are
    read only when it ends (or, with dedup, which counts redelivered events once, whenever more come). A transaction that
    is complete within one micro-batch never touches the state store. expire_ms: after that long without completion a
    transaction is emitted with status EXPIRED and forgotten (needs processing-time mode); None keeps it for ever."""

    def __init__(self, tables: list[str], dedup: bool = False, expire_ms: int | None = None):
        self.tables, self.dedup, self.expire_ms = tables, dedup, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", _EVENT)
        self.have = handle.getValueState("have", _HAVE)
        self.want = handle.getValueState("want", _WANT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  the interface's names
        came, want = [], None
        for part in rows:
            for entity, event, tx_ts, counts in zip(part["entity"], part["event"], part["tx_ts"], part["counts"], strict=True):
                if counts is not None:
                    if want is None or (tx_ts or "") >= (want[0] or ""):
                        want = (tx_ts, [int(c) for c in counts])
                else:
                    came.append((entity, event))
        known = self.want.get() if self.want.exists() else None
        counted = self.have.get() if self.have.exists() else None
        stored = counted is not None
        if known is not None and (want is None or (known[0] or "") > (want[0] or "")):
            want = (known[0], list(known[1]))
        if self.dedup:
            held = set(self._held()) if stored else set()
            came = [e for e in dict.fromkeys(came) if e not in held]
        have = dict(zip(self.tables, counted[0] if stored else [0] * len(self.tables), strict=True))
        for entity, _ in came:
            if entity in have:
                have[entity] += 1
        if want is not None and all(have[t] >= n for t, n in zip(self.tables, want[1], strict=True)):
            every = [*self._held(), *came] if stored else came
            if stored:
                self._forget()
            yield self._row(key, want[0], "COMPLETE", every)
            return
        if came:
            self.events.appendList(came)
        self.have.update((list(have.values()),))
        if want is not None:
            self.want.update(want)
        if self.expire_ms and not stored:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.expire_ms)

    def _held(self) -> list[tuple]:
        return [tuple(e) for e in self.events.get()] if self.events.exists() else []

    def _forget(self) -> None:
        self.events.clear()
        self.have.clear()
        self.want.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if not self.have.exists():
            return  # it was complete before
        want = self.want.get() if self.want.exists() else None
        held = self._held()
        self._forget()
        yield self._row(key, want[0] if want else None, "EXPIRED", held)

    @staticmethod
    def _row(key, tx_ts, status: str, events: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({"xid": [key[0]], "csn": [key[1]], "tx_ts": [tx_ts], "status": [status], "events": [[e for _, e in events]]})

    def close(self) -> None:
        pass


def buffered(events: DataFrame, entities: tuple[Entity, ...] = ENTITIES, dedup: bool = False, expire_ms: int | None = None, count_deletes: bool = True) -> DataFrame:
    """Emitted transactions of a stream of unified events: xid, csn, tx_ts, status, events (array of JSON texts).
    count_deletes=False: deletes don't count towards the announced numbers."""
    e = with_transaction(events)
    own = F.to_json(F.struct(normalised(F.col("table")).alias("entity"), "op_type", "pos", "before", "after"))
    counts = F.when(F.col("event_type") == "METADATA", F.array(*(expected(F.col("data_collections"), x.table) for x in entities)))
    entity = normalised(F.col("table")) if count_deletes else F.when(F.coalesce(F.col("op_type") != "D", F.lit(True)), normalised(F.col("table")))
    rows = e.select("xid", "csn", entity.alias("entity"), F.when(F.col("event_type") != "METADATA", own).alias("event"), F.when(F.col("event_type") == "METADATA", F.col("op_ts")).alias("tx_ts"), counts.alias("counts"))
    return rows.groupBy("xid", "csn").transformWithStateInPandas(statefulProcessor=TransactionBuffer([x.table for x in entities], dedup, expire_ms), outputStructType=_OUT, outputMode="Append", timeMode="ProcessingTime" if expire_ms else "None")


_PAYLOAD = "entity string, op_type string, pos string, before map<string,string>, after map<string,string>"
#: What doesn't get into the history: EXPIRED transactions with their events, and UNREADABLE lines.
LETTERS = StructType([StructField("kind", S), StructField("xid", S), StructField("csn", S), StructField("events", ArrayType(S))])


def unreadable(sources: dict[str, DataFrame], value: str = "value") -> DataFrame:
    """Lines of the feeds that name no transaction, in the form of `buffered`: status UNREADABLE, the line as the event."""
    out = None
    for df in sources.values():
        line = F.col(value).cast("string")
        named = F.from_json(line, "xid string, csn string")
        lost = df.filter(F.coalesce(named["xid"].isNull() | named["csn"].isNull(), F.lit(True)))
        none = F.lit(None).cast("string")
        lost = lost.select(none.alias("xid"), none.alias("csn"), none.alias("tx_ts"), F.lit("UNREADABLE").alias("status"), F.array(line).alias("events"))
        out = lost if out is None else out.unionByName(lost)
    return out


def assembled(transactions: DataFrame, entities: tuple[Entity, ...] = ENTITIES, processed=None, exact: bool = False) -> DataFrame:
    """One row per transaction and order of a batch of emitted transactions, by operators.transactions.denormalised: events
    are dealt by order, so a bulk transaction is taken apart once and no task assembles all of it."""
    events = transactions.filter("status = 'COMPLETE'").select("xid", "csn", "tx_ts", F.explode("events").alias("event"))
    e = F.from_json("event", _PAYLOAD)
    return denormalised(events.select("xid", "csn", "tx_ts", e.alias("e")).select("xid", "csn", "tx_ts", "e.*"), entities, processed, exact)
