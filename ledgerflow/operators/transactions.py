"""Whole transactions from change events: completion and assembly in batch form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.parsing import expected, normalised, row_of, with_transaction
from ..functions.specs import ENTITIES, Entity

KEY = ("xid", "csn")


def _distinct_events(events: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    order = W.partitionBy(*also, *KEY, "table", "pos").orderBy("op_ts")
    changes = events.filter("event_type <> 'METADATA'").withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
    return changes.unionByName(events.filter("event_type = 'METADATA'"))


def with_progress(events: DataFrame, entities: tuple[Entity, ...] = ENTITIES, dedup: bool = False, count_deletes: bool = True, strict: bool = False, last: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """Every row of a transaction with have_<table>, want_<table>, announced (metadata is there) and complete.

    A transaction is complete when its metadata is there and every table has at least the announced number of events;
    of several metadata rows the latest counts. One window over (xid, csn), whose partitioning the assembly reuses.
    dedup drops redelivered events (same table and pos); count_deletes=False doesn't count deletes; strict: exactly the
    announced number, after dedup; last: a table's name is what follows its last dot. also: columns that are equal in all
    rows of a transaction; rows that are dealt by them stay where they are."""
    events = with_transaction(events)
    if dedup or strict:
        events = _distinct_events(events, also)
    over = W.partitionBy(*also, *KEY)
    change = F.col("event_type") != "METADATA"
    name = normalised(F.col("table"), last)
    told = F.max(F.when(~change, F.struct("op_ts", *(expected(F.col("data_collections"), e.table).alias(e.table) for e in entities)))).over(over)
    counted = change if count_deletes else change & (F.col("op_type") != "D")
    out = events.withColumn("entity", name).withColumn("_told", told)
    out = out.select("*", *(F.count_if(counted & (F.col("entity") == e.table)).over(over).alias(f"have_{e.table}") for e in entities))
    out = out.select("*", *(F.col("_told")[e.table].alias(f"want_{e.table}") for e in entities), F.col("_told").isNotNull().alias("announced"), F.col("_told.op_ts").alias("tx_ts")).drop("_told")
    done = F.col("announced")
    for e in entities:
        done = done & (F.col(f"have_{e.table}") == F.col(f"want_{e.table}") if strict else F.col(f"have_{e.table}") >= F.col(f"want_{e.table}"))
    return out.withColumn("complete", F.coalesce(done, F.lit(False)))


def transactions(events: DataFrame, entities: tuple[Entity, ...] = ENTITIES, dedup: bool = False, count_deletes: bool = True, strict: bool = False, last: bool = False) -> DataFrame:
    """One row per transaction: its counts, whether its metadata is there and whether it is complete. Counted on the map
    side first, so a transaction with a large part of all events is no task of its own."""
    events = with_transaction(events)
    if dedup or strict:
        events = _distinct_events(events)
    change, name = F.col("event_type") != "METADATA", normalised(F.col("table"), last)
    counted = change if count_deletes else change & (F.col("op_type") != "D")
    told = F.max(F.when(~change, F.struct("op_ts", *(expected(F.col("data_collections"), e.table).alias(e.table) for e in entities))))
    out = events.groupBy(*KEY).agg(*(F.count_if(counted & (name == e.table)).alias(f"have_{e.table}") for e in entities), told.alias("_told"))
    done = F.col("_told").isNotNull()
    for e in entities:
        done = done & (F.col(f"have_{e.table}") == F.col("_told")[e.table] if strict else F.col(f"have_{e.table}") >= F.col("_told")[e.table])
    return out.select(*KEY, *(f"have_{e.table}" for e in entities), *(F.col("_told")[e.table].alias(f"want_{e.table}") for e in entities), F.col("_told").isNotNull().alias("announced"), F.col("_told.op_ts").alias("tx_ts"), F.coalesce(done, F.lit(False)).alias("complete"))


def pending(events: DataFrame, entities: tuple[Entity, ...] = ENTITIES, **options) -> DataFrame:
    """Transactions that wait, with a line on their progress."""
    lines = [F.concat(F.lit(f"{e.array}: "), F.col(f"have_{e.table}").cast("string"), F.lit("/"), F.coalesce(F.col(f"want_{e.table}").cast("string"), F.lit("?"))) for e in entities]
    return transactions(events, entities, **options).filter("NOT complete").withColumn("progress", F.concat_ws(", ", *lines))


def denormalised(changes: DataFrame, entities: tuple[Entity, ...] = ENTITIES, processed: Column | None = None, exact: bool = False, spread: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """One row per transaction and order from rows with xid, csn, entity, pos, before, after: an array for each entity,
    empty where the transaction has none, in the order of pos. Events without an after image (deletes) make no row.
    spread: rows are dealt by transaction and order, however they lie (else Spark leaves them dealt by transaction where a
    join has done that). also: as for `with_progress`."""
    root = entities[0].fields[0]
    number = F.element_at("after", root.wire).try_cast(root.exact if exact else root.type)
    rows = changes.filter(F.col("after").isNotNull() & F.col("entity").isin([e.table for e in entities])).withColumn(root.name, number)
    rows = rows.repartition(*KEY, root.name) if spread else rows
    lists = []
    for e in entities:
        own = F.when(F.col("entity") == e.table, F.struct("pos", row_of(e, F.col("before"), F.col("after"), exact).alias("row")))
        lists.append(F.transform(F.array_sort(F.collect_list(own)), lambda x: x["row"]).alias(e.array))
    stamp = processed if processed is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    grouped = rows.withColumn("dwhProcessedTs", stamp).groupBy(*also, *KEY, root.name).agg(F.max("dwhProcessedTs").alias("dwhProcessedTs"), *lists)
    return grouped.select(*also, *KEY, "dwhProcessedTs", root.name, *(e.array for e in entities))


def history(events: DataFrame, entities: tuple[Entity, ...] = ENTITIES, processed: Column | None = None, exact: bool = False, spread: bool = True, also: tuple[str, ...] = (), **options) -> DataFrame:
    """Denormalised rows of all complete transactions.

    Transactions are counted by an aggregate, events join the complete ones (a join whose large keys Spark can split) and
    are dealt by order, so no task holds a whole transaction, of which one may be a large part of all events. Where none
    is, spread=False does it by one shuffle and a window over (xid, csn), with the same result; by none where rows are dealt
    by columns that stay and are equal in all rows of a transaction (also)."""
    if not spread:
        return denormalised(with_progress(events, entities, also=also, **options).filter("complete"), entities, processed, exact, also=also)
    done = transactions(events, entities, **options).filter("complete").select(*KEY, "tx_ts")
    events = with_transaction(events)
    events = _distinct_events(events) if options.get("dedup") or options.get("strict") else events
    changes = events.filter("event_type <> 'METADATA'").withColumn("entity", normalised(F.col("table"), options.get("last", False)))
    return denormalised(changes.join(done, list(KEY)), entities, processed, exact, spread=True)
