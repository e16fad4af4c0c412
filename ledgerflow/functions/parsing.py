"""Change events and transaction metadata from text to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .specs import COLLECTIONS, ENTITIES, ENVELOPE, METADATA, Entity

EVENT_COLUMNS = ["xid", "csn", "table", "op_type", "op_ts", "current_ts", "pos", "before", "after", "event_type"]


def normalised(table: Column, last: bool = False) -> Column:
    """The table's name without its first qualifier: A.B becomes B, A.B.C becomes B.C; last: without any, C."""
    return F.regexp_replace(table, r"^.*\." if last else r"^[^.]*\.", "")


def is_insert(op: Column) -> Column:
    return op == "I"


def is_update(op: Column) -> Column:
    return op == "U"


def is_delete(op: Column) -> Column:
    return op == "D"


def _parsed(value: Column, kind: StructType) -> Column:
    """The fields of a JSON text, as columns. A generator, which filters on them aren't moved below: each would parse the
    text (and make it, where it is made) once more."""
    return F.inline(F.array(F.from_json(value.cast("string"), kind)))


def parse_events(raw: DataFrame, event_type: str | Column, value: str = "value", also: tuple[str, ...] = ()) -> DataFrame:
    """Change events of one feed, or of several whose name is in a column; text that isn't one gives nulls, which
    `with_transaction` drops. also: columns that stay."""
    name = event_type if isinstance(event_type, Column) else F.lit(event_type)
    data = raw.select(*also, name.alias("event_type"), _parsed(F.col(value), ENVELOPE))
    return data.select(*also, *ENVELOPE.names, "event_type")


def parse_metadata(raw: DataFrame, value: str = "value", also: tuple[str, ...] = ()) -> DataFrame:
    data = raw.select(*also, _parsed(F.col(value), METADATA))
    return data.select(*also, "xid", "csn", F.col("tx_ts").alias("op_ts"), F.lit("METADATA").alias("event_type"), F.col("event_count").alias("expected_count"), "data_collections")


def unified(events: list[DataFrame], metadata: DataFrame | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """All feeds in one, with nulls where a feed has no such column. also: columns that stay."""
    out = events[0]
    for e in events[1:]:
        out = out.unionByName(e)
    if metadata is not None:
        out = out.unionByName(metadata, allowMissingColumns=True)
    else:
        out = out.withColumn("expected_count", F.lit(None).cast("int")).withColumn("data_collections", F.lit(None).cast(COLLECTIONS))
    return out.select(*also, *EVENT_COLUMNS, "expected_count", "data_collections")


def with_transaction(events: DataFrame) -> DataFrame:
    """Only rows that name their transaction."""
    return events.filter(F.col("xid").isNotNull() & F.col("csn").isNotNull())


def expected(collections: Column, name: str) -> Column:
    """The announced number of events of a table: the sum over its entries, 0 without any."""
    own = F.filter(F.coalesce(collections, F.array().cast(COLLECTIONS)), lambda c: c["data_collection"] == name)
    return F.aggregate(own, F.lit(0), lambda n, c: n + F.coalesce(c["event_count"], F.lit(0)))


def typed(image: Column, entity: Entity, exact: bool = False) -> Column:
    """A row image as the entity's struct: absent keys and text that is no number give nulls, unknown keys are ignored."""
    fields = []
    for f in entity.fields:
        kind = f.exact if exact and f.exact else f.type
        value = F.element_at(image, f.wire)
        fields.append((value if kind.simpleString() == "string" else value.try_cast(kind)).alias(f.name))
    return F.struct(*fields)


def bad_numbers(image: Column, entity: Entity) -> Column:
    """How many numeric fields of an image hold text that is no number."""
    flags = [(F.element_at(image, f.wire).isNotNull() & (F.trim(F.element_at(image, f.wire)) != "") & F.element_at(image, f.wire).try_cast(f.type).isNull()).cast("int") for f in entity.fields if f.type.simpleString() != "string"]
    return F.coalesce(sum(flags[1:], flags[0]), F.lit(0))


def row_of(entity: Entity, before: Column, after: Column, exact: bool = False) -> Column:
    """The entity's fields of the after image, and the before image where there is one."""
    now = typed(after, entity, exact)
    return F.struct(*(now[c].alias(c) for c in entity.columns), F.when(before.isNotNull(), typed(before, entity, exact)).alias("before"))


def entity_of(table: str, entities: tuple[Entity, ...] = ENTITIES) -> Entity:
    return next(e for e in entities if e.table == table)
