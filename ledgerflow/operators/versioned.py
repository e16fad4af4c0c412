"""The current state: orders, their detail and their line items by independent versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ..functions.specs import DETAIL, ITEM, ORDER, current_type
from ..functions.versions import distinct_ties, first_newest, merge_array, merge_struct, newer, newest

STAMPS = ["xid", "csn", "dwhProcessedTs"]
FIELDS = [c for c in ORDER.columns if c != "orderId"]
COLUMNS = [f.name for f in current_type()]


def flattened(rows: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """A history row as one of the current state: its newest order and detail, the newest of its items (an item without a
    version is none). The order is bound once, so that its fields don't repeat the search.
    also: columns that stay."""
    bound = rows.select(*also, *STAMPS, "orderId", first_newest(F.col("orders"), "orderId").alias("_order"), first_newest(F.col("orderDetails"), "orderId").alias("orderDetails"), newest(F.col("lineItems"), ITEM.key).alias("lineItems"))
    return bound.select(*also, *STAMPS, "orderId", *(F.col("_order")[c].alias(c) for c in FIELDS), F.col("_order.before").alias("orderBefore"), "orderDetails", "lineItems")


def combined(rows: DataFrame, dedupe_ties: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """One row per order of a batch of history rows: the order row of the greatest version (then the latest), the detail
    of the greatest version, and the newest of all rows' newest line items. One aggregate and one shuffle, by orderId; rows without an
    orderId have no place in the current state and are left out. also: columns that tell batches apart, each combined by itself."""
    flat = flattened(rows, also).filter(F.col("orderId").isNotNull())
    head = [*STAMPS, *FIELDS, "orderBefore"]
    best = F.max_by(F.struct(*head), F.struct("version", "dwhProcessedTs", "csn", "xid")).alias("_best")
    detail = F.max_by("orderDetails", F.when(F.col("orderDetails").isNotNull(), F.struct("orderDetails.version", "dwhProcessedTs", "csn", "xid"))).alias("orderDetails")
    some = F.when(F.col("lineItems").isNotNull() & (F.size("lineItems") > 0), F.struct("csn", "xid", "lineItems"))
    items = F.flatten(F.transform(F.array_sort(F.collect_list(some)), lambda x: x["lineItems"])).alias("lineItems")
    out = flat.groupBy("orderId", *also).agg(best, detail, items)
    own = newest(F.col("lineItems"), ITEM.key)
    own = distinct_ties(own, ITEM.key) if dedupe_ties else own
    out = out.withColumn("lineItems", own)
    return out.select(*also, *(F.col("_best")[c].alias(c) for c in STAMPS), "orderId", *(F.col("_best")[c].alias(c) for c in FIELDS), F.col("_best.orderBefore").alias("orderBefore"), "orderDetails", F.when(F.size("lineItems") > 0, F.col("lineItems")).alias("lineItems"))


def bootstrapped(batch: DataFrame, guard: bool = True) -> DataFrame:
    """The first batch as the target. guard: orders that have no order row yet wait for one, as in every later batch."""
    return batch.filter(F.col("version").isNotNull()) if guard else batch


def upserted(target: DataFrame, batch: DataFrame, null_version: float | None = None, guard: bool = True) -> DataFrame:
    """The target with a combined batch merged in, by one full outer join on orderId.

    Matched: an order of greater version replaces the order's fields; children merge by their own versions either way,
    and the stamps are always the batch's. Not matched: batch rows with an order version are added, others are not;
    guard=False adds them too: an order whose children come first is parked in the table, without a version, until its own
    row comes, so the state doesn't depend on how transactions are cut to batches. Target rows without a match stay."""
    t = target.select(F.struct(*COLUMNS).alias("t"), F.col("orderId").alias("t_id"))
    s = batch.select(F.struct(*COLUMNS).alias("s"), F.col("orderId").alias("s_id"))
    both = t.join(s, F.col("t_id") == F.col("s_id"), "full_outer")
    both = both.filter(F.col("t").isNotNull() | F.col("s.version").isNotNull()) if guard else both
    out = _merged(F.col("t"), F.col("s"), null_version)
    return both.select(*(out[c].alias(c) for c in COLUMNS))


def _merged(t: Column, s: Column, null_version: float | None = None) -> dict[str, Column]:
    """The columns of a target row and a batch's row merged; either may be null."""
    take = t.isNull() | newer(s["version"], t["version"])
    there, came = t.isNotNull(), s.isNotNull()
    out = {c: F.when(came, s[c]).otherwise(t[c]) for c in STAMPS}
    out["orderId"] = F.coalesce(t["orderId"], s["orderId"])
    out |= {c: F.when(came & take, s[c]).otherwise(t[c]) for c in [*FIELDS, "orderBefore"]}
    out["orderDetails"] = F.when(~came, t["orderDetails"]).when(~there, s["orderDetails"]).otherwise(merge_struct(s["orderDetails"], t["orderDetails"]))
    out["lineItems"] = F.when(~came, t["lineItems"]).when(~there, s["lineItems"]).otherwise(merge_array(s["lineItems"], t["lineItems"], ITEM.key, null_version))
    return out


def states(rows: DataFrame, batch: str, guard: bool = True, dealt: tuple[str, ...] = ()) -> DataFrame:
    """Every state that an order takes when batches of history rows (column batch: a number) are merged one after the other,
    as by `combined` and `upserted`: since and until, the numbers of the batches that made it and replaced it (null: none
    did), and the columns of the current state. One shuffle by orderId for all batches; an order's own rows are folded.
    dealt: columns that are equal in all rows of an order, by which the rows are dealt already: no shuffle."""
    each = combined(rows if dealt else rows.repartition("orderId"), also=(*dealt, batch))
    own = each.groupBy(*dealt, "orderId").agg(F.array_sort(F.collect_list(F.struct(F.col(batch).cast("long").alias("since"), F.struct(*COLUMNS).alias("s")))).alias("own"))
    kind = StructType([StructField("since", LongType()), StructField("t", current_type())])

    def step(done: Column, came: Column) -> Column:
        t, s = F.get(done, F.size(done) - 1)["t"], came["s"]
        whole = F.struct(*(c.alias(n) for n, c in ((n, out[n]) for out in [_merged(t, s)] for n in COLUMNS)))
        state = F.when(t.isNotNull() | s["version"].isNotNull(), whole) if guard else whole
        return F.concat(done, F.array(F.struct(came["since"].alias("since"), state.alias("t"))))

    folded_ = own.select(F.aggregate("own", F.array().cast(ArrayType(kind)), step).alias("x"))
    ends = F.transform("x", lambda e, i: F.struct(e["since"].alias("since"), F.get("x", i + 1)["since"].alias("until"), e["t"].alias("t")))
    return folded_.select(F.explode(ends).alias("e")).filter("e.t IS NOT NULL").select("e.since", "e.until", "e.t.*")


def folded(batches: list[DataFrame], guard: bool = True) -> DataFrame:
    """The current state after batches of history rows in turn."""
    state = bootstrapped(combined(batches[0]), guard)
    for b in batches[1:]:
        state = upserted(state, combined(b), guard=guard)
    return state


__all__ = ["COLUMNS", "DETAIL", "bootstrapped", "combined", "flattened", "folded", "states", "upserted"]
