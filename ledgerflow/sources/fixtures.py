"""A bulk load as a change feed: n orders with a detail and 2 to 5 items each, all in one transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .derived import CARRIERS, CURRENCIES, METHODS, SCHEMA, _pick

# What a status or a type can be.
STATUSES, TYPES, DELIVERIES = ("PENDING", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED"), ("STANDARD", "EXPRESS", "SUBSCRIPTION"), ("PENDING", "IN_TRANSIT", "DELIVERED", "RETURNED")
XID, CSN, TS = "9.1.1.1", "000000000001", "2025-07-07 23:33:54.000000"


def _event(table: str, kind: int, image: Column) -> Column:
    null = F.lit(None).cast("string")
    head = [F.lit(f"{SCHEMA}.{table}").alias("table"), F.lit("I").alias("op_type"), F.lit(TS).alias("op_ts"), F.lit(TS).alias("current_ts"), F.concat(F.lit(kind), F.lpad(F.col("i").cast("string"), 9, "0"), F.lpad(F.coalesce(F.col("k"), F.lit(0)).cast("string"), 2, "0")).alias("pos"), F.lit(CSN).alias("csn"), F.lit(XID).alias("xid")]
    return F.to_json(F.struct(*head, null.alias("before"), image.alias("after")))


def bulk(spark: SparkSession, n: int = 100) -> dict[str, DataFrame]:
    """The four feeds as JSON text. Order i has 2 + i % 4 items; the quantity 1000 + 10 i is split over them exactly, the
    price of one is 25 + i / 2, and the order's total is quantity times price."""
    i = F.col("i")
    orders = spark.range(1, n + 1).select(F.col("id").alias("i"), (F.col("id") % 4 + 2).cast("int").alias("items"), F.lit(None).cast("int").alias("k"))
    quantity, price = F.lit(1000) + i * 10, F.lit(25) + i / 2
    order = F.struct(i.alias("ORDER_ID"), F.concat(F.lit("BULK-"), F.lpad(i.cast("string"), 6, "0")).alias("ORDER_REF"), F.lit(1).alias("VERSION"), F.lit(TS[:10]).alias("ORDER_DATE"), F.lit(TS).alias("ORDER_TS"), _pick(STATUSES, i).alias("ORDER_STATUS"), _pick(TYPES, i).alias("ORDER_TYPE"), (quantity * price).alias("TOTAL_AMOUNT"), _pick(CURRENCIES, i).alias("CURRENCY"), F.concat(F.lit("C"), i % 17).alias("CUSTOMER_ID"), F.concat(F.lit("A"), i % 19).alias("SHIPPING_ADDRESS_ID"), F.lit(TS).alias("CREATED_TS"))
    detail = F.struct(i.alias("ORDER_ID"), F.lit(1).alias("VERSION"), _pick(METHODS, i).alias("SHIPPING_METHOD"), F.concat(F.lit("TRK"), F.lpad(i.cast("string"), 8, "0")).alias("TRACKING_NUMBER"), F.lit(TS).alias("SHIPPED_TS"), F.lit(TS[:10]).alias("ESTIMATED_DELIVERY_DATE"), _pick(CARRIERS, i).alias("CARRIER"), _pick(DELIVERIES, i).alias("DELIVERY_STATUS"))
    items = orders.select("i", "items", F.explode(F.sequence(F.lit(1), F.col("items"))).alias("k"))
    share = F.floor(quantity / F.col("items"))
    own = F.when(F.col("k") < F.col("items"), share).otherwise(quantity - share * (F.col("items") - 1))
    item = F.struct((i * 10 + F.col("k")).alias("LINE_ITEM_ID"), i.alias("ORDER_ID"), F.lit(1).alias("VERSION"), F.concat(F.lit("P"), F.col("k")).alias("PRODUCT_ID"), own.alias("ITEM_QTY"), price.alias("ITEM_PRICE"), (own * price).alias("ITEM_AMOUNT"), _pick(CURRENCIES, i).alias("ITEM_CURRENCY"))
    counts = {"ORDERS": n, "ORDER_DETAILS": n, "ORDER_LINE_ITEMS": sum(2 + j % 4 for j in range(1, n + 1))}
    told = F.struct(F.lit(XID).alias("xid"), F.lit(CSN).alias("csn"), F.lit(TS).alias("tx_ts"), F.lit(sum(counts.values())).alias("event_count"), F.array(*(F.struct(F.lit(t).alias("data_collection"), F.lit(c).alias("event_count")) for t, c in counts.items())).alias("data_collections"))
    return {"ORDERS": orders.select(_event("ORDERS", 1, order).alias("value")), "ORDER_DETAILS": orders.select(_event("ORDER_DETAILS", 2, detail).alias("value")), "ORDER_LINE_ITEMS": items.select(_event("ORDER_LINE_ITEMS", 3, item).alias("value")), "METADATA": spark.range(1).select(F.to_json(told).alias("value"))}
