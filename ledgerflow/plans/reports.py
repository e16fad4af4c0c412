"""Named queries over the history (order_stream) and the current state (orders_current)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

money = lambda c: F.sum(F.col(c).cast("decimal(20,4)")).cast("double")  # noqa: E731  exact, so that no order of summing shows
count = lambda: F.count(F.lit(1))


def mean(c: str) -> Column:
    return money(c) / F.count(c)


def head(h: DataFrame) -> DataFrame:
    """History rows with their first order's fields; null where a transaction has no order row."""
    return h.withColumn("o", F.get("orders", 0))


def named(prefix: str, **fields: str) -> list[Column]:
    """Fields of a struct under names of their own."""
    return [F.col(f"{prefix}.{f}").alias(n) for n, f in fields.items()]


# -- views


def order_stream_current(h: DataFrame) -> DataFrame:
    return head(h).select("orderId", "xid", "csn", "dwhProcessedTs", "o.orderRef", "o.orderStatus", "o.totalAmount", "o.currency", "o.orderDate", F.col("o.version").alias("orderVersion"), F.size("orderDetails").alias("detail_count"), F.size("lineItems").alias("line_item_count"))


def order_stream_changes(h: DataFrame) -> DataFrame:
    o = h.select("orderId", "xid", "csn", "dwhProcessedTs", F.explode("orders").alias("o")).filter("o.before IS NOT NULL")
    kind = F.when(F.col("o.before").isNotNull(), "UPDATED").otherwise("INSERTED")
    old = named("o.before", previous_total_amount="totalAmount", previous_status="orderStatus", previous_version="version")
    return o.select("orderId", "xid", "csn", "dwhProcessedTs", "o.orderRef", "o.orderStatus", "o.totalAmount", F.col("o.version").alias("orderVersion"), *old, kind.alias("change_type"))


def orders_current_view(c: DataFrame) -> DataFrame:
    return c.select("orderId", "orderRef", "orderStatus", "totalAmount", "currency", "orderDate", F.col("version").alias("orderVersion"), "dwhProcessedTs", "orderDetails.shippingMethod", "orderDetails.carrier", "orderDetails.deliveryStatus", F.size("lineItems").alias("line_item_count"))


def register_views(history: DataFrame, current: DataFrame | None = None) -> None:
    history.createOrReplaceTempView("order_stream")
    order_stream_current(history).createOrReplaceTempView("order_stream_current")
    order_stream_changes(history).createOrReplaceTempView("order_stream_changes")
    if current is not None:
        current.createOrReplaceTempView("orders_current")
        orders_current_view(current).createOrReplaceTempView("orders_current_view")


# -- over the history. Limits stay where an order gives them a meaning; ties are broken by the key


def _orders(h: DataFrame) -> DataFrame:
    return h.select("xid", "csn", "dwhProcessedTs", "orderId", "orderDetails", F.explode("orders").alias("o"))


def _exploded(h: DataFrame, array: str) -> DataFrame:
    return head(h).select("orderId", "o", F.explode(array).alias("x"))


HISTORY = {
    "q2_01": lambda h: h.agg(count().alias("total_records")),
    "q2_02": lambda h: order_stream_current(h).orderBy(F.col("orderId").desc(), F.col("csn").desc()).limit(10),
    "q2_03": lambda h: _orders(h).groupBy("o.orderStatus").agg(count().alias("order_count"), money("o.totalAmount").alias("total_amount"), mean("o.totalAmount").alias("avg_amount")).orderBy(F.col("order_count").desc(), "orderStatus"),
    "q2_04": lambda h: _orders(h).groupBy("o.currency").agg(count().alias("order_count"), money("o.totalAmount").alias("total_amount")).orderBy(F.col("order_count").desc(), "currency"),
    "q2_05": lambda h: _orders(h).select("orderId", "o", F.explode("orderDetails").alias("d")).select("orderId", "o.orderRef", "o.orderStatus", "d.shippingMethod", "d.trackingNumber", "d.carrier", "d.deliveryStatus", F.col("d.version").alias("detail_version")),
    "q2_06": lambda h: _exploded(h, "lineItems").select("orderId", "o.orderRef", "o.orderStatus", "x.lineItemId", "x.productId", "x.itemQty", "x.itemPrice", "x.itemAmount", "x.itemCurrency", F.col("x.version").alias("line_item_version")),
    "q2_07": lambda h: head(h).select("xid", "csn", F.col("o.totalAmount").alias("amount")).groupBy("xid", "csn").agg(count().alias("orders_in_transaction"), money("amount").alias("total_amount")).orderBy(F.col("orders_in_transaction").desc(), F.col("total_amount").desc_nulls_last(), "csn").limit(10),
    "q2_08": lambda h: _orders(h).groupBy("o.customerId").agg(count().alias("order_count"), money("o.totalAmount").alias("total_amount")).orderBy(F.col("order_count").desc(), "customerId").limit(20),
    "q2_09": lambda h: head(h).select("orderId", "csn", "o.orderRef", "o.orderStatus", "o.totalAmount", "o.currency", F.size("orderDetails").alias("num_details"), F.size("lineItems").alias("num_line_items"), F.aggregate("lineItems", F.lit(0.0), lambda n, i: n + i["itemQty"]).alias("total_item_qty")).orderBy(F.col("total_item_qty").desc_nulls_last(), "csn").limit(20).drop("csn"),
    "q2_10": lambda h: _orders(h).filter("o.before IS NOT NULL").select("orderId", "xid", "dwhProcessedTs", *named("o", current_amount="totalAmount", current_status="orderStatus", current_version="version"), *named("o.before", previous_amount="totalAmount", previous_status="orderStatus", previous_version="version")),
    "q2_11": lambda h: _exploded(h, "orderDetails").filter("x.before IS NOT NULL").select("orderId", *named("x", current_shipping_method="shippingMethod", current_delivery_status="deliveryStatus", current_version="version"), *named("x.before", previous_shipping_method="shippingMethod", previous_delivery_status="deliveryStatus", previous_version="version")),
    "q2_12": lambda h: _exploded(h, "lineItems").filter("x.before IS NOT NULL").select("orderId", "x.lineItemId", "x.productId", *named("x", current_qty="itemQty", current_version="version"), *named("x.before", previous_qty="itemQty", previous_version="version"), (F.col("x.itemQty") - F.col("x.before.itemQty")).alias("qty_change")),
    "q2_13": lambda h: _orders(h).groupBy(F.col("o.version").alias("orderVersion")).agg(count().alias("order_count")).orderBy("orderVersion"),
    "view_order_stream_current": order_stream_current,
    "view_order_stream_changes": order_stream_changes,
}

# -- over the current state


def _largest(c: str) -> Column:
    return F.aggregate("lineItems", F.lit(0.0), lambda n, i: F.greatest(n, i[c]))


CURRENT = {
    "q1_01": lambda c: c.agg(count().alias("total_current_orders")),
    "q1_02": lambda c: c.groupBy("orderId").agg(count().alias("occurrence_count")).filter("occurrence_count > 1"),
    "q1_03": lambda c: c.orderBy(F.col("dwhProcessedTs").desc(), "orderId").limit(10).select("orderId", "xid", "csn", "dwhProcessedTs", "orderRef", "orderStatus", "totalAmount", "currency", F.col("version").alias("orderVersion"), "orderDetails.shippingMethod", "orderDetails.carrier", F.size("lineItems").alias("line_item_count")),
    "q1_04": lambda c: c.groupBy("orderStatus").agg(count().alias("order_count"), money("totalAmount").alias("total_amount"), (F.sum("version") / F.count("version")).alias("avg_version")).orderBy(F.col("order_count").desc(), "orderStatus"),
    "q1_05": lambda c: c.groupBy("currency").agg(count().alias("count"), (F.sum("version") / F.count("version")).alias("avg_version")),
    "q1_06": lambda c: c.orderBy(F.col("version").desc(), "orderId").limit(20).select("orderId", "orderRef", "orderStatus", "totalAmount", "currency", F.col("version").alias("orderVersion"), "dwhProcessedTs"),
    "q1_08": lambda c: c.select("orderId", "orderRef", "orderStatus", F.col("version").alias("order_version"), "orderDetails.shippingMethod", "orderDetails.trackingNumber", "orderDetails.carrier", "orderDetails.deliveryStatus", F.col("orderDetails.version").alias("detail_version")),
    "q1_09": lambda c: c.select("orderId", "orderRef", F.explode("lineItems").alias("x")).select("orderId", "orderRef", "x.lineItemId", "x.productId", "x.itemQty", "x.itemPrice", F.col("x.version").alias("line_item_version")),
    "q1_10": lambda c: c.filter("orderBefore IS NOT NULL").select("orderId", "orderRef", F.col("version").alias("current_version"), F.col("totalAmount").alias("current_amount"), *named("orderBefore", previous_version="version", previous_amount="totalAmount")),
    "q1_11": lambda c: c.orderBy(F.col("dwhProcessedTs").desc(), "orderId").limit(20).select("orderId", "orderRef", "orderStatus", "totalAmount", "currency", "version", "dwhProcessedTs"),
    "q1_12": lambda c: c.select("orderId", F.col("version").alias("order_version"), F.col("orderDetails.version").alias("detail_version"), _largest("version").alias("max_line_item_version")).filter("order_version <> detail_version OR order_version <> max_line_item_version"),
    "q1_13": lambda c: c.filter("orderDetails.before IS NOT NULL").select("orderId", "orderRef", *named("orderDetails", current_shipping_method="shippingMethod", current_delivery_status="deliveryStatus"), *named("orderDetails.before", previous_shipping_method="shippingMethod", previous_delivery_status="deliveryStatus")),
    "view_orders_current": orders_current_view,
}
