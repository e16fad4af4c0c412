"""Tables and views in the session's catalog, as SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions.specs import current_type, history_type

VIEWS = {
    "order_stream_current": """
        SELECT orderId, xid, csn, dwhProcessedTs, o.orderRef, o.orderStatus, o.totalAmount, o.currency, o.orderDate, o.version AS orderVersion,
            size(orderDetails) AS detail_count, size(lineItems) AS line_item_count
        FROM (SELECT *, get(orders, 0) AS o FROM {order_stream})""",
    "order_stream_changes": """
        SELECT orderId, xid, csn, dwhProcessedTs, o.orderRef, o.orderStatus, o.totalAmount, o.version AS orderVersion, o.before.totalAmount AS previous_total_amount,
            o.before.orderStatus AS previous_status, o.before.version AS previous_version, CASE WHEN o.before IS NOT NULL THEN 'UPDATED' ELSE 'INSERTED' END AS change_type
        FROM {order_stream} LATERAL VIEW explode(orders) AS o WHERE o.before IS NOT NULL""",
    "orders_current_view": """
        SELECT orderId, orderRef, orderStatus, totalAmount, currency, orderDate, version AS orderVersion, dwhProcessedTs, orderDetails.shippingMethod, orderDetails.carrier,
            orderDetails.deliveryStatus, size(lineItems) AS line_item_count
        FROM {orders_current}""",
}


def create_tables(spark: SparkSession, recreate: bool = False, exact: bool = False, location: str | None = None, properties: dict[str, str] | None = None) -> None:
    """order_stream and orders_current, if they aren't there; recreate drops them first. exact: decimal columns."""
    for name, schema in (("order_stream", history_type(exact=exact)), ("orders_current", current_type(exact))):
        if recreate:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()} COMMENT '{f.name}'" for f in schema)
        place = f"LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING PARQUET {place}")
        if properties:
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f'{k!r} = {v!r}' for k, v in properties.items())})")


def create_views(spark: SparkSession, **tables: str) -> None:
    """The views over the tables of these names (their own by default)."""
    names = {"order_stream": "order_stream", "orders_current": "orders_current"} | tables
    for view, body in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS {body.format(**names)}")


def analyze(spark: SparkSession, name: str, columns: bool = True) -> None:
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS{' FOR ALL COLUMNS' if columns else ''}")
