"""Entities of a transaction: wire names, field names and types. Everything else loops over these."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import ArrayType, DataType, DecimalType, DoubleType, IntegerType, MapType, StringType, StructField, StructType

S, D = StringType(), DoubleType()


@dataclass(frozen=True)
class Field:
    wire: str
    name: str
    type: DataType
    exact: DataType | None = None  # the type in the decimal profile


@dataclass(frozen=True)
class Entity:
    """One table of the source. key: the field that names a row; array: its column in the history table."""

    table: str
    array: str
    key: str
    fields: tuple[Field, ...]
    parent: str = "ORDER_ID"

    def row_type(self, exact: bool = False, before: bool = True) -> StructType:
        own = [StructField(f.name, f.exact if exact and f.exact else f.type) for f in self.fields]
        return StructType([*own, StructField("before", StructType(own))] if before else own)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]


_ID, _VERSION = DecimalType(20, 0), DecimalType(10, 0)
# Fixed names: the columns of the three source tables and the fields they become.
ORDER = Entity("ORDERS", "orders", "orderId", (
    Field("ORDER_ID", "orderId", D, _ID), Field("ORDER_REF", "orderRef", S), Field("VERSION", "version", D, _VERSION), Field("ORDER_DATE", "orderDate", S),
    Field("ORDER_TS", "orderTs", S), Field("ORDER_STATUS", "orderStatus", S), Field("ORDER_TYPE", "orderType", S), Field("TOTAL_AMOUNT", "totalAmount", D, DecimalType(20, 4)),
    Field("CURRENCY", "currency", S), Field("CUSTOMER_ID", "customerId", S), Field("SHIPPING_ADDRESS_ID", "shippingAddressId", S), Field("CREATED_TS", "createdTs", S),
))
DETAIL = Entity("ORDER_DETAILS", "orderDetails", "orderId", (
    Field("ORDER_ID", "orderId", D, _ID), Field("VERSION", "version", D, _VERSION), Field("SHIPPING_METHOD", "shippingMethod", S), Field("TRACKING_NUMBER", "trackingNumber", S),
    Field("SHIPPED_TS", "shippedTs", S), Field("ESTIMATED_DELIVERY_DATE", "estimatedDeliveryDate", S), Field("CARRIER", "carrier", S), Field("DELIVERY_STATUS", "deliveryStatus", S),
))
ITEM = Entity("ORDER_LINE_ITEMS", "lineItems", "lineItemId", (
    Field("LINE_ITEM_ID", "lineItemId", D, _ID), Field("ORDER_ID", "orderId", D, _ID), Field("VERSION", "version", D, _VERSION), Field("PRODUCT_ID", "productId", S),
    Field("ITEM_QTY", "itemQty", D, DecimalType(18, 4)), Field("ITEM_PRICE", "itemPrice", D, DecimalType(18, 8)), Field("ITEM_AMOUNT", "itemAmount", D, DecimalType(20, 4)), Field("ITEM_CURRENCY", "itemCurrency", S),
))
ENTITIES = (ORDER, DETAIL, ITEM)

_IMAGE = MapType(S, S)
#: A change event as it comes, and a transaction's metadata.
ENVELOPE = StructType([*(StructField(n, S) for n in ("table", "op_type", "op_ts", "current_ts", "pos", "csn", "xid")), StructField("before", _IMAGE), StructField("after", _IMAGE)])
COLLECTIONS = ArrayType(StructType([StructField("data_collection", S), StructField("event_count", IntegerType())]))
METADATA = StructType([StructField("xid", S), StructField("csn", S), StructField("tx_ts", S), StructField("event_count", IntegerType()), StructField("data_collections", COLLECTIONS)])


def history_type(entities: tuple[Entity, ...] = ENTITIES, exact: bool = False) -> StructType:
    key = entities[0].fields[0]
    return StructType([StructField("xid", S), StructField("csn", S), StructField("dwhProcessedTs", S), StructField(key.name, key.exact if exact else key.type), *(StructField(e.array, ArrayType(e.row_type(exact))) for e in entities)])


def current_type(exact: bool = False) -> StructType:
    order = ORDER.row_type(exact, before=False)
    own = {f.name: f for f in order}
    return StructType([StructField("xid", S), StructField("csn", S), StructField("dwhProcessedTs", S), own["orderId"], *(own[c] for c in ORDER.columns if c != "orderId"), StructField("orderBefore", order), StructField("orderDetails", DETAIL.row_type(exact)), StructField("lineItems", ArrayType(ITEM.row_type(exact)))])
