"""A change feed derived from the tables orders and lineitem.

Line items that share an order and a line are versions of one item, in the order of ship date, part and supplier. Wave k
of an order is a transaction: wave 1 inserts the order, its detail and its items; wave k carries the items' version k;
wave 2 also updates the order (orderkey % 3 = 0) and the detail (% 5 = 0). Orders with orderkey % 11 = 0 announce one
detail too many and never complete, those with % 13 = 0 have no metadata (unless % 11 = 0), % 17 = 0 add a delete to wave
1 that isn't announced, % 19 = 0 an event without xid, % 23 = 0 an event of an unknown table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

METHODS, CARRIERS, CURRENCIES = ("STANDARD", "EXPRESS", "OVERNIGHT", "PICKUP"), ("FEDEX", "UPS", "DHL", "USPS"), ("USD", "EUR", "GBP")
SCHEMA = "APPUSER"
_found: dict[int, list[int]] = {}


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values)).cast("int") + 1)


def _text(**fields: Column) -> Column:
    """An image as JSON text fields; null fields are left out."""
    return F.struct(*(c.cast("string").alias(k) for k, c in fields.items()))


def slice_of(key: Column, slices: int) -> Column:
    """The slice of an order, 0 to slices - 1, by a hash of its key as the double that the history has. A transaction is of
    one order, so it lies whole in one slice. slices: a power of two."""
    return F.coalesce(F.pmod(F.xxhash64(key.cast("double")), F.lit(slices)).cast("int"), F.lit(0))


def _seats(spark: SparkSession, n: int) -> list[int]:
    """For each of n partitions a number that is dealt to it: a union keeps only partitionings by a hash."""
    if n not in _found:
        at = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n))
        _found[n] = [r[1] for r in spark.range(100 * n).groupBy(at.alias("at")).agg(F.min("id")).orderBy("at").collect()]
    return _found[n]


def _source(spark: SparkSession, sf_dir: str, name: str, key: str, part: tuple[int, int] | None, dealt: int | None) -> DataFrame:
    """Rows of a table, with their place (null unless they are dealt)."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # compared as text, which generated code has by reference: so all slices share their compiled code
    rows = rows if part is None else rows.filter(slice_of(F.col(key), part[1]).cast("string") == str(part[0]))
    if dealt is None:
        return rows.withColumn("place", F.lit(None).cast("int"))
    n = part[1] if part else 1
    at = (slice_of(F.col(key), n * dealt) / n).cast("int")
    return rows.withColumn("place", F.element_at(F.array(*map(F.lit, _seats(spark, dealt))), at + 1)).repartition(dealt, "place")


def _items(spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None, dealt: int | None = None) -> DataFrame:
    li = _source(spark, sf_dir, "lineitem", "l_orderkey", part, dealt).select("place", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    order = W.partitionBy("place", "l_orderkey", "l_linenumber").orderBy("l_shipdate", "l_partkey", "l_suppkey")
    image = _text(LINE_ITEM_ID=F.col("l_orderkey") * 10 + F.col("l_linenumber"), ORDER_ID=F.col("l_orderkey"), VERSION=F.col("wave"), PRODUCT_ID=F.concat(F.lit("P"), F.col("l_partkey")), ITEM_QTY=F.col("l_quantity"), ITEM_PRICE=F.col("l_extendedprice"), ITEM_AMOUNT=F.col("l_quantity") * F.col("l_extendedprice"), ITEM_CURRENCY=_pick(CURRENCIES, F.col("l_orderkey")))
    out = li.withColumn("wave", F.row_number().over(order)).withColumn("image", F.to_json(image)).withColumn("before", F.lag("image").over(order))
    return out.select("place", F.col("l_orderkey").alias("o"), "wave", F.lit("ORDER_LINE_ITEMS").alias("name"), (F.lit(300) + F.col("l_linenumber")).alias("at"), "before", F.col("image").alias("after"))


def _order_images(orders: DataFrame) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")

    def order(version: int) -> Column:
        return _text(ORDER_ID=F.col("o_orderkey"), ORDER_REF=F.concat(F.lit("REF-"), F.col("o_orderkey")), VERSION=F.lit(version), ORDER_DATE=day, ORDER_TS=F.concat(day, F.lit(" 00:00:00")), ORDER_STATUS=F.col("o_orderstatus") if version == 1 else F.lit("SHIPPED"), ORDER_TYPE=F.col("o_orderpriority"), TOTAL_AMOUNT=F.col("o_totalprice") if version == 1 else F.col("o_totalprice") + 1, CURRENCY=_pick(CURRENCIES, F.col("o_orderkey")), CUSTOMER_ID=F.concat(F.lit("C"), F.col("o_custkey")), SHIPPING_ADDRESS_ID=F.concat(F.lit("A"), F.col("o_custkey")), CREATED_TS=F.concat(day, F.lit(" 00:00:00")))

    def detail(version: int) -> Column:
        return _text(ORDER_ID=F.col("o_orderkey"), VERSION=F.lit(version), SHIPPING_METHOD=_pick(METHODS, F.col("o_orderkey")), TRACKING_NUMBER=F.concat(F.lit("TRK-"), F.col("o_orderkey")), SHIPPED_TS=F.concat(day, F.lit(" 12:00:00")), ESTIMATED_DELIVERY_DATE=day, CARRIER=_pick(CARRIERS, F.col("o_orderkey")), DELIVERY_STATUS=F.lit("PENDING" if version == 1 else "IN_TRANSIT"))

    def change(name: str, at: int, make, wave: int) -> Column:
        old, new = make(1), make(wave)
        fields = lambda x: F.to_json(x)
        return F.struct(F.lit(wave).alias("wave"), F.lit(name).alias("name"), F.lit(at).alias("at"), (fields(old) if wave > 1 else F.lit(None).cast("string")).alias("before"), fields(new).alias("after"))

    k = F.col("o_orderkey")
    changes = F.array(change("ORDERS", 100, order, 1), change("ORDER_DETAILS", 200, detail, 1), F.when(k % 3 == 0, change("ORDERS", 100, order, 2)), F.when(k % 5 == 0, change("ORDER_DETAILS", 200, detail, 2)))
    return orders.select("place", k.alias("o"), F.explode(F.array_compact(changes)).alias("c")).select("place", "o", "c.wave", "c.name", "c.at", "c.before", "c.after")


def changes(spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None, dealt: int | None = None) -> DataFrame:
    """All changes: o, wave, name, at, op_type, before, after (JSON text), real (announced in the metadata). part: those of
    slice i of n only, (i, n). dealt: the sources' rows are dealt into so many partitions (a power of two), each with
    a number in the column place: a slice's orders as `slice_of` has them in n times as many slices."""
    orders = _source(spark, sf_dir, "orders", "o_orderkey", part, dealt)
    own = _order_images(orders).unionByName(_items(spark, sf_dir, part, dealt)).withColumn("op_type", F.when(F.col("before").isNull(), "I").otherwise("U")).withColumn("real", F.lit(True))
    k = F.col("o_orderkey")
    none = F.lit(None).cast("string")
    extra = lambda name, op, before, after: F.struct(F.lit(name).alias("name"), F.lit(op).alias("op_type"), before.alias("before"), after.alias("after"))
    image = F.concat(F.lit('{"ORDER_ID":'), k, F.lit("}"))
    odd = F.array_compact(F.array(F.when(k % 17 == 0, extra("ORDER_LINE_ITEMS", "D", image, none)), F.when(k % 19 == 0, extra("NO_XID", "I", none, image)), F.when(k % 23 == 0, extra("AUDIT_LOG", "I", none, image))))
    odd = orders.select("place", k.alias("o"), F.explode(odd).alias("c")).select("place", "o", F.lit(1).alias("wave"), "c.name", F.lit(900).alias("at"), "c.before", "c.after", "c.op_type", F.lit(False).alias("real"))
    return own.unionByName(odd)


def _ids(o: Column, wave: Column) -> tuple[Column, Column]:
    return F.concat(F.lit("1."), o.cast("string"), F.lit("."), wave.cast("string")), F.lpad((o * 10 + wave).cast("string"), 12, "0")


def raw_events(spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None, dealt: int | None = None) -> tuple[DataFrame, DataFrame]:
    """JSON text in a column value: the events of all three tables (column feed: in which feed they come), and METADATA.
    Events of unknown tables and without xid come with ORDERS. part, dealt and the column place: as for `changes`."""
    rows = changes(spark, sf_dir, part, dealt)
    xid, csn = _ids(F.col("o"), F.col("wave"))
    ts = F.concat(F.lit("2025-07-07 23:33:"), F.lpad((F.col("wave") % 60).cast("string"), 2, "0"))
    head = F.to_json(F.struct(F.concat(F.lit(f"{SCHEMA}."), F.when(F.col("name") == "NO_XID", "ORDERS").otherwise(F.col("name"))).alias("table"), "op_type", ts.alias("op_ts"), ts.alias("current_ts"), F.lpad(F.col("at").cast("string"), 8, "0").alias("pos"), csn.alias("csn"), F.when(F.col("name") != "NO_XID", xid).alias("xid")))
    null = F.lit("null")
    value = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"before":'), F.coalesce("before", null), F.lit(',"after":'), F.coalesce("after", null), F.lit("}"))
    feed = F.when(F.col("name").isin("ORDER_DETAILS", "ORDER_LINE_ITEMS"), F.col("name")).otherwise("ORDERS")
    events = rows.select("place", feed.alias("feed"), value.alias("value"))
    names = ("ORDERS", "ORDER_DETAILS", "ORDER_LINE_ITEMS")
    told = rows.filter("real").groupBy("place", "o", "wave").agg(*(F.count_if(F.col("name") == n).cast("int").alias(n) for n in names))
    told = told.filter("o % 11 = 0 OR o % 13 <> 0").withColumn("ORDER_DETAILS", F.col("ORDER_DETAILS") + (F.col("o") % 11 == 0).cast("int"))
    counts = F.array(*(F.struct(F.lit(n).alias("data_collection"), F.col(n).alias("event_count")) for n in names))
    metadata = told.select("place", F.to_json(F.struct(xid.alias("xid"), csn.alias("csn"), ts.alias("tx_ts"), sum(map(F.col, names[1:]), F.col(names[0])).alias("event_count"), counts.alias("data_collections"))).alias("value"))
    return events, metadata


def raw_feeds(spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None) -> dict[str, DataFrame]:
    """The four feeds as JSON text in a column value: ORDERS, ORDER_DETAILS, ORDER_LINE_ITEMS and METADATA."""
    events, metadata = raw_events(spark, sf_dir, part)
    return {n: events.filter(F.col("feed") == n).select("value") for n in ("ORDERS", "ORDER_DETAILS", "ORDER_LINE_ITEMS")} | {"METADATA": metadata.select("value")}
