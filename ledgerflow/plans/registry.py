"""Queries by name, (spark, folder of source tables) -> DataFrame, and the same in DuckDB's SQL over the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.parsing import bad_numbers, expected, is_delete, is_insert, is_update, normalised, typed, with_transaction
from ..functions.specs import DETAIL, ENTITIES, ITEM, ORDER, history_type
from ..functions.versions import first_newest, newest
from ..operators.transactions import history, pending, transactions
from ..operators.versioned import bootstrapped, combined, flattened, folded, upserted
from .reports import CURRENT, HISTORY, count
from ..sources.feeds import json_lines
from ..sources.store import Table
from ..streaming.pipelines import current_pipeline, history_pipeline
from .tables import current_table, events, feed_folders, history_table, once, state_table

_h = lambda s, d: history_table(s, d).read()
_c = lambda s, d: state_table(s, d)[0].read()
QUERIES = {n: (lambda s, d, f=f: f(_h(s, d))) for n, f in HISTORY.items()} | {n: (lambda s, d, f=f: f(_c(s, d))) for n, f in CURRENT.items()}
for _n in ("q1_03", "view_orders_current"):  # an integer with nulls, as a double for the comparison
    QUERIES[_n] = lambda s, d, f=CURRENT[_n]: f(_c(s, d)).withColumn("line_item_count", F.col("line_item_count").cast("double"))


def query(f):
    QUERIES[f.__name__] = f
    return f


def _wave(h: DataFrame, wave: int) -> DataFrame:
    return h.filter(F.substring_index("xid", ".", -1) == str(wave))


@query
def parse_events(s: SparkSession, d: str) -> DataFrame:
    e = events(s, d)
    return e.groupBy("event_type").agg(count().alias("rows"), F.count("xid").alias("with_xid"), F.count("before").alias("with_before"), F.count("after").alias("with_after"))


@query
def op_predicates(s: SparkSession, d: str) -> DataFrame:
    op = F.col("op_type")
    return events(s, d).filter("event_type <> 'METADATA'").groupBy(normalised(F.col("table")).alias("entity")).agg(F.count_if(is_insert(op)).alias("inserts"), F.count_if(is_update(op)).alias("updates"), F.count_if(is_delete(op)).alias("deletes"))


@query
def table_normalise(s: SparkSession, d: str) -> DataFrame:
    return events(s, d).filter("table IS NOT NULL").groupBy("table", normalised(F.col("table")).alias("entity")).agg(count().alias("n"))


@query
def union_event_counts(s: SparkSession, d: str) -> DataFrame:
    return with_transaction(events(s, d)).groupBy("event_type").agg(count().alias("n"), F.count_distinct("xid", "csn").alias("transactions"))


@query
def typed_rows(s: SparkSession, d: str) -> DataFrame:
    """The typed rows of all three tables; amount: an order's total or an item's amount."""
    e, out = with_transaction(events(s, d)).filter("after IS NOT NULL"), None
    for entity, amount in ((ORDER, "totalAmount"), (DETAIL, None), (ITEM, "itemAmount")):
        own = e.filter(normalised(F.col("table")) == entity.table).select("csn", typed(F.col("after"), entity).alias("r"), bad_numbers(F.col("after"), entity).cast("long").alias("bad_numbers"))
        own = own.select(F.lit(entity.table).alias("entity"), "csn", "r.orderId", "r.version", (F.col(f"r.{amount}") if amount else F.lit(None).cast("double")).alias("amount"), "bad_numbers")
        out = own if out is None else out.unionAll(own)
    return out


@query
def tx_expected_counts(s: SparkSession, d: str) -> DataFrame:
    m = events(s, d).filter("event_type = 'METADATA'")
    return m.select("xid", "csn", F.col("expected_count").cast("long").alias("event_count"), *(expected(F.col("data_collections"), e.table).cast("long").alias(e.table.lower()) for e in ENTITIES))


@query
def tx_completion(s: SparkSession, d: str) -> DataFrame:
    return transactions(events(s, d)).groupBy("announced", "complete").agg(count().alias("n"), F.sum("have_ORDER_LINE_ITEMS").alias("item_events"))


@query
def tx_pending(s: SparkSession, d: str) -> DataFrame:
    return pending(events(s, d)).select("xid", "csn", "announced", "progress")


@query
def tx_emitted_orders(s: SparkSession, d: str) -> DataFrame:
    return history(events(s, d), processed=F.col("tx_ts")).select("xid", "csn", "orderId", F.size("orders").alias("orders"), F.size("orderDetails").alias("details"), F.size("lineItems").alias("items"))


@query
def tx_order_array_sizes(s: SparkSession, d: str) -> DataFrame:
    return _h(s, d).groupBy(F.size("orders").alias("orders"), F.size("orderDetails").alias("details"), F.size("lineItems").alias("items")).agg(count().alias("n"))


@query
def before_images(s: SparkSession, d: str) -> DataFrame:
    each = [_h(s, d).select(F.explode(e.array).alias("r")).select(F.lit(e.array).alias("entity"), F.col("r.version").alias("version"), F.col("r.before.version").alias("old_version")) for e in ENTITIES]
    return each[0].union(each[1]).union(each[2]).groupBy("entity", "version", "old_version").agg(count().alias("n"))


@query
def deletes_ignored(s: SparkSession, d: str) -> DataFrame:
    """Transactions with a delete: counted towards completion, without a row."""
    t = with_transaction(events(s, d)).filter("op_type = 'D'").select("xid", "csn").distinct()
    return _h(s, d).join(t, ["xid", "csn"]).select("csn", "orderId", F.size("lineItems").alias("items"))


def _all_of(h: DataFrame, entity) -> DataFrame:
    """All of an order's rows of an entity in one array."""
    return h.groupBy("orderId").agg(F.flatten(F.collect_list(entity.array)).alias("all"))


@query
def dedup_orders(s: SparkSession, d: str) -> DataFrame:
    return _all_of(_h(s, d), ORDER).select("orderId", first_newest(F.col("all"), ORDER.key).alias("o")).filter("o IS NOT NULL").select("orderId", "o.version", "o.orderStatus")


@query
def dedup_line_items(s: SparkSession, d: str) -> DataFrame:
    return _all_of(_h(s, d), ITEM).select(F.explode(newest(F.col("all"), ITEM.key)).alias("i")).select("i.lineItemId", "i.version", "i.productId", "i.itemQty")


@query
def best_order_row(s: SparkSession, d: str) -> DataFrame:
    return combined(_h(s, d)).filter("version IS NOT NULL").select("orderId", "version", "xid", "csn", "orderStatus")


@query
def best_detail(s: SparkSession, d: str) -> DataFrame:
    return combined(_h(s, d)).filter("orderDetails IS NOT NULL").select("orderId", F.col("orderDetails.version").alias("version"), F.col("orderDetails.deliveryStatus").alias("delivery_status"))


@query
def flatten_history(s: SparkSession, d: str) -> DataFrame:
    return flattened(_h(s, d)).select("csn", "orderId", "version", "orderStatus", F.col("orderBefore.version").alias("old_version"), F.col("orderDetails.version").alias("detail_version"), F.size("lineItems").alias("items"))


@query
def combine_batch(s: SparkSession, d: str) -> DataFrame:
    return combined(_h(s, d)).select("orderId", "version", F.col("orderDetails.version").alias("detail_version"), F.size("lineItems").cast("double").alias("items"))


@query
def merge_order_fields(s: SparkSession, d: str) -> DataFrame:
    return _c(s, d).select("orderId", "xid", "csn", "dwhProcessedTs", "version", "orderStatus", "totalAmount", F.col("orderBefore.version").alias("old_version"))


@query
def merge_details(s: SparkSession, d: str) -> DataFrame:
    return _c(s, d).select("orderId", F.col("orderDetails.version").alias("version"), F.col("orderDetails.deliveryStatus").alias("delivery_status"), F.col("orderDetails.before.version").alias("old_version"))


@query
def merge_line_items(s: SparkSession, d: str) -> DataFrame:
    return _c(s, d).select(F.explode("lineItems").alias("i")).select("i.lineItemId", "i.version", "i.productId", "i.itemQty", F.col("i.before.itemQty").alias("old_qty"))


@query
def merge_multi_batch(s: SparkSession, d: str) -> DataFrame:
    """Two batches folded: wave 1, then all the others."""
    h = _h(s, d)
    wave = F.substring_index("xid", ".", -1)
    out = folded([h.filter(wave == "1"), h.filter(wave != "1")])
    return out.select("orderId", "version", F.col("orderDetails.version").alias("detail_version"), F.explode_outer("lineItems").alias("i")).select("orderId", "version", "detail_version", F.col("i.lineItemId").alias("line_item_id"), F.col("i.version").alias("item_version"))


@query
def merge_out_of_order(s: SparkSession, d: str) -> DataFrame:
    """All other waves after wave 1, then wave 1 again: stale input changes nothing but the stamps."""
    h = _h(s, d)
    first, others = _wave(h, 1), h.filter(F.substring_index("xid", ".", -1) != "1")
    return folded([first, others, first]).select("orderId", "xid", "version", F.col("orderDetails.version").alias("detail_version"), F.size("lineItems").cast("double").alias("items"))


@query
def scd1_insert_guard(s: SparkSession, d: str) -> DataFrame:
    """Children of orders that aren't there don't make orders: all waves but the first."""
    h = combined(_h(s, d).filter(F.substring_index("xid", ".", -1) != "1"))
    guarded = upserted(bootstrapped(h).limit(0), h)
    return guarded.select("orderId", "version")


@query
def scd1_parked(s: SparkSession, d: str) -> DataFrame:
    """Without the guard they wait in the table for their order: all waves but the first, then the first."""
    h = _h(s, d)
    state = folded([h.filter(F.substring_index("xid", ".", -1) != "1"), _wave(h, 1)], guard=False)
    return state.select("orderId", "version", F.col("orderDetails.version").alias("detail_version"), F.size("lineItems").cast("double").alias("items"))


@query
def q1_07(s: SparkSession, d: str) -> DataFrame:
    """The history's rows were counted when the current state was folded from them."""
    kind = lambda x: F.lit(x).alias("table_type")
    current, rows = state_table(s, d)
    return current.read().agg(kind("SCD Type 1 (Current)"), count().alias("record_count")).unionAll(s.range(1).select(kind("SCD Type 2 (Historical)"), F.lit(rows).cast("long").alias("record_count")))


@query
def duplicate_check(s: SparkSession, d: str) -> DataFrame:
    """q1_02 over a state with repeated orders: the current state, and once more its orders of some keys."""
    c = _c(s, d).select("orderId")
    return CURRENT["q1_02"](c.unionAll(c.filter("orderId % 10 = 0")))


@query
def null_versions(s: SparkSession, d: str) -> DataFrame:
    """A batch with items whose first version is unknown: they don't hide the others."""
    items = F.transform("lineItems", lambda i: i.withField("version", F.when((F.col("orderId") % 7 != 0) | (i["version"] != 1), i["version"])))
    return combined(_h(s, d).withColumn("lineItems", items)).select(F.explode("lineItems").alias("i")).select("i.lineItemId", "i.version", "i.productId")


@query
def time_travel_count(s: SparkSession, d: str) -> DataFrame:
    """Rows by version of the history: the first, and all."""
    t = history_table(s, d)
    return t.read(version=0).agg(F.lit(0).cast("long").alias("version"), count().alias("n")).unionAll(t.read().agg(F.lit(-1).cast("long"), count()))


@query
def q2_14(s: SparkSession, d: str) -> DataFrame:
    return history_table(s, d).read(version=0).agg(count().alias("count_at_version_0"))


@query
def q2_15(s: SparkSession, d: str) -> DataFrame:
    """As of the time of the second batch."""
    t = history_table(s, d)
    return t.read(timestamp=t.commit_at(1).timestamp).agg(count().alias("n"))


@query
def q2_16(s: SparkSession, d: str) -> DataFrame:
    """The last ten commits."""
    return history_table(s, d).history(10).select("version", "operation", "batch_id", "is_current")


@query
def table_detail(s: SparkSession, d: str) -> DataFrame:
    """What both tables say of themselves."""
    tables = [history_table(s, d).detail().withColumn("name", F.lit("order_stream")), current_table(s, d).detail().withColumn("name", F.lit("orders_current"))]
    return tables[0].unionAll(tables[1]).select("name", "version", (F.col("num_files") > 0).alias("has_files"), (F.col("size_in_bytes") > 0).alias("has_bytes"), F.size(F.from_json("schema", "fields array<struct<name:string>>")["fields"]).cast("long").alias("columns"), F.get_json_object("properties", "$.bucket_by").alias("bucket_by"))


@query
def q1_14(s: SparkSession, d: str) -> DataFrame:
    """The change feed of the second merge, row by row."""
    return current_table(s, d).changes("orderId", 1, 2).select("orderId", "_change_type", "version", F.col("orderDetails.version").alias("detail_version"))


@query
def q1_15(s: SparkSession, d: str) -> DataFrame:
    return current_table(s, d).history(10).select("version", "operation", F.col("batch_id").cast("double").alias("batch_id"), "is_current")


@query
def qm_01(s: SparkSession, d: str) -> DataFrame:
    """A scan by path: the whole table at its place."""
    return Table(s, history_table(s, d).path).read().agg(count().alias("num_records"))


@query
def qm_02(s: SparkSession, d: str) -> DataFrame:
    """Files and size."""
    return history_table(s, d).size_report()


@query
def qm_03(s: SparkSession, d: str) -> DataFrame:
    return history_table(s, d).history().agg(count().alias("version_count"))


@query
def qm_04(s: SparkSession, d: str) -> DataFrame:
    """The columns and their types, from the table's detail."""
    t = history_table(s, d)
    names = F.from_json("schema", "fields array<struct<name:string>>")
    return t.detail().select(F.posexplode(names["fields"]).alias("place", "f")).select(F.col("place").cast("long").alias("place"), "f.name", F.element_at(F.create_map(*(F.lit(x) for f in t.schema() for x in (f.name, f.dataType.simpleString()))), F.col("f.name")).alias("type"))


@query
def change_feed(s: SparkSession, d: str) -> DataFrame:
    """What the second merge changed, by kind."""
    return current_table(s, d).changes("orderId", 1, 2).groupBy("_change_type").agg(count().alias("n"))


@query
def table_history(s: SparkSession, d: str) -> DataFrame:
    return history_table(s, d).history().groupBy("operation").agg(count().alias("n"))


@query
def decimal_profile(s: SparkSession, d: str) -> DataFrame:
    h = history(events(s, d), processed=F.col("tx_ts"), exact=True)
    return h.select(F.explode("orders").alias("o")).groupBy(F.col("o.currency").alias("currency")).agg(F.sum("o.totalAmount").cast("double").alias("total_amount"), F.max(F.col("o.orderId").cast("long")).alias("max_order_id"))


@query
def detail_items_cross(s: SparkSession, d: str) -> DataFrame:
    """Items by carrier: two explodes of one row."""
    x = _h(s, d).select(F.explode("orderDetails").alias("d"), "lineItems").select("d", F.explode("lineItems").alias("i"))
    return x.groupBy(F.col("d.carrier").alias("carrier")).agg(count().alias("n"), F.sum("i.itemQty").alias("qty"))


def _streamed_history(s: SparkSession, d: str) -> Table:
    """The whole feed through the stateful pipeline in several micro-batches, so that transactions wait for their rest, until
    there is no more input. Deletes, which aren't announced, don't count, or one would stand for an event yet to come."""

    def make(path: str) -> Table:
        # the state store needs a backend that transformWithState can use; the session's own setting comes back after
        key, old = "spark.sql.streaming.stateStore.providerClass", None
        old = s.conf.get(key, None)
        s.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        try:
            table = Table(s, f"{path}/table")
            sources = {n: json_lines(s, at, max(1, -(-len(s.read.text(at).inputFiles()) // 3))) for n, at in feed_folders(s, d).items()}
            history_pipeline(s, sources, table, f"{path}/checkpoint", once=True, processed=F.col("tx_ts"), count_deletes=False).awaitTermination()
            return table
        finally:
            s.conf.set(key, old) if old else s.conf.unset(key)

    return once(s, d, "streamed-history", make)


@query
def stream_history(s: SparkSession, d: str) -> DataFrame:
    h = _streamed_history(s, d).read()
    return h.select("xid", "csn", "orderId", F.size("orders").alias("orders"), F.size("orderDetails").alias("details"), F.size("lineItems").alias("items"), F.aggregate("lineItems", F.lit(0.0), lambda n, i: n + i["itemQty"]).alias("qty"))


@query
def stream_current(s: SparkSession, d: str) -> DataFrame:
    """The streamed history merged by the second pipeline, commit by commit; orders whose row hasn't come are left out."""

    def make(path: str) -> Table:
        table = Table(s, f"{path}/table")
        current_pipeline(s, _streamed_history(s, d), table, f"{path}/checkpoint", once=True, commits_per_batch=1, guard=False).awaitTermination()
        return table

    c = once(s, d, "streamed-current", make).read().filter("version IS NOT NULL")
    return c.select("orderId", "version", "orderStatus", F.col("orderDetails.version").alias("detail_version"), F.size("lineItems").cast("double").alias("items"))


assert DETAIL.key == "orderId"

_BASE = r"""
WITH li AS (
  SELECT l_orderkey AS o, l_linenumber AS ln, row_number() OVER p AS v, 'P' || l_partkey AS product, l_quantity AS qty, l_extendedprice AS price, l_quantity * l_extendedprice AS amount,
    lag(l_quantity) OVER p AS old_qty FROM lineitem WINDOW p AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey)
), waves AS (
  SELECT o_orderkey AS o, 1 AS w FROM orders UNION SELECT o, v FROM li UNION SELECT o_orderkey, 2 FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0
), tx AS (
  SELECT o, w::BIGINT AS w, '1.' || o || '.' || w AS xid, lpad((o * 10 + w)::VARCHAR, 12, '0') AS csn, '2025-07-07 23:33:' || lpad((w % 60)::VARCHAR, 2, '0') AS ts, o % 11 <> 0 AND o % 13 <> 0 AS complete, o % 11 = 0 OR o % 13 <> 0 AS announced FROM waves
), ov AS (
  SELECT o_orderkey AS o, v, 'REF-' || o_orderkey AS ref, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE v WHEN 1 THEN o_orderstatus ELSE 'SHIPPED' END AS status, o_orderpriority AS kind,
    CASE v WHEN 1 THEN o_totalprice ELSE o_totalprice + 1 END AS amount, ['USD', 'EUR', 'GBP'][(o_orderkey % 3 + 1)::INT] AS currency, 'C' || o_custkey AS customer,
    CASE v WHEN 2 THEN o_orderstatus END AS old_status, CASE v WHEN 2 THEN o_totalprice END AS old_amount FROM orders, (VALUES (1), (2)) x(v) WHERE v = 1 OR o_orderkey % 3 = 0
), dv AS (
  SELECT o_orderkey AS o, v, ['STANDARD', 'EXPRESS', 'OVERNIGHT', 'PICKUP'][(o_orderkey % 4 + 1)::INT] AS method, ['FEDEX', 'UPS', 'DHL', 'USPS'][(o_orderkey % 4 + 1)::INT] AS carrier, 'TRK-' || o_orderkey AS tracking,
    CASE v WHEN 1 THEN 'PENDING' ELSE 'IN_TRANSIT' END AS delivery FROM orders, (VALUES (1), (2)) x(v) WHERE v = 1 OR o_orderkey % 5 = 0
), ho AS (SELECT tx.*, ov.* EXCLUDE (o) FROM tx JOIN ov ON tx.o = ov.o AND tx.w = ov.v WHERE complete
), hd AS (SELECT tx.*, dv.* EXCLUDE (o) FROM tx JOIN dv ON tx.o = dv.o AND tx.w = dv.v WHERE complete
), hi AS (SELECT tx.*, li.* EXCLUDE (o) FROM tx JOIN li ON tx.o = li.o AND tx.w = li.v WHERE complete
), h AS (
  SELECT tx.*, (SELECT count(*) FROM ov WHERE ov.o = tx.o AND ov.v = w) AS n_orders, (SELECT count(*) FROM dv WHERE dv.o = tx.o AND dv.v = w) AS n_details, coalesce(n, 0) AS n_items, coalesce(q, 0) AS qty
  FROM tx LEFT JOIN (SELECT o AS io, v AS iv, count(*) AS n, sum(qty) AS q FROM li GROUP BY ALL) ON io = tx.o AND iv = w WHERE complete
), co AS (SELECT * FROM ho QUALIFY row_number() OVER (PARTITION BY o ORDER BY v DESC) = 1
), cd AS (SELECT * FROM hd QUALIFY row_number() OVER (PARTITION BY o ORDER BY v DESC) = 1
), ci AS (SELECT * FROM hi QUALIFY row_number() OVER (PARTITION BY o, ln ORDER BY v DESC) = 1
), cn AS (SELECT o, count(*) AS n, max(v) AS top FROM ci GROUP BY o
), last AS (SELECT o, max_by(xid, w) AS xid, max_by(csn, w) AS csn, max_by(ts, w) AS ts, max(w) AS w FROM tx WHERE complete GROUP BY o
), ev AS (
  SELECT 'ORDERS' AS feed, 'APPUSER.ORDERS' AS tab, o, v AS w, CASE v WHEN 1 THEN 'I' ELSE 'U' END AS op FROM ov
  UNION ALL SELECT 'ORDER_DETAILS', 'APPUSER.ORDER_DETAILS', o, v, CASE v WHEN 1 THEN 'I' ELSE 'U' END FROM dv
  UNION ALL SELECT 'ORDER_LINE_ITEMS', 'APPUSER.ORDER_LINE_ITEMS', o, v, CASE v WHEN 1 THEN 'I' ELSE 'U' END FROM li
  UNION ALL SELECT 'ORDER_LINE_ITEMS', 'APPUSER.ORDER_LINE_ITEMS', o_orderkey, 1, 'D' FROM orders WHERE o_orderkey % 17 = 0
  UNION ALL SELECT 'ORDERS', 'APPUSER.AUDIT_LOG', o_orderkey, 1, 'I' FROM orders WHERE o_orderkey % 23 = 0
), bad AS (SELECT o_orderkey AS o FROM orders WHERE o_orderkey % 19 = 0
)
"""
_M = "sum({0}::DECIMAL(20,4))::DOUBLE"
_SIZES = "(SELECT count(*) FROM ov WHERE ov.o = tx.o AND ov.v = tx.w)"
SQL = {
    "q2_01": "SELECT count(*) AS total_records FROM h",
    "q2_02": 'SELECT h.o::DOUBLE AS "orderId", h.xid, h.csn, h.ts AS "dwhProcessedTs", ref AS "orderRef", status AS "orderStatus", amount AS "totalAmount", currency, day AS "orderDate", v::DOUBLE AS "orderVersion", n_details::INT AS detail_count, n_items::INT AS line_item_count FROM h LEFT JOIN ho USING (o, w) ORDER BY h.o DESC, h.csn DESC LIMIT 10',
    "q2_03": f"SELECT status AS \"orderStatus\", count(*) AS order_count, {_M.format('amount')} AS total_amount, {_M.format('amount')} / count(amount) AS avg_amount FROM ho GROUP BY status",
    "q2_04": f"SELECT currency, count(*) AS order_count, {_M.format('amount')} AS total_amount FROM ho GROUP BY currency",
    "q2_05": 'SELECT ho.o::DOUBLE AS "orderId", ref AS "orderRef", status AS "orderStatus", method AS "shippingMethod", tracking AS "trackingNumber", carrier, delivery AS "deliveryStatus", hd.v::DOUBLE AS detail_version FROM ho JOIN hd USING (o, w)',
    "q2_06": 'SELECT hi.o::DOUBLE AS "orderId", ref AS "orderRef", status AS "orderStatus", (hi.o * 10 + ln)::DOUBLE AS "lineItemId", product AS "productId", qty AS "itemQty", price AS "itemPrice", hi.amount AS "itemAmount", [\'USD\', \'EUR\', \'GBP\'][(hi.o % 3 + 1)::INT] AS "itemCurrency", hi.v::DOUBLE AS line_item_version FROM hi LEFT JOIN ho USING (o, w)',
    "q2_07": 'SELECT h.xid, h.csn, 1::BIGINT AS orders_in_transaction, amount::DECIMAL(20,4)::DOUBLE AS total_amount FROM h LEFT JOIN ho USING (o, w) ORDER BY total_amount DESC NULLS LAST, h.csn LIMIT 10',
    "q2_08": f"SELECT customer AS \"customerId\", count(*) AS order_count, {_M.format('amount')} AS total_amount FROM ho GROUP BY customer ORDER BY order_count DESC, customer LIMIT 20",
    "q2_09": 'SELECT h.o::DOUBLE AS "orderId", ref AS "orderRef", status AS "orderStatus", amount AS "totalAmount", currency, n_details::INT AS num_details, n_items::INT AS num_line_items, qty::DOUBLE AS total_item_qty FROM h LEFT JOIN ho USING (o, w) ORDER BY qty DESC, h.csn LIMIT 20',
    "q2_10": 'SELECT o::DOUBLE AS "orderId", xid, ts AS "dwhProcessedTs", amount AS current_amount, old_amount AS previous_amount, status AS current_status, old_status AS previous_status, 2::DOUBLE AS current_version, 1::DOUBLE AS previous_version FROM ho WHERE v = 2',
    "q2_11": 'SELECT o::DOUBLE AS "orderId", method AS current_shipping_method, method AS previous_shipping_method, delivery AS current_delivery_status, \'PENDING\' AS previous_delivery_status, 2::DOUBLE AS current_version, 1::DOUBLE AS previous_version FROM hd WHERE v = 2',
    "q2_12": 'SELECT o::DOUBLE AS "orderId", (o * 10 + ln)::DOUBLE AS "lineItemId", product AS "productId", qty AS current_qty, old_qty AS previous_qty, qty - old_qty AS qty_change, v::DOUBLE AS current_version, (v - 1)::DOUBLE AS previous_version FROM hi WHERE v > 1',
    "q2_13": 'SELECT v::DOUBLE AS "orderVersion", count(*) AS order_count FROM ho GROUP BY v',
    "view_order_stream_current": 'SELECT h.o::DOUBLE AS "orderId", h.xid, h.csn, h.ts AS "dwhProcessedTs", ref AS "orderRef", status AS "orderStatus", amount AS "totalAmount", currency, day AS "orderDate", v::DOUBLE AS "orderVersion", n_details::INT AS detail_count, n_items::INT AS line_item_count FROM h LEFT JOIN ho USING (o, w)',
    "view_order_stream_changes": 'SELECT o::DOUBLE AS "orderId", xid, csn, ts AS "dwhProcessedTs", ref AS "orderRef", status AS "orderStatus", amount AS "totalAmount", 2::DOUBLE AS "orderVersion", old_amount AS previous_total_amount, old_status AS previous_status, 1::DOUBLE AS previous_version, \'UPDATED\' AS change_type FROM ho WHERE v = 2',
    "q1_01": 'SELECT count(*) AS total_current_orders FROM co',
    "q1_02": 'SELECT o::DOUBLE AS "orderId", count(*) AS occurrence_count FROM co GROUP BY o HAVING count(*) > 1',
    "q1_03": 'SELECT co.o::DOUBLE AS "orderId", last.xid, last.csn, last.ts AS "dwhProcessedTs", ref AS "orderRef", status AS "orderStatus", amount AS "totalAmount", currency, co.v::DOUBLE AS "orderVersion", method AS "shippingMethod", carrier, cn.n::DOUBLE AS line_item_count FROM co JOIN last ON last.o = co.o LEFT JOIN cd ON cd.o = co.o LEFT JOIN cn ON cn.o = co.o ORDER BY last.ts DESC, co.o LIMIT 10',
    "q1_04": f"SELECT status AS \"orderStatus\", count(*) AS order_count, {_M.format('amount')} AS total_amount, sum(v)::DOUBLE / count(v) AS avg_version FROM co GROUP BY status",
    "q1_05": "SELECT currency, count(*) AS count, sum(v)::DOUBLE / count(v) AS avg_version FROM co GROUP BY currency",
    "q1_06": 'SELECT co.o::DOUBLE AS "orderId", ref AS "orderRef", status AS "orderStatus", amount AS "totalAmount", currency, co.v::DOUBLE AS "orderVersion", last.ts AS "dwhProcessedTs" FROM co JOIN last ON last.o = co.o ORDER BY co.v DESC, co.o LIMIT 20',
    "q1_07": "SELECT 'SCD Type 1 (Current)' AS table_type, count(*) AS record_count FROM co UNION ALL SELECT 'SCD Type 2 (Historical)', count(*) FROM h",
    "q1_08": 'SELECT co.o::DOUBLE AS "orderId", ref AS "orderRef", status AS "orderStatus", co.v::DOUBLE AS order_version, method AS "shippingMethod", tracking AS "trackingNumber", carrier, delivery AS "deliveryStatus", cd.v::DOUBLE AS detail_version FROM co LEFT JOIN cd ON cd.o = co.o',
    "q1_09": 'SELECT ci.o::DOUBLE AS "orderId", ref AS "orderRef", (ci.o * 10 + ln)::DOUBLE AS "lineItemId", product AS "productId", qty AS "itemQty", price AS "itemPrice", ci.v::DOUBLE AS line_item_version FROM ci JOIN co ON co.o = ci.o',
    "q1_10": 'SELECT o::DOUBLE AS "orderId", ref AS "orderRef", 2::DOUBLE AS current_version, 1::DOUBLE AS previous_version, amount AS current_amount, old_amount AS previous_amount FROM co WHERE v = 2',
    "q1_11": 'SELECT co.o::DOUBLE AS "orderId", ref AS "orderRef", status AS "orderStatus", amount AS "totalAmount", currency, v::DOUBLE AS version, last.ts AS "dwhProcessedTs" FROM co JOIN last ON last.o = co.o ORDER BY last.ts DESC, co.o LIMIT 20',
    "q1_12": 'SELECT co.o::DOUBLE AS "orderId", co.v::DOUBLE AS order_version, cd.v::DOUBLE AS detail_version, cn.top::DOUBLE AS max_line_item_version FROM co LEFT JOIN cd ON cd.o = co.o LEFT JOIN cn ON cn.o = co.o WHERE co.v <> cd.v OR co.v <> cn.top',
    "q1_13": 'SELECT cd.o::DOUBLE AS "orderId", ref AS "orderRef", method AS current_shipping_method, method AS previous_shipping_method, delivery AS current_delivery_status, \'PENDING\' AS previous_delivery_status FROM cd LEFT JOIN co ON co.o = cd.o WHERE cd.v = 2',
    "view_orders_current": 'SELECT co.o::DOUBLE AS "orderId", ref AS "orderRef", status AS "orderStatus", amount AS "totalAmount", currency, day AS "orderDate", co.v::DOUBLE AS "orderVersion", last.ts AS "dwhProcessedTs", method AS "shippingMethod", carrier, delivery AS "deliveryStatus", cn.n::DOUBLE AS line_item_count FROM co JOIN last ON last.o = co.o LEFT JOIN cd ON cd.o = co.o LEFT JOIN cn ON cn.o = co.o',
    "parse_events": "SELECT feed AS event_type, count(*) AS rows, count(*) AS with_xid, count(*) FILTER (op <> 'I') AS with_before, count(*) FILTER (op <> 'D') AS with_after FROM ev WHERE feed <> 'ORDERS' GROUP BY feed UNION ALL SELECT 'ORDERS', count(*) + (SELECT count(*) FROM bad), count(*), count(*) FILTER (op <> 'I'), count(*) + (SELECT count(*) FROM bad) FROM ev WHERE feed = 'ORDERS' UNION ALL SELECT 'METADATA', count(*), count(*), 0, 0 FROM tx WHERE announced",
    "op_predicates": "SELECT split_part(tab, '.', 2) AS entity, count(*) FILTER (op = 'I') + CASE WHEN tab = 'APPUSER.ORDERS' THEN (SELECT count(*) FROM bad) ELSE 0 END AS inserts, count(*) FILTER (op = 'U') AS updates, count(*) FILTER (op = 'D') AS deletes FROM ev GROUP BY tab",
    "table_normalise": "SELECT tab AS \"table\", split_part(tab, '.', 2) AS entity, count(*) + CASE WHEN tab = 'APPUSER.ORDERS' THEN (SELECT count(*) FROM bad) ELSE 0 END AS n FROM ev GROUP BY tab",
    "union_event_counts": "SELECT feed AS event_type, count(*) AS n, count(DISTINCT o * 10 + w) AS transactions FROM ev GROUP BY feed UNION ALL SELECT 'METADATA', count(*), count(*) FROM tx WHERE announced",
    "typed_rows": "SELECT 'ORDERS' AS entity, csn, tx.o::DOUBLE AS \"orderId\", v::DOUBLE AS version, amount, 0::BIGINT AS bad_numbers FROM tx JOIN ov ON ov.o = tx.o AND v = w UNION ALL SELECT 'ORDER_DETAILS', csn, tx.o::DOUBLE, v::DOUBLE, NULL, 0 FROM tx JOIN dv ON dv.o = tx.o AND v = w UNION ALL SELECT 'ORDER_LINE_ITEMS', csn, tx.o::DOUBLE, v::DOUBLE, amount, 0 FROM tx JOIN li ON li.o = tx.o AND v = w",
    "tx_expected_counts": f"SELECT xid, csn, (a + b + c)::BIGINT AS event_count, a::BIGINT AS orders, b::BIGINT AS order_details, c::BIGINT AS order_line_items FROM (SELECT *, {_SIZES} AS a, {_SIZES.replace('ov', 'dv')} + (o % 11 = 0)::INT AS b, coalesce(n, 0) AS c FROM tx LEFT JOIN (SELECT o AS io, v AS iv, count(*) AS n FROM li GROUP BY ALL) ON io = o AND iv = w WHERE announced)",
    "tx_completion": "SELECT announced, complete, count(*) AS n, sum(coalesce(n, 0) + (w = 1 AND o % 17 = 0)::INT)::BIGINT AS item_events FROM tx LEFT JOIN (SELECT o AS io, v AS iv, count(*) AS n FROM li GROUP BY ALL) ON io = o AND iv = w GROUP BY announced, complete",
    "tx_pending": f"SELECT xid, csn, announced, 'orders: ' || a || '/' || CASE WHEN announced THEN a::VARCHAR ELSE '?' END || ', orderDetails: ' || b || '/' || CASE WHEN announced THEN (b + 1)::VARCHAR ELSE '?' END || ', lineItems: ' || (c + (w = 1 AND o % 17 = 0)::INT) || '/' || CASE WHEN announced THEN c::VARCHAR ELSE '?' END AS progress FROM (SELECT *, {_SIZES} AS a, {_SIZES.replace('ov', 'dv')} AS b, coalesce(n, 0) AS c FROM tx LEFT JOIN (SELECT o AS io, v AS iv, count(*) AS n FROM li GROUP BY ALL) ON io = o AND iv = w WHERE NOT complete)",
    "tx_emitted_orders": 'SELECT xid, csn, o::DOUBLE AS "orderId", n_orders::INT AS orders, n_details::INT AS details, n_items::INT AS items FROM h',
    "tx_order_array_sizes": "SELECT n_orders::INT AS orders, n_details::INT AS details, n_items::INT AS items, count(*) AS n FROM h GROUP BY ALL",
    "before_images": "SELECT entity, v::DOUBLE AS version, CASE WHEN v > 1 THEN CASE WHEN entity = 'lineItems' THEN v - 1 ELSE 1 END END::DOUBLE AS old_version, count(*) AS n FROM (SELECT 'orders' AS entity, v FROM ho UNION ALL SELECT 'orderDetails', v FROM hd UNION ALL SELECT 'lineItems', v FROM hi) GROUP BY ALL",
    "deletes_ignored": 'SELECT csn, o::DOUBLE AS "orderId", n_items::INT AS items FROM h WHERE w = 1 AND o % 17 = 0',
    "dedup_orders": 'SELECT o::DOUBLE AS "orderId", v::DOUBLE AS version, status AS "orderStatus" FROM co',
    "dedup_line_items": 'SELECT (o * 10 + ln)::DOUBLE AS "lineItemId", v::DOUBLE AS version, product AS "productId", qty AS "itemQty" FROM ci',
    "best_order_row": 'SELECT o::DOUBLE AS "orderId", v::DOUBLE AS version, xid, csn, status AS "orderStatus" FROM co',
    "best_detail": 'SELECT o::DOUBLE AS "orderId", v::DOUBLE AS version, delivery AS delivery_status FROM cd',
    "flatten_history": 'SELECT h.csn, h.o::DOUBLE AS "orderId", ho.v::DOUBLE AS version, status AS "orderStatus", CASE WHEN ho.v = 2 THEN 1 END::DOUBLE AS old_version, hd.v::DOUBLE AS detail_version, n_items::INT AS items FROM h LEFT JOIN ho USING (o, w) LEFT JOIN hd USING (o, w)',
    "combine_batch": 'SELECT co.o::DOUBLE AS "orderId", co.v::DOUBLE AS version, cd.v::DOUBLE AS detail_version, cn.n::DOUBLE AS items FROM co LEFT JOIN cd ON cd.o = co.o LEFT JOIN cn ON cn.o = co.o',
    "merge_order_fields": 'SELECT co.o::DOUBLE AS "orderId", last.xid, last.csn, last.ts AS "dwhProcessedTs", v::DOUBLE AS version, status AS "orderStatus", amount AS "totalAmount", CASE WHEN v = 2 THEN 1 END::DOUBLE AS old_version FROM co JOIN last ON last.o = co.o',
    "merge_details": 'SELECT o::DOUBLE AS "orderId", v::DOUBLE AS version, delivery AS delivery_status, CASE WHEN v = 2 THEN 1 END::DOUBLE AS old_version FROM cd',
    "merge_line_items": 'SELECT (o * 10 + ln)::DOUBLE AS "lineItemId", v::DOUBLE AS version, product AS "productId", qty AS "itemQty", old_qty FROM ci',
    "merge_multi_batch": 'SELECT co.o::DOUBLE AS "orderId", co.v::DOUBLE AS version, cd.v::DOUBLE AS detail_version, (co.o * 10 + ln)::DOUBLE AS line_item_id, ci.v::DOUBLE AS item_version FROM co LEFT JOIN cd ON cd.o = co.o LEFT JOIN ci ON ci.o = co.o',
    "merge_out_of_order": "SELECT co.o::DOUBLE AS \"orderId\", '1.' || co.o || '.1' AS xid, co.v::DOUBLE AS version, cd.v::DOUBLE AS detail_version, (SELECT nullif(count(DISTINCT ln), 0) FROM hi WHERE hi.o = co.o)::DOUBLE AS items FROM co LEFT JOIN cd ON cd.o = co.o",
    "scd1_parked": 'SELECT co.o::DOUBLE AS "orderId", co.v::DOUBLE AS version, cd.v::DOUBLE AS detail_version, cn.n::DOUBLE AS items FROM co LEFT JOIN cd ON cd.o = co.o LEFT JOIN cn ON cn.o = co.o',
    "scd1_insert_guard": 'SELECT o::DOUBLE AS "orderId", v::DOUBLE AS version FROM ho WHERE v = 2',
    "time_travel_count": 'SELECT 0::BIGINT AS version, count(*) AS n FROM h WHERE w = 1 UNION ALL SELECT -1, count(*) FROM h',
    "q2_14": 'SELECT count(*) AS count_at_version_0 FROM h WHERE w = 1',
    "q2_15": "SELECT count(*) AS n FROM h WHERE w <= 2",
    "q2_16": "SELECT (v - 1)::BIGINT AS version, CASE v WHEN 1 THEN 'CREATE TABLE AS SELECT' ELSE 'APPEND' END AS operation, v::BIGINT AS batch_id, v = (SELECT max(w) FROM h) AS is_current FROM (SELECT unnest(range(1, (SELECT max(w) FROM h) + 1)) AS v) ORDER BY v DESC LIMIT 10",
    "q1_14": 'SELECT h.o::DOUBLE AS "orderId", t._change_type, CASE WHEN t._change_type = \'update_postimage\' AND h.o % 3 = 0 THEN 2 ELSE 1 END::DOUBLE AS version, CASE WHEN t._change_type = \'update_postimage\' AND h.o % 5 = 0 THEN 2 ELSE 1 END::DOUBLE AS detail_version FROM h, (VALUES (\'update_preimage\'), (\'update_postimage\')) t(_change_type) WHERE w = 2',
    "q1_15": "SELECT v::BIGINT AS version, CASE v WHEN 0 THEN 'CREATE' ELSE 'MERGE' END AS operation, CASE WHEN v > 0 THEN v - 1 END::DOUBLE AS batch_id, v = (SELECT max(w) FROM h) AS is_current FROM (SELECT unnest(range((SELECT max(w) FROM h) + 1)) AS v) ORDER BY v DESC LIMIT 10",
    "qm_01": 'SELECT count(*) AS num_records FROM h',
    "qm_03": 'SELECT max(w) AS version_count FROM h',
    "qm_04": "SELECT * FROM (VALUES " + ", ".join(f"({i}::BIGINT, '{f.name}', '{f.dataType.simpleString()}')" for i, f in enumerate(history_type())) + ") t(place, name, type)",
    "change_feed": "SELECT _change_type, count(*) AS n FROM (SELECT unnest(['update_preimage', 'update_postimage']) AS _change_type FROM h WHERE w = 2) GROUP BY ALL",
    "table_history": "SELECT 'CREATE TABLE AS SELECT' AS operation, 1::BIGINT AS n UNION ALL SELECT 'APPEND', (SELECT max(w) - 1 FROM h)",
    "decimal_profile": f"SELECT currency, {_M.format('amount')} AS total_amount, max(o) AS max_order_id FROM ho GROUP BY currency",
    "stream_history": 'SELECT xid, csn, o::DOUBLE AS "orderId", n_orders::INT AS orders, n_details::INT AS details, n_items::INT AS items, qty::DOUBLE AS qty FROM h',
    "stream_current": 'SELECT co.o::DOUBLE AS "orderId", co.v::DOUBLE AS version, status AS "orderStatus", cd.v::DOUBLE AS detail_version, cn.n::DOUBLE AS items FROM co LEFT JOIN cd ON cd.o = co.o LEFT JOIN cn ON cn.o = co.o',
    "detail_items_cross": "SELECT carrier, count(*) AS n, sum(qty) AS qty FROM hd JOIN hi USING (o, w) GROUP BY carrier",
    "table_detail": "SELECT name, version::BIGINT AS version, true AS has_files, true AS has_bytes, columns::BIGINT AS columns, bucket_by FROM (VALUES ('order_stream', (SELECT max(w) - 1 FROM h), 7, NULL), ('orders_current', (SELECT max(w) FROM h), 18, 'orderId')) t(name, version, columns, bucket_by)",
    "null_versions": 'SELECT (o * 10 + ln)::DOUBLE AS "lineItemId", v::DOUBLE AS version, product AS "productId" FROM hi WHERE o % 7 <> 0 OR v <> 1 QUALIFY row_number() OVER (PARTITION BY o, ln ORDER BY v DESC) = 1',
    "duplicate_check": 'SELECT o::DOUBLE AS "orderId", 2::BIGINT AS occurrence_count FROM co WHERE o % 10 = 0',
}
ORACLE_SQL = {n: _BASE + q for n, q in SQL.items()}
