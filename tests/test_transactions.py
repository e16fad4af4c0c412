import json
import re

from ledgerflow.functions.parsing import parse_events, parse_metadata, unified
from ledgerflow.operators.transactions import history, pending, transactions


def feed(spark, events, metas):
    ev = [json.dumps({"table": f"APP.{t}", "op_type": op, "op_ts": "t", "pos": pos, "csn": "1", "xid": x, "before": {"ORDER_ID": 1} if op != "I" else None, "after": after}) for x, t, op, pos, after in events]
    ms = [json.dumps({"xid": x, "csn": "1", "tx_ts": "t", "event_count": 0, "data_collections": c}) for x, c in metas]
    text = lambda rows: spark.createDataFrame([(r,) for r in rows], "value string")
    return unified([parse_events(text(ev), "ORDERS")], parse_metadata(text(ms)))


def want(orders=0, details=0, items=0):
    return [{"data_collection": n, "event_count": c} for n, c in (("ORDERS", orders), ("ORDER_DETAILS", details), ("ORDER_LINE_ITEMS", items))]


ORDER, DETAIL, ITEM = "ORDERS", "ORDER_DETAILS", "ORDER_LINE_ITEMS"
EVENTS = [
    ("a", ITEM, "I", "3", {"LINE_ITEM_ID": 12, "ORDER_ID": 1}), ("a", ORDER, "I", "1", {"ORDER_ID": 1, "VERSION": 1}), ("a", ITEM, "I", "2", {"LINE_ITEM_ID": 11, "ORDER_ID": 1.0}),
    ("b", ORDER, "I", "1", {"ORDER_ID": 2}), ("c", ORDER, "I", "1", {"ORDER_ID": 3}), ("c", "AUDIT", "I", "2", {"ORDER_ID": 3}),
    ("d", ITEM, "D", "1", None), ("d", ORDER, "U", "2", {"ORDER_ID": 4}), ("e", ORDER, "I", "1", {"ORDER_ID": 5}), ("e", ORDER, "I", "1", {"ORDER_ID": 5}),
]
METAS = [("a", want(1, 0, 2)), ("b", want(1, 1)), ("d", want(1, 0, 1)), ("e", want(2)), ("f", None)]


def test_completion(spark):
    t = {r["xid"]: r["complete"] for r in transactions(feed(spark, EVENTS, METAS)).collect()}
    # b waits for a detail, c for its metadata; d's delete counts; e's redelivery counts; f expects nothing
    assert t == {"a": True, "b": False, "c": False, "d": True, "e": True, "f": True}
    strict = {r["xid"]: r["complete"] for r in transactions(feed(spark, EVENTS, METAS), dedup=True, count_deletes=False).collect()}
    assert strict == {"a": True, "b": False, "c": False, "d": False, "e": False, "f": True}


def test_history(spark):
    h = {(r["xid"], r["orderId"]): r for r in history(feed(spark, EVENTS, METAS)).collect()}
    assert set(h) == {("a", 1.0), ("d", 4.0), ("e", 5.0)}
    a = h["a", 1.0]
    assert [i["lineItemId"] for i in a["lineItems"]] == [11.0, 12.0] and len(a["orders"]) == 1 and a["orderDetails"] == []
    assert a["orders"][0]["before"] is None and h["d", 4.0]["orders"][0]["before"]["orderId"] == 1.0
    assert h["d", 4.0]["lineItems"] == []  # the delete made no row


def test_pending(spark):
    p = {r["xid"]: r["progress"] for r in pending(feed(spark, EVENTS, METAS)).collect()}
    assert p == {"b": "orders: 1/1, orderDetails: 0/1, lineItems: 0/0", "c": "orders: 1/?, orderDetails: 0/?, lineItems: 0/?"}


def test_shuffles(spark):
    """By transaction alone, or so that a bulk transaction's rows are dealt by order."""
    plan = history(feed(spark, EVENTS, METAS))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(xid#\d+, csn#\d+, orderId#\d+", plan)
    plan = history(feed(spark, EVENTS, METAS), spread=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1


def test_no_events(spark):
    assert history(feed(spark, [], []).limit(0)).count() == 0


def test_spread_history_is_the_same(spark):
    from pyspark.sql import functions as F

    text = lambda df: sorted(r[0] for r in df.select(F.to_json(F.struct(*df.columns))).collect())
    for options in ({}, {"dedup": True}, {"count_deletes": False}):
        a = history(feed(spark, EVENTS, METAS), processed=F.col("tx_ts"), spread=False, **options)
        b = history(feed(spark, EVENTS, METAS), processed=F.col("tx_ts"), spread=True, **options)
        assert text(a) == text(b)


def test_bulk_transaction(spark):
    from pyspark.sql import functions as F

    from ledgerflow.sources.fixtures import bulk

    feeds = bulk(spark)
    names = [ORDER, DETAIL, ITEM]
    events = unified([parse_events(feeds[n], n) for n in names], parse_metadata(feeds["METADATA"]))
    t = transactions(events).collect()
    assert len(t) == 1 and t[0]["complete"] and t[0]["have_ORDER_LINE_ITEMS"] == 350
    for spread in (False, True):
        h = history(events, spread=spread)
        sums = h.select("orderId", F.get("orders", 0).alias("o"), F.size("orderDetails").alias("d"), F.size("lineItems").alias("n"), F.aggregate("lineItems", F.lit(0.0), lambda a, i: a + i["itemAmount"]).alias("amount"), F.aggregate("lineItems", F.lit(0.0), lambda a, i: a + i["itemQty"]).alias("qty")).collect()
        assert len(sums) == 100
        for r in sums:
            i = int(r["orderId"])
            assert (r["d"], r["n"], r["qty"]) == (1, 2 + i % 4, 1000 + 10 * i) and r["amount"] == r["o"]["totalAmount"] == (1000 + 10 * i) * (25 + i / 2)
    short = unified([parse_events(feeds[n], n) for n in names[:2]], parse_metadata(feeds["METADATA"]))
    assert history(short).count() == 0


def test_strict_and_last_names(spark):
    """Exactly the announced number; names after the last dot."""
    more = [("g", ORDER, "I", "1", {"ORDER_ID": 7}), ("g", ORDER, "I", "2", {"ORDER_ID": 8}), ("h", f"S.{ORDER}", "I", "1", {"ORDER_ID": 9})]
    metas = [*METAS, ("g", want(1)), ("h", want(1))]
    complete = lambda **o: {r["xid"] for r in transactions(feed(spark, EVENTS + more, metas), **o).filter("complete").collect()}
    assert complete() == {"a", "d", "e", "f", "g"} and complete(strict=True) == {"a", "d", "f"} and "h" in complete(last=True)
    for spread in (True, False):
        got = {r["orderId"] for r in history(feed(spark, EVENTS + more, metas), spread=spread, strict=True, last=True).collect()}
        assert got == {1.0, 4.0, 9.0}
