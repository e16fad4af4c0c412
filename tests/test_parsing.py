import json

from pyspark.sql import functions as F

from ledgerflow.functions.parsing import bad_numbers, expected, normalised, parse_events, parse_metadata, row_of, typed, unified, with_transaction
from ledgerflow.functions.specs import COLLECTIONS, ORDER


def event(**over):
    return json.dumps({"table": "APPUSER.ORDERS", "op_type": "U", "op_ts": "2025-07-07 23:33:54", "pos": "1", "csn": "334516829", "xid": "1342848513.2.24.5354", "before": {"ORDER_ID": 248.0, "VERSION": 1}, "after": {"ORDER_ID": 248.0, "VERSION": 2, "ORDER_STATUS": "", "OTHER": 1}} | over)


def text(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_events_and_metadata(spark):
    meta = json.dumps({"xid": "a", "csn": "1", "tx_ts": "t", "event_count": 3, "data_collections": [{"data_collection": "ORDERS", "event_count": 2}, {"data_collection": "ORDERS", "event_count": 1}]})
    rows = unified([parse_events(text(spark, event(), "no json", event(xid=None)), "ORDERS")], parse_metadata(text(spark, meta))).collect()
    assert [r["event_type"] for r in rows] == ["ORDERS"] * 3 + ["METADATA"]
    first = rows[0]
    assert first["after"]["ORDER_ID"] == "248.0" and first["after"]["VERSION"] == "2" and first["expected_count"] is None
    assert rows[3]["expected_count"] == 3 and rows[3]["after"] is None
    kept = with_transaction(unified([parse_events(text(spark, event(), "no json", event(xid=None)), "ORDERS")]))
    assert kept.count() == 1


def test_table_names(spark):
    df = spark.createDataFrame([("A.B",), ("A.B.C",), ("B",), (None,), ("",)], "t string").select(normalised(F.col("t")))
    assert [r[0] for r in df.collect()] == ["B", "B.C", "B", None, ""]


def test_expected_counts(spark):
    df = spark.createDataFrame([([("ORDERS", 2), ("ORDERS", 1), ("X", 9)],), (None,), ([],), ([("ORDERS", None)],)], f"c {COLLECTIONS.simpleString()}")
    assert [r[0] for r in df.select(expected(F.col("c"), "ORDERS")).collect()] == [3, 0, 0, 0]


def test_typed_rows(spark):
    df = spark.createDataFrame([({"ORDER_ID": "248", "VERSION": "x", "TOTAL_AMOUNT": "", "CURRENCY": "USD", "OTHER": "1"}, None), ({}, {"ORDER_ID": "248.0"})], "after map<string,string>, before map<string,string>")
    a, b = df.select(typed(F.col("after"), ORDER).alias("r"), bad_numbers(F.col("after"), ORDER).alias("bad"), row_of(ORDER, F.col("before"), F.col("after")).alias("full")).collect()
    assert (a["r"]["orderId"], a["r"]["version"], a["r"]["totalAmount"], a["r"]["currency"], a["bad"]) == (248.0, None, None, "USD", 1)
    assert a["full"]["before"] is None and b["full"]["before"]["orderId"] == 248.0 and b["r"]["orderId"] is None


def test_exact_profile(spark):
    df = spark.createDataFrame([({"ORDER_ID": "12345678901234567890", "TOTAL_AMOUNT": "0.1"},)], "after map<string,string>")
    r = df.select(typed(F.col("after"), ORDER, exact=True).alias("r")).first()["r"]
    assert str(r["orderId"]) == "12345678901234567890" and str(r["totalAmount"]) == "0.1000"
