import random

from pyspark.sql import functions as F

from ledgerflow.functions.versions import distinct_ties, first_newest, merge_array, merge_struct, newest
from ledgerflow.functions.specs import current_type, history_type
from ledgerflow.operators.versioned import bootstrapped, combined, folded, upserted

T = "array<struct<k:double,version:double,n:string>>"


def one(spark, expression, **columns):
    df = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} {T if isinstance(v, list) or v is None else 'struct<k:double,version:double,n:string>'}" for c, v in columns.items()))
    value = df.select(expression).first()[0]
    return None if value is None else [x["n"] for x in value] if isinstance(value, list) else value["n"]


def test_newest(spark):
    assert one(spark, newest(F.col("a"), "k"), a=[(1.0, 1.0, "old"), (1.0, 2.0, "new"), (2.0, 1.0, "other")]) == ["new", "other"]
    assert one(spark, newest(F.col("a"), "k"), a=[(1.0, 2.0, "x"), (1.0, 2.0, "y")]) == ["x", "y"]  # ties stay
    assert one(spark, newest(F.col("a"), "k"), a=[(1.0, None, "x"), (1.0, 2.0, "y")]) == []  # a null version drops its key
    assert one(spark, newest(F.col("a"), "k", null_version=0), a=[(1.0, None, "x"), (1.0, 2.0, "y")]) == ["y"]
    assert one(spark, newest(F.col("a"), "k"), a=[(None, 1.0, "x"), (1.0, 2.0, "y")]) == ["y"]  # a null key may equal any
    assert one(spark, first_newest(F.col("a"), "k"), a=[]) is None
    assert one(spark, distinct_ties(F.col("a"), "k"), a=[(1.0, 2.0, "x"), (1.0, 2.0, "y"), (2.0, 2.0, "z")]) == ["x", "z"]


def test_merge_struct(spark):
    s, t = (1.0, 2.0, "s"), (1.0, 1.0, "t")
    assert one(spark, merge_struct(F.col("s"), F.col("t")), s=s, t=t) == "s"
    assert one(spark, merge_struct(F.col("t"), F.col("s")), s=s, t=t) == "s"
    assert one(spark, merge_struct(F.col("s"), F.col("t")), s=(1.0, 1.0, "s"), t=t) == "t"
    assert one(spark, merge_struct(F.col("s"), F.col("t")), s=(1.0, None, "s"), t=t) == "t"
    assert one(spark, merge_struct(F.lit(None).cast("struct<k:double,version:double,n:string>"), F.col("t")), t=t) == "t"


def test_merge_array(spark):
    m = merge_array(F.col("s"), F.col("t"), "k")
    assert one(spark, m, s=[(1.0, 2.0, "s1")], t=[(1.0, 1.0, "t1"), (2.0, 1.0, "t2")]) == ["s1", "t2"]  # the worked example: source first
    assert one(spark, m, s=[(1.0, 1.0, "s")], t=[(1.0, 1.0, "t")]) == ["t"]
    assert one(spark, m, s=[], t=[(1.0, 1.0, "t")]) == ["t"]
    assert one(spark, m, s=[(1.0, 1.0, "s")], t=None) == ["s"]
    assert one(spark, m, s=[(1.0, None, "s")], t=[(1.0, 1.0, "t")]) == []  # both go
    assert one(spark, merge_array(F.col("s"), F.col("t"), "k", null_version=0), s=[(1.0, None, "s")], t=[(1.0, 1.0, "t")]) == ["t"]


def order(i, v, status="N"):
    return (float(i), f"R{i}", v and float(v), None, None, status, None, 1.0, None, None, None, None, None)


def detail(i, v):
    return (float(i), v and float(v), None, None, None, None, None, None, None)


def item(i, o, v):
    return (float(i), float(o), v and float(v), None, 1.0, 1.0, 1.0, None, None)


def rows(spark, *data):
    return spark.createDataFrame([(f"x{n}", f"{n:05d}", f"t{n}", float(o), list(os), list(ds), list(ls)) for n, o, os, ds, ls in data], history_type())


def state(df):
    return {r["orderId"]: (r["version"], r["orderStatus"], r["orderDetails"] and r["orderDetails"]["version"], sorted((i["lineItemId"], i["version"]) for i in r["lineItems"] or [])) for r in df.collect()}


def test_upsert_rules(spark):
    first = combined(rows(spark, (1, 1, [order(1, 1)], [detail(1, 1)], [item(11, 1, 1), item(12, 1, 1)]), (2, 2, [], [detail(2, 1)], [])))
    assert set(state(bootstrapped(first))) == {1.0} and set(state(bootstrapped(first, guard=False))) == {1.0, 2.0}
    target = bootstrapped(first)
    stale = upserted(target, combined(rows(spark, (3, 1, [order(1, 1, "STALE")], [], [item(11, 1, 2)]), (4, 3, [], [], [item(31, 3, 1)]))))
    assert state(stale) == {1.0: (1.0, "N", 1.0, [(11.0, 2.0), (12.0, 1.0)])}  # children merge, the order doesn't; 3 has no order yet
    assert stale.first()["xid"] == "x3"  # the stamp is the batch's
    newer = upserted(target, combined(rows(spark, (5, 1, [order(1, 2, "NEW")], [detail(1, 1)], []), (6, 7, [order(7, 1)], [], []))))
    assert state(newer) == {1.0: (2.0, "NEW", 1.0, [(11.0, 1.0), (12.0, 1.0)]), 7.0: (1.0, "N", None, [])}
    assert state(upserted(spark.createDataFrame([], current_type()), first)) == state(target)


def test_any_split_of_versions_ends_alike(spark):
    rnd = random.Random(3)
    data, n = [], 0
    for o in range(1, 12):
        data.append((n := n + 1, o, [order(o, 1)], [detail(o, 1)], [item(o * 10 + k, o, 1) for k in range(rnd.randint(0, 3))]))
    later = []
    for o in range(1, 12):
        for v in range(2, rnd.randint(2, 5)):
            later.append((o, [order(o, v, f"S{v}")] if rnd.random() < 0.5 else [], [detail(o, v)] if rnd.random() < 0.5 else [], [item(o * 10, o, v)] if rnd.random() < 0.7 else []))
    rnd.shuffle(later)
    data += [(n := n + 1, *x) for x in later]
    whole = state(folded([rows(spark, *data)]))
    cut = 11 + len(later) // 2
    assert state(folded([rows(spark, *data[:11]), rows(spark, *data[11:cut]), rows(spark, *data[cut:])])) == whole


def test_a_null_version_hides_no_other_row(spark):
    """Items are chosen within each row first, then over the batch's rows: an item without a version is none in its own."""
    batch = rows(spark, (1, 1, [order(1, 1)], [], [item(10, 1, None), item(11, 1, 1)]), (2, 1, [], [], [item(10, 1, 2)]), (3, 2, [order(2, 1)], [], [item(20, 2, None)]))
    got = {r["orderId"]: sorted((i["lineItemId"], i["version"]) for i in r["lineItems"] or []) for r in combined(batch).collect()}
    assert got == {1.0: [(10.0, 2.0), (11.0, 1.0)], 2.0: []}


def test_parked_orders(spark):
    """Children before their order: dropped by the guard, kept without it, in whatever batches they come."""
    child, parent = rows(spark, (1, 5, [], [], [item(50, 5, 1)])), rows(spark, (2, 5, [order(5, 1)], [], []))
    first = rows(spark, (0, 1, [order(1, 1)], [], []))
    for guard, items in ((True, 0), (False, 1)):
        out = {r["orderId"]: (r["version"], len(r["lineItems"] or [])) for r in folded([first, child, parent], guard=guard).collect()}
        assert out == {1.0: (1.0, 0), 5.0: (1.0, items)}
    waiting = {r["orderId"]: r["version"] for r in folded([first, child], guard=False).collect()}
    assert waiting == {1.0: 1.0, 5.0: None}
