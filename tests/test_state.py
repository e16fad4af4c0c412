"""The current state without older versions: built without a stored history, with the same rows."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.parsing import parse_events, parse_metadata, with_transaction
from ledgerflow.plans import tables
from ledgerflow.plans.registry import ORACLE_SQL, QUERIES
from ledgerflow.sources.store import Files
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
REPORTS = ("merge_details", "merge_order_fields", "q1_02", "q1_03", "q1_04", "q1_06", "q1_07", "q1_08", "q1_09", "q1_10", "q1_11", "q1_12", "q1_13", "duplicate_check")


@pytest.fixture(params=[1, 4])
def fresh(request, spark, monkeypatch):
    """Everything is built anew, in one slice or in four, and forgotten after."""
    monkeypatch.setattr(tables, "SLICE_BYTES", 1)
    monkeypatch.setattr(tables, "SLICES", request.param)
    monkeypatch.setattr(tables, "_built", {})
    return spark


def texts(df):
    return sorted(r[0] for r in df.select(F.to_json(F.struct(*[x for x in df.columns if x != "lineItems"], F.array_sort("lineItems").alias("lineItems")))).collect())


def test_reports_store_neither_history_nor_old_versions(fresh):
    for name in REPORTS:
        compare(fresh, name, QUERIES[name], ORACLE_SQL[name], SF)
    assert {k[2] for k in tables._built} == {"state"}
    state, rows = tables.state_table(fresh, SF)
    files = Files(fresh, state.path)
    home, own = state.path.rpartition("/")[::2]
    assert not [n for n in files.names(home) if n.startswith(f"{own}-")]  # the slices' histories are gone
    stored = sum(fresh.read.parquet(f"{state.path}/data/{n}").count() for n in files.names(f"{state.path}/data"))
    assert stored == state.read().count() > 0
    assert rows == tables.history_table(fresh, SF).read().count()
    assert texts(state.read()) == texts(tables.current_table(fresh, SF).read())
    assert tables.state_table(fresh, SF) == (tables.current_table(fresh, SF), rows)


def test_state_from_a_stored_history(fresh):
    tables.history_table(fresh, SF)
    for name in ("q1_07", "q1_09", "merge_order_fields"):
        compare(fresh, name, QUERIES[name], ORACLE_SQL[name], SF)
    assert {k[2] for k in tables._built} == {"history", "state"}


def test_a_text_is_parsed_once(spark):
    raw = spark.createDataFrame([(1, "x")], "a int, b string").select(F.to_json(F.struct("a", "b")).alias("value"))
    for rows in (parse_events(raw, "ORDERS"), parse_metadata(raw)):
        plan = with_transaction(rows)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") + plan.count("JsonToStructs(") == 1, plan


def test_text_that_is_no_event(spark):
    raw = spark.createDataFrame([("{",), (None,), ("[]",), ('{"xid": "1", "csn": "2", "after": {"A": "3"}}',)], "value string")
    rows = parse_events(raw, "ORDERS")
    assert rows.count() == 4 and [(r["xid"], r["after"]) for r in with_transaction(rows).collect()] == [("1", {"A": "3"})]
