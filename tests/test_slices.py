"""The shared tables are built slice by slice where their sources are large."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.specs import current_type, history_type
from ledgerflow.plans import tables
from ledgerflow.plans.registry import ORACLE_SQL, QUERIES
from ledgerflow.sources.derived import raw_feeds
from ledgerflow.sources.store import Table
from ledgerflow.streaming.pipelines import merge_batch
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def sliced(spark, monkeypatch):
    """Everything is built anew, in four slices, and forgotten after."""
    monkeypatch.setattr(tables, "SLICE_BYTES", 1)
    monkeypatch.setattr(tables, "SLICES", 4)
    monkeypatch.setattr(tables, "_built", {})
    return spark


def test_slices_are_the_whole_feed(sliced):
    assert tables.slices(sliced, SF) == 4
    whole = raw_feeds(sliced, SF)
    parts = [raw_feeds(sliced, SF, (i, 4)) for i in range(4)]
    for name in ("ORDER_LINE_ITEMS", "METADATA"):
        want = sorted(r[0] for r in whole[name].collect())
        each = [[r[0] for r in p[name].collect()] for p in parts]
        assert all(each) and sorted(sum(each, [])) == want


def test_history(sliced):
    """The same rows and commits, no feed on disk, no shuffle left behind."""
    for name in ("q2_01", "q2_06", "q2_16", "before_images", "detail_items_cross", "time_travel_count"):
        compare(sliced, name, QUERIES[name], ORACLE_SQL[name], SF)
    assert {k[2] for k in tables._built} == {"history"}
    h = tables.history_table(sliced, SF)
    assert {h.part_of(f) for f in h.folders()} == {0, 1, 2, 3}


def test_current(sliced):
    """Every version is as merges wave by wave make it, but rows that a wave leaves alone are stored once."""
    for name in ("q1_09", "q1_14", "q1_15", "table_detail", "merge_order_fields"):
        compare(sliced, name, QUERIES[name], ORACLE_SQL[name], SF)
    h, c = tables.history_table(sliced, SF), tables.current_table(sliced, SF)
    assert {k[2] for k in tables._built} == {"history", "current"}
    one = Table(sliced, c.path + "-merged").create(current_type())
    text = lambda df: sorted(r[0] for r in df.select(F.to_json(F.struct(*[x for x in df.columns if x != "lineItems"], F.array_sort("lineItems").alias("lineItems")))).collect())
    for v in h.versions()[:3]:
        merge_batch(one, sliced.read.schema(history_type()).parquet(*map(h._at, h.commit_at(v).added)), v)
        assert text(c.read(v + 1)) == text(one.read(v + 1))
    rows = sum(sliced.read.parquet(c._at(f)).count() for v in c.versions() for f in c.commit_at(v).added)
    assert rows < 2 * c.read(1).count() < sum(c.read(v).count() for v in c.versions()[1:])
    assert c.commit_at(3).metrics["folders_kept"] > 0
