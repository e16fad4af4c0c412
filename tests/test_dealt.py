"""For the current state the sources' rows are dealt by order; their events, transactions and states aren't dealt again."""

from ledgerflow.plans import tables
from ledgerflow.plans.registry import ORACLE_SQL, QUERIES
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


def shuffled(spark) -> int:
    """Rows that the session's stages have written for a shuffle so far."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    stages = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_only_the_sources_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(tables, "_built", {})
    before = shuffled(spark)
    state, rows = tables.state_table(spark, SF)
    moved = shuffled(spark) - before
    orders, items = (spark.read.parquet(f"{SF}/{n}.parquet").count() for n in ("orders", "lineitem"))
    assert items < moved < 4 * orders + 2 * items + 1000  # events and metadata are made of both; 1000: small jobs
    assert rows > state.read().count() > 0
    for name in ("merge_order_fields", "q1_07", "q1_09"):
        compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF)


def test_slices_follow_rows_however_small_their_files_are(spark, tmp_path):
    """Rows that compress well have as many events as others."""
    n = 4_000_000
    spark.range(n).selectExpr("id div 4 AS l_orderkey", "0 AS l_quantity").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(n // 4).selectExpr("id AS o_orderkey").coalesce(1).write.option("compression", "zstd").parquet(f"{tmp_path}/orders.parquet")
    rows = n + n // 4
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet") if f.is_file()) < tables.SLICE_BYTES
    slices = tables.slices(spark, str(tmp_path))
    assert slices == 4 and rows / slices / tables.places(spark, str(tmp_path), slices) < 120_000
